"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; it takes the vectors whose cosine with it reaches a threshold. The
directions are product codes: space, turned at random, is cut into blocks of dimensions, each
block has a few random code words, and a direction is one word of every block. A vector is
list-decoded to all directions that take it: block by block, partial sums that cannot reach the
threshold any more are dropped, so the directions are never gone through one by one. Vectors meet in
the filters they share and are verified there in double precision.

``plan`` chooses threshold and number of directions from the number of vectors, the dimensions,
the cosine and the wanted recall alone: caps so small that a filter takes about ``OCCUPANCY`` unrelated vectors, and so
many directions that a pair at the wanted cosine shares one. The chance holds for any data, since the directions are
random; closer pairs share more of them. Inner products are taken between whole numbers, so a vector has
the same list in every task that decodes it.

Equal vectors are one row until the end. A filter with more than ``PIECE`` vectors, as a cluster of
near copies makes it, is dealt into pieces, and each pair of pieces is a block of its own: nothing is
dropped, and a task holds two pieces at most. Such a cluster costs the square of its size, in blocks; no
pairs leave them. A pair is counted in the first filter that both
vectors share; a block gives one row per linked vector with its count and a tie to its class.

Vectors that are NULL, all zeros, empty, or hold NULL or non-finite components link with nothing, and nor
do vectors of different lengths. Equal vectors link with each other. Rows without an id take part; the class of
rows without any id has a NULL id and all its rows are kept. Rows that repeat an id are rows of their own. An empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.common import settle_narrow
from herald.llm.components import components
from herald.llm.vectors import finite, lengths, matrix
from herald.scale import keyed_join, settle

#: Unrelated vectors that a filter takes on average.
OCCUPANCY = 128
#: Vectors of a filter that are compared in one block.
PIECE = 2048
#: Independent codes, each turned its own way. Directions of one code share words, so a pair that
#: one of them misses is likelier missed by the others; 64 codes bring the measured recall to the planned one.
CODES = 64
#: A block has at most so many words; more directions take more blocks.
WORDS = 256
#: Fewer dimensions are filled up with zeros, which leaves cosines as they are.
LEAST_DIMS = 16
SEED = 12
_VECTOR_BITS, _WORD_BITS = 20, 14


# --- how many filters, and how large ------------------------------------------------------

def _tail(dims: int):
    """P(first coordinate >= x) on the unit sphere, as a function."""
    grid = np.linspace(-1, 1, 20_001)
    density = np.maximum(1 - grid ** 2, 0) ** ((dims - 3) / 2)
    total = np.concatenate(([0.0], np.cumsum((density[1:] + density[:-1]) / 2)))
    above = 1 - total / total[-1]
    return lambda x: np.interp(x, grid, above)


def _both(dims: int, cosine: float, threshold: float) -> float:
    """P(a random direction takes both of two vectors at ``cosine``)."""
    x = np.linspace(threshold, 1, 4001)[:-1]
    density = (1 - x ** 2) ** ((dims - 3) / 2)
    whole = np.linspace(-1, 1, 20_001)
    norm = np.trapezoid((1 - whole ** 2).clip(0) ** ((dims - 3) / 2), whole)
    need = (threshold - x * cosine) / (np.sqrt(1 - x ** 2) * math.sqrt(1 - cosine ** 2))
    return float(np.trapezoid(density * _tail(dims - 1)(need), x) / norm)


@dataclass(frozen=True)
class Plan:
    dims: int
    threshold: float
    blocks: int
    words: int  # per block

    @property
    def filters(self) -> int:
        return CODES * self.words ** self.blocks


def plan(n: int, dims: int, cosine: float, recall: float) -> Plan:
    dims = max(LEAST_DIMS, dims)
    tail, share = _tail(dims), min(0.2, OCCUPANCY / max(n, 1))
    low, high = 0.0, 0.999
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) > share else (low, middle)
    filters = -math.log(1 - recall) / _both(dims, cosine, low)
    blocks = 2
    while filters > CODES * WORDS ** blocks and blocks < dims // 4:
        blocks += 1
    return Plan(dims, low, blocks, math.ceil((filters / CODES) ** (1 / blocks)))


# --- list decoding --------------------------------------------------------------------------

@functools.lru_cache(maxsize=2)
def code_words(p: Plan) -> list[np.ndarray]:
    """Per block: words (codes x words x dims) as whole numbers, in the space of the vectors."""
    draw = np.random.Generator(np.random.PCG64(SEED))
    size = p.dims // p.blocks
    out = [np.empty((CODES, p.words, p.dims)) for _ in range(p.blocks)]
    for c in range(CODES):
        turn, _ = np.linalg.qr(draw.standard_normal((p.dims, p.dims)))
        for b in range(p.blocks):
            # the last block takes what is left over
            part = turn[b * size:(b + 1) * size if b + 1 < p.blocks else p.dims]
            words = draw.standard_normal((p.words, len(part)))
            words /= np.linalg.norm(words, axis=1, keepdims=True) * math.sqrt(p.blocks)
            out[b][c] = np.rint(words @ part * (1 << _WORD_BITS))
    return out


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one. Squares are added dimension by dimension, so that the result for a
    row does not depend on the rows around it."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    square = np.zeros(len(x))
    for j in range(x.shape[1]):
        square += x[:, j] * x[:, j]
    return x / np.sqrt(square)[:, None]


def decode(unit: np.ndarray, p: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every filter that takes a row, in order of the rows. All codes are
    walked at once: each row is one row per code."""
    whole = np.rint(unit * (1 << _VECTOR_BITS))
    need = math.ceil(p.threshold * (1 << _VECTOR_BITS + _WORD_BITS))
    step = max(1, (1 << 23) // (CODES * p.words * max(16, p.words // 4)))
    rows, filters = [], []
    for start in range(0, len(whole), step):
        part = whole[start:start + step]
        dots = [(part @ words.reshape(-1, p.dims).T).reshape(-1, p.words) for words in code_words(p)]
        rest = np.zeros(len(part) * CODES)  # the most that the blocks to come can add
        goal = [np.full(len(rest), float(need))]
        for d in dots[:0:-1]:
            rest = rest + d.max(axis=1)
            goal.append(need - rest)
        row = np.arange(len(rest))
        code, sofar = row % CODES, np.zeros(len(row))
        for d, least in zip(dots, goal[::-1]):
            at, word = np.nonzero(d[row] >= (least[row] - sofar)[:, None])
            sofar = sofar[at] + d[row[at], word]
            row, code = row[at], code[at] * p.words + word
        rows.append(row // CODES + start)
        filters.append(code)
    return np.concatenate([np.empty(0, np.int64), *rows]), np.concatenate([np.empty(0, np.int64), *filters])


# --- one block of a filter ------------------------------------------------------------------

def _linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    out = np.empty((len(a), len(b)), bool)
    for i in range(0, len(a), 512):
        out[i:i + 512] = a[i:i + 512] @ b.T >= cosine
    return out


def _earlier(unit: np.ndarray, need: np.ndarray, here: int, p: Plan) -> np.ndarray:
    """Bits of the filters before ``here`` that take at least two of the needed rows; a row of
    words per row of ``unit``."""
    at = np.flatnonzero(need)
    row, name = decode(unit[at], p)
    row, name = at[row[name < here]], name[name < here]
    names, number, count = np.unique(name, return_inverse=True, return_counts=True)
    often = np.cumsum(count > 1) - 1
    row, number = row[count[number] > 1], often[number[count[number] > 1]]
    bits = np.zeros((len(unit), max(1, -(-int((count > 1).sum()) // 64))), np.uint64)
    np.bitwise_or.at(bits, (row, number >> 6), np.uint64(1) << (number & 63).astype(np.uint64))
    return bits


def _classes(linked: np.ndarray) -> np.ndarray:
    """Class number of each row of a symmetric matrix of links: rows are walked once each."""
    n = len(linked)
    label = np.full(n, -1)
    for i in range(n):
        if label[i] >= 0:
            continue
        label[i], edge = i, np.array([i])
        while len(edge):
            edge = np.flatnonzero(linked[edge].any(axis=0) & (label < 0))
            label[edge] = i
    return label


def block_links(here: int, unit: np.ndarray, size: np.ndarray, copies: np.ndarray, left: np.ndarray,
                across: bool, cosine: float, p: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with links in a block, the vectors (copies included) each is counted with here, and a row that
    stands for its class. ``across``: pairs of a row marked ``left`` and one not marked; else all pairs."""
    linked = _linked(unit, unit, cosine) & (size[:, None] == size)
    np.fill_diagonal(linked, False)
    linked |= linked.T  # rounding must not differ by direction
    if across:
        linked &= left[:, None] != left
    need = linked.any(axis=1)
    rows = np.flatnonzero(need)
    if not len(rows):
        return rows, rows, rows
    linked = linked[np.ix_(rows, rows)]
    bits = _earlier(unit[rows], np.ones(len(rows), bool), here, p)
    count = np.zeros(len(rows), np.int64)
    step = max(1, (1 << 21) // (len(rows) * bits.shape[1]))
    for start in range(0, len(rows), step):
        i, j = np.nonzero(linked[start:start + step])
        first = ~(bits[i + start] & bits[j]).any(axis=1)
        count += np.bincount(i[first] + start, copies[rows[j[first]]], len(rows)).astype(np.int64)
    return rows, count, rows[_classes(linked)]


def _grouped(batches, columns: list[str]) -> Iterator[pa.Table]:
    """Rows that agree in ``columns``, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in columns], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for start, stop in zip(cuts, cuts[1:]):
            key = tuple(keys[start])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


# --- the join ---------------------------------------------------------------------------------

def classes(df: DataFrame) -> DataFrame:
    """(cid, vector, low, copies): each distinct vector that can link, with its smallest id."""
    each = df.filter(F.col("vector").isNotNull()).groupBy("vector").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    return settle(each.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, vector): NULL where the vector links with nothing. Minus zero is zero."""
    vector = F.col("embedding")
    number = vector.cast("array<double>")
    good = finite(vector) & F.exists(number, lambda x: x != 0)
    return df.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                     F.when(good, F.transform(number, lambda x: x + F.lit(0.0)).cast(df.schema["embedding"].dataType))
                     .alias("vector"))


def _decoded(each: DataFrame, p: Plan, carry: bool) -> DataFrame:
    """(filter) or (filter, cid, copies, vector), a row per filter that takes a vector."""
    kind = each.schema["vector"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                row, name = decode(units(matrix(part.column("vector"), p.dims, np.float64)), p)
                if carry:
                    for some in range(0, len(row), 20_000):
                        at = pa.array(row[some:some + 20_000])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(name[some:some + 20_000]), *(part.column(c).take(at) for c in ("cid", "copies", "vector"))],
                            ["filter", "cid", "copies", "vector"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(name)], ["filter"])

    if carry:
        return each.select("cid", "copies", "vector").mapInArrow(
            work, f"filter long, cid long, copies long, vector {kind}")
    return each.select("vector").mapInArrow(work, "filter long")


def links(each: DataFrame, p: Plan, cosine: float) -> DataFrame:
    """(cid, n, root): per block, vectors with links, how many are counted there, and another
    vector of the same class."""
    tasks = int(each.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = _decoded(each, p, False).groupBy("filter").count()
    hot = settle(sizes.filter(F.col("count") > PIECE).select(
        "filter", F.ceil(F.col("count") / PIECE).cast("int").alias("parts")), "large-filters")
    rows = keyed_join(_decoded(each, p, True), hot, ["filter"], "left")
    parts = F.coalesce("parts", F.lit(1))
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("cid"), parts).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.select("filter", F.least("piece", "other").alias("a"), F.greatest("piece", "other").alias("b"),
                       (F.col("piece") <= F.col("other")).alias("low"), "cid", "copies", "vector")
    key = ["filter", "a", "b"]

    def work(batches):
        for table in _grouped(batches, key):
            if table.num_rows < 2:
                continue
            block = table.combine_chunks().to_batches()[0]
            vector, cid = block.column("vector"), block.column("cid").to_numpy()
            at, count, root = block_links(
                block.column("filter")[0].as_py(), units(matrix(vector, p.dims, np.float64)), lengths(vector),
                block.column("copies").to_numpy(), block.column("low").to_numpy(zero_copy_only=False),
                block.column("a")[0] != block.column("b")[0], cosine, p)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(count), pa.array(cid[root])],
                                                 ["cid", "n", "root"])

    dealt = rows.repartition(tasks, *key).sortWithinPartitions(*key)
    return settle(dealt.mapInArrow(work, "cid long, n long, root long"), "vector-links")


def near_vectors(df: DataFrame, cosine: float = 0.9, recall: float = 0.999999) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = usable(df)
    each = classes(rows)
    n, width = each.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    found = links(each, plan(n, width or 1, cosine, recall), cosine)
    counts = found.groupBy("cid").agg(F.sum("n").alias("n"))
    tied = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")).distinct())
    tied = settle_narrow(tied, "vector-components")
    low = each.select(F.col("cid").alias("node"), "low").join(tied, "node").groupBy("label").agg(
        F.min("low").alias("class_low"))
    named = keyed_join(tied, low, ["label"], "left").select(F.col("node").alias("cid"), "class_low")
    about = each.join(counts, "cid", "left").join(named, "cid", "left").select(
        "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("class_low", "low").alias("class_id"))
    result = keyed_join(rows, settle(about, "vector-about"), ["vector"], "left")
    class_id = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("class_id"))
    result = result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                           class_id.alias("component_id"))
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
