"""Repeated lines lose all copies but those in the first document that holds them.

Two Bloom filters find suspects without moving a line: one of hashes seen once, one of hashes
seen again. Scan tasks send the sorted hashes of their lines, each once and compressed to gaps, to the
shard of the filters they belong to: hashes of all lines move, lines do not. A shard is built by one task,
with as many bits as its hashes call for, and its second filter is written to the shared folder, where
the next scan maps it into memory. Only lines that it suspects are shuffled, as whole keys, so
that a false alarm of the filter is found out.

A line's key is the line without white space at both ends, A-Z lower-cased; shorter keys than
``least`` code points are never dropped. NULL and empty texts are one empty line. Rows with a NULL
``doc_id`` count as one document after all others; rows that share an id are one document; neither keeps more
than its own text's lines together, so they spread over tasks. Texts of any length are split where they are. An empty
table gives no rows. Columns of other names are carried along, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm import common
from herald.llm.common import by_key, pack, pack_counts, pieces, runs, unpack, unpack_counts, utf8
from herald.scale import keyed_join, settle

LEAST = 10
#: Words of 64 bits that a shard's filter has at least, bits per hash, and hashes held before they are sent off.
SHARD_WORDS, HASH_BITS, HELD = 1 << 12, 12, 1_000_000


def line_keys(text: bytes) -> list[bytes]:
    return [line.strip().lower() for line in text.split(b"\n")]


def long_keys(keys: list[bytes], least: int) -> set[bytes]:
    """The distinct keys of a document with at least ``least`` code points."""
    return {k for k in keys if len(k) >= 4 * least or len(k) >= least and len(k.decode()) >= least}


def digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def places(h: np.ndarray, n: int, words: int = SHARD_WORDS) -> np.ndarray:
    """Position of the filter word inside its shard, which has so many."""
    rest = ((h >> np.uint64(32)) * np.uint64(n)) & np.uint64(0xFFFFFFFF)
    return ((rest * np.uint64(words)) >> np.uint64(32)).astype(np.int64)


def bits(h: np.ndarray) -> np.ndarray:
    """Four bits of a word."""
    out = np.zeros(len(h), np.uint64)
    for shift in (0, 6, 12, 18):
        out |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return out


def build(blobs, n: int) -> np.ndarray:
    """The filter of a shard's hashes that were seen again. ``blobs``: (hashes, documents), a number of
    times; its size follows from theirs."""
    blobs = list(blobs)
    words = max(SHARD_WORDS, -(-sum(len(h) for h, _ in blobs) * HASH_BITS // 64))
    once, again = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    for h, count in blobs:
        at, b = places(h, n, words), bits(h)
        seen = ((once[at] & b) == b) | (count > 1)
        for filter_, rows in ((again, np.flatnonzero(seen)), (once, np.arange(len(h)))):
            if len(rows):
                first = rows[np.flatnonzero(np.diff(at[rows], prepend=-1))]
                starts = np.searchsorted(rows, first)
                filter_[at[first]] |= np.bitwise_or.reduceat(b[rows], starts)
    return again


class Suspects:
    """The second filter, memory-mapped shard by shard."""

    def __init__(self, folder: str, n: int, present: frozenset[int]):
        self.folder, self.n, self.present, self._open = folder, n, present, {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def holds(self, h: np.ndarray) -> np.ndarray:
        """For sorted hashes: whether the filter has them."""
        out = np.zeros(len(h), bool)
        for shard, at in common.cut_by_shard(h, self.n):
            if shard in self.present:
                if shard not in self._open:
                    self._open[shard] = common.mapped(f"{self.folder}/again-{shard:06d}", "<u8")
                b, own = bits(h[at]), self._open[shard]
                out[at] = (own[places(h[at], self.n, len(own))] & b) == b
        return out


def suspects_filter(rows: DataFrame, least: int) -> Suspects:
    spark = rows.sparkSession
    n, folder = common.shards(spark), common.new_folder(spark, "line-filter")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held):
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            cut = list(common.cut_by_shard(keys, n))
            return pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in cut], pa.int32()),
                 pa.array([pack(keys[at]) for _, at in cut], pa.binary()),
                 pa.array([pack_counts(counts[at]) for _, at in cut], pa.binary())],
                ["shard", "keys", "counts"])

        held, size = [], 0
        for batch in pieces(batches):
            for text in utf8(batch):
                held.append(hashes(long_keys(line_keys(text), least)))
                size += len(held[-1])
            if size > HELD:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "shard"):
            shard = group.column("shard")[0].as_py()
            again = build(((unpack(k), unpack_counts(c)) for k, c in
                           zip(group.column("keys").to_pylist(), group.column("counts").to_pylist())), n)
            if again.any():
                common.write_shard(folder, shard, again=again)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], ["shard"])

    sent = rows.select("text").mapInArrow(send, "shard int, keys binary, counts binary")
    built = by_key(sent, max(1, n // 4), "shard").mapInArrow(merge, "shard int")
    return Suspects(folder, n, frozenset(r.shard for r in built.collect()))  # at most n numbers


def repeated(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, tie, digest) of every line that the document has to give up: its key's 128-bit hash,
    so that keys themselves are shuffled once only. ``rows``: doc_id, tie and text, which is never NULL."""
    found = suspects_filter(rows, least)

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            at, keys = [], []
            for i, text in enumerate(utf8(batch)):
                own = list(long_keys(line_keys(text), least))
                at += [i] * len(own)
                keys += own
            h = hashes(keys)
            order = np.argsort(h)
            hit = order[found.holds(h[order])]
            own = pa.array(np.array(at, np.int64)[hit])
            some = [keys[i] for i in hit.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(own), batch.column("tie").take(own), pa.array(some, pa.binary()),
                 pa.array(list(map(digest, some)), pa.binary())], ["doc_id", "tie", "key", "digest"])

    lines = settle(rows.mapInArrow(suspect, "doc_id bigint, tie bigint, key binary, digest binary"),
                   "suspected-lines")
    first = lines.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                     F.bool_or(F.col("doc_id").isNull()).alias("none"),
                                     F.first("digest").alias("digest"))
    first = first.filter((F.col("first") < F.col("last")) | (F.col("first").isNotNull() & F.col("none")))
    held = keyed_join(lines.select("doc_id", "tie", "digest"), settle(first.select("digest", "first"), "repeated-lines"),
                      ["digest"], "inner")
    return held.filter(F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first"))).select("doc_id", "tie", "digest")


def dedup_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(row, n_lines, n_dropped, kept): every row of ``docs`` as a struct with all its columns,
    lines before dropping, lines dropped, and the text without them."""
    text, ident = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("bigint")
    rows = docs.select(
        F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), ident.alias("doc_id"),
        # rows without an id are told apart by their texts
        F.when(ident.isNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("bigint")).alias("tie"), text.alias("text"))
    drops = repeated(rows.select("doc_id", "tie", "text"), least)
    key = [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("ident"), "tie"]
    per_doc = drops.select(*key, "digest").groupBy("none", "ident", "tie").agg(F.collect_set("digest").alias("drop"))
    # Always a shuffle of both sides, as at any size a third of the documents may have something to give
    # up; an id with very many rows is split by the adaptive skew join.
    joined = rows.select("row", "text", *key).join(per_doc, ["none", "ident", "tie"], "left").select("row", "text", "drop")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lines, gone, kept = [], [], []
            for text, drop in zip(utf8(batch), batch.column("drop").to_pylist()):
                own = text.split(b"\n")
                if drop:
                    drop = set(drop)
                    left = [x for x in own if digest(x.strip().lower()) not in drop]
                    text = b"\n".join(left)
                lines.append(len(own))
                gone.append(len(own) - len(left) if drop else 0)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["row", "n_lines", "n_dropped", "kept"])

    row = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(rewrite, f"row {row}, n_lines bigint, n_dropped bigint, kept string")


def without_repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The documents with their remaining lines as ``text`` and, where there is such a column,
    ``n_chars`` counted anew; other columns as they were."""
    done = dedup_lines(docs, least)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("kept").alias(c))
        elif c == "n_chars":
            columns.append(F.length("kept").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return done.select(*columns)
