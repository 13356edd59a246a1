"""Near-duplicate documents: an n-gram Jaccard join by blocked sparse matrix products.

Documents are rows of a 0/1 matrix over word n-grams. Two link if their sets' Jaccard similarity
reaches ``percent``; a document's class is everything reachable over links. No link is lost:

1. Every n-gram that two documents share is found by merging sorted hashes, shard by shard. The
   table of shared n-grams, with the number of documents of each, is mapped by the next scan.
2. In the order rare to common, linked sets must share one of the first
   ``size - ceil(size * percent) + 1`` n-grams. Only those that are shared at all are posted, so
   documents that resemble nothing post nothing. Equal sets are one row of the matrix from here on.
3. Documents posted under one n-gram are compared by size and by a histogram of their hashes,
   whose difference can't exceed the difference of the sets: pairs below the bound are discarded
   without their sets. What is left spans clusters; no link leads out of one.
4. Inside a cluster the blocked product of the incidence matrix with itself accumulates overlap
   counts exactly, and pairs below the bound that their sizes give are discarded. A task emits a
   spanning forest of its links, never the pairs. A cluster of more than a block is dealt over
   tasks: each block meets itself and some pivots; then rows outside the largest class meet all.

The same hash of a text's n-gram set stands for it, so copies cost one row. Documents without
words, NULL texts included, link with nothing. Fewer words than ``width`` make one shingle. Rows
that share an id keep their own entry each. A class without any id is NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald.llm import common
from herald.llm.common import (
    SortedTable,
    WordHashes,
    by_key,
    cut_by_shard,
    mixed,
    pack,
    pieces,
    runs,
    settle_narrow,
    shingles,
    texts,
    unpack,
    utf8,
    whole_groups,
    words_lower,
)
from herald.llm.components import components
from herald.scale import keyed_join, settle

WIDTH, PERCENT = 4, 85
#: Hashes held by a scan task before they are sent to their shards.
HELD = 2_000_000
#: Buckets of a set's histogram.
BUCKETS = 32
#: Postings of one n-gram up to which they are compared in one task; above, its documents are
#: put into one cluster without comparing them.
POSTINGS = 4096
#: Documents per block of the product, and pivots of a cluster that has several blocks.
BLOCK, PIVOTS = 1024, 64
#: N-grams per block: blocks of long documents hold fewer of them, and such clusters fewer pivots.
BLOCK_GRAMS = 1 << 22
#: Columns of the product that are worked on at once.
COLUMNS = 4096


def sets(batch: pa.RecordBatch, hashes: WordHashes, width: int) -> list[np.ndarray]:
    return [shingles(hashes.of(words_lower(t)), width) for t in utf8(batch)]


# --- 1: n-grams that documents share ---------------------------------------------------

def shared_ngrams(rows: DataFrame, width: int) -> SortedTable:
    """The n-grams of two documents or more, with their number of documents (255 at most: only
    the order matters). A table as large as what the corpus repeats, in shards by hash."""
    spark = rows.sparkSession
    n, folder = common.shards(spark), common.new_folder(spark, "shared-ngrams")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held):
            keys = np.sort(np.concatenate(held) >> np.uint64(16))
            cut = list(cut_by_shard(keys << np.uint64(16), n))
            return pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in cut], pa.int32()),
                 pa.array([pack(keys[at]) for _, at in cut], pa.binary())], ["shard", "keys"])

        hashes, held, size = WordHashes(), [], 0
        for batch in pieces(batches):
            held += sets(batch, hashes, width)
            size = sum(map(len, held))
            if size > HELD:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "shard"):
            shard = group.column("shard")[0].as_py()
            keys = np.sort(np.concatenate([unpack(k) for k in group.column("keys").to_pylist()]))
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            counts = np.diff(first, append=len(keys))
            often = counts > 1
            if often.any():
                common.write_shard(folder, shard, keys=keys[first[often]] << np.uint64(16),
                                   docs=np.minimum(counts[often], 255).astype(np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([int(often.sum())], pa.int64())],
                    ["shard", "keys"])

    sent = rows.select("text").mapInArrow(send, "shard int, keys binary")
    built = by_key(sent, max(1, n // 4), "shard").mapInArrow(merge, "shard int, keys bigint")
    present = {r.shard: r["keys"] for r in built.collect()}  # a number per shard
    return SortedTable(folder, n, present, {"docs": "u1"})


# --- 2: profiles -----------------------------------------------------------------------

PROFILE = ("doc_id bigint, tie bigint, print binary, n_shingles bigint, prefix array<bigint>, "
           "histogram binary, grams binary")
_PROFILE = [c.split()[0] for c in PROFILE.split(", ")]


def prefix_length(size: int, percent: int) -> int:
    """Linked sets share ``ceil(size * percent / 100)`` n-grams, so one of so many first ones."""
    return size - -(-size * percent // 100) + 1


def histogram(grams: np.ndarray) -> np.ndarray:
    return np.bincount((mixed(grams) >> np.uint64(59)).astype(np.int64), minlength=BUCKETS)


def stored(hist: np.ndarray) -> bytes:
    """Counts of 16 bits where all fit, else of 32: a text has under 2^32 n-grams."""
    return hist.astype("<u2" if hist.max() < 1 << 16 else "<u4").tobytes()


def histograms(rows: list[bytes]) -> np.ndarray:
    narrow = np.array([len(r) == 2 * BUCKETS for r in rows], bool)
    if narrow.all():
        return np.frombuffer(b"".join(rows), "<u2").reshape(-1, BUCKETS)
    out = np.empty((len(rows), BUCKETS), np.uint32)
    for kind, which in (("<u2", narrow), ("<u4", ~narrow)):
        some = b"".join([rows[i] for i in np.flatnonzero(which)])
        out[which] = np.frombuffer(some, kind).reshape(-1, BUCKETS)
    return out


def profiles(rows: DataFrame, shared: SortedTable, width: int, percent: int) -> DataFrame:
    """Per document its set's fingerprint and size; where its prefix holds shared n-grams, also
    those, the histogram and the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches):
            found = sets(batch, hashes, width)
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate([*found, np.empty(0, np.uint64)])
            order = np.argsort(flat)
            docs = np.empty(len(flat), np.uint8)
            docs[order] = shared.find(flat[order] >> np.uint64(16) << np.uint64(16), "docs", 1)
            out = []
            ids = zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist())
            for i, ((doc, tie), grams) in enumerate(zip(ids, found)):
                df, n, prefix = docs[ends[i]:ends[i + 1]], len(grams), []
                if n:
                    length = prefix_length(n, percent)
                    unique = int((df == 1).sum())
                    if unique < length:  # common ones follow by number of documents, then hash
                        rest = np.flatnonzero(df > 1)
                        rest = rest[np.argsort(df[rest], kind="stable")][:length - unique]
                        prefix = grams[rest].view(np.int64).tolist()
                # the set's hash; the empty set needs none, as it meets no other
                out.append((doc, tie, xxhash.xxh3_128_digest(grams.tobytes()) if n else None, n, prefix,
                            stored(histogram(grams)) if prefix else None,
                            pack(grams) if prefix else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary(),
                    pa.binary()))],
                _PROFILE)

    return settle(rows.mapInArrow(run, PROFILE), "ngram-profiles")


# --- 3: clusters -----------------------------------------------------------------------

def least_overlap(a, b, percent: int):
    """Overlap that sets of these sizes need: 100 * o >= percent * (a + b - o)."""
    return -(-(a + b) * percent // (100 + percent))


def alike(size, hist, sizes, hists, percent: int) -> np.ndarray:
    """Which sets can be linked to one: sets overlap in no more than their histograms do."""
    need = least_overlap(size + sizes, 0, percent)
    fits = np.minimum(size, sizes) >= need
    out = np.zeros(len(sizes), bool)
    some = np.flatnonzero(fits)
    out[some] = np.minimum(hists[some], hist).sum(1) >= need[some]
    return out


def spanning(sizes: np.ndarray, hists: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that span the classes of possible links, found by growing one class at a time."""
    left, edges = np.arange(len(sizes)), []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            hit = alike(sizes[at], hists[at], sizes[left], hists[left], percent)
            edges += [(at, int(x)) for x in left[hit]]
            queue += left[hit].tolist()
            left = left[~hit]
    return edges


#: Groups of up to so many postings are compared all at once.
FEW = 8


def possible_links(table: pa.Table, percent: int) -> Iterator[tuple[bytes, bytes]]:
    """Pairs that may link, spanning each n-gram's classes of such pairs."""
    grams, sizes = table.column("gram").to_numpy(), table.column("n_shingles").to_numpy()
    first = np.flatnonzero(np.diff(grams, prepend=grams[0] - 1))
    ends = np.append(first[1:], len(grams))
    rows = np.repeat(ends - first, ends - first)
    stop = np.repeat(ends, ends - first)
    prints = table.column("print").combine_chunks()
    hists = histograms(table.column("histogram").to_pylist())
    for step in range(1, FEW):
        i = np.flatnonzero((rows <= FEW) & (np.arange(len(grams)) + step < stop))
        need = least_overlap(sizes[i], sizes[i + step], percent)
        fits = np.minimum(sizes[i], sizes[i + step]) >= need
        i, need = i[fits], need[fits]
        i = i[np.minimum(hists[i], hists[i + step]).sum(1) >= need]
        yield from zip(prints.take(pa.array(i)).to_pylist(), prints.take(pa.array(i + step)).to_pylist())
    for start, end in zip(first, ends):
        if end - start > FEW:
            names = prints.slice(start, end - start).to_pylist()
            for i, j in spanning(sizes[start:end], hists[start:end], percent):
                yield names[i], names[j]


def candidate_edges(profile: DataFrame, percent: int) -> DataFrame:
    """(a, b) fingerprints whose clusters belong together."""
    spark = profile.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    posts = (profile.filter(F.size("prefix") > 0)
             .select(F.explode("prefix").alias("gram"), "print", "n_shingles", "histogram")
             .groupBy("gram", "print").agg(F.first("n_shingles").alias("n_shingles"),
                                           F.first("histogram").alias("histogram")))
    posts = settle(posts, "ngram-postings")
    sizes = settle_narrow(posts.groupBy("gram").agg(F.count(F.lit(1)).alias("docs"), F.min("print").alias("hub"))
                   .filter(F.col("docs") > POSTINGS).select("gram", "hub"), "ngram-hot")
    if sizes.isEmpty():
        hot, normal = None, posts
    else:
        hot = keyed_join(posts.select("gram", "print"), sizes, ["gram"], "inner").select(
            F.col("hub").alias("a"), F.col("print").alias("b"))
        normal = keyed_join(posts, sizes, ["gram"], "left_anti")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[bytes, bytes]] = set()
        for table in whole_groups(batches, "gram"):
            seen.update(possible_links(table, percent))
            if len(seen) > 50_000:
                yield _pairs(*zip(*seen))
                seen.clear()
        if seen:
            yield _pairs(*zip(*seen))

    edges = by_key(normal, parts, "gram", "n_shingles", "print").mapInArrow(compare, "a binary, b binary")
    if hot is not None:
        edges = edges.unionByName(hot.filter(F.col("a") != F.col("b")))
    return settle_narrow(edges.distinct(), "ngram-candidates")


# --- 4: exact products inside clusters -------------------------------------------------

class Forest:
    """Classes of what has been joined so far."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: the product of the two incidence matrices, accumulated over
    blocks of columns. Columns that only one side has are left out."""
    flat = np.concatenate(left + right)
    columns, place = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    both = np.bincount(place[row < len(left)], minlength=len(columns)).astype(bool)
    both &= np.bincount(place[row >= len(left)], minlength=len(columns)).astype(bool)
    keep = both[place]
    rank = np.cumsum(both) - 1
    row, place = row[keep], rank[place[keep]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, int(both.sum()), COLUMNS):
        i, j = np.searchsorted(place, [start, start + COLUMNS])
        block = np.zeros((len(left) + len(right), min(COLUMNS, int(both.sum()) - start)), np.float32)
        block[row[i:j], place[i:j] - start] = 1
        out += (block[:len(left)] @ block[len(left):].T).astype(np.int64)
    return out


def links(every: list[np.ndarray], main: int, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of one of the first ``main`` sets and any that reach the similarity, in blocks of
    the product; a pair of two of the first ones is met once."""
    small = 256
    for i in range(0, main, small):
        for j in range(i, len(every), small):
            some, more = every[i:min(i + small, main)], every[j:j + small]
            a, b = np.array([len(x) for x in some])[:, None], np.array([len(x) for x in more])[None, :]
            need = least_overlap(a, b, percent)
            if (np.minimum(a, b) < need).all():
                continue
            for x, y in zip(*np.nonzero(overlaps(some, more) >= need)):
                yield i + int(x), j + int(y)


PAIR = "a binary, b binary"


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def block_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Spanning links of every block. ``side`` 0 rows meet all; ``side`` 1 rows only side 0."""
    for group in runs(batches, "place"):
        prints, side = group.column("print").to_pylist(), group.column("side").to_pylist()
        rows = dict(zip(prints, zip(group.column("grams").to_pylist(), side)))
        for name, grams, s in zip(prints, group.column("grams").to_pylist(), side):
            rows[name] = (grams, min(s, rows[name][1]))
        prints = sorted(rows, key=lambda p: rows[p][1])
        every = [unpack(rows[p][0]) for p in prints]
        main = sum(rows[p][1] == 0 for p in prints)
        forest, a, b = Forest(len(prints)), [], []
        for i, j in links(every, main, percent):
            if i != j and forest.join(i, j):
                a.append(prints[i])
                b.append(prints[j])
        if a:
            yield _pairs(a, b)


def product(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) links from rows (place, side, print, grams)."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_key(members, parts, "place").select("place", "side", "print", "grams").mapInArrow(
        lambda batches: block_links(batches, percent), PAIR)


def exact_classes(profile: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """(print, class) of documents that link with another one. ``clusters``: (node, label)."""
    posted = profile.filter(F.col("grams").isNotNull())
    sizes = posted.groupBy("print").agg(F.first("n_shingles").alias("n"))
    sized = settle_narrow(clusters.join(sizes, F.col("node") == F.col("print")).groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).select(
        "label", "rows", F.ceil(F.greatest(F.col("rows") / BLOCK, F.col("n") / BLOCK_GRAMS)).cast("int").alias("blocks")),
        "ngram-clusters")
    one = posted.groupBy("print").agg(F.first("grams").alias("grams"))
    of = keyed_join(clusters.withColumnRenamed("node", "print"), sized, ["label"], "inner")
    members = settle(of.join(one, "print").withColumn(
        "block", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")), "ngram-members")
    place = F.struct("label", "block")
    own = members.select(place.alias("place"), F.lit(0).alias("side"), "print", "grams")
    large = members.filter(F.col("blocks") > 1)
    if large.isEmpty():
        return components(settle(product(keyed(own), percent), "ngram-links"))
    # pivots: about so many rows by hash, in every block of their cluster, and so small a part of a block
    some = F.least(F.lit(PIVOTS), F.ceil(F.col("rows") * PIVOTS / (F.col("blocks") * BLOCK)))
    pivots = (large.filter(F.pmod(F.xxhash64("print", F.lit("pivot")), F.col("rows")) < some)
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(place.alias("place"), F.lit(0).alias("side"), "print", "grams"))
    first = settle(product(keyed(own.unionByName(pivots)), percent), "ngram-links")
    classes = components(first)
    # what is outside the largest class of its cluster meets the whole cluster
    state = large.join(classes.select(F.col("node").alias("print"), F.col("label").alias("class")),
                       "print", "left").withColumn("class", F.coalesce("class", "print"))
    counts = state.groupBy("label", "class").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("label").agg(F.max_by("class", F.struct("n", "class")).alias("main"))
    state = settle(keyed_join(state, settle_narrow(main, "ngram-main"), ["label"], "inner"), "ngram-state")
    outside = state.filter(F.col("class") != F.col("main"))
    if outside.isEmpty():
        return classes
    dense = F.max(F.col("blocks") / F.col("rows"))
    per = outside.groupBy("label").agg(F.ceil(F.count(F.lit(1)) * dense).cast("int").alias("groups"))
    per = settle_narrow(per, "ngram-outside")
    place = F.struct("label", "group", "block")
    rest = (keyed_join(outside, per, ["label"], "inner")
            .withColumn("group", F.pmod(F.xxhash64("print", F.lit("group")), F.col("groups")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(place.alias("place"), F.lit(0).alias("side"), "print", "grams"))
    whole = (keyed_join(state, per, ["label"], "inner")
             .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
             .select(place.alias("place"), F.lit(1).alias("side"), "print", "grams"))
    second = settle(product(keyed(rest.unionByName(whole)), percent), "ngram-links")
    return components(first.unionByName(second))


def keyed(rows: DataFrame) -> DataFrame:
    """One plain value per block, so that runs of it can be told apart."""
    return rows.withColumn("place", F.to_json(F.struct("place")))


def classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id) for every row of ``docs``; ``tie`` is a hash of
    the text, which tells rows with the same id apart."""
    rows = texts(docs).withColumn("tie", F.xxhash64("text"))
    profile = profiles(rows, shared_ngrams(rows, width), width, percent)
    edges = candidate_edges(profile, percent)
    linked = exact_classes(profile, components(edges), percent)
    first = profile.groupBy("print").agg(F.min("doc_id").alias("first"))
    first = first.join(linked.select(F.col("node").alias("print"), "label"), "print", "left")
    first = settle_narrow(first.withColumn("label", F.coalesce("label", "print")), "ngram-classes")
    smallest = settle_narrow(first.groupBy("label").agg(F.min("first").alias("component_id")), "ngram-smallest")
    of = keyed_join(first, smallest, ["label"], "inner").select("print", "component_id")
    rows = profile.select("doc_id", "tie", "print", "n_shingles")
    met = keyed_join(rows.filter(F.col("print").isNotNull()), of, ["print"], "inner")
    return met.drop("print").unionByName(
        rows.filter(F.col("print").isNull()).drop("print").withColumn("component_id", F.col("doc_id")))


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    return classes(docs, width, percent).select("doc_id", "n_shingles", "component_id")


def without_near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns. Repeated
    rows (same id and text) are one document; different texts under the class's smallest id all
    stay. Documents without words all stay, repeated or not."""
    kept = settle_narrow(classes(docs, width, percent).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
                  .select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"),
                          "tie").distinct(), "ngram-kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("bigint")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(doc, F.lit(0)).alias("id"),
                       doc.isNull().alias("none"), F.xxhash64(text).alias("tie"),
                       text.rlike(r"[^\x20\x09-\x0D]").alias("words"))
    key = ["id", "none", "tie"]
    rows = rows.join(kept, key, "left_semi")
    copy = F.row_number().over(Window.partitionBy(*key).orderBy("words"))
    return rows.withColumn("copy", copy).filter((F.col("copy") == 1) | ~F.col("words")).select("row.*")
