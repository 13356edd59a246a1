"""Bottom-k sketches of a document's word shingles, from DataFrame functions only.

A sketch is the ``K`` smallest distinct hashes of all runs of ``WIDTH`` words, in order. Sketches
of parts merge into the sketch of the whole set; two sketches give estimates of resemblance and
containment, one gives the number of distinct shingles. A text of fewer words is one shingle, one
without words has the empty sketch; two empty sketches resemble each other fully, an empty and
another one not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH, K = 5, 128
#: Ranges of ids per shuffle partition in ``with_next``.
RANGES = 4


def sketch(text: Column, width: int = WIDTH, k: int = K) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # an array of one array: the lambda's variable holds the hashes, which are made once
    hashes = F.filter(F.array(F.transform(words, lambda w: F.xxhash64(w))), lambda h: F.size(h) > 0)
    runs = F.transform(hashes, lambda h: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(h, i, width))))
    return F.slice(F.sort_array(F.array_distinct(F.flatten(runs))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of the sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both sketches hold."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds too; 1 for the empty set."""
    union = distinct_shingles(merge(a, b, k), k)
    own = distinct_shingles(a, k)
    return F.when(own == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, k) * union / own))


def as_text(a: Column) -> Column:
    """A sketch as base64 of its hashes, eight bytes each."""
    digits = F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")
    return F.translate(F.base64(F.unhex(digits)), "\r\n", "")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch): every row with the one after it in
    descending order of ``doc_id``, the first one after the last.

    Ids are cut into ranges at their quantiles, and each range is ordered on its own. A range's
    first row is also sent to the range before it, so a text moves once. Rows that share an id
    are ordered by the hash of their text and stay in one range; NULL ids come last, as one range.
    NULL texts are empty.
    """
    n = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("tie"))
    marks = [i / n for i in range(1, n)]
    cuts = rows.select("doc_id").agg(F.percentile_approx("doc_id", marks, 10 * n)).first()[0] or []
    cuts = sorted(set(cuts))  # at most n - 1 numbers
    bounds = F.array(*map(F.lit, cuts)).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    place = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(bounds, lambda c: c < F.col("doc_id"))))
    rows = rows.withColumn("place", place)
    heads = rows.groupBy("place").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
    order = Window.orderBy("place")  # one row per range
    heads = heads.select("head", F.coalesce(F.lead("place").over(order),
                                            F.min("place").over(Window.partitionBy(F.lit(1))))
                         .alias("before"))
    heads = heads.select(F.col("head.doc_id").alias("head_id"), F.col("head.tie").alias("head_tie"), "before")
    # heads: a row of three numbers for each of at most n + 1 ranges
    rows = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id"))
                     & (F.col("tie") == F.col("head_tie")), "left")
    own = F.struct(F.col("place").alias("place"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("before").alias("place"), F.lit(True).alias("copy"))
    rows = rows.select("doc_id", "text", "tie", F.explode(
        F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("at"))
    rows = (rows.select("doc_id", "text", "tie", "at.place", "at.copy").repartition(n // RANGES, "place")
            .withColumn("sketch", sketch(F.col("text"))))
    down = Window.partitionBy("place").orderBy("copy", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return (rows.withColumn("next_text", F.lead("text").over(down))
            .withColumn("next_sketch", F.lead("sketch").over(down)).filter(~F.col("copy"))
            .select("doc_id", "text", "sketch", "next_text", "next_sketch"))


def edited_text() -> Column:
    """The text with its last third replaced by as much of the start of the next one."""
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substr("text", F.lit(1), (n - third).cast("int")),
                    F.substr("next_text", F.lit(1), third))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_shingles) for every row of ``docs``."""
    rows = with_next(docs).withColumn("edited", edited_text())
    rows = rows.select("doc_id", F.length("text").cast("bigint").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch",
                       sketch(F.col("edited")).alias("edited_sketch"))
    return rows.select("doc_id", "n_chars", "edited_sha256",
                       as_text(F.col("sketch")).alias("fingerprint"),
                       as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                       resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
                       distinct_shingles(F.col("sketch")).alias("n_shingles"))
