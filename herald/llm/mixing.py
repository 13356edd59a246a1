"""Mix sources to target weights by Pareto order sampling.

Sources share the words of the corpus by weight, none above ``most`` times what it has. Within
a source a document is expected ``least(most, rate * weight)`` times, where the weight grows
with the logarithm of its size, and the source's rate makes the expected words equal its target.
The whole part of that is certain; the fraction is an inclusion probability p. A document's
order value is the odds of a random number, taken from its id, over the odds of p; the documents
with the smallest values get one copy more, until the source's remaining words are used up.

The random number depends on the id and a seed alone, without an id on the text, so reruns agree.
What a document gets depends on its own row and its source's figures, so texts are not shuffled: the cut in the
order comes from sums over slices of it, and only the slice with the cut is sorted. Rows that tie in the order
(repeated ids, repeated rows) are counted as one entry there; of the entry that the cut falls into,
as many rows as fit are taken, in the order in which the rows were written down.
NULL and empty texts have size 0 and are taken zero words; in a mix of rows they are left out.
A NULL source is a source, last in order. Repeated rows each count. Texts of any length are only
counted. An empty table gives no rows. Columns of other names than the three that are read are carried along
in a mix, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald.scale import keyed_join, settle

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
#: Documents per slice of a source's order.
SLICE = 1000
_UNIT = float(1 << 52)


def word_count(text):
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")),
                      F.lit(0)).cast("bigint")


def sized(docs: DataFrame, *keep) -> DataFrame:
    """Id, source key (never NULL, in the order of sources), size, size class and random number."""
    ident = F.coalesce(F.col("doc_id").cast("string"),
                       F.concat(F.lit("null:"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))))
    rows = docs.select(
        *keep, F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("a"), F.col("source").cast("string")), F.lit("b")).alias("src"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.concat(ident, F.lit(":" + SEED)).cast("binary")).alias("digest"))
    number = F.conv(F.substring("digest", 1, 13), 16, 10).cast("double")
    return rows.select(
        *[c for c in rows.columns if c != "digest"],
        F.length(F.bin("size")).cast("int").alias("class"),
        ((number + 0.5) / F.lit(_UNIT)).alias("u"))


def targets(by_source: DataFrame) -> DataFrame:
    """(src, source_size, target). One row per source, so one task orders them: sources are few
    beside documents. Those with the least room per weight reach their limit first."""
    turn = Window.orderBy("src")
    number = (F.row_number().over(turn) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), number + 1).cast("double")
    rows = by_source.select("src", "source_size", weight.alias("weight"),
                            (F.lit(MOST) * F.col("source_size")).cast("double").alias("limit"))
    room = Window.orderBy(F.col("limit") / F.col("weight"), "src")
    every = Window.partitionBy(F.lit(1))
    rows = rows.select(
        "*", F.sum("source_size").over(every).cast("double").alias("total"),
        (F.sum("limit").over(room.rowsBetween(Window.unboundedPreceding, 0)) - F.col("limit")).alias("full"),
        F.sum("weight").over(room.rowsBetween(0, Window.unboundedFollowing)).alias("rest"))
    share = (F.col("total") - F.col("full")) / F.col("rest")
    first = F.when(share * F.col("weight") <= F.col("limit"),
                   F.struct((F.col("limit") / F.col("weight")).alias("room"), "src"))
    rows = rows.select("*", F.min_by(share, first).over(every).alias("share"))
    return rows.select("src", "source_size",
                       F.least("limit", F.coalesce(F.col("share") * F.col("weight"), F.col("limit")))
                       .alias("target"))


def rates(rows: DataFrame) -> DataFrame:
    """Per source and size class: certain copies, inclusion probability, and the words left for
    the sample. A source has at most 64 classes."""
    classes = rows.groupBy("src", "class").agg(F.sum("size").alias("words"),
                                               F.count(F.lit(1)).alias("docs"))
    classes = settle(classes, "mix-classes")
    goal = targets(classes.groupBy("src").agg(F.sum("words").alias("source_size")))
    rows = classes.join(goal, "src").withColumn("weight", (F.col("class") + 4).cast("double"))
    down = Window.partitionBy("src").orderBy(F.desc("weight"))
    source = Window.partitionBy("src")
    before = F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    after = F.sum(F.col("words") * F.col("weight")).over(down.rowsBetween(0, Window.unboundedFollowing))
    rate = (F.col("target") - MOST * before) / F.when(after > 0, after)
    rows = rows.withColumn("rate", rate)
    rows = rows.withColumn("rate", F.max_by(
        F.when(F.col("rate") * F.col("weight") <= MOST, F.col("rate")),
        F.when(F.col("rate") * F.col("weight") <= MOST, F.col("weight"))).over(source))
    copies = F.least(F.lit(float(MOST)), F.coalesce(F.col("rate") * F.col("weight"), F.lit(float(MOST))))
    near = F.round(copies)
    rows = rows.withColumn("copies", F.when(F.abs(copies - near) < 1e-9, near).otherwise(copies))
    rows = rows.withColumn("certain", F.floor("copies").cast("bigint"))
    return settle(rows.select(
        "src", "class", "certain", (F.col("copies") - F.col("certain")).alias("p"),
        "source_size", "target",
        (F.col("target") - F.sum(F.col("words") * F.col("certain")).over(source)).alias("left"),
        F.sum(F.when(F.col("copies") > F.col("certain"), F.col("docs")).otherwise(0)).over(source).alias("drawn")),
        "mix-rates")


def placed(rows: DataFrame) -> DataFrame:
    """Rows with their order value and the slice of the order it falls in."""
    odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
    rows = rows.withColumn("q", F.when(F.col("p") > 0, odds))
    slices = F.ceil(F.col("drawn") / F.lit(SLICE))
    return rows.withColumn("slice", F.floor(F.col("q") / (1 + F.col("q")) * slices).cast("bigint"))


#: monotonically_increasing_id() keeps the partition number above this bit.
_PARTITION_BITS = 33


def cuts(rows: DataFrame) -> DataFrame:
    """Per source: the slice that holds the cut and the last entry of it that is taken, with the last row of
    that entry. A row is taken if the words before it and half its own fit, so the cut is the nearest one."""
    sums = rows.groupBy("src", "left", "slice").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("src").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("before", F.sum("words").over(run) - F.col("words"))
    edge = sums.filter(F.col("before") < F.col("left")).groupBy("src").agg(
        F.max("slice").alias("edge"), F.max("before").alias("edge_before"))
    edge = settle(edge, "mix-edges")
    inside = keyed_join(rows, edge, ["src"], "inner").filter(F.col("slice") == F.col("edge"))
    entries = inside.groupBy("src", "left", "edge_before", "q", "doc_id", "size").agg(F.count(F.lit(1)).alias("tied"))
    order = (Window.partitionBy("src").orderBy("q", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, 0))
    words = F.col("size") * F.col("tied")
    entries = entries.withColumn("room", F.col("left") - F.col("edge_before") - F.sum(words).over(order) + words)
    fit = F.floor((F.col("room") - F.col("size") / 2) / F.nullif(F.col("size"), F.lit(0))) + 1
    fit = F.coalesce(fit, F.when(F.col("room") >= 0, F.col("tied")).otherwise(0))
    entries = entries.withColumn("fit", F.greatest(F.lit(0), F.least(fit, F.col("tied"))).cast("bigint"))
    last = entries.filter(F.col("fit") > 0).groupBy("src").agg(
        F.max(F.struct("q", "doc_id", "size", "fit", "tied")).alias("m"))
    last = settle(last.select("src", F.struct("m.q", "m.doc_id", "m.size").alias("last"), "m.fit", "m.tied"), "mix-last")
    found = edge.select("src", "edge").join(last, "src", "left")
    return settle(found.join(_last_rows(rows, last), "src", "left").select("src", "edge", "last", "last_row"), "mix-cuts")


def _last_rows(rows: DataFrame, last: DataFrame) -> DataFrame:
    """(src, last_row) of the entries whose rows do not all fit: the number of the last row that does. Rows are
    counted per partition they were written in; only the one that holds the last row is sorted."""
    split = settle(last.filter(F.col("fit") < F.col("tied")), "mix-split")
    if split.isEmpty():
        return split.select("src", F.lit(0).cast("bigint").alias("last_row"))
    mark = F.struct("q", "doc_id", "size")
    tied = keyed_join(rows, split, ["src"], "inner").filter((mark <= F.col("last")) & (mark >= F.col("last")))
    tied = tied.select("src", "fit", "number", F.shiftright("number", _PARTITION_BITS).alias("part"))
    parts = tied.groupBy("src", "fit", "part").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("upto", F.sum("n").over(run)).filter(F.col("upto") >= F.col("fit"))
    holder = settle(parts.groupBy("src").agg(F.min(F.struct("part", (F.col("fit") - F.col("upto") + F.col("n")).alias("rest")))
                                             .alias("h")).select("src", "h.*"), "mix-holder")
    inside = keyed_join(tied.drop("fit"), holder, ["src", "part"], "inner")
    place = F.row_number().over(Window.partitionBy("src", "part").orderBy("number"))
    return inside.withColumn("place", place).filter(F.col("place") == F.col("rest")).select(
        "src", F.col("number").alias("last_row"))


def copies(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, size, source_size, target and copies of every row of ``docs``, with ``whole`` also the row itself.
    Rows are written down once with a number, which tells rows apart that are equal."""
    if whole:
        kept = settle(docs.select(F.struct(*docs.columns).alias("row"),
                                  F.monotonically_increasing_id().alias("number")), "mix-rows")
        read = ["row.doc_id", "row.text", "row.source", "number"]
        small = settle(sized(kept.select(*read), "number"), "mix-sizes")
    else:
        small = settle(sized(docs).withColumn("number", F.monotonically_increasing_id()), "mix-sizes")
    figures = rates(small)
    cut = cuts(placed(keyed_join(small, figures, ["src", "class"], "inner").filter(F.col("p") > 0)))
    every = settle(figures.join(cut, "src", "left"), "mix-figures")
    each = sized(kept.select("row", *read), "row", "number") if whole else small
    rows = placed(keyed_join(each, every, ["src", "class"], "inner"))
    mark = F.struct("q", "doc_id", "size")
    within = (mark <= F.col("last")) & ((mark < F.col("last")) | F.col("last_row").isNull()
                                        | (F.col("number") <= F.col("last_row")))
    taken = (F.col("slice") < F.col("edge")) | ((F.col("slice") == F.col("edge")) & within)
    extra = F.coalesce(F.when(F.col("p") > 0, taken), F.lit(False)).cast("bigint")
    return rows.select(*["row"] * whole, "doc_id", "size", "source_size", "target", (F.col("certain") + extra).alias("copies"))


def taken(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document."""
    return copies(docs).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, with its own columns."""
    rows = copies(docs, whole=True)
    rows = rows.filter((F.col("copies") > 0) & (F.col("size") > 0))
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")).select("row.*")
