"""A/B assignment and its outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herald.functions import predicates as p
from herald.functions.rates import pct, tenths
from herald.operators.metrics import events_per_member
from herald.operators.ranking import number_rows

ASSIGNED = ["member_id", "first_name", "email", "location_tag"]
EXPORTED = ["member_id", "first_name", "last_name", "email", "location_raw", "location_tag"]


def ab_label(row_num: Column) -> Column:
    """Even numbers are A, odd are B; an odd stratum has one more B."""
    return F.when(row_num % 2 == 0, "A").otherwise("B")


def _labelled(df: DataFrame, columns: list[str], strata: list[str], key: str,
              keep_row_number: bool = False, ordered: bool = False) -> DataFrame:
    numbered = number_rows(df.select(*columns), strata, key)
    result = numbered.withColumn("ab_group", ab_label(F.col("row_num")))
    if not keep_row_number:
        result = result.drop("row_num")
    return result.orderBy(*strata, key) if ordered else result


def ab_simple(audience: DataFrame, region: str, ordered: bool = False) -> DataFrame:
    """Alternate over one region in member_id order, with the running number."""
    rows = audience.filter(F.col("location_tag") == region)
    return _labelled(rows, ASSIGNED, [], "member_id", keep_row_number=True, ordered=ordered)


def ab_stratified(audience: DataFrame, strata: str = "location_tag", key: str = "member_id",
                  keep_row_number: bool = False, ordered: bool = False,
                  keep: Sequence[str] = ASSIGNED) -> DataFrame:
    """Alternate within every stratum; rows without a stratum are left out. With all audience
    columns in ``keep``, the result is the audience with its ab_group filled in."""
    columns = list(dict.fromkeys([*keep, strata, key]))
    rows = audience.filter(F.col(strata).isNotNull())
    return _labelled(rows, columns, [strata], key, keep_row_number, ordered)


def ab_region(audience: DataFrame, region: str) -> DataFrame:
    """The stratified assignment of one region."""
    return _labelled(audience.filter(F.col("location_tag") == region), ASSIGNED,
                     ["location_tag"], "member_id")


def ab_hash_split(audience: DataFrame, salt: str = "") -> DataFrame:
    """Opt-in random split by a salted hash of the id: no shuffle, and a contact keeps its
    group in every run and batch."""
    digest = F.md5(F.concat(F.lit(salt), F.col("member_id")))
    even = F.substring(digest, 32, 1).isin(*"02468ace")
    return (audience.filter(p.tagged()).select(*ASSIGNED)
            .withColumn("ab_group", F.when(even, "A").otherwise("B")))


def fill_groups(audience: DataFrame, salt: str = "") -> DataFrame:
    """The audience with an A/B group for every contact of a location that has none yet. A group
    once given stays; new ones come from the salted hash of the id."""
    digest = F.md5(F.concat(F.lit(salt), F.col("member_id")))
    new = F.when(F.substring(digest, 32, 1).isin(*"02468ace"), "A").otherwise("B")
    group = F.coalesce("ab_group", F.when(p.tagged(), new))
    return audience.select(*[group.alias(c) if c == "ab_group" else c for c in audience.columns])


def region_export(audience: DataFrame, region: str) -> DataFrame:
    """Contacts of a region ready to send, numbered after filtering."""
    return export_ready(audience.filter(p.exportable(region)))


def export_ready(contacts: DataFrame) -> DataFrame:
    """The export columns and label of contacts that already passed the export's tests."""
    return _labelled(contacts, EXPORTED, ["location_tag"], "member_id")


def ab_results(assigned: DataFrame, events: DataFrame) -> DataFrame:
    """Members, deliveries and rates per group; needs member_id and ab_group."""
    facts = (assigned.select("member_id", "ab_group").filter(F.col("ab_group").isNotNull())
             .join(events_per_member(events), "member_id", "left"))
    totals = facts.groupBy("ab_group").agg(
        F.count(F.lit(1)).alias("members"),
        *[F.coalesce(F.sum(f"n_{c}"), F.lit(0)).alias(c)
          for c in ("sent", "delivered", "opens", "clicks")])
    return totals.withColumns({"open_rate": pct(F.col("opens"), F.col("delivered")),
                               "ctr": pct(F.col("clicks"), F.col("delivered"))})


def ab_lift(results: DataFrame) -> DataFrame:
    """Open-rate lift of B over A in points, with the two-proportion z score."""
    def of(group: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("ab_group") == group, F.col(column))), F.lit(0))

    row = results.agg(*[of(g, c).cast("bigint").alias(f"{c}_{g.lower()}")
                        for g in ("A", "B") for c in ("opens", "delivered")])
    xa, na, xb, nb = (F.col(c) for c in ("opens_a", "delivered_a", "opens_b", "delivered_b"))
    rate_a, rate_b = tenths(xa, na), tenths(xb, nb)
    zero = F.lit(0.0)
    size_a, size_b = F.nullif(na.cast("double"), zero), F.nullif(nb.cast("double"), zero)
    pooled = (xa + xb).cast("double") / (size_a + size_b)
    variance = pooled * (F.lit(1.0) - pooled) * (F.lit(1.0) / size_a + F.lit(1.0) / size_b)
    # More opens than deliveries make the pooled share exceed one; then there is no score.
    spread = F.when(variance > 0, F.sqrt(variance))
    z = (xb.cast("double") / size_b - xa.cast("double") / size_a) / spread
    return row.select((rate_a / F.lit(10.0)).alias("open_rate_a"),
                      (rate_b / F.lit(10.0)).alias("open_rate_b"),
                      ((rate_b - rate_a) / F.lit(10.0)).alias("lift_points"),
                      F.round(z, 6).alias("z_score"))


# P(a Poisson number with mean 1 is at most k), k = 0, 1, ...; sixty bits of a hash decide.
POISSON_STEPS = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
                 0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999898050903253]


def poisson_weight(key: Column, replicate: Column, salt: str = "") -> Column:
    """How often a resample holds a member: a Poisson number with mean 1 from a hash of the two."""
    digest = F.md5(F.concat(F.lit(salt), key, F.lit(":"), replicate.cast("string")))
    unit = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return sum((unit >= F.lit(s)).cast("bigint") for s in POISSON_STEPS)


def ab_bootstrap(assigned: DataFrame, events: DataFrame, replicates: int = 100,
                 salt: str = "") -> DataFrame:
    """(replicate, lift): open rate of B less that of A, in shares, in each of so many resamples of members.

    The z score of ``ab_lift`` takes every open for itself; a member opens again and again. Here members
    are drawn, with all their events. Weights come from a hash, so one pass gives all resamples and reruns
    agree: events shrink to a row per member, and members who open or were sent alike, being few kinds, are summed
    per task before anything is shuffled. NULL where a resample has no deliveries in a group.
    """
    facts = (assigned.select("member_id", "ab_group").filter(F.col("ab_group").isin("A", "B"))
             .join(events_per_member(events).select("member_id", "n_delivered", "n_opens"), "member_id")
             .filter((F.col("n_delivered") > 0) | (F.col("n_opens") > 0)))
    draws = facts.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    weight = poisson_weight(F.col("member_id"), F.col("replicate"), salt)
    sums = draws.groupBy("replicate").agg(*[
        F.sum(F.when(F.col("ab_group") == g, weight * F.col(c)).otherwise(0)).alias(f"{c}_{g}")
        for g in "AB" for c in ("n_delivered", "n_opens")])

    def share(g: str) -> Column:
        return F.col(f"n_opens_{g}").cast("double") / F.nullif(F.col(f"n_delivered_{g}").cast("double"), F.lit(0.0))

    return sums.select("replicate", (share("B") - share("A")).alias("lift"))


def bootstrap_interval(draws: DataFrame, percent: int = 95) -> DataFrame:
    """(replicates, low, high): the middle ``percent`` of the lifts; a row per replicate is all it sorts."""
    tail = (100 - percent) / 200
    low, high = (F.percentile("lift", F.lit(q)) for q in (tail, 1 - tail))
    return draws.agg(F.count("lift").alias("replicates"), low.alias("low"), high.alias("high"))


def assign_ab_groups(spark: SparkSession, region: str, table: str = "audience") -> DataFrame:
    return ab_region(spark.table(table), region)


def export_region_audience(spark: SparkSession, region: str,
                           table: str = "audience") -> DataFrame:
    return region_export(spark.table(table), region)
