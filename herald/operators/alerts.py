"""Stock, engagement and tagging alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.functions import predicates as p
from herald.functions.rates import above, below, pct
from herald.operators.metrics import events_per_member


def low_inventory(inventory: DataFrame, crit: int = 20, warn: int = 50,
                  shops: DataFrame | None = None, include_ok: bool = False) -> DataFrame:
    """Cars per shop with a level. ``shops`` adds shops that have no car at all."""
    counts = inventory.groupBy("shop_location").agg(F.count(F.lit(1)).alias("car_count"))
    if shops is not None:
        counts = (shops.select("shop_location").distinct()
                  .join(counts, "shop_location", "full")
                  .na.fill(0, ["car_count"]))
    if not include_ok:
        counts = counts.filter(F.col("car_count") < warn)
    level = (F.when(F.col("car_count") < crit, "CRITICAL")
             .when(F.col("car_count") < warn, "WARNING").otherwise("OK"))
    return counts.withColumn("alert_level", level)


def low_engagement(audience: DataFrame, events: DataFrame, threshold: float = 0.25) -> DataFrame:
    """Share of opens among all events per location, for contacts with any event."""
    opens, total = F.col("opens"), F.col("total")
    warning = f"WARNING: Below {threshold * 100:g}%"
    return (audience.filter(p.tagged()).select("member_id", "location_tag")
            .join(events_per_member(events), "member_id")
            .groupBy("location_tag")
            .agg(F.sum("n_opens").alias("opens"), F.sum("n_events").alias("total"))
            .select("location_tag", pct(opens, total).alias("open_rate"),
                    F.when(below(opens, total, threshold), warning).otherwise("OK")
                    .alias("alert")))


def untagged_alert(audience: DataFrame, threshold: float = 0.80) -> DataFrame:
    counts = audience.agg(F.count(F.lit(1)).alias("contacts"),
                          F.count_if(~p.tagged()).alias("untagged"))
    untagged, contacts = F.col("untagged"), F.col("contacts")
    return counts.select("contacts", "untagged", pct(untagged, contacts).alias("untagged_pct"),
                         F.when(above(untagged, contacts, threshold), "WARNING").otherwise("OK")
                         .alias("alert"))
