"""Row numbers within strata that do not put a whole stratum into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald.scale import fits_broadcast, settle

# monotonically_increasing_id() keeps the partition number above this bit.
_PARTITION_BITS = 33


def number_rows(df: DataFrame, strata: Sequence[str], key: str,
                name: str = "row_num") -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY strata ORDER BY key). ``key`` is meant to be unique;
    rows that share it are ordered by a hash of the whole row.

    A plain window gives each stratum to one task, and a location may hold a third of all
    contacts. Here the rows are range-partitioned by (strata, key), so a large stratum spans
    many partitions, and positions in that order are written once to the shared folder.
    A stratum's run inside one partition starts at its smallest position; the rows in
    earlier partitions are a running total over those runs, which number at most
    partitions + strata. The result is one shuffle of the rows and a narrow lookup.
    """
    order = [*strata, key, F.xxhash64(*df.columns)]
    placed = settle(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_pos", _PARTITION_BITS)
    runs = (placed.groupBy(*strata, part.alias("_part"))
            .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")))
    earlier = (Window.partitionBy(*strata).orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = settle(
        runs.select(*[F.col(s).alias(f"_s{i}") for i, s in enumerate(strata)], "_part", "_first",
                    F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")),
        "run-starts")
    if fits_broadcast(starts):
        starts = F.broadcast(starts)
    same_run = part == F.col("_part")
    for i, s in enumerate(strata):
        same_run &= F.col(s).eqNullSafe(F.col(f"_s{i}"))
    number = (F.col("_before") + F.col("_pos") - F.col("_first") + 1).cast("bigint")
    return placed.join(starts, same_run).select(*df.columns, number.alias(name))
