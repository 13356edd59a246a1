"""Constraint audit and run statistics."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from herald import schemas
from herald.scale import keyed_join, settle


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows that name a parent which does not exist; a NULL reference is allowed.

    The distinct references are checked first, which reads one column and keeps a busy parent
    to one row per task. What is missing is usually little, so the child rows are then found
    by a broadcast.
    """
    used = child.select(column).filter(F.col(column).isNotNull()).distinct()
    known = parent.select(F.col(parent_column).alias(column))
    missing = settle(used.join(known, column, "left_anti"), "missing-parents")
    return keyed_join(child, missing, [column], "left_semi")


def orphan_events(events: DataFrame, audience: DataFrame) -> DataFrame:
    return orphans(events, "member_id", audience, "member_id")


def _finding(table: str, constraint: str, violations: Column) -> list[Column]:
    return [F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"),
            F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")]


def _keys_and_values(table: str, df: DataFrame) -> DataFrame:
    """Repeated keys and missing values of a table, in one pass: counts per key, then sums."""
    key = schemas.PRIMARY_KEYS[table]
    values = [c for c in schemas.required_columns(table) if c != key]
    per_key = df.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in values])
    has_key = F.col("key").isNotNull()
    totals = per_key.agg(
        F.count_if(has_key & (F.col("rows") > 1)).alias("repeated"),
        F.sum(F.when(~has_key, F.col("rows"))).alias("no_key"),
        *[F.sum(f"no_{c}").alias(f"no_{c}") for c in values])
    return totals.select(F.inline(F.array(
        F.struct(*_finding(table, f"primary key {key}", F.col("repeated"))),
        F.struct(*_finding(table, f"not null {key}", F.col("no_key"))),
        *[F.struct(*_finding(table, f"not null {c}", F.col(f"no_{c}"))) for c in values])))


def _broken_references(fk: schemas.ForeignKey, child: DataFrame, parent: DataFrame) -> DataFrame:
    # Children shrink to a count per reference first: a busy member is one row in the join.
    uses = child.filter(F.col(fk.column).isNotNull()).groupBy(fk.column).count()
    known = parent.select(F.col(fk.parent_column).alias(fk.column))
    return (uses.join(known, fk.column, "left_anti")
            .agg(*_finding(fk.table, f"foreign key {fk.column}", F.sum("count"))))


def audit(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, constraint_name, violations) for every declared constraint."""
    findings = [_keys_and_values(name, df) for name, df in tables.items()]
    for fk in schemas.FOREIGN_KEYS:
        if fk.table in tables and fk.parent in tables:
            findings.append(_broken_references(fk, tables[fk.table], tables[fk.parent]))
    return functools.reduce(DataFrame.unionByName, findings)


def run_stats(run_id: str, stages: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows in, kept and rejected per stage; each stage is its input and a keep condition."""
    rows = []
    for stage, (df, keep) in stages.items():
        kept = F.count_if(keep)
        total = F.count(F.lit(1))
        rows.append(df.agg(F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"),
                           total.alias("rows_in"), kept.alias("kept"),
                           (total - kept).alias("rejected")))
    return functools.reduce(DataFrame.unionByName, rows)


STATS_SCHEMA = "run_id string, stage string, rows_in bigint, kept bigint, rejected bigint"


def watched(df: DataFrame, stage: str, keep: Column) -> tuple[DataFrame, Observation]:
    """The same rows, counted while they are written for another reason.

    Watch the last step before a write: below a range shuffle, which samples its input first,
    or in a plan that two writes share, rows would be counted more than once. Filters above it
    no longer reach the scan. Everything read once is counted for free.
    """
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(keep).alias("kept")), seen


def observed_stats(spark: SparkSession, run_id: str, seen: dict[str, Observation]) -> DataFrame:
    """``run_stats`` of stages that were watched, without a scan. Their writes must be over: asking for
    the counts of rows that nothing has read waits for ever."""
    rows = []
    for stage, observation in seen.items():
        counts = observation.get
        n, kept = counts["rows_in"], counts["kept"]
        rows.append((run_id, stage, n, kept, n - kept))
    return spark.createDataFrame(rows, STATS_SCHEMA)


def append_run_stats(stats: DataFrame, path: str) -> None:
    stats.write.mode("append").parquet(path)
