"""Named tables, upserts and versioned snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from herald.scale import BROADCAST_ROWS, fits_broadcast, keyed_join, remove, settle

SINCE_COLUMNS = ["member_id", "first_name", "last_name", "email", "location_raw", "in_segment"]


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view whose name is data. The name is one identifier, never SQL."""
    if not name:
        raise ValueError("table name is missing")
    return spark.table("`" + name.replace("`", "``") + "`")


def contacts_since(spark: SparkSession, table: str, since: dt.date) -> DataFrame:
    """Segment members of a batch table that arrived after ``since``, midnight excluded."""
    if since is None:
        raise ValueError("since date is missing")
    after = F.col("ingested_at") > F.lit(since).cast("timestamp_ntz")
    return (named_table(spark, table)
            .filter((F.col("in_segment") == 1) & after).select(*SINCE_COLUMNS))


def append_batch(contacts: DataFrame, table: str) -> None:
    """Add a batch to one table of all batches, which is partitioned by the day of arrival."""
    day = F.coalesce(F.col("ingested_at").cast("date").cast("string"), F.lit("none")).alias("arrived")
    rows = contacts.select("*", day).hint("rebalance", F.col("arrived"))
    rows.write.mode("append").partitionBy("arrived").format("parquet").saveAsTable(table)


def arrived_since(spark: SparkSession, table: str, since: dt.date) -> DataFrame:
    """``contacts_since`` over the table of all batches: only days after ``since``, and that day itself past
    midnight, are opened; the rest of the table is not listed as input, let alone read."""
    if since is None:
        raise ValueError("since date is missing")
    later = (F.col("arrived") >= F.lit(since.isoformat())) & (F.col("arrived") != "none")
    after = F.col("ingested_at") > F.lit(since).cast("timestamp_ntz")
    return (named_table(spark, table).filter(later)
            .filter((F.col("in_segment") == 1) & after).select(*SINCE_COLUMNS))


def count_rows(spark: SparkSession, table: str) -> int:
    return named_table(spark, table).count()


def table_counts(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Row counts of several named tables in one result."""
    counts = [named_table(spark, t).agg(F.lit(t).alias("table_name"),
                                        F.count(F.lit(1)).alias("n_rows")) for t in tables]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


def segment_flag(contacts: DataFrame, member_ids: DataFrame) -> DataFrame:
    """Set in_segment to 1 for the listed members and 0 for the rest."""
    listed = member_ids.select("member_id").distinct().withColumn("_listed", F.lit(True))
    if fits_broadcast(listed):
        listed = F.broadcast(listed)
    return (contacts.join(listed, "member_id", "left")
            .withColumn("in_segment", F.when(F.col("_listed"), 1).otherwise(0))
            .drop("_listed"))


def segment_members(contacts: DataFrame, member_ids: DataFrame) -> DataFrame:
    listed = member_ids.select("member_id")
    if fits_broadcast(listed):
        listed = F.broadcast(listed)
    return contacts.join(listed, "member_id", "left_semi")


# --- upsert ----------------------------------------------------------------------------

def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row per key. Each input partition keeps one row per key before the shuffle,
    so a key with very many versions costs one row per task."""
    columns = df.columns
    last = Window.partitionBy(key).orderBy(
        *[F.desc_nulls_last(c) for c in order], F.xxhash64(*columns))
    return (df.withColumn("_n", F.row_number().over(last))
            .filter(F.col("_n") == 1).select(*columns))


def upsert(base: DataFrame, batch: DataFrame, key: str = "member_id", order: str = "ingested_at",
           defaults: dict[str, Column] | None = None, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``base`` with the batch merged in. Every key the batch brings has one row afterwards: its
    newest values, a tie going to the batch, and for columns that the batch lacks the stored ones
    (for a new key the default, or NULL). All other base rows pass as they are, also those that
    repeat a key or have none; the audit finds such rows. Batch rows without a key are ignored.

    The meaning is the same whatever the sizes are. The batch's newest row per key is written
    down first; when its keys, ``max_rows`` at most, fit a broadcast, base rows it does not touch are not shuffled.
    """
    given = [c for c in base.columns if c in batch.columns]
    ranked = [order] if order in given else []
    fresh = settle(latest_per_key(batch.filter(F.col(key).isNotNull()).select(given), key, ranked), "batch")
    keys = fresh.select(key)
    if fits_broadcast(keys, max_rows):
        keys = F.broadcast(keys)
    untouched = base.join(keys, key, "left_anti")
    stored = latest_per_key(base.join(keys, key, "left_semi"), key, [order])
    stored = stored.select(F.col(key), *[F.col(c).alias(f"_stored_{c}") for c in base.columns if c != key],
                           F.lit(True).alias("_known"))
    both = fresh.join(stored, key, "left")
    old = F.col(f"_stored_{order}")
    keep = F.col("_known").isNotNull() & (
        old.isNotNull() & (F.col(order).isNull() | (old > F.col(order))) if ranked else F.lit(False))
    defaults = defaults or {}

    def column(c: str) -> Column:
        if c == key:
            return F.col(c)
        if c in given:
            return F.when(keep, F.col(f"_stored_{c}")).otherwise(F.col(c)).alias(c)
        missing = defaults.get(c, F.lit(None)).cast(base.schema[c].dataType)
        return F.when(F.col("_known"), F.col(f"_stored_{c}")).otherwise(missing).alias(c)

    return untouched.unionByName(both.select(*map(column, base.columns)))


# --- snapshots -------------------------------------------------------------------------

def _open(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _open(spark, path)
    return fs.exists(location)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, location = _open(spark, path)
    fs.mkdirs(location)


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, root = _open(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))


def _version_path(path: str, version: int) -> str:
    return f"{path}/version={version:06d}"


def latest_version(spark: SparkSession, path: str) -> int:
    """The newest version that was written to the end; 0 if there is none."""
    return max(complete_versions(spark, path), default=0)


def publish(df: DataFrame, path: str, cluster_by: Sequence[str] = (), keep: int | None = None,
            watch: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write the next full version. Readers see it once it is complete; the version being
    read is never overwritten, so a run may replace the table it reads from. With ``keep``, only
    so many versions stay, the new one included; unfinished older ones go too.

    ``cluster_by`` sorts the files by these columns, so that filters on them skip most row
    groups. End with the key: a hot leading value then spans many files. ``watch`` sees the
    rows as they are written, each once.
    """
    spark = df.sparkSession
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    if watch:
        df = watch(df)
    target = _version_path(path, max(_versions(spark, path), default=0) + 1)
    df.write.parquet(target)
    if keep:
        for version in _versions(spark, path)[:-keep]:
            remove(spark, _version_path(path, version))
    return target


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that were written to the end, oldest first."""
    return [v for v in _versions(spark, path) if exists(spark, f"{_version_path(path, v)}/_SUCCESS")]


def current(spark: SparkSession, path: str, back: int = 0) -> DataFrame | None:
    """The newest complete version, or the one ``back`` versions before it; None if there is none."""
    done = complete_versions(spark, path)
    return spark.read.parquet(_version_path(path, done[-1 - back])) if len(done) > back else None


def replace_inventory(df: DataFrame, path: str, keep: int | None = None) -> str:
    """Stock is replaced as a whole on every run. A car that several pages list is one car."""
    cars = latest_per_key(df, "car_id", ["scraped_at"])
    return publish(cars, path, cluster_by=["shop_location", "car_id"], keep=keep)


def replace_table(df: DataFrame, table: str) -> None:
    df.write.insertInto(table, overwrite=True)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store a table hashed by its unique key, so that joins and groupings on the key read it
    without a shuffle. Take as many buckets as the session has shuffle partitions. Not for
    events: a bucket is read by one task, and a busy member would fill one."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def read_with_fallback(spark: SparkSession, paths: Sequence[str],
                       read: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """The first input that exists and has a row; later ones are older."""
    read = read or spark.read.parquet
    for path in paths:
        try:
            df = read(path)
            if not df.isEmpty():
                return df
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise  # a folder without files has no schema to read
    raise FileNotFoundError(f"no usable input among {list(paths)}")


def fill_from_previous(now: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """For a partial delivery: this run's rows plus earlier rows whose key is absent. Keys such as
    shops are few and hot, so the earlier rows meet each present key once."""
    present = now.select(key).filter(F.col(key).isNotNull()).distinct()
    kept = keyed_join(previous, settle(present, "present-keys"), [key], "left_anti")
    return now.unionByName(kept.select(*now.columns))
