"""Incremental twins of the batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from herald.functions import predicates as p
from herald.functions.rates import pct
from herald.functions.times import instant, zoneless
from herald.scale import fresh_path, remove
from herald.sources.buckets import BucketTable
from herald.sources.tables import current, exists, latest_per_key, latest_version, publish, upsert


def file_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str | None = None,
                fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder, optionally only those whose name fits ``pattern``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def ingest_contacts(contacts: DataFrame, store_path: str, checkpoint: str,
                    key: str = "member_id", order: str = "ingested_at", keep: int = 4,
                    buckets: int | None = None) -> DataFrame | None:
    """Take in every contact that has arrived, then merge them into the store once.

    Batches are only set aside as they come, one row per key each, under a folder named after
    the version they follow: rewriting a large base per batch would cost the base each time. A
    replayed batch overwrites itself. If a run dies before the merge, the version has not
    moved on, so the next run merges what was set aside together with its own. The newest ``keep``
    versions stay. With ``buckets`` the store is a table of so many, and the merge rewrites only those
    that the arrivals touch.
    """
    spark = contacts.sparkSession
    table = BucketTable(store_path, key, buckets) if buckets else None
    version = max(table.versions(spark), default=0) if table else latest_version(spark, store_path)
    pending = f"{store_path}/pending/after={version}"

    def set_aside(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch.filter(F.col(key).isNotNull()), key, [order])
        rows.write.mode("overwrite").parquet(f"{pending}/batch={batch_id}")

    (contacts.writeStream.foreachBatch(set_aside).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    if exists(spark, pending):
        schema = StructType([*contacts.schema.fields, StructField("batch", LongType())])
        arrived = spark.read.schema(schema).parquet(pending)
        fresh = latest_per_key(arrived, key, [order, "batch"]).drop("batch")
        if table:
            table.merge(fresh, order, keep=keep)
        else:
            base = current(spark, store_path)
            publish(fresh if base is None else upsert(base, fresh, key, order), store_path, (), keep)
        remove(spark, pending)  # merged: the version has moved on
    return table.read(spark) if table else current(spark, store_path)


def _with_watermark(events: DataFrame, delay: str) -> DataFrame:
    """Watermarks need an instant."""
    return (events.withColumn("event_at", instant(F.col("event_at")))
            .withWatermark("event_at", delay))


def dedupe_events(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """One row per event_id among events up to ``delay`` late; state older than that goes."""
    return (_with_watermark(events, delay).dropDuplicatesWithinWatermark(["event_id"])
            .withColumn("event_at", zoneless(F.col("event_at"))))


# Counted event kinds under the names they are shown by.
COUNTED = {"delivered": "delivered", "opens": "open", "clicks": "click"}


def _daily(events: DataFrame, delay: str | None) -> DataFrame:
    if delay:
        events = _with_watermark(events, delay)
    return (events.withColumn("journey", p.campaign_family())
            .filter(F.col("journey").isNotNull())
            .groupBy(F.window("event_at", "1 day").alias("span"), "journey")
            .agg(*[F.count_if(p.is_event(kind)).alias(name) for name, kind in COUNTED.items()]))


def _with_rates(counts: DataFrame, delay: str | None) -> DataFrame:
    start, end = F.col("span.start"), F.col("span.end")
    return counts.select(
        (zoneless(start) if delay else start).alias("window_start"),
        (zoneless(end) if delay else end).alias("window_end"),
        "journey", *COUNTED,
        pct(F.col("opens"), F.col("delivered")).alias("open_rate"),
        pct(F.col("clicks"), F.col("delivered")).alias("ctr"))


def daily_rates(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Rates per day and journey. Works on a table and, with ``delay``, on a stream."""
    return _with_rates(_daily(events, delay), delay)


def sliding_rates(events: DataFrame, days: int = 7, delay: str | None = None) -> DataFrame:
    """Rates over ``days`` days, one window starting each day, for a table or a stream.

    Events are counted per day and journey first, so that those few rows, not the events,
    are repeated for the windows they belong to.
    """
    windows = F.window(F.window_time("span"), f"{days} days", "1 day")
    counts = (_daily(events, delay).groupBy(windows.alias("span"), "journey")
              .agg(*[F.sum(name).alias(name) for name in COUNTED]))
    return _with_rates(counts, delay)


# --- deliveries and what became of them -------------------------------------------------

def _kind(events: DataFrame, kind: str, delay: str | None) -> DataFrame:
    rows = events.filter(p.is_event(kind) & F.col("member_id").isNotNull() & F.col("campaign_id").isNotNull())
    return _with_watermark(rows, delay) if delay else rows


def delivery_opens(events: DataFrame, within: str = "2 days", delay: str | None = None) -> DataFrame:
    """(delivery_id, member_id, campaign_id, delivered_at, open_id, opened_at): every delivery with each
    open by the same member of the same campaign in the time ``within`` after it; without one, the open is NULL.

    Works on a table and, with ``delay``, on a stream: a left outer join of two streams that keeps a
    delivery as state until the watermark of both is past its last possible open. Then an unopened
    delivery comes out, once, and its state goes; opens go as soon as no delivery can need them. Events later than
    ``delay`` are dropped. State is dealt out by member and campaign.
    """
    sent, opened = _kind(events, "delivered", delay), _kind(events, "open", delay)
    left = sent.select(F.col("event_id").alias("delivery_id"), "member_id", "campaign_id",
                       F.col("event_at").alias("delivered_at"))
    right = opened.select(F.col("event_id").alias("open_id"), F.col("member_id").alias("open_member"),
                          F.col("campaign_id").alias("open_campaign"), F.col("event_at").alias("opened_at"))
    same = ((F.col("member_id") == F.col("open_member")) & (F.col("campaign_id") == F.col("open_campaign"))
            & (F.col("opened_at") >= F.col("delivered_at"))
            & (F.col("opened_at") <= F.col("delivered_at") + F.expr(f"INTERVAL {within}")))
    rows = left.join(right, same, "left").drop("open_member", "open_campaign")
    if delay:
        rows = rows.withColumns({c: zoneless(F.col(c)) for c in ("delivered_at", "opened_at")})
    return rows


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what has arrived and return what it appended."""
    spark = stream.sparkSession
    out, state = fresh_path(spark, name), fresh_path(spark, f"{name}-state")
    query = (stream.writeStream.outputMode("append").format("parquet")
             .option("path", out).option("checkpointLocation", state)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
