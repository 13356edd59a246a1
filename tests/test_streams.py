import datetime as dt

import pytest
from pyspark.sql import functions as F

from herald import schemas
from herald.sources import tables
from herald.streaming import streams

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)


def events(spark, rows):
    """rows: (event_id, hours after the start, type)"""
    return schemas.conform(spark.createDataFrame(
        [(e, "m", "weekly_1", k, START + dt.timedelta(hours=h)) for e, h, k in rows],
        "event_id STRING, member_id STRING, campaign_id STRING, event_type STRING, "
        "event_at TIMESTAMP_NTZ"), schemas.EMAIL_EVENTS)


def inbox(spark, path, *batches):
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(path)
    return streams.file_stream(spark, path, batches[0].schema, files_per_batch=1)


def table(df):
    return sorted(tuple(r) for r in df.select(
        F.date_format("window_start", "yyyy-MM-dd"), "journey", "delivered", "opens", "clicks",
        "open_rate").collect())


def test_daily_rates_of_a_table(spark):
    df = streams.daily_rates(events(spark, [("1", 1, "delivered"), ("2", 2, "open"), ("3", 30, "open")]))
    assert table(df) == [("2024-01-01", "weekly", 1, 1, 0, 100.0), ("2024-01-02", "weekly", 0, 1, 0, None)]


def test_stream_equals_table_for_closed_windows(spark, tmp_path):
    one = events(spark, [("1", 1, "delivered"), ("2", 2, "open"), ("3", 26, "delivered")])
    two = events(spark, [("4", 20, "click"), ("5", 80, "open"), ("6", 130, "delivered")])
    stream = inbox(spark, str(tmp_path / "in"), one, two)
    got = streams.drain(streams.daily_rates(stream, delay="1 day"), "daily")
    whole = table(streams.daily_rates(one.unionByName(two)))
    assert table(got) == [r for r in whole if r[0] <= "2024-01-04"]


def test_rows_past_the_watermark_are_dropped(spark, tmp_path):
    # A batch drops what was late for the batch before it.
    batches = [events(spark, rows) for rows in (
        [("1", 1, "open"), ("2", 24 * 5, "open")], [("3", 24 * 5, "click")],
        [("4", 2, "open"), ("5", 24 * 9, "open")], [("6", 24 * 12, "open")])]
    stream = inbox(spark, str(tmp_path / "in"), *batches)
    rows = {r[0]: r for r in table(streams.drain(streams.daily_rates(stream, delay="1 day"), "late"))}
    assert rows["2024-01-01"][3] == 1
    assert rows["2024-01-06"][3:5] == (1, 1)


def test_sliding_table_equals_sliding_windows(spark):
    df = events(spark, [(str(i), (i * 7) % 400, k) for i, k in
                        enumerate(["delivered", "open", "click", "sent"] * 30)])
    spans = F.window("event_at", "7 days", "1 day").alias("span")
    counts = df.withColumn("journey", F.lit("weekly")).groupBy(spans, "journey").agg(
        *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in streams.COUNTED.items()])
    assert table(streams.sliding_rates(df, days=7)) == table(streams._with_rates(counts, None))
    for days in (30, 90):
        spans = streams.sliding_rates(df, days=days)
        assert spans.filter(F.col("window_end") - F.col("window_start") != F.make_dt_interval(F.lit(days))).isEmpty()


def test_duplicates_across_batches_are_dropped(spark, tmp_path):
    one = events(spark, [("1", 1, "open"), ("1", 1, "open"), ("2", 2, "open")])
    two = events(spark, [("2", 2, "open"), ("3", 3, "open")])
    stream = inbox(spark, str(tmp_path / "in"), one, two)
    got = streams.drain(streams.dedupe_events(stream), "dedupe")
    assert got.schema["event_at"].dataType == one.schema["event_at"].dataType
    assert sorted(r.event_id for r in got.collect()) == ["1", "2", "3"]


def contact(spark, rows):
    return schemas.conform(spark.createDataFrame(
        [(m, e, START + n * DAY) for m, e, n in rows],
        "member_id STRING, email STRING, ingested_at TIMESTAMP_NTZ"), schemas.AUDIENCE)


def test_contacts_arrive_in_batches(spark, tmp_path):
    store, state, box = (str(tmp_path / n) for n in ("store", "state", "in"))
    one = contact(spark, [("a", "a1", 1), ("a", "a2", 2), ("b", "b1", 1)])
    two = contact(spark, [("b", "b2", 3), ("a", "a0", 0), ("c", "c1", 1), ("b", "tie", 1)])

    def run(stream):
        merged = streams.ingest_contacts(stream, store, state)
        return sorted((r.member_id, r.email) for r in merged.collect())
    assert run(inbox(spark, box, one, two)) == [("a", "a2"), ("b", "b2"), ("c", "c1")]
    # All batches of a run make one version; the next run continues from the checkpoint.
    assert tables.latest_version(spark, store) == 1
    assert run(inbox(spark, box, contact(spark, [("c", "c2", 5)]))) == [("a", "a2"), ("b", "b2"), ("c", "c2")]
    assert tables.latest_version(spark, store) == 2
    assert run(streams.file_stream(spark, box, one.schema)) == [("a", "a2"), ("b", "b2"), ("c", "c2")]


def test_a_run_that_died_before_its_merge_is_made_up_for(spark, tmp_path, monkeypatch):
    store, state, box = (str(tmp_path / n) for n in ("store", "state", "in"))
    streams.ingest_contacts(inbox(spark, box, contact(spark, [("a", "a1", 1)])), store, state)

    def die(*args):
        raise RuntimeError("lost")
    with monkeypatch.context() as broken:
        broken.setattr(streams, "publish", die)
        with pytest.raises(RuntimeError):
            streams.ingest_contacts(inbox(spark, box, contact(spark, [("a", "a2", 2), ("b", "b1", 1)])), store, state)
    merged = streams.ingest_contacts(inbox(spark, box, contact(spark, [("c", "c1", 1)])), store, state)
    assert sorted((r.member_id, r.email) for r in merged.collect()) == [("a", "a2"), ("b", "b1"), ("c", "c1")]
