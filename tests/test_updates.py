"""Merges that leave data alone, maintained sums, feeds of changes, counts taken while writing."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from herald import schemas
from herald.operators import metrics, quality
from herald.plans import maintained
from herald.plans.maintained import Breakdown
from herald.plans.weekly import Store, weekly_run
from herald.sources import changes, tables
from herald.sources.buckets import BucketTable
from herald.streaming import streams
from test_weekly import HEADER, lookup, pages, shops  # noqa: F401  (fixtures)

START = dt.datetime(2024, 1, 1)


def people(spark, rows):
    """rows: (member_id, email, days after the start)"""
    return spark.createDataFrame([(m, e, START + dt.timedelta(days=d)) for m, e, d in rows],
                                 "member_id STRING, email STRING, ingested_at TIMESTAMP_NTZ")


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def bag(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


# --- buckets ---------------------------------------------------------------------------

@pytest.fixture
def table(spark, tmp_path):
    made = BucketTable(str(tmp_path / "t"), "member_id", 8)
    rows = [(f"m{i}", f"e{i}", 0) for i in range(60)] + [("m1", "again", -1), (None, "x", 0), (None, "x", 0), (None, "y", 0)]
    made.write(people(spark, rows))
    return made, people(spark, rows)


def test_merge_leaves_untouched_files(spark, table):
    made, base = table
    before = files(made.path)
    batch = people(spark, [("m1", "new", 3), ("m2", "old", -3), ("m1", "older", 2), (None, "lost", 5)])
    version = made.merge(batch)
    assert bag(made.read(spark)) == bag(tables.upsert(base, batch))
    after = files(made.path)
    assert all(after[f] == t for f, t in before.items())  # nothing was rewritten in place
    touched = set(made.touched(batch.filter("member_id IS NOT NULL")))
    written = {int(f.split("bucket=")[1].split("/")[0]) for f in after.keys() - before.keys() if "bucket=" in f}
    assert written == touched and len(touched) <= 2
    read = {f for r in made.read(spark).inputFiles() for f in [r.removeprefix("file://")]}
    assert len(read & before.keys()) > len(read - before.keys())
    assert made.read(spark, version - 1).count() == base.count()


def test_new_keys_and_new_buckets(spark, tmp_path):
    made = BucketTable(str(tmp_path / "t"), "member_id", 32)
    first = people(spark, [("a", "1", 0)])
    made.merge(first)  # no table yet
    second = people(spark, [("b", "2", 0), ("c", "3", 0), ("d", "4", 0)])
    made.merge(second, keep=1)
    assert bag(made.read(spark)) == bag(first.unionByName(second))
    assert made.merge(people(spark, [])) == 2  # an empty batch makes no version
    assert made.versions(spark) == [2]


def test_a_failed_run_changes_nothing(spark, table, monkeypatch):
    made, base = table
    batch = people(spark, [(f"m{i}", "new", 3) for i in range(0, 60, 2)])
    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_stored", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            made.merge(batch)
    assert bag(made.read(spark)) == bag(base)
    left = {f for f in files(made.path) if "run=000002" in f}
    assert left  # the run had written its buckets
    made.merge(batch, keep=1)
    assert bag(made.read(spark)) == bag(tables.upsert(base, batch))
    assert not left & files(made.path).keys()
    named = {f.removeprefix("file://") for f in made.read(spark).inputFiles()}
    assert {f for f in files(made.path) if "bucket=" in f} == named  # and nothing that no version names


def test_put_replaces_all_rows_of_a_key(spark, table):
    made, base = table
    made.put(people(spark, [("m1", "one", 0), ("m99", "two", 0)]))
    got = {(r.member_id, r.email) for r in made.read(spark).filter("member_id IN ('m1', 'm99')").collect()}
    assert got == {("m1", "one"), ("m99", "two")}
    assert made.read(spark).count() == base.count()  # m1 had two rows


def test_rows_without_key_spread(spark, tmp_path):
    made = BucketTable(str(tmp_path / "t"), "member_id", 8)
    made.write(people(spark, [(None, f"e{i}", 0) for i in range(200)]))
    assert len(made.manifest(spark).runs) == 8


def test_stream_into_buckets_keeps_versions(spark, tmp_path):
    inbox, store, state = (str(tmp_path / n) for n in ("in", "store", "state"))
    whole = None
    for n in range(4):
        batch = people(spark, [(f"m{i}", f"week {n}", n) for i in range(n, 40, 7)])
        whole = batch if whole is None else whole.unionByName(batch)
        batch.write.mode("append").parquet(inbox)
        stream = streams.file_stream(spark, inbox, batch.schema)
        got = streams.ingest_contacts(stream, store, state, keep=2, buckets=8)
    assert bag(got) == bag(tables.latest_per_key(whole, "member_id", ["ingested_at"]))
    assert len(BucketTable(store).versions(spark)) == 2


def test_stream_into_versions_keeps_some(spark, tmp_path):
    inbox, store, state = (str(tmp_path / n) for n in ("in", "store", "state"))
    for n in range(4):
        batch = people(spark, [(f"m{n}", "x", n)])
        batch.write.mode("append").parquet(inbox)
        got = streams.ingest_contacts(streams.file_stream(spark, inbox, batch.schema), store, state, keep=2)
    assert got.count() == 4 and len(tables.complete_versions(spark, store)) == 2


# --- a weekly run over buckets, and only what changed -------------------------------------

def plans(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [found.apply(i).physicalPlanDescription() for i in range(found.size())]


def reads(spark, path):
    """The plans of finished queries that scan a file whose path holds ``path``."""
    return [t for t in plans(spark) if re.search(rf"Location: \w+ ?\[[^]]*{re.escape(path)}", t)]


def test_weekly_run_over_buckets(spark, tmp_path, lookup, shops):  # noqa: F811
    csv = [tmp_path / f"w{i}.csv" for i in range(3)]
    csv[0].write_text(HEADER + "".join(f'm{i},a{i}@x,Ann,Lee,"Dallas, TX",1,,2024-01-01 00:00:00\n' for i in range(30)))
    csv[1].write_text(HEADER + 'm1,new@x,Ann,Lee,"Boston, MA",1,,2024-01-08 00:00:00\n'
                      'm2,a2@x,Ann,Lee,"Dallas, TX",1,,2024-01-08 00:00:00\n'
                      "n1,n1@x,Nu,Lee,near Greater Boston,1,,\nbad\n")
    csv[2].write_text('member_id,email,first_name,location_raw,ingested_at\nm3,a3@x,Ann,Nowhere,2024-01-15 00:00:00\n')
    plain, bucketed = Store(str(tmp_path / "plain")), Store(str(tmp_path / "bucketed"), 8)
    for week, path in enumerate(csv):
        now = dt.datetime(2024, 1, 7 + 7 * week)
        common = (str(path), lookup, shops, pages(spark, "c1"))
        one = weekly_run(spark, plain, *common, now=now)
        two = weekly_run(spark, bucketed, *common, now=now, only_changes=True)
        assert bag(one["audience"]) == bag(two["audience"])
        assert bag(one["stats"]) == bag(two["stats"])
        if week == 0:
            assert two["changes"] is None and two["payloads"].count() == 30
            before = files(bucketed.root)
    feed = {(r.member_id, r.change) for r in two["changes"].collect()}
    assert feed == {("m3", "delete")}  # no longer at a known place
    second = spark.read.parquet(bucketed.at("payload_changes/run=20240114T000000")).collect()
    assert {(r.member_id, r.change, tuple(r.changed_columns or ())) for r in second} == {
        ("m1", "update", ("email", "std_location", "location_tag")), ("n1", "insert", ())}
    assert spark.read.text(bucketed.at("payloads/run=20240114T000000")).count() == 2
    kept = [f for f in before if "audience-buckets" in f and "bucket=" in f and f in files(bucketed.root)]
    assert kept and all(files(bucketed.root)[f] == before[f] for f in kept)


def test_stats_cost_no_scan(spark, tmp_path, lookup, shops):  # noqa: F811
    """The list is parsed by one query, and no query only counts the audience."""
    csv = tmp_path / "only-once.csv"
    csv.write_text(HEADER + 'm1,a@x,Ann,Lee,"Dallas, TX",1,,\nm2,,Bo,Lee,,1,,\n')
    store = Store(str(tmp_path / "counted-store"))
    run = weekly_run(spark, store, str(csv), lookup, shops, pages(spark, "c1"), now=dt.datetime(2024, 1, 7))
    assert {tuple(r)[1:] for r in run["stats"].collect()} == {("contacts", 2, 1, 1), ("qualified", 1, 1, 0)}
    parsed = reads(spark, "only-once.csv")
    assert len([t for t in parsed if "raw_line" in t]) == 1  # the other one looks for the header
    assert "CollectMetrics" in [t for t in parsed if "raw_line" in t][0]
    assert not [t for t in reads(spark, "counted-store/audience") if "count(if" in t or "count_if" in t]
    written = [t for t in plans(spark) if re.search(r"Arguments: \S*counted-store/audience", t)]
    assert len(written) == 1 and "CollectMetrics" in written[0]


def test_watched_rows_count_once(spark, tmp_path):
    rows = spark.range(1000).withColumnRenamed("id", "n")
    seen = {}

    def watch(df):
        df, seen["s"] = quality.watched(df, "s", F.col("n") > 10)
        return df

    tables.publish(rows, str(tmp_path / "t"), cluster_by=["n"], watch=watch)
    empty, seen["none"] = quality.watched(rows.limit(0), "none", F.lit(True))
    empty.write.parquet(str(tmp_path / "e"))
    got = {tuple(r) for r in quality.observed_stats(spark, "r", seen).collect()}
    assert got == {("r", "s", 1000, 989, 11), ("r", "none", 0, 0, 0)}


# --- changes -------------------------------------------------------------------------------

def feed(spark, before, after):
    schema = "k STRING, a STRING, b STRING"
    got = changes.changes(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), "k")
    return {(r.k, r.change, tuple(r.changed_columns or ()), r.rows_before, r.rows_after) for r in got.collect()}


def test_changes_by_hand(spark):
    before = [("same", "1", None), ("a", "1", "2"), ("null", None, "x"), ("gone", "1", "1"),
              ("two", "1", "x"), ("two", "2", "y"), ("more", "1", "1"), (None, "1", "1"), (None, "2", "2"),
              ("cancel", "1", "2")]
    after = [("same", "1", None), ("a", "1", "3"), ("null", "x", None), ("new", None, None),
             ("two", "1", "y"), ("two", "2", "x"), ("more", "1", "1"), ("more", "1", "1"), (None, "1", "1"), (None, "2", "3"),
             ("cancel", "2", "1")]
    assert feed(spark, before, after) == {
        ("a", "update", ("b",), 1, 1), ("null", "update", ("a", "b"), 1, 1), ("gone", "delete", (), 1, 0),
        ("new", "insert", (), 0, 1), ("two", "update", (), 2, 2), ("more", "update", ("a", "b"), 1, 2),
        (None, "update", ("b",), 2, 2), ("cancel", "update", ("a", "b"), 1, 1)}
    assert feed(spark, before, before) == set()
    assert feed(spark, [], [("", "1", "1"), (None, "1", "1")]) == {("", "insert", (), 0, 1), (None, "insert", (), 0, 1)}


def test_payloads_of_contacts_with_two_rows(spark):
    def audience(rows):
        return schemas.conform(spark.createDataFrame(
            [(m, e, "Ann", 1, t) for m, e, t in rows],
            "member_id STRING, email STRING, first_name STRING, in_segment INT, location_tag STRING"), schemas.AUDIENCE)

    before = audience([("m1", "a", "X"), ("m1", "b", "X"), ("m2", "c", "X"), (None, "d", "X")])
    after = audience([("m1", "a", "X"), ("m1", "z", "X"), ("m2", "c", None), (None, "e", "X")])
    got = sorted((r.member_id, r.change, "z" in (r.payload or "")) for r in changes.changed_payloads(before, after).collect())
    assert got == [("m1", "update", False), ("m1", "update", True), ("m2", "delete", False)]


# --- the maintained breakdown ------------------------------------------------------------------

def board_tables(spark):
    audience = schemas.conform(spark.createDataFrame(
        [(f"m{i}", "e", "F", i % 4 != 0, None if i % 7 == 0 else f"L{i % 3}") for i in range(60)],
        "member_id STRING, email STRING, first_name STRING, in_segment BOOLEAN, location_tag STRING")
        .withColumn("in_segment", F.col("in_segment").cast("int")), schemas.AUDIENCE)
    sync = schemas.conform(spark.createDataFrame([(f"m{i % 50}",) for i in range(0, 90, 2)], "member_id STRING"), schemas.DELIVERY_SYNC)
    kinds = ["open", "click", "delivered", "sent"]
    events = schemas.conform(spark.createDataFrame(
        [(str(i), None if i % 11 == 0 else f"m{(i * i) % 70}", kinds[i % 4]) for i in range(400)],
        "event_id STRING, member_id STRING, event_type STRING"), schemas.EMAIL_EVENTS)
    stock = schemas.conform(spark.createDataFrame([("c1", "L0"), ("c2", "L0"), ("c3", "L2")],
                                                  "car_id STRING, shop_location STRING"), schemas.INVENTORY)
    return audience, sync, events, stock


def test_breakdown_after_each_batch(spark, tmp_path):
    audience, sync, events, stock = board_tables(spark)
    board = Breakdown(str(tmp_path / "b"), 8)
    board.start(audience, sync)
    none = events.limit(0)
    assert bag(board.location_breakdown(stock)) == bag(metrics.location_breakdown(audience, sync, none, stock))
    taken = none
    for n in range(3):
        batch = events.filter(F.col("event_id").cast("int") % 3 == n)
        taken = taken.unionByName(batch)
        assert board.take_events(batch, n)
        assert bag(board.location_breakdown(stock)) == bag(metrics.location_breakdown(audience, sync, taken, stock))
        assert bag(board.location_status(stock)) == bag(metrics.location_status(audience, sync, taken, stock))
    assert not board.take_events(events, 1)  # an old batch
    moved = audience.withColumn("location_tag", F.when(F.col("member_id").isin("m1", "m2"), "L9").otherwise(F.col("location_tag")))
    moved = moved.withColumn("in_segment", F.when(F.col("member_id") == "m5", 0).otherwise(F.col("in_segment")))
    late = schemas.conform(spark.createDataFrame([("m65", "e", "F", 1, "L1")], "member_id STRING, email STRING, "
                                                 "first_name STRING, in_segment INT, location_tag STRING"), schemas.AUDIENCE)
    board.take_contacts(moved.filter("member_id IN ('m1', 'm2', 'm5')").unionByName(late), 3)  # m65 has events already
    assert bag(board.location_breakdown(stock)) == bag(
        metrics.location_breakdown(moved.unionByName(late), sync, events, stock))


def test_breakdown_after_a_failed_batch(spark, tmp_path, monkeypatch):
    audience, sync, events, stock = board_tables(spark)
    board = Breakdown(str(tmp_path / "b"), 8)
    board.start(audience, sync)
    with monkeypatch.context() as m:
        m.setattr(maintained, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            board.take_events(events, 0)  # counts were written, sums were not
    assert bag(board.location_breakdown(stock)) == bag(metrics.location_breakdown(audience, sync, events.limit(0), stock))
    board.take_events(events, 0)
    assert bag(board.location_breakdown(stock)) == bag(metrics.location_breakdown(audience, sync, events, stock))


def test_a_batch_reads_its_own_events_only(spark, tmp_path):
    audience, sync, events, stock = board_tables(spark)
    parts = [str(tmp_path / f"events-{n}") for n in range(2)]
    for n, path in enumerate(parts):
        events.filter(F.col("event_id").cast("int") % 2 == n).write.parquet(path)
    board = Breakdown(str(tmp_path / "b"), 8)
    board.start(audience, sync)
    for n, path in enumerate(parts):
        board.take_events(spark.read.schema(schemas.EMAIL_EVENTS).parquet(path), n)
    assert [len(reads(spark, p)) for p in parts] == [1, 1]
    with pytest.raises(FileNotFoundError):
        Breakdown(str(tmp_path / "none")).take_events(events, 0)


# --- joined streams ------------------------------------------------------------------------------

def test_unopened_deliveries_come_out_once(spark, tmp_path):
    def batch(rows):
        return schemas.conform(spark.createDataFrame(
            [(e, m, "weekly_1", k, START + dt.timedelta(hours=h)) for e, m, k, h in rows],
            "event_id STRING, member_id STRING, campaign_id STRING, event_type STRING, event_at TIMESTAMP_NTZ"),
            schemas.EMAIL_EVENTS)

    inbox = str(tmp_path / "in")
    parts = [batch([("d1", "a", "delivered", 0), ("d2", "b", "delivered", 0), ("d3", None, "delivered", 0)]),
             batch([("o1", "a", "open", 5), ("o2", "a", "open", 47), ("o3", "a", "open", 49), ("o4", "b", "open", 60)]),
             batch([("d4", "c", "delivered", 200), ("o5", "x", "open", 200)]),
             batch([("d5", "c", "delivered", 210), ("o6", "c", "open", 201)])]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(inbox)
    stream = streams.file_stream(spark, inbox, schemas.EMAIL_EVENTS, files_per_batch=1)
    got = sorted((r.delivery_id, r.open_id) for r in streams.drain(
        streams.delivery_opens(stream, delay="1 day"), "opens").collect())
    # d5 still has time; d2 was opened too late
    assert got == [("d1", "o1"), ("d1", "o2"), ("d2", None), ("d4", "o6")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    want = {(r.delivery_id, r.open_id) for r in streams.delivery_opens(whole).collect()}
    assert set(got) == want - {("d5", None)}


# --- named tables and batches ------------------------------------------------------------------------

def test_missing_arguments_raise_in_sql(spark):
    from herald.functions.sql import register_named_table_queries

    register_named_table_queries(spark)
    people(spark, []).withColumn("in_segment", F.lit(1)).createOrReplaceTempView("empty_batch")
    for call in ("contacts_since USING 'empty_batch' AS table_name, CAST(NULL AS DATE) AS since_date",
                 "contacts_since USING CAST(NULL AS STRING) AS table_name, DATE'2024-01-01' AS since_date",
                 "count_rows USING CAST(NULL AS STRING) AS table_name",
                 "count_rows USING 'empty_batch WHERE 1 = 1' AS table_name"):
        with pytest.raises(Exception, match="NULL|NOT_FOUND"):
            spark.sql(f"EXECUTE IMMEDIATE {call}").collect()
    assert spark.sql("EXECUTE IMMEDIATE count_rows USING 'empty_batch' AS table_name").first().n_rows == 0


def test_only_later_days_are_opened(spark):
    rows = people(spark, [(f"m{d}", "e", d) for d in range(20)] + [("none", "e", 0)]).withColumn("in_segment", F.lit(1))
    rows = rows.withColumn("ingested_at", F.when(F.col("member_id") != "none", F.col("ingested_at")))
    rows = schemas.conform(rows, schemas.AUDIENCE)
    spark.sql("DROP TABLE IF EXISTS dated_batches")
    try:
        tables.append_batch(rows, "dated_batches")
        got = tables.arrived_since(spark, "dated_batches", dt.date(2024, 1, 18))
        assert {r.member_id for r in got.collect()} == {"m18", "m19"}
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(arrived" in plan and "arrived" in plan.split("PartitionFilters")[1][:120]
    finally:
        spark.sql("DROP TABLE IF EXISTS dated_batches")
    with pytest.raises(ValueError):
        tables.arrived_since(spark, "dated_batches", None)


def test_fill_from_previous_with_a_hot_shop(spark):
    now = spark.createDataFrame([("c1", "hot")] * 50 + [("c2", None)], "car_id STRING, shop STRING")
    before = spark.createDataFrame([("p1", "hot")] * 500 + [("p2", "quiet"), ("p3", None)], "car_id STRING, shop STRING")
    got = tables.fill_from_previous(now, before, "shop").groupBy("car_id").count().collect()
    assert {r.car_id: r["count"] for r in got} == {"c1": 50, "c2": 1, "p2": 1, "p3": 1}


def test_unique_rates_stay_below_hundred(spark):
    events = schemas.conform(spark.createDataFrame(
        [("1", "a", "weekly_1", "delivered")] + [(str(i), "a", "weekly_1", "open") for i in range(2, 9)]
        + [("9", "b", "weekly_1", "open")], "event_id STRING, member_id STRING, campaign_id STRING, event_type STRING"),
        schemas.EMAIL_EVENTS)
    assert [tuple(r) for r in metrics.unique_rates(events).collect()] == [("weekly", 1, 1, 0, 100.0, 0.0)]


def test_fields_of_a_feed(spark):
    from herald.sources.drift import drift, feed_fields

    def feed(*texts):
        return spark.createDataFrame([(t,) for t in texts], "record STRING")

    old = feed('{"a":1,"b":"x"}', '{"a":2.5,"b":null}', "{}", "[1,2]", "7", "{bad", "", None)
    assert {tuple(r) for r in feed_fields(old).collect()} == {
        ("a", "number", 2), ("b", "text", 1), ("b", "null", 1), (None, "unreadable", 4)}
    new = feed('{"a":"1","b":"x","c":{"d":[1]}}', '{"b":null,"e":[],"f":false}')
    assert {tuple(r) for r in drift(old, new).collect()} == {
        ("a", "number", 2, 0), ("a", "text", 0, 1), ("c", "record", 0, 1), ("e", "list", 0, 1), ("f", "flag", 0, 1),
        (None, "unreadable", 4, 0)}
    assert feed_fields(feed().limit(0)).count() == 0
