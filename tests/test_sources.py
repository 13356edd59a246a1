import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from herald import schemas
from herald.functions.sql import register_last_day
from herald.operators import quality
from herald.sources import listings, tables
from herald.sources.contacts import read_contacts_csv


def member(spark, rows):
    return spark.createDataFrame(rows, "member_id STRING, email STRING, ingested_at TIMESTAMP_NTZ")


JAN, FEB, MAR = (dt.datetime(2024, m, 1) for m in (1, 2, 3))


# --- DDL and defaults ------------------------------------------------------------------

def test_tables_with_defaults(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS ddl LOCATION '{tmp_path}/ddl'")
    schemas.reset_tables(spark, "ddl")
    schemas.create_tables(spark, "ddl")
    spark.sql("INSERT INTO ddl.audience (member_id, email, first_name) VALUES ('1', 'e', 'f')")
    row = spark.table("ddl.audience").first()
    assert row.in_segment == 0 and row.ingested_at is not None and row.last_name is None
    for name, schema in schemas.TABLES.items():
        got = [(f.name, f.dataType) for f in spark.table(f"ddl.{name}").schema]
        assert got == [(f.name, f.dataType) for f in schema]
    cars = spark.createDataFrame([("c", "x")], "car_id STRING, shop_location STRING")
    for _ in range(2):
        tables.replace_table(schemas.conform(cars, schemas.INVENTORY), "ddl.inventory")
    assert spark.table("ddl.inventory").count() == 1
    schemas.reset_tables(spark, "ddl")
    assert [t.name for t in spark.catalog.listTables("ddl") if not t.isTemporary] == []


def test_apply_defaults_fills_only_nulls(spark):
    df = schemas.conform(spark.createDataFrame([("1", 1, None), ("2", None, JAN)],
                         "member_id STRING, in_segment INT, ingested_at TIMESTAMP_NTZ"), schemas.AUDIENCE)
    rows = schemas.apply_defaults(df, "audience", now=FEB).orderBy("member_id").collect()
    assert [(r.in_segment, r.ingested_at) for r in rows] == [(1, FEB), (0, JAN)]


# --- CSV -------------------------------------------------------------------------------

def test_contacts_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "member_id,email,first_name,last_name,location_raw,in_segment,profile_url,ingested_at\n"
        'm1,a@x,Ann,"Harries, MA","Dallas, TX",1,http://p,2024-01-02 03:04:05\n'
        'm2,b@x,Bob,"say ""hi""",,0,,2024-01-02 00:00:00\n'
        "m3,,Cy,Li,,0,,2024-01-02 00:00:00\n"
        ",d@x,Di,Li,,0,,2024-01-02 00:00:00\n"
        "m5,e@x,,Li,,0,,2024-01-02 00:00:00\n"
        "m6,f@x,Fay,Li,,yes,,2024-01-02 00:00:00\n"
        "m7,g@x,Gus\n")
    good, rejects = read_contacts_csv(spark, str(tmp_path / "c.csv"))
    rows = {r.member_id: r for r in good.collect()}
    assert set(rows) == {"m1", "m2"}
    assert (rows["m1"].last_name, rows["m1"].location_raw) == ("Harries, MA", "Dallas, TX")
    assert rows["m1"].ingested_at == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert rows["m2"].last_name == 'say "hi"'
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == ["malformed line", "missing email", "missing first_name",
                       "missing member_id", "unreadable in_segment"]
    assert [r.raw_line for r in rejects.collect() if r.raw_line] == ["m7,g@x,Gus"]
    assert rejects.filter("raw_line LIKE '%Gus%'").count() == 1
    assert rejects.filter("in_segment = 'yes'").count() == 1
    # The verdict on a line does not depend on what is selected from it.
    assert good.select("member_id").count() == good.count() == 2
    assert rejects.count() == 5 and good.filter("email = 'f@x'").isEmpty()


# --- named tables ----------------------------------------------------------------------

def test_contacts_since_excludes_midnight(spark):
    schemas.conform(spark.createDataFrame(
        [("a", 1, dt.datetime(2024, 5, 1)), ("b", 1, dt.datetime(2024, 5, 1, 0, 0, 1)),
         ("c", 0, dt.datetime(2024, 5, 2)), ("d", 1, None)],
        "member_id STRING, in_segment INT, ingested_at TIMESTAMP_NTZ"),
        schemas.AUDIENCE).createOrReplaceTempView("weekly_batch_2024_06")
    df = tables.contacts_since(spark, "weekly_batch_2024_06", dt.date(2024, 5, 1))
    assert [r.member_id for r in df.collect()] == ["b"]
    assert df.columns == tables.SINCE_COLUMNS


def test_table_names_are_not_sql(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW `weekly-2024 06` AS SELECT * FROM range(3)")
    assert tables.count_rows(spark, "weekly-2024 06") == 3
    for name in ("a.b", "x` UNION SELECT 1", "(SELECT 1)"):
        with pytest.raises(AnalysisException):
            tables.count_rows(spark, name)
    for args in ((None, JAN.date()), ("", JAN.date()), ("weekly-2024 06", None)):
        with pytest.raises(ValueError):
            tables.contacts_since(spark, *args)


def test_last_day(spark):
    register_last_day(spark)
    got = spark.sql("SELECT get_last_day_of_month(d) AS e FROM VALUES (DATE '2024-02-07'), "
                    "(DATE '2023-02-28'), (DATE '2024-12-31'), (CAST(NULL AS DATE)) AS t(d)")
    assert [r.e for r in got.collect()] == [dt.date(2024, 2, 29), dt.date(2023, 2, 28),
                                            dt.date(2024, 12, 31), None]


# --- segment ---------------------------------------------------------------------------

def test_segment_flag_and_members(spark):
    df = member(spark, [("a", "1", JAN), ("b", "2", JAN)])
    ids = spark.createDataFrame([("b",), ("b",), ("z",), (None,)], "member_id STRING")
    assert [(r.member_id, r.in_segment) for r in
            tables.segment_flag(df, ids).orderBy("member_id").collect()] == [("a", 0), ("b", 1)]
    assert [r.member_id for r in tables.segment_members(df, ids).collect()] == ["b"]


def test_csv_columns_go_by_their_names(spark, tmp_path):
    (tmp_path / "c.csv").write_text("email,extra,member_id,first_name\na@x,1,m1,Ann\nb@x,2,m2\n")
    good, rejects = read_contacts_csv(spark, str(tmp_path / "c.csv"))
    assert [tuple(r) for r in good.select("member_id", "email", "first_name").collect()] == [("m1", "a@x", "Ann")]
    assert "in_segment" not in good.columns and "extra" not in good.columns
    assert [r.reject_reason for r in rejects.collect()] == ["malformed line"]
    (tmp_path / "d.csv").write_text("email,first_name\na@x,Ann\n")
    with pytest.raises(ValueError, match="member_id"):
        read_contacts_csv(spark, str(tmp_path / "d.csv"))


# --- upsert and snapshots --------------------------------------------------------------

def upserted(df):
    return sorted((r.member_id, r.email) for r in df.collect())


@pytest.mark.parametrize("broadcast_rows", [50_000, 0])
def test_upsert(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(tables, "fits_broadcast",
                        lambda df: broadcast_rows > 0)
    base = member(spark, [("a", "a1", JAN), ("b", "b1", FEB), ("c", "c1", FEB), ("d", "d1", None)])
    batch = member(spark, [("b", "b2", MAR), ("b", "b0", JAN), ("c", "old", JAN), ("e", "e1", JAN),
                           ("a", "tie", JAN), ("d", "d2", JAN), (None, "x", MAR)])
    once = tables.upsert(base, batch)
    want = [("a", "tie"), ("b", "b2"), ("c", "c1"), ("d", "d2"), ("e", "e1")]
    assert upserted(once) == want
    assert upserted(tables.upsert(once, batch)) == want
    # Rows that repeat a key or have none pass, unless the batch brings the key.
    dirty = member(spark, [(None, "n1", JAN), (None, "n2", JAN), ("d", "dup1", JAN), ("d", "dup2", JAN),
                           ("a", "a1", JAN), ("a", "a0", JAN)])
    got = tables.upsert(dirty, member(spark, [("a", "a2", FEB)]))
    assert sorted((r.member_id or "", r.email) for r in got.collect()) == [
        ("", "n1"), ("", "n2"), ("a", "a2"), ("d", "dup1"), ("d", "dup2")]


@pytest.mark.parametrize("fits", [True, False])
def test_upsert_keeps_columns_the_batch_lacks(spark, monkeypatch, fits):
    monkeypatch.setattr(tables, "fits_broadcast", lambda df: fits)
    base = member(spark, [("a", "a1", JAN), ("b", "b1", FEB)]).withColumn("ab_group", F.lit("B"))
    batch = member(spark, [("a", "a2", FEB), ("b", "old", JAN), ("c", "c1", JAN)])
    got = tables.upsert(base, batch.select("member_id", "email", "ingested_at"),
                        defaults={"ab_group": F.lit("new")})
    assert sorted((r.member_id, r.email, r.ab_group) for r in got.select("member_id", "email", "ab_group").collect()) == [
        ("a", "a2", "B"), ("b", "b1", "B"), ("c", "c1", "new")]


def test_only_the_newest_versions_are_kept(spark, tmp_path):
    path = str(tmp_path / "kept")
    for i in range(5):
        tables.publish(member(spark, [("a", str(i), JAN)]), path, keep=2)
    assert sorted(f.name for f in (tmp_path / "kept").iterdir() if f.is_dir()) == [
        "version=000004", "version=000005"]
    assert upserted(tables.current(spark, path)) == [("a", "4")]


def test_latest_per_key_prunes_before_the_shuffle(spark):
    from plans import physical
    text = physical(tables.latest_per_key(member(spark, [("a", "1", JAN)]).repartition(2),
                                          "member_id", ["ingested_at"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "store")
    assert tables.current(spark, path) is None
    tables.publish(member(spark, [("a", "1", JAN)]), path)
    tables.publish(tables.upsert(tables.current(spark, path), member(spark, [("a", "2", FEB)])), path)
    assert upserted(tables.current(spark, path)) == [("a", "2")]
    # A version that was not written to the end is not read, and its number is not reused.
    (tmp_path / "store" / "version=000003").mkdir()
    assert upserted(tables.current(spark, path)) == [("a", "2")]
    assert tables.publish(member(spark, [("z", "9", JAN)]), path).endswith("version=000004")
    assert upserted(tables.current(spark, path)) == [("z", "9")]


def test_clustered_files_hold_ranges(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("member_id"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(
                                        F.concat(F.lit("t"), F.col("id") % 9)).alias("location_tag"))
    path = str(tmp_path / "store")
    tables.publish(rows.repartition(5), path, cluster_by=["location_tag", "member_id"])
    back = tables.current(spark, path)
    assert back.exceptAll(rows).isEmpty() and back.count() == 2000
    spans = (back.groupBy(F.input_file_name().alias("f"))
             .agg(F.min(F.struct("location_tag", "member_id")).alias("lo"),
                  F.max(F.struct("location_tag", "member_id")).alias("hi")).orderBy("lo").collect())
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    from herald.operators import metrics
    from plans import physical
    spark.sql(f"CREATE DATABASE IF NOT EXISTS buckets LOCATION '{tmp_path}/buckets'")
    people = spark.range(500).select(
        F.col("id").cast("string").alias("member_id"), F.lit("e").alias("email"), F.lit("f").alias("first_name"),
        F.lit("x").alias("location_tag"), F.lit(1).alias("in_segment"), F.lit("s").alias("journey_status"))
    tables.save_bucketed(people, "buckets.audience", "member_id", 8)
    tables.save_bucketed(people, "buckets.sync", "member_id", 8)
    events = people.select("member_id", F.lit("open").alias("event_type"))
    stock = spark.createDataFrame([("c", "x")], "car_id STRING, shop_location STRING")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = metrics.location_breakdown(spark.table("buckets.audience"), spark.table("buckets.sync"), events, stock)
        assert physical(df).count("Exchange hashpartitioning(member_id") == 1
        assert tuple(df.first()) == ("x", 500, 500, 100.0, 1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    spark.sql("DROP DATABASE buckets CASCADE")


def test_fallback(spark, tmp_path):
    empty, last = str(tmp_path / "empty"), str(tmp_path / "last")
    member(spark, []).write.parquet(empty)
    member(spark, [("a", "1", JAN)]).write.parquet(last)
    (tmp_path / "bare").mkdir()
    bare = str(tmp_path / "bare")
    assert tables.read_with_fallback(spark, [str(tmp_path / "none"), bare, empty, last]).count() == 1
    with pytest.raises(FileNotFoundError):
        tables.read_with_fallback(spark, [str(tmp_path / "none"), empty])


def test_fill_from_previous(spark):
    now, before = member(spark, [("a", "2", FEB)]), member(spark, [("a", "1", JAN), ("b", "1", JAN)])
    assert upserted(tables.fill_from_previous(now, before, "member_id")) == [("a", "2"), ("b", "1")]


# --- audit -----------------------------------------------------------------------------

def test_audit_counts_violations(spark):
    aud = schemas.conform(spark.createDataFrame(
        [("a", "e", "f"), ("a", None, "f"), ("b", "e", None), (None, "e", "f")],
        "member_id STRING, email STRING, first_name STRING"), schemas.AUDIENCE)
    ev = schemas.conform(spark.createDataFrame(
        [("1", "a"), ("2", "zz"), ("3", "zz"), ("4", None), ("4", "b")],
        "event_id STRING, member_id STRING"), schemas.EMAIL_EVENTS)
    found = {(r.table_name, r.constraint_name): r.violations for r in
             quality.audit({"audience": aud, "email_events": ev}).collect()}
    assert found == {("audience", "primary key member_id"): 1, ("audience", "not null member_id"): 1,
                     ("audience", "not null email"): 1, ("audience", "not null first_name"): 1,
                     ("email_events", "primary key event_id"): 1, ("email_events", "not null event_id"): 0,
                     ("email_events", "foreign key member_id"): 2}
    assert sorted(r.event_id for r in quality.orphan_events(ev, aud).collect()) == ["2", "3"]


def test_run_stats_append(spark, tmp_path):
    df = member(spark, [("a", "1", JAN), ("b", None, JAN)])
    stats = quality.run_stats("r1", {"kept": (df, F.col("email").isNotNull())})
    assert [tuple(r) for r in stats.collect()] == [("r1", "kept", 2, 1, 1)]
    for _ in range(2):
        quality.append_run_stats(stats, str(tmp_path / "stats"))
    assert spark.read.parquet(str(tmp_path / "stats")).count() == 2


# --- listings --------------------------------------------------------------------------

PAGE = """<html><body><h1>Stock</h1>
<article class="listing" data-shop="Boston"><a href="/product-details.html?id=c1"><img src="p1.jpg"></a>
<h2>2021 Lexus RX 350 AWD</h2><p class="trim">Premium</p><p>$38,900</p><p>32,400 mi</p></article>
<article class="listing" data-shop="boston "><a href="https://x/product-details.html?id=c2&amp;r=1">go</a>
<h2>Mystery wagon</h2><p>call us</p></article>
<article class="listing" data-shop="nowhere"><h2>no id</h2></article></body></html>"""


def test_parse_listings(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<html>empty</html>"), (3, None)], "page_id INT, html STRING")
    cars, rejects = listings.parse_listings(pages)
    rows = {r.car_id: r for r in cars.collect()}
    assert set(rows) == {"c1", "c2"}
    assert [("no id" in r.listing, r.reject_reason) for r in rejects.collect()] == [(True, "missing car_id")]
    assert rows["c2"].product_url == "https://x/product-details.html?id=c2&r=1"
    one, two = rows["c1"], rows["c2"]
    assert (one.year, one.make, one.model, one.trim) == (2021, "Lexus", "RX 350 AWD", "Premium")
    assert (one.price, one.mileage, one.photo_url) == (Decimal("38900.00"), 32400, "p1.jpg")
    assert one.product_url == "/product-details.html?id=c1"
    assert (two.year, two.make, two.price, two.mileage) == (None, None, None, None)


def test_parse_records(spark):
    df = spark.createDataFrame(
        [('{"id":"r1","title":"2020 Tesla Model 3","price":"24800.50","mileage":"41,800 mi","shop":"S"}',),
         ('{"title":"no id"}',), ("not json",)], "record STRING")
    cars, rejects = listings.parse_listing_records(df)
    rows = cars.collect()
    assert sorted(r.listing for r in rejects.collect()) == ["not json", '{"title":"no id"}']
    assert [(r.car_id, r.model, r.price, r.mileage, r.shop_location) for r in rows] == [
        ("r1", "Model 3", Decimal("24800.50"), 41800, "S")]


def test_normalize_shops(spark):
    cars = spark.createDataFrame([("1", "Boston"), ("2", " GREATER boston"), ("3", "moon"), ("4", None)],
                                 "car_id STRING, shop_location STRING")
    shops = spark.createDataFrame([("Greater Boston", "boston"), ("Dallas", "dallas")],
                                  "shop_location STRING, tag STRING")
    known, rejects = listings.normalize_shops(cars, shops)
    assert sorted(tuple(r) for r in known.collect()) == [("1", "Greater Boston"), ("2", "Greater Boston")]
    assert sorted(r.car_id for r in rejects.collect()) == ["3", "4"]
