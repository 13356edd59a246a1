import datetime as dt

import pytest

from herald.plans.ingest import ingest_audience
from herald.plans.weekly import Store, weekly_run
from herald.sources import tables

HEADER = "member_id,email,first_name,last_name,location_raw,in_segment,profile_url,ingested_at\n"
PAGE = ('<article class="listing" data-shop="dallas"><a href="/product-details.html?id={id}"></a>'
        "<h2>2021 Lexus RX</h2><p>$38,900</p><p>32,400 mi</p></article>")


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([("Dallas", "TX", "Dallas Area"), ("Boston", "MA", "Greater Boston")],
                                 "city STRING, state STRING, region STRING")


@pytest.fixture
def shops(spark):
    return spark.createDataFrame([("Dallas Area", "1 Main", "555", "9-5", "dallas")],
                                 "shop_location STRING, address STRING, phone STRING, hours STRING, tag STRING")


def pages(spark, *ids):
    return spark.createDataFrame([(PAGE.format(id=i),) for i in ids], "html STRING")


def test_two_weeks(spark, tmp_path, lookup, shops):
    store = Store(str(tmp_path / "store"))
    first, second = tmp_path / "w1.csv", tmp_path / "w2.csv"
    first.write_text(HEADER + 'm1,a@x,Ann,"Lee, MA","Dallas, TX",1,,2024-01-01 00:00:00\n'
                     'm2,b@x,Bob,Kim,"Plano, TX",0,,2024-01-01 00:00:00\n'
                     "m3,,Cy,Li,,1,,\n")
    second.write_text(HEADER + 'm1,new@x,Ann,"van Lee","Boston, MA",1,,2024-01-08 00:00:00\n'
                      "m4,d@x,Di,Oh,near Greater Boston,1,,\n")
    fetched = pages(spark, "c1", "c2").unionByName(
        pages(spark, "c3").replace(PAGE.format(id="c3"), PAGE.format(id="c3").replace("dallas", "moon")))
    one = weekly_run(spark, store, str(first), lookup, shops, fetched, now=dt.datetime(2024, 1, 7, 9))
    assert [r.reject_reason for r in spark.read.parquet(store.at("rejects/contacts")).collect()] == ["missing email"]
    assert [r.car_id for r in spark.read.parquet(store.at("rejects/stock")).collect()] == ["c3"]
    assert {r.scraped_at for r in one["inventory"].collect()} == {dt.datetime(2024, 1, 7, 9)}
    assert {(r.member_id, r.last_name, r.location_tag, r.std_location) for r in one["audience"].collect()} == {
        ("m1", "lee", "Dallas Area", "Dallas"), ("m2", "kim", "Dallas Area", "Dallas Area")}
    assert [(r.car_id, r.shop_location) for r in one["inventory"].orderBy("car_id").collect()] == [
        ("c1", "Dallas Area"), ("c2", "Dallas Area")]
    sent = spark.read.parquet(store.at("messages"))
    assert [r.member_id for r in sent.collect()] == ["m1"]
    assert {tuple(r)[1:] for r in one["stats"].collect()} == {("contacts", 3, 2, 1), ("qualified", 2, 1, 1)}

    # The second week brings no pages, so last week's stock stays.
    two = weekly_run(spark, store, str(second), lookup, shops, now=dt.datetime(2024, 1, 14, 9))
    got = {r.member_id: r for r in two["audience"].collect()}
    assert {m: (r.email, r.location_tag) for m, r in got.items()} == {
        "m1": ("new@x", "Greater Boston"), "m2": ("b@x", "Dallas Area"), "m4": ("d@x", "Greater Boston")}
    assert got["m4"].ingested_at == dt.datetime(2024, 1, 14, 9)
    assert two["inventory"].count() == 2
    assert spark.read.parquet(store.at("run_stats")).count() == 4
    assert spark.read.text(store.at("payloads")).count() == 3
    # Repeating the run replaces its output and leaves the audience as it is.
    again = weekly_run(spark, store, str(second), lookup, shops, now=dt.datetime(2024, 1, 14, 9))
    assert again["audience"].exceptAll(two["audience"]).isEmpty() and again["audience"].count() == 3
    assert spark.read.text(store.at("payloads")).count() == 3
    assert spark.read.parquet(store.at("run_stats")).count() == 4
    # A location without a shop gets cars from the pool.
    assert again["messages"].filter("html LIKE '%2021 Lexus RX%'").count() == 2


def test_a_list_without_columns_keeps_them(spark, tmp_path, lookup, shops):
    store = Store(str(tmp_path / "store"))
    first, second = tmp_path / "w1.csv", tmp_path / "w2.csv"
    first.write_text(HEADER + 'm1,a@x,Ann,Lee,"Dallas, TX",1,http://p,2024-01-01 00:00:00\n')
    second.write_text('first_name,email,member_id\nAnna,new@x,m1\n')
    one = weekly_run(spark, store, str(first), lookup, shops, pages(spark, "c1"), now=dt.datetime(2024, 1, 7))
    group = one["audience"].first().ab_group
    assert group in ("A", "B")
    row = weekly_run(spark, store, str(second), lookup, shops, now=dt.datetime(2024, 1, 14))["audience"].first()
    assert (row.email, row.first_name, row.in_segment, row.profile_url, row.ab_group, row.location_tag) == (
        "new@x", "Anna", 1, "http://p", group, "Dallas Area")


def test_fallbacks_and_journey(spark, tmp_path, lookup, shops):
    store = Store(str(tmp_path / "store"))
    csv = tmp_path / "w.csv"
    csv.write_text(HEADER + 'm1,a@x,Ann,Lee,"Dallas, TX",1,,\nm2,b@x,Bo,Lee,"Dallas, TX",1,,\n')
    with pytest.raises(FileNotFoundError):
        weekly_run(spark, store, str(tmp_path / "none.csv"), lookup, shops, pages(spark, "c1"))
    both = shops.unionByName(shops.replace({"Dallas Area": "Greater Boston", "dallas": "boston"}))
    fetched = pages(spark, "c1", "c1").unionByName(
        pages(spark, "b1").replace(PAGE.format(id="b1"), PAGE.format(id="b1").replace("dallas", "boston")))
    one = weekly_run(spark, store, str(csv), lookup, both, fetched, now=dt.datetime(2024, 1, 7))
    assert sorted(r.car_id for r in one["inventory"].collect()) == ["b1", "c1"]
    # Without a list the stored audience is used; a shop that was not fetched keeps its cars.
    sync = spark.createDataFrame([("m1", dt.datetime(2024, 1, 8)), ("m2", dt.datetime(2024, 1, 13))],
                                 "member_id STRING, synced_at TIMESTAMP_NTZ")
    two = weekly_run(spark, store, str(tmp_path / "none.csv"), lookup, both, pages(spark, "c2"),
                     now=dt.datetime(2024, 1, 14), sync=sync)
    assert sorted(r.car_id for r in two["inventory"].collect()) == ["b1", "c2"]
    assert [r.member_id for r in two["messages"].collect()] == ["m1"]
    assert two["payloads"].count() == 2


def test_a_run_leaves_nothing_in_the_shared_folder(spark, tmp_path, lookup, shops):
    from herald import scale
    csv = tmp_path / "w.csv"
    csv.write_text(HEADER + 'm1,a@x,Ann,Lee,"Dallas, TX",1,,\n')
    before = list(scale._settled)
    weekly_run(spark, Store(str(tmp_path / "s")), str(csv), lookup, shops, pages(spark, "c1"))
    with pytest.raises(FileNotFoundError):
        weekly_run(spark, Store(str(tmp_path / "t")), str(csv), lookup, shops)
    assert scale._settled == before


def test_stock_from_records(spark, tmp_path, lookup, shops):
    store = Store(str(tmp_path / "store"))
    csv = tmp_path / "w.csv"
    csv.write_text(HEADER + 'm1,a@x,Ann,Lee,"Dallas, TX",1,,\n')
    records = spark.createDataFrame(
        [('{"id":"r1","title":"2020 Tesla Model 3","price":"$24,800","shop":"Dallas"}',)], "record STRING")
    run = weekly_run(spark, store, str(csv), lookup, shops, records, now=dt.datetime(2024, 1, 7))
    assert "2020 Tesla Model 3" in run["messages"].first().html


def test_dry_run_writes_no_messages(spark, tmp_path, lookup, shops):
    store = Store(str(tmp_path / "store"))
    csv = tmp_path / "w.csv"
    csv.write_text(HEADER + 'm1,a@x,Ann,Lee,"Dallas, TX",1,,\n')
    run = weekly_run(spark, store, str(csv), lookup, shops, pages(spark, "c1"),
                     now=dt.datetime(2024, 1, 7), dry_run=True)
    assert run["messages"].count() == 1
    assert not (tmp_path / "store").exists()


def test_a_missing_stock_stops_the_run(spark, tmp_path, lookup, shops):
    store = Store(str(tmp_path / "store"))
    csv = tmp_path / "w.csv"
    csv.write_text(HEADER + 'm1,a@x,Ann,Lee,"Dallas, TX",1,,\n')
    with pytest.raises(FileNotFoundError):
        weekly_run(spark, store, str(csv), lookup, shops)
    assert not (tmp_path / "store" / "messages").exists()
    assert tables.current(spark, store.at("audience")).count() == 1


def test_ingest_takes_the_segment_from_a_list(spark, lookup):
    raw = spark.createDataFrame([("m1", "a", "A", "Lee", "Dallas, TX"), ("m2", "b", "B", None, None)],
                                "member_id STRING, email STRING, first_name STRING, last_name STRING, "
                                "location_raw STRING")
    ids = spark.createDataFrame([("m1",)], "member_id STRING")
    rows = ingest_audience(raw, lookup, segment_ids=ids, now=dt.datetime(2024, 1, 1)).orderBy("member_id").collect()
    assert [(r.in_segment, r.location_tag, r.full_name) for r in rows] == [
        (1, "Dallas Area", "A Lee"), (0, None, "B")]


def test_command_line(spark, tmp_path, capsys):
    from herald.run import main
    (tmp_path / "w.csv").write_text(HEADER + 'm1,a@x,Ann,Lee,"Dallas, TX",0,,\n')
    (tmp_path / "shops.csv").write_text("shop_location,address,phone,hours,tag\n"
                                        "Dallas-Fort Worth Metroplex,1 Main,555,9-5,dallas\n")
    (tmp_path / "ids.csv").write_text("member_id\nm1\n")
    pages(spark, "c1").write.parquet(str(tmp_path / "pages"))
    common = ["--csv", str(tmp_path / "w.csv"), "--store", str(tmp_path / "store"),
              "--shops", str(tmp_path / "shops.csv"), "--segment-ids", str(tmp_path / "ids.csv"),
              "--shuffle-partitions", "8"]
    main([*common, "--pages", str(tmp_path / "pages"), "--now", "2024-01-07T09:00:00"])
    assert "20240107T090000" in capsys.readouterr().out
    sent = spark.read.parquet(str(tmp_path / "store" / "messages")).collect()
    assert [r.member_id for r in sent] == ["m1"] and "2021 Lexus RX" in sent[0].html
    main([*common, "--skip-scrape", "--dry-run", "--now", "2024-01-14T09:00:00"])
    assert spark.read.parquet(str(tmp_path / "store" / "messages")).count() == 1
