"""The SQL function surface over live tables."""

import pytest

from herald.functions.sql import register_region_functions

COLUMNS = ("member_id STRING, first_name STRING, last_name STRING, email STRING, location_raw STRING, "
           "location_tag STRING, in_segment INT")


def people(spark, *ids, tag="X"):
    return spark.createDataFrame([(i, "F", "L", f"{i}@x", "raw", tag, 1) for i in ids], COLUMNS)


def called(spark, name, region="X"):
    return [(r.member_id, r.ab_group) for r in
            spark.sql(f"SELECT * FROM {name}(:r) ORDER BY member_id", {"r": region}).collect()]


def test_functions_read_the_table_as_it_is(spark):
    spark.sql("DROP TABLE IF EXISTS live_audience")
    try:
        people(spark, "a").write.saveAsTable("live_audience")
        register_region_functions(spark, "live_audience")
        assert called(spark, "assign_ab_groups") == [("a", "B")]
        people(spark, "b").write.insertInto("live_audience")
        assert called(spark, "assign_ab_groups") == [("a", "B"), ("b", "A")]
        assert called(spark, "export_region_audience") == [("a", "B"), ("b", "A")]
    finally:
        spark.sql("DROP TABLE live_audience")


def test_two_audiences_in_one_session(spark):
    register_region_functions(spark, people(spark, "a"), "one_")
    register_region_functions(spark, people(spark, "b"), "two_")
    assert called(spark, "one_assign_ab_groups") == [("a", "B")]
    assert called(spark, "two_assign_ab_groups") == [("b", "B")]


def test_nothing_is_settled_at_registration(spark):
    from herald import scale
    before = list(scale._settled)
    register_region_functions(spark, people(spark, "a"))
    assert scale._settled == before


@pytest.mark.parametrize("region", ["nowhere", "x' OR 1=1 --"])
def test_the_region_is_data(spark, region):
    register_region_functions(spark, people(spark, "a"))
    assert called(spark, "export_region_audience", region) == []


def test_a_large_region_is_numbered_in_ranges(spark):
    ids = [f"m{i:05d}" for i in range(6000)]
    rows = people(spark, *ids[::2]).unionByName(people(spark, *ids[1::2], tag="Y")).unionByName(
        people(spark, None, "m00000"))  # an id that is missing, and one that is there twice
    register_region_functions(spark, rows.repartition(7), "large_")
    got = called(spark, "large_assign_ab_groups")
    want = [None, "m00000", *ids[::2]]
    assert [m for m, _ in got] == want
    assert sorted(g for _, g in got[1:3]) == ["A", "B"]
    assert [g for _, g in got[3:]] == ["BA"[i % 2] for i in range(3, len(want))] and got[0][1] == "B"
    plan = spark.sql("SELECT * FROM large_assign_ab_groups('X')")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan
    numbering = [line for line in plan.splitlines() if "row_number()" in line]
    assert numbering and all("id_range" in line for line in numbering)


def test_an_empty_audience_has_no_rows(spark):
    register_region_functions(spark, people(spark, "a").limit(0), "empty_")
    assert called(spark, "empty_assign_ab_groups") == []
