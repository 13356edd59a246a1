import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from herald import scale, schemas
from herald.operators import experiments as ex
from herald.operators.ranking import number_rows


def skewed(spark, n=20_000, seed=3):
    """One stratum holds a third of the rows; ids arrive in random order."""
    ids = list(range(n))
    random.Random(seed).shuffle(ids)
    rows = [(f"id{i:07d}" if i % 5 else f"ID{i}",
             "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"s{i % 11}"), i) for i in ids]
    return spark.createDataFrame(rows, "member_id STRING, tag STRING, v INT").repartition(6)


def by_window(df, strata):
    w = Window.partitionBy(*strata).orderBy("member_id")
    return df.withColumn("row_num", F.row_number().over(w).cast("bigint"))


@pytest.mark.parametrize("strata", [["tag"], []])
def test_equals_a_plain_window(spark, strata):
    df = skewed(spark)
    got = number_rows(df, strata, "member_id")
    want = by_window(df, strata)
    assert got.columns == want.columns
    assert got.count() == want.count() == 20_000
    assert got.exceptAll(want).count() == 0


def test_a_stratum_spans_partitions(spark):
    """With many partitions, as on large data, numbers still continue across them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        df = skewed(spark)
        got = number_rows(df, ["tag"], "member_id")
        assert got.exceptAll(by_window(df, ["tag"])).count() == 0
        placed = spark.read.parquet(next(f for f in reversed(scale._settled) if "positions" in f))
        per_task = placed.groupBy("tag", F.shiftright("_pos", 33).alias("part")).count()
        hot = per_task.filter("tag = 'hot'").agg(F.count("part").alias("parts"), F.max("count").alias("most")).first()
        assert hot.parts >= 10 and hot.most < 20_000 / 15
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_repeated_keys_still_get_each_number_once(spark):
    df = skewed(spark, 3000).withColumn("member_id", F.substring("member_id", 1, 7))
    got = number_rows(df, ["tag"], "member_id")
    numbers = [c.select("tag", "row_num") for c in (got, by_window(df, ["tag"]))]
    assert numbers[0].exceptAll(numbers[1]).isEmpty() and got.count() == 3000
    again = number_rows(df.repartition(3), ["tag"], "member_id")
    assert got.exceptAll(again).isEmpty()


def test_empty(spark):
    assert number_rows(skewed(spark).limit(0), ["tag"], "member_id").count() == 0


def audience(spark):
    return (skewed(spark, 3000).withColumnRenamed("tag", "location_tag")
            .withColumns({"first_name": F.lit("f"), "email": F.lit("e"),
                          "last_name": F.lit("l"), "location_raw": F.lit("r"),
                          "in_segment": (F.col("v") % 2).cast("int")}))


def test_strata_are_balanced_and_start_with_b(spark):
    df = ex.ab_stratified(audience(spark), keep_row_number=True)
    per = df.groupBy("location_tag").agg(
        F.count_if(F.col("ab_group") == "A").alias("a"),
        F.count_if(F.col("ab_group") == "B").alias("b"),
        F.min_by("ab_group", "row_num").alias("first")).collect()
    assert per and all(r.b - r.a in (0, 1) and r.first == "B" for r in per)
    assert df.filter("location_tag IS NULL").count() == 0


def test_groups_can_be_stored_with_the_audience(spark):
    people = schemas.conform(audience(spark), schemas.AUDIENCE)
    stored = ex.ab_stratified(people, keep=people.columns)
    assert stored.columns == people.columns
    labels = stored.select("member_id", "ab_group")
    assert labels.exceptAll(ex.ab_stratified(people).select("member_id", "ab_group")).isEmpty()


def test_ordered_output(spark):
    rows = ex.ab_stratified(audience(spark), ordered=True).collect()
    keys = [(r.location_tag, r.member_id) for r in rows]
    assert keys == sorted(keys)


def test_region_export_numbers_after_filtering(spark):
    rows = ex.region_export(audience(spark), "hot").orderBy("member_id").collect()
    assert [r.ab_group for r in rows] == ["BA"[i % 2] for i in range(len(rows))]


def test_wrappers_read_named_tables(spark):
    audience(spark).createOrReplaceTempView("people")
    one = ex.assign_ab_groups(spark, "hot", table="people")
    assert one.exceptAll(ex.ab_stratified(audience(spark)).filter("location_tag = 'hot'")).isEmpty()
    two = ex.export_region_audience(spark, "hot", table="people")
    assert two.exceptAll(ex.region_export(audience(spark), "hot")).isEmpty()


def test_hash_split_is_stable_and_near_even(spark):
    df = ex.ab_hash_split(audience(spark), salt="s")
    share = df.filter("ab_group = 'A'").count() / df.count()
    assert 0.45 < share < 0.55
    assert df.exceptAll(ex.ab_hash_split(audience(spark).repartition(3), salt="s")).isEmpty()
    assert not df.exceptAll(ex.ab_hash_split(audience(spark), salt="t")).isEmpty()
