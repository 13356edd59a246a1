"""Elementary operators used as Spark offers them, at the points where SQL engines differ."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from plans import physical


def one(spark, sql):
    return spark.sql(sql).first()[0]


def test_inline_relation(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, NULL) AS t(id, x) ORDER BY id").collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, None)]


@pytest.mark.parametrize("sql, want", [
    ("split_part('a,b', ',', 1)", "a"), ("split_part('a,b', ',', 3)", ""), ("split_part(NULL, ',', 1)", None),
    (r"regexp_replace('x (a) y (b) z', r'(?s)\(.*\)', '')", "x  z"),
    ("lower('ÀB')", "àb"), ("trim('  a\t ')", "a\t"), ("reverse('abc')", "cba"),
    ("position(' ' IN 'a b')", 2), ("position('x' IN NULL)", None),
    ("split_part('de la cruz', ' ', -1)", "cruz"), ("concat('a', NULL)", None),
    ("concat('a', coalesce(NULL, ''))", "a"), ("'a%b' LIKE 'a\\\\%b'", True), ("'axb' LIKE 'a_b'", True),
    ("coalesce(NULL, NULL, 3)", 3), ("nullif(0, 0)", None), ("round(2.45, 1)", None),
    ("7 % 2", 1), ("trunc(DATE '2024-02-07', 'MM')", dt.date(2024, 2, 1)),
    ("CAST(trunc(DATE '2024-02-07', 'MM') + INTERVAL '1' MONTH - INTERVAL '1' DAY AS DATE)", dt.date(2024, 2, 29)),
    ("CAST('2024-01-01 23:59:59' AS DATE)", dt.date(2024, 1, 1)),
    ("CASE WHEN 1 > 2 THEN 'x' END", None), ("3 IN (1, NULL, 3)", True), ("try_cast('x' AS INT)", None),
])
def test_scalars(spark, sql, want):
    got = one(spark, f"SELECT {sql}")
    if sql.startswith("round"):
        assert str(got) == "2.5"
    else:
        assert got == want


def test_contains_takes_wildcards_literally(spark):
    df = spark.createDataFrame([("a%b here", "a%b"), ("axb here", "a%b"), (None, "a")], "t STRING, n STRING")
    assert [r[0] for r in df.select(F.contains("t", "n")).collect()] == [True, False, None]


def test_row_number_needs_an_order(spark):
    with pytest.raises(AnalysisException):
        spark.range(3).select(F.row_number().over(Window.partitionBy(F.lit(1)))).collect()


def test_text_order_is_by_bytes(spark):
    df = spark.createDataFrame([("a",), ("B",), ("A",), ("é",)], "s STRING")
    assert [r.s for r in df.orderBy("s").collect()] == ["A", "B", "a", "é"]
    assert [r.s for r in df.orderBy(F.desc("s")).collect()] == ["é", "a", "B", "A"]


def test_aggregates(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), ("y", 1), ("y", 1)], "k STRING, v INT")
    got = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("v"),
                              F.count_distinct("v").alias("d"), F.count_if(F.col("v") == 1).alias("c"))
    assert sorted(tuple(r) for r in got.collect()) == [("x", 2, 1, 1, 1), ("y", 2, 2, 1, 2)]
    assert got.filter("c > 1").count() == 1
    assert df.distinct().count() == 3
    assert df.unionByName(df).count() == 8


def test_joins(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), (None, "z")], "k STRING, a STRING")
    b = spark.createDataFrame([("1", "p"), ("1", "q"), (None, "r")], "k STRING, b STRING")
    assert a.join(b, "k").count() == 2
    assert a.join(b, "k", "left").count() == 4
    assert sorted(r.a for r in a.join(b, "k", "left_anti").collect()) == ["y", "z"]
    assert [r.a for r in a.join(b, "k", "left_semi").collect()] == ["x"]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "e")
    (spark.range(100).select(F.concat(F.when(F.col("id") % 2 == 0, "weekly_").otherwise("promo_"), "id").alias("campaign_id"),
                             F.lit("open").alias("event_type"), F.col("id").cast("string").alias("member_id"))
     .write.parquet(path))
    return spark.read.parquet(path)


def test_prefix_filter_and_columns_reach_the_scan(events):
    from herald.operators import metrics
    text = physical(metrics.kpi_ctr(events))
    assert "StringStartsWith(campaign_id,weekly)" in text
    assert "ReadSchema: struct<campaign_id:string,event_type:string>" in text


def test_cards_read_each_table_once(spark, events):
    from herald import schemas
    from herald.operators import metrics
    text = physical(metrics.kpi_cards(schemas.conform(events, schemas.AUDIENCE),
                                      schemas.conform(events, schemas.DELIVERY_SYNC), events))
    assert text.split("Initial Plan")[0].count("FileScan") == 3
    assert "Join" not in text
