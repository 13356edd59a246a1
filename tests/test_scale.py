import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from herald import scale


def fact(spark):
    """A third under one key, some NULL keys, the rest spread."""
    key = (F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 1, F.lit(None))
           .otherwise(F.col("id") % 500))
    return spark.range(6000).select("id", key.cast("string").alias("k"))


def side(spark):
    one = spark.range(0, 300).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("w"))
    extra = spark.createDataFrame([("0", -1), ("5", -5), (None, -9)], "k STRING, w BIGINT")
    return one.unionByName(extra)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("partitions", [1, 8, 200])
def test_salted_join_equals_plain_join(spark, how, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = scale._salted_join(fact(spark), side(spark), ["k"], how)
        want = fact(spark).join(side(spark), ["k"], how)
        assert sorted(got.columns) == sorted(want.columns)
        got = got.select(want.columns)
        assert got.count() == want.count()
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def over_mean(df, tasks):
    """Rows of the largest task over the mean of all."""
    sizes = df.groupBy(F.spark_partition_id().alias("t")).count()
    return sizes.agg(F.max("count") * tasks / F.sum("count")).first()[0]


@pytest.mark.parametrize("tasks", [16, 200, 2000])
@pytest.mark.parametrize("equal", [False, True])
def test_hot_keys_spread_over_tasks(spark, tasks, equal):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": str(tasks)}
    before = {k: spark.conf.get(k) for k in settings}
    rows = spark.range(200 * tasks).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("string").alias("k"),
        (F.lit(0) if equal else F.col("id")).alias("v"))
    other = spark.createDataFrame([("-1", 1), ("7", 2)], "k STRING, w BIGINT")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert over_mean(rows.join(other, ["k"], "left"), tasks) > 0.3 * tasks
        assert over_mean(scale._salted_join(rows, other, ["k"], "left"), tasks) < 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_fact_side_is_read_twice(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact(spark).write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(path).mapInArrow(counted, "id bigint, k string")
    scale._salted_join(rows, side(spark), ["k"], "inner").count()
    assert read.value == 2 * 6000


def test_two_keys(spark):
    left = fact(spark).withColumn("j", F.col("id") % 2)
    right = side(spark).withColumn("j", F.col("w") % 2)
    got = scale._salted_join(left, right, ["k", "j"], "left")
    assert got.exceptAll(left.join(right, ["k", "j"], "left").select(got.columns)).isEmpty()


def test_keyed_join_takes_the_large_path_beyond_the_bound(spark):
    small = scale.keyed_join(fact(spark), side(spark), ["k"], "inner")
    large = scale.keyed_join(fact(spark), side(spark), ["k"], "inner", max_rows=10)
    assert small.exceptAll(large.select(small.columns)).isEmpty()
    assert small.count() == large.count()


def test_size_is_measured_in_rows_and_bytes(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert scale.fits_broadcast(df)
    assert not scale.fits_broadcast(df, max_rows=99)
    assert scale.fits_broadcast(df, max_rows=100)
    assert not scale.fits_broadcast(df, max_bytes=50_000)


def test_settle_reads_back_the_same_rows(spark):
    df = fact(spark)
    back = scale.settle(df, "t")
    assert back.schema == df.schema or back.dtypes == df.dtypes
    assert back.exceptAll(df).isEmpty()
    assert scale.shared_folder(spark) in back.inputFiles()[0]


def test_settled_tables_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(scale, "_settled", [])
    scale.settle(spark.range(3), "t")
    folder = scale._settled[0]
    assert scale.clear_settled(spark) == 1 and scale._settled == []
    with pytest.raises(AnalysisException):
        spark.read.parquet(folder)


def test_settled_for_clears_after_a_failure(spark):
    kept = scale.settle(spark.range(2), "kept")
    with pytest.raises(ZeroDivisionError):
        with scale.settled_for(spark):
            scale.settle(spark.range(3), "gone")
            folder = scale._settled[-1]
            1 / 0
    assert kept.count() == 2
    with pytest.raises(AnalysisException):
        spark.read.parquet(folder)
