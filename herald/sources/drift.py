"""Which fields a feed of JSON records has, of which kind, so that a changed feed is seen before it is parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNREADABLE = "unreadable"


def _kind(value: Column) -> Column:
    """text, number, flag, null, list or record."""
    schema = F.schema_of_variant(value)
    return (F.when(schema == "STRING", "text").when(schema == "BOOLEAN", "flag").when(schema == "VOID", "null")
            .when(schema.startswith("ARRAY"), "list").when(schema.startswith("OBJECT"), "record").otherwise("number"))


def feed_fields(records: DataFrame, column: str = "record") -> DataFrame:
    """(field, kind, records): in how many records each field is of each kind, at the top level; texts that
    are no JSON object are one row without a field. One pass; counts are added up per task, and fields are few."""
    parsed = records.filter(F.col(column).isNotNull()).select(F.try_parse_json(column).alias("v"))
    good = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    parsed = parsed.select(good.alias("good"), F.when(good, F.col("v")).alias("v"))
    rows = records.sparkSession.sql(
        "SELECT good, key AS field, value FROM {parsed}, LATERAL variant_explode_outer(v)", parsed=parsed)
    rows = rows.filter(~F.col("good") | F.col("field").isNotNull())  # an empty object has no field
    kind = F.when(F.col("good"), _kind(F.col("value"))).otherwise(UNREADABLE)
    return rows.select("field", kind.alias("kind")).groupBy("field", "kind").agg(F.count(F.lit(1)).alias("records"))


def drift(before: DataFrame, after: DataFrame, column: str = "record") -> DataFrame:
    """(field, kind, records_before, records_after) of every field and kind that only one of two deliveries has."""
    old = feed_fields(before, column).withColumnRenamed("records", "records_before")
    new = feed_fields(after, column).withColumnRenamed("records", "records_after")
    same = old["field"].eqNullSafe(new["field"]) & (old["kind"] == new["kind"])
    both = old.join(new, same, "full").select(
        F.coalesce(old["field"], new["field"]).alias("field"), F.coalesce(old["kind"], new["kind"]).alias("kind"),
        F.coalesce("records_before", F.lit(0)).alias("records_before"), F.coalesce("records_after", F.lit(0)).alias("records_after"))
    return both.filter((F.col("records_before") == 0) | (F.col("records_after") == 0))
