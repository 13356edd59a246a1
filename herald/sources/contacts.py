"""Contact lists from CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

CONTACT_CSV = StructType([
    StructField("member_id", StringType()),
    StructField("email", StringType()),
    StructField("first_name", StringType()),
    StructField("last_name", StringType()),
    StructField("location_raw", StringType()),
    StructField("in_segment", IntegerType()),
    StructField("profile_url", StringType()),
    StructField("ingested_at", TimestampNTZType()),
])
REQUIRED = ("member_id", "email", "first_name")


def csv_by_header(spark: SparkSession, path: str | list[str], required: Sequence[str],
                  corrupt: str | None = None) -> DataFrame:
    """CSV as text, with columns named by the header. Every file of a folder must have the same
    header: one with another order is refused, as its values would go astray."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    names = reader.csv(path).columns
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"columns missing from {path}: {missing}")
    schema = StructType([StructField(n, StringType()) for n in names])
    reader = reader.option("enforceSchema", False)
    if corrupt:
        schema = schema.add(corrupt, StringType())
        reader = (reader.option("mode", "PERMISSIVE").option("columnPruning", False)
                  .option("columnNameOfCorruptRecord", corrupt))
    return reader.schema(schema).csv(path)


def checked_contacts(spark: SparkSession, path: str | list[str],
                     schema: StructType = CONTACT_CSV,
                     required: Sequence[str] = REQUIRED) -> DataFrame:
    """Every line as text, with ``raw_line`` if it does not split into as many fields as the
    header, and ``reject_reason`` unless it is good. Columns go by the header's names: others
    than the schema's are ignored, optional ones may be absent and then stay absent.

    Values are read as text and cast here. A typed reader converts only the columns a query
    selects, so whether a line counts as bad would depend on the query.
    """
    rows = csv_by_header(spark, path, required, corrupt="raw_line")
    rows = rows.select(*[n for n in schema.names if n in rows.columns], "raw_line")
    reason = F.when(F.col("raw_line").isNotNull(), "malformed line")
    for column in required:
        reason = reason.when(F.col(column).isNull(), f"missing {column}")
    for f in [f for f in schema.fields if f.name in rows.columns]:
        unreadable = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        reason = reason.when(unreadable, f"unreadable {f.name}")
    return rows.withColumn("reject_reason", reason)


def split_contacts(checked: DataFrame, schema: StructType = CONTACT_CSV) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): good lines typed, rejects as text."""
    good = checked.filter(F.col("reject_reason").isNull())
    return (good.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields
                          if f.name in checked.columns]),
            checked.filter(F.col("reject_reason").isNotNull()))


def read_contacts_csv(spark: SparkSession, path: str | list[str],
                      schema: StructType = CONTACT_CSV,
                      required: Sequence[str] = REQUIRED) -> tuple[DataFrame, DataFrame]:
    return split_contacts(checked_contacts(spark, path, schema, required), schema)
