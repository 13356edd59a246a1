"""Table schemas, their constraints, and the DDL built from them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from herald.functions.times import moment

_TEXT, _INT, _TIME = StringType(), IntegerType(), TimestampNTZType()

AUDIENCE = StructType([
    StructField("member_id", _TEXT, False),
    StructField("email", _TEXT, False),
    StructField("first_name", _TEXT, False),
    StructField("last_name", _TEXT),
    StructField("full_name", _TEXT),
    StructField("location_raw", _TEXT),
    StructField("in_segment", _INT),
    StructField("location_tag", _TEXT),
    StructField("std_location", _TEXT),
    StructField("profile_url", _TEXT),
    StructField("ab_group", _TEXT),
    StructField("ingested_at", _TIME),
])

INVENTORY = StructType([
    StructField("car_id", _TEXT, False),
    StructField("year", _INT),
    StructField("make", _TEXT),
    StructField("model", _TEXT),
    StructField("trim", _TEXT),
    StructField("mileage", _INT),
    StructField("price", DecimalType(10, 2)),
    StructField("photo_url", _TEXT),
    StructField("product_url", _TEXT),
    StructField("shop_location", _TEXT, False),
    StructField("scraped_at", _TIME),
])

DELIVERY_SYNC = StructType([
    StructField("member_id", _TEXT, False),
    StructField("provider_member_id", _TEXT),
    StructField("synced_at", _TIME),
    StructField("journey_status", _TEXT),
])

EMAIL_EVENTS = StructType([
    StructField("event_id", _TEXT, False),
    StructField("member_id", _TEXT),
    StructField("campaign_id", _TEXT),
    StructField("event_type", _TEXT),
    StructField("event_at", _TIME),
])

METRO_AREAS = StructType([
    StructField("city", _TEXT),
    StructField("state", _TEXT),
    StructField("region", _TEXT),
])

SHOPS = StructType([
    StructField("shop_location", _TEXT, False),
    StructField("address", _TEXT),
    StructField("phone", _TEXT),
    StructField("hours", _TEXT),
    StructField("tag", _TEXT),
])

SEGMENT_IDS = StructType([StructField("member_id", _TEXT, False)])

TABLES = {
    "audience": AUDIENCE,
    "inventory": INVENTORY,
    "delivery_sync": DELIVERY_SYNC,
    "email_events": EMAIL_EVENTS,
}

PRIMARY_KEYS = {
    "audience": "member_id",
    "inventory": "car_id",
    "delivery_sync": "member_id",
    "email_events": "event_id",
}


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    parent_column: str


FOREIGN_KEYS = [ForeignKey("email_events", "member_id", "audience", "member_id")]

# Columns that take a value when the input leaves them out: zero for the
# segment flag, load time for the arrival stamps.
ZERO_DEFAULTS = {"audience": ["in_segment"]}
TIME_DEFAULTS = {
    "audience": ["ingested_at"],
    "inventory": ["scraped_at"],
    "delivery_sync": ["synced_at"],
    "email_events": ["event_at"],
}


def required_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to the schema's columns and types; absent columns become NULL."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def apply_defaults(df: DataFrame, table: str,
                   now: dt.datetime | Column | None = None) -> DataFrame:
    """Fill the defaulted columns where NULL. ``now`` pins the clock for replays."""
    if now is None:
        stamp = F.current_timestamp().cast(_TIME)
    else:
        stamp = now.cast(_TIME) if isinstance(now, Column) else moment(now)
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in ZERO_DEFAULTS.get(table, [])}
    filled |= {c: F.coalesce(F.col(c), stamp) for c in TIME_DEFAULTS.get(table, [])}
    return df.withColumns(filled)


def _column_ddl(table: str, field: StructField) -> str:
    default = ""
    if field.name in ZERO_DEFAULTS.get(table, []):
        default = " DEFAULT 0"
    elif field.name in TIME_DEFAULTS.get(table, []):
        default = " DEFAULT localtimestamp()"
    return f"{field.name} {field.dataType.simpleString()}{default}"


def create_tables(spark: SparkSession, database: str = "default") -> None:
    for table, schema in TABLES.items():
        columns = ", ".join(_column_ddl(table, f) for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet")


def reset_tables(spark: SparkSession, database: str = "default") -> None:
    for table in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
