"""The built-in metropolitan areas; any other lookup of the same columns works as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from herald.schemas import METRO_AREAS

# City, state, region.
AREAS = [
    ("Dallas", "TX", "Dallas-Fort Worth Metroplex"),
    ("Atlanta", "GA", "Atlanta Metropolitan Area"),
    ("Boston", "MA", "Greater Boston"),
    ("Chicago", "IL", "Chicago Metropolitan Area"),
    ("Indianapolis", "IN", "Indianapolis Metropolitan Area"),
    ("San Francisco", "CA", "San Francisco Bay Area"),
    ("New York", "NY", "New York Metropolitan Area"),
]


def metro_areas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AREAS, METRO_AREAS)
