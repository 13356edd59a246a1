"""The function surface for SQL users: temporary functions of one session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from herald.operators.experiments import ASSIGNED, EXPORTED


def register_last_day(spark: SparkSession) -> None:
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION get_last_day_of_month(input_date DATE) "
              "RETURNS DATE RETURN last_day(input_date)")


#: Member ids that cut a table's rows into ranges.
CUTS = 64


def _table_function(spark: SparkSession, name: str, source: str, test: str, columns: list[str]) -> None:
    """Rows are numbered inside ranges of ``member_id``, and a range starts after what the earlier ones of its
    region hold. The ranges' bounds are the ids with the smallest hashes, so a region with a third of the
    rows is dealt over about a third of the ranges. A call's region reaches the scans of rows and counts."""
    typed = ", ".join(f"{c} STRING" for c in [*columns, "ab_group"])
    picked = ", ".join(f"n.{c}" for c in columns)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(region_name STRING) RETURNS TABLE({typed}) RETURN
        WITH ids AS (SELECT member_id FROM {source} WHERE member_id IS NOT NULL
                     ORDER BY xxhash64(member_id), member_id LIMIT {CUTS}),
        cuts AS (SELECT collect_set(member_id) AS bounds FROM ids),
        beside AS (SELECT *, (SELECT bounds FROM cuts) AS bounds FROM {source} WHERE location_tag IS NOT NULL{test}),
        placed AS (SELECT *, coalesce(size(filter(bounds, b -> b < member_id)), 0) AS id_range FROM beside),
        counts AS (SELECT location_tag, id_range, count(*) AS n_rows FROM placed GROUP BY location_tag, id_range),
        starts AS (SELECT location_tag, id_range, sum(n_rows) OVER (PARTITION BY location_tag ORDER BY id_range)
                          - n_rows AS before FROM counts),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY location_tag, id_range ORDER BY member_id) AS row_num
                     FROM placed)
        SELECT {picked}, CASE WHEN (f.before + n.row_num) % 2 = 0 THEN 'A' ELSE 'B' END
        FROM numbered AS n JOIN starts AS f ON n.location_tag = f.location_tag AND n.id_range = f.id_range
        WHERE n.location_tag = region_name""")


def register_region_functions(spark: SparkSession, audience: DataFrame | str, prefix: str = "") -> None:
    """assign_ab_groups(region) and export_region_audience(region) over a table, by its name, or
    over a DataFrame. A call reads the table as it is then, and numbers only its region, in many tasks
    if the region is large.
    ``prefix`` tells the functions of several audiences in one session apart.
    """
    if isinstance(audience, str):
        source = "`" + audience.replace("`", "``") + "`"
    else:
        source = f"audience_{uuid.uuid4().hex}"
        audience.createOrReplaceTempView(source)
    _table_function(spark, f"{prefix}assign_ab_groups", source, "", ASSIGNED)
    ready = " AND in_segment = 1 AND email IS NOT NULL AND first_name IS NOT NULL"
    _table_function(spark, f"{prefix}export_region_audience", source, ready, EXPORTED)


# Queries over a table whose name is data. The name is one identifier, whatever it holds, and the
# values are parameters, so nothing of a call is ever read as SQL. A missing argument is an error.
_ONE_NAME = "'`' || replace(:table_name, '`', '``') || '`'"
QUERIES = {
    "count_rows": f"SELECT count(*) AS n_rows FROM IDENTIFIER({_ONE_NAME})",
    # without a date there is no name either, so the call fails even on an empty table
    "contacts_since": (
        "SELECT member_id, first_name, last_name, email, location_raw, in_segment "
        f"FROM IDENTIFIER(CASE WHEN :since_date IS NOT NULL THEN {_ONE_NAME} END) "
        "WHERE in_segment = 1 AND ingested_at > CAST(CAST(:since_date AS DATE) AS TIMESTAMP_NTZ)"),
}


def register_named_table_queries(spark: SparkSession, prefix: str = "") -> None:
    """Session variables ``count_rows`` and ``contacts_since`` that hold queries over a named table, for SQL users:

        EXECUTE IMMEDIATE contacts_since USING 'batch_2024_06' AS table_name, DATE'2024-05-01' AS since_date;
        EXECUTE IMMEDIATE count_rows INTO n USING 'batch_2024_06' AS table_name;

    A table function cannot take the name: its body is resolved when it is made.
    """
    for name, text in QUERIES.items():
        literal = text.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"DECLARE OR REPLACE VARIABLE {prefix}{name} STRING DEFAULT '{literal}'")


def count_named_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """(table_name, n_rows) of tables whose names are data, as one SQL script: a loop over the names,
    with a row added to the result for each."""
    register_named_table_queries(spark, "herald_")
    spark.sql("DECLARE OR REPLACE VARIABLE herald_names ARRAY<STRING>")
    marks = ", ".join(f":n{i}" for i in range(len(names)))
    spark.sql(f"SET VAR herald_names = array({marks})", args={f"n{i}": n for i, n in enumerate(names)})
    spark.sql("DECLARE OR REPLACE VARIABLE herald_counts ARRAY<STRUCT<table_name: STRING, n_rows: BIGINT>> DEFAULT array()")
    spark.sql("""
        BEGIN
          DECLARE i INT DEFAULT 0;
          DECLARE n BIGINT;
          DECLARE name STRING;
          WHILE i < size(herald_names) DO
            SET name = herald_names[i];
            EXECUTE IMMEDIATE herald_count_rows INTO n USING name AS table_name;
            SET herald_counts = array_append(herald_counts, named_struct('table_name', name, 'n_rows', n));
            SET i = i + 1;
          END WHILE;
        END""")
    return spark.sql("SELECT inline(herald_counts)")
