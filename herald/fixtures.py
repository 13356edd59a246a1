"""The outreach tables as views over the benchmark star schema.

Each text is plain SQL that Spark and DuckDB both read; ``{name}`` stands for a base table.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from herald import schemas
from herald.sources.contacts import CONTACT_CSV

# Stated so that opening a table does not read file footers first.
BASE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}
BASE_TABLES = list(BASE_SCHEMAS)

METRO_AREAS = """
SELECT n_name AS city, r_name AS state, concat('Greater ', n_name, ' Area') AS region
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

AUDIENCE = """
SELECT
  c_name AS member_id,
  CASE WHEN c_custkey % 17 = 0 THEN NULL
       ELSE concat(lower(c_name), '@example.com') END AS email,
  CASE WHEN c_custkey % 23 = 0 THEN NULL
       ELSE concat('First', CAST(c_custkey % 50 AS VARCHAR(10))) END AS first_name,
  CASE c_custkey % 8
       WHEN 0 THEN 'Harries, MA' WHEN 1 THEN 'Smith PhD' WHEN 2 THEN 'de la Cruz'
       WHEN 3 THEN 'ZHANG' WHEN 4 THEN 'Chen (CPA)' WHEN 5 THEN '  wang '
       WHEN 6 THEN 'Lee (a) Van (b) Linde' ELSE NULL END AS last_name,
  CAST(NULL AS VARCHAR(40)) AS full_name,
  CASE c_custkey % 5
       WHEN 0 THEN concat(n_name, ', ', r_name, ', US')
       WHEN 1 THEN concat('Greater ', n_name, ' Area')
       WHEN 2 THEN concat('Elsewhere, ', r_name)
       WHEN 3 THEN 'Remote'
       ELSE concat(n_name, ' ,  ', r_name) END AS location_raw,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END AS in_segment,
  CASE WHEN c_custkey % 9 = 0 THEN NULL
       ELSE concat('Greater ', n_name, ' Area') END AS location_tag,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE n_name END AS std_location,
  concat('https://example.com/in/', CAST(c_custkey AS VARCHAR(12))) AS profile_url,
  CAST(NULL AS VARCHAR(1)) AS ab_group,
  CAST('2024-01-01' AS TIMESTAMP)
    + CAST(c_custkey % 30 AS INT) * INTERVAL '1' DAY AS ingested_at
FROM {customer}
JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""

INVENTORY = """
SELECT
  concat('P', CAST(p_partkey AS VARCHAR(12))) AS car_id,
  CAST(2015 + p_size % 10 AS INT) AS year,
  p_brand AS make,
  p_name AS model,
  p_type AS trim,
  CAST(p_size * 1000 AS INT) AS mileage,
  CAST(p_retailprice AS DECIMAL(10,2)) AS price,
  concat('https://example.com/photo/', CAST(p_partkey AS VARCHAR(12)), '.jpg') AS photo_url,
  concat('https://example.com/product-details.html?id=P',
         CAST(p_partkey AS VARCHAR(12))) AS product_url,
  concat('Greater NATION_', CAST(
    CASE WHEN p_partkey % 40 = 0 THEN 20
         WHEN p_partkey % 80 = 1 THEN 21
         WHEN p_partkey % 200 = 3 THEN 22
         ELSE p_partkey % 20 END AS VARCHAR(4)), ' Area') AS shop_location,
  CAST('2024-01-20' AS TIMESTAMP)
    + CAST(p_partkey % 10 AS INT) * INTERVAL '1' DAY AS scraped_at
FROM {part}
"""

DELIVERY_SYNC = """
SELECT
  c_name AS member_id,
  concat('m', CAST(c_custkey AS VARCHAR(12))) AS provider_member_id,
  CAST('2024-01-10' AS TIMESTAMP)
    + CAST(c_custkey % 22 AS INT) * INTERVAL '1' DAY AS synced_at,
  CASE c_custkey % 4
       WHEN 0 THEN 'onboarding_sent' WHEN 1 THEN 'weekly_active' WHEN 2 THEN 'paused'
       ELSE NULL END AS journey_status
FROM {customer}
WHERE c_custkey % 3 <> 0
"""

EMAIL_EVENTS = """
SELECT
  CAST(event_id AS VARCHAR(12)) AS event_id,
  concat('Customer#', lpad(CAST(user_id AS VARCHAR(12)), 9, '0')) AS member_id,
  CASE event_id % 3 WHEN 0 THEN 'onboarding_day0' WHEN 1 THEN 'weekly_2024_01'
       ELSE 'promo' END AS campaign_id,
  CASE event_type WHEN 'signup' THEN 'sent' WHEN 'purchase' THEN 'delivered'
       WHEN 'view' THEN 'open' WHEN 'click' THEN 'click' ELSE 'unsub' END AS event_type,
  ts AS event_at
FROM {events}
"""

SHOPS = """
SELECT
  concat('Greater ', n_name, ' Area') AS shop_location,
  concat(CAST(100 + n_nationkey AS VARCHAR(6)), ' Main & Side Street') AS address,
  concat('(555) 010-', lpad(CAST(n_nationkey AS VARCHAR(4)), 4, '0')) AS phone,
  'Mon - Sat 10:00 AM - 6:00 PM' AS hours,
  lower(n_name) AS tag
FROM {nation}
"""

# A weekly batch: one market segment re-sent with newer rows, one with rows older than the
# audience has, and members not seen before.
CONTACT_BATCH = """
SELECT
  c_name AS member_id,
  concat('w', CAST(c_custkey AS VARCHAR(12)), '@example.org') AS email,
  concat('Again', CAST(c_custkey AS VARCHAR(12))) AS first_name,
  concat('O Neil ', c_mktsegment, ', MBA') AS last_name,
  concat(n_name, ', ', r_name) AS location_raw,
  0 AS in_segment,
  concat('https://example.com/in/', CAST(c_custkey AS VARCHAR(12))) AS profile_url,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST('2024-03-01' AS TIMESTAMP)
       ELSE CAST('2023-12-01' AS TIMESTAMP) END AS ingested_at
FROM {customer}
JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')
UNION ALL
SELECT
  s_name AS member_id,
  concat(lower(s_name), '@example.org') AS email,
  'Newcomer' AS first_name,
  s_name AS last_name,
  concat('near Greater ', n_name, ' Area') AS location_raw,
  0 AS in_segment,
  CAST(NULL AS VARCHAR(40)) AS profile_url,
  CAST('2024-03-01' AS TIMESTAMP) AS ingested_at
FROM {supplier}
JOIN {nation} ON s_nationkey = n_nationkey
"""

# An audience as it may come from elsewhere: some ids repeated, some rows without one.
DIRTY_AUDIENCE = """
SELECT c_name AS member_id, concat('a', CAST(c_custkey AS VARCHAR(12)), '@example.com') AS email,
       'First' AS first_name, c_mktsegment AS last_name,
       CAST('2024-01-01' AS TIMESTAMP) AS ingested_at FROM {customer}
UNION ALL
SELECT CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE NULL END AS member_id,
       concat('b', CAST(c_custkey AS VARCHAR(12)), '@example.com') AS email,
       'Second' AS first_name, c_mktsegment AS last_name,
       CAST('2024-01-05' AS TIMESTAMP) AS ingested_at FROM {customer} WHERE c_custkey % 5 = 0
"""

# Members who asked for the segment's language, stated by the caller.
SEGMENT_IDS = """
SELECT DISTINCT c_name AS member_id
FROM {customer} JOIN {orders} ON o_custkey = c_custkey
WHERE o_orderpriority = '1-URGENT'
"""

VIEWS = {
    "metro_areas": (METRO_AREAS, schemas.METRO_AREAS),
    "audience": (AUDIENCE, schemas.AUDIENCE),
    "inventory": (INVENTORY, schemas.INVENTORY),
    "delivery_sync": (DELIVERY_SYNC, schemas.DELIVERY_SYNC),
    "email_events": (EMAIL_EVENTS, schemas.EMAIL_EVENTS),
    "shops": (SHOPS, schemas.SHOPS),
    "contact_batch": (CONTACT_BATCH, CONTACT_CSV),
    "dirty_audience": (DIRTY_AUDIENCE, schemas.AUDIENCE),
    "segment_ids": (SEGMENT_IDS, schemas.SEGMENT_IDS),
}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def over(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a template text over the base tables it names."""
    used = {n: base(spark, sf_dir, n) for n in BASE_TABLES if "{" + n + "}" in sql}
    return spark.sql(sql, **used)


@functools.lru_cache(maxsize=256)
def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view's plan; it is built once per session and folder, and holds no data."""
    sql, schema = VIEWS[name]
    return schemas.conform(over(spark, sf_dir, sql), schema)


def as_ctes(*names: str) -> str:
    """The same views as a WITH list for another SQL engine."""
    plain = {t: t for t in BASE_TABLES}
    return "WITH " + ",\n".join(
        f"{n} AS ({VIEWS[n][0].format(**plain).strip()})" for n in names) + "\n"
