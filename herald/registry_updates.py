"""Registered queries over state that is kept up to date, streams that are joined, and feeds of changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald import fixtures as fx
from herald import schemas
from herald.functions import predicates as p
from herald.functions.sql import count_named_tables, register_named_table_queries
from herald.operators import experiments, metrics, quality
from herald.operators.messages import delivery_payload
from herald.operators.typos import tag_typos
from herald.plans.dashboard import Tables, dashboard
from herald.plans.maintained import Breakdown
from herald.registry import (
    _CONTACT,
    _CONTACT_COLUMNS,
    _DIRTY,
    _HERE,
    _JOURNEY,
    _MEMBERS,
    _MERGED,
    _OUTCOME,
    _QUALIFIED,
    _STAMP,
    AS_OF,
    ORACLES,
    REGION,
    SINCE,
    _delta_sql,
    _engagement_sql,
    _event_stream,
    _n,
    _panel,
    _pct,
    _query,
)
from herald.scale import fresh_path, settle
from herald.sources import changes, sinks, tables
from herald.sources.buckets import BucketTable
from herald.sources.drift import drift, feed_fields
from herald.streaming import streams

BUCKETS = 16


# --- counts taken while rows are written ------------------------------------------------

@_query("run_stats_observed", "audience email_events", f"""
SELECT '2024-01-31' AS run_id, 'qualified' AS stage, count(*) AS rows_in,
       count(*) FILTER (WHERE {_QUALIFIED}) AS kept,
       count(*) - count(*) FILTER (WHERE {_QUALIFIED}) AS rejected FROM audience
UNION ALL
SELECT '2024-01-31', 'journey events', count(*), count({_JOURNEY}), count(*) - count({_JOURNEY})
FROM email_events""")
def _(spark, sf_dir, audience, events):
    """Payloads and a sorted copy of the events are written; the counts come with them."""
    seen = {}

    def watch(rows: DataFrame) -> DataFrame:
        rows, seen["journey events"] = quality.watched(rows, "journey events", p.campaign_family().isNotNull())
        return rows

    people, seen["qualified"] = quality.watched(audience, "qualified", p.qualified())
    sinks.write_payloads(delivery_payload(people.filter(p.qualified())), fresh_path(spark, "payloads"))
    tables.publish(events, fresh_path(spark, "events"), cluster_by=["event_at", "event_id"], watch=watch)
    return quality.observed_stats(spark, "2024-01-31", seen)


# --- merges that rewrite touched buckets only ---------------------------------------------

def _bucketed(spark: SparkSession, base: DataFrame) -> BucketTable:
    table = BucketTable(fresh_path(spark, "bucketed"), "member_id", BUCKETS)
    table.write(base)
    return table


@_query("upsert_buckets", "audience contact_batch", _MERGED + f"SELECT {_CONTACT} FROM newest")
def _(spark, sf_dir, audience, batch):
    """Two merges: the known members of the batch, then all of it, which changes nothing more of these."""
    table = _bucketed(spark, audience)
    batch = schemas.conform(batch, schemas.AUDIENCE)
    table.merge(batch.filter(F.col("member_id").startswith("Customer")), keep=2)
    table.merge(batch, keep=2)
    return table.read(spark).select(*_CONTACT_COLUMNS)


@_query("upsert_buckets_dirty", "dirty_audience contact_batch", _DIRTY)
def _(spark, sf_dir, dirty, batch):
    columns = ["member_id", "email", "first_name", "last_name", "ingested_at"]
    table = _bucketed(spark, dirty.select(columns))
    table.merge(batch.select(columns))
    return table.read(spark)


@_query("stream_contacts_buckets", "audience contact_batch", _MERGED + f"SELECT {_CONTACT} FROM newest")
def _(spark, sf_dir, audience, batch):
    inbox, store, state = (fresh_path(spark, n) for n in ("inbox", "contact-buckets", "contact-state"))
    batch = schemas.conform(batch, schemas.AUDIENCE)
    for arrivals in (audience, batch):
        arrivals.write.mode("append").parquet(inbox)
        stream = streams.file_stream(spark, inbox, schemas.AUDIENCE)
        merged = streams.ingest_contacts(stream, store, state, buckets=BUCKETS)
    return merged.select(*_CONTACT_COLUMNS)


# --- the breakdown, from new events only -----------------------------------------------------

def _three_batches(spark: SparkSession, audience: DataFrame, sync: DataFrame, events: DataFrame) -> Breakdown:
    """Contacts and syncs arrive in two parts, events in three."""
    board = Breakdown(fresh_path(spark, "breakdown"), BUCKETS)
    early = F.col("member_id") < "Customer#000000700"
    board.start(audience.filter(early), sync.filter(F.dayofmonth("synced_at") < 20))
    third = F.col("event_id").cast("bigint") % 3
    board.take_events(events.filter(third == 0), 0)
    board.take_contacts(audience.filter(~early), 1)
    board.take_events(events.filter(third == 1), 2)
    board.take_syncs(sync.filter(F.dayofmonth("synced_at") >= 20), 3)
    board.take_events(events.filter(third == 1), 2)  # delivered again: passed over
    board.take_events(events.filter(third == 2), 4)
    return board


@_query("breakdown_incremental", "audience delivery_sync email_events inventory")
def _(spark, sf_dir, audience, sync, events, inventory):
    return _three_batches(spark, audience, sync, events).location_breakdown(inventory)


@_query("status_incremental", "audience delivery_sync email_events inventory")
def _(spark, sf_dir, audience, sync, events, inventory):
    return _three_batches(spark, audience, sync, events).location_status(inventory)


@_query("stream_breakdown", "audience delivery_sync email_events inventory")
def _(spark, sf_dir, audience, sync, events, inventory):
    """Events arrive as files, twice in two runs of the stream."""
    board = Breakdown(fresh_path(spark, "breakdown"), BUCKETS)
    board.start(audience, sync)
    inbox, state = fresh_path(spark, "events-inbox"), fresh_path(spark, "events-state")
    for part in (0, 1):
        events.filter(F.col("event_id").cast("bigint") % 2 == part).coalesce(2).write.mode("append").parquet(inbox)
        board.follow(streams.file_stream(spark, inbox, schemas.EMAIL_EVENTS, files_per_batch=1), state)
    return board.location_breakdown(inventory)


ORACLES |= {"breakdown_incremental": ORACLES["location_breakdown"],
            "status_incremental": ORACLES["location_status"],
            "stream_breakdown": ORACLES["location_breakdown"]}


# --- what changed between two versions ---------------------------------------------------------

_NUMBER = "CAST(substr(member_id, 10) AS BIGINT)"
# The next version of the audience: members gone, changed, only stamped anew, and new.
_NEXT = f"""
SELECT CASE WHEN {_NUMBER} % 19 = 3 THEN concat('New', member_id) ELSE member_id END AS member_id,
       CASE WHEN {_NUMBER} % 7 = 1 AND email IS NOT NULL THEN concat('new-', email) ELSE email END AS email,
       CASE WHEN {_NUMBER} % 13 = 2 THEN NULL ELSE first_name END AS first_name,
       CASE WHEN {_NUMBER} % 7 = 1 THEN 'Changed' ELSE last_name END AS last_name,
       full_name, location_raw, in_segment, location_tag, std_location, profile_url, ab_group,
       CASE WHEN {_NUMBER} % 5 = 0 THEN CAST('2024-02-01' AS TIMESTAMP) ELSE ingested_at END AS ingested_at
FROM {{audience}} WHERE {_NUMBER} % 11 <> 0"""
_FEED_COLUMNS = ["email", "first_name", "last_name", "location_tag", "ingested_at"]


def _next(spark: SparkSession, audience: DataFrame) -> DataFrame:
    return schemas.conform(spark.sql(_NEXT, audience=audience), schemas.AUDIENCE)


def _feed_sql(before: str, after: str, columns: list[str], where: str = "true") -> str:
    """Versions side by side: per key the bag of rows, and of each column's values."""
    def bags(table: str) -> str:
        each = ", ".join(f"list_sort(list({c})) AS b_{c}" for c in columns)
        row = ", ".join(f"{c} := {c}" for c in columns)
        return (f"SELECT member_id, count(*) AS n, list_sort(list(struct_pack({row}))) AS bag, {each} "
                f"FROM {table} WHERE {where} GROUP BY member_id")

    names = ", ".join(f"CASE WHEN x.b_{c} IS DISTINCT FROM y.b_{c} THEN '{c}' END" for c in columns)
    return f"""
, x AS ({bags(before)}), y AS ({bags(after)}),
feed AS (
  SELECT coalesce(x.member_id, y.member_id) AS member_id,
         CASE WHEN x.n IS NULL THEN 'insert' WHEN y.n IS NULL THEN 'delete' ELSE 'update' END AS change,
         CASE WHEN x.n IS NOT NULL AND y.n IS NOT NULL
              THEN array_to_string(list_filter([{names}], lambda c: c IS NOT NULL), ',') END AS changed_columns,
         coalesce(x.n, 0) AS rows_before, coalesce(y.n, 0) AS rows_after
  FROM x FULL JOIN y ON x.member_id IS NOT DISTINCT FROM y.member_id WHERE x.bag IS DISTINCT FROM y.bag)
"""


def _flat(feed: DataFrame) -> DataFrame:
    return feed.withColumn("changed_columns", F.array_join("changed_columns", ","))


_NEXT_CTE = f", newer AS ({_NEXT.format(audience='audience').strip()})"


@_query("audience_changes", "audience", _NEXT_CTE + _feed_sql("audience", "newer", _FEED_COLUMNS)
        + "SELECT * FROM feed")
def _(spark, sf_dir, audience):
    path = fresh_path(spark, "versions")
    tables.publish(audience, path)
    tables.publish(_next(spark, audience), path)
    before, after = tables.current(spark, path, back=1), tables.current(spark, path)
    return _flat(changes.changes(before, after, "member_id", _FEED_COLUMNS))


# Rows without an id, and ids with several rows: some lose one, some get one more, some swap values.
_DIRTY_NEXT = """
SELECT member_id, email, CASE WHEN email LIKE '%7@example.com' THEN 'Third' ELSE first_name END AS first_name,
       last_name, ingested_at FROM {dirty} WHERE email NOT LIKE 'b%5@example.com'
UNION ALL
SELECT member_id, email, first_name, last_name, ingested_at FROM {dirty} WHERE email LIKE 'b%10@example.com'"""
_DIRTY_COLUMNS = ["email", "first_name", "last_name"]


@_query("audience_changes_dirty", "dirty_audience",
        f", newer AS ({_DIRTY_NEXT.format(dirty='dirty_audience').strip()})"
        + _feed_sql("dirty_audience", "newer", _DIRTY_COLUMNS) + "SELECT * FROM feed")
def _(spark, sf_dir, dirty):
    after = spark.sql(_DIRTY_NEXT, dirty=dirty)
    return _flat(changes.changes(dirty.select(*after.columns), after, "member_id", _DIRTY_COLUMNS))


_PAYLOAD_COLUMNS = ["email", "first_name", "last_name", "std_location", "profile_url", "location_tag"]


@_query("changed_payloads", "audience", _NEXT_CTE + _feed_sql("audience", "newer", _PAYLOAD_COLUMNS, _QUALIFIED) + f"""
SELECT f.member_id, change, changed_columns, CASE WHEN change <> 'delete' THEN
  '{{"email_address":"' || email || '","merge_fields":{{"EMAIL":"' || email || '","FNAME":"' || first_name
  || '","LNAME":"' || coalesce(last_name, '') || '","STD_LOC":"' || coalesce(std_location, '')
  || '","LK_URL":"' || coalesce(profile_url, '') || '"}},"tags":["cac-' || location_tag || '","source-linkedin"]}}'
  END AS payload
FROM feed AS f LEFT JOIN (SELECT * FROM newer WHERE {_QUALIFIED}) AS n ON n.member_id = f.member_id""")
def _(spark, sf_dir, audience):
    return _flat(changes.changed_payloads(audience, _next(spark, audience)))


# --- named tables from SQL -----------------------------------------------------------------------

_HOSTILE = "weekly.batch`; DROP TABLE audience --"


def _named(spark: SparkSession, df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView("named_source")
    quoted = "`" + name.replace("`", "``") + "`"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quoted} AS SELECT * FROM named_source")


@_query("sql_contacts_since", "audience", ORACLES["contacts_since"].split("\n)\n", 1)[-1])
def _(spark, sf_dir, audience):
    _named(spark, audience, _HOSTILE)
    register_named_table_queries(spark)
    return spark.sql("EXECUTE IMMEDIATE contacts_since USING :name AS table_name, :since AS since_date",
                     {"name": _HOSTILE, "since": SINCE})


ORACLES["sql_contacts_since"] = ORACLES["contacts_since"]


@_query("sql_count_rows", "audience", f"""
SELECT '{_HOSTILE}' AS table_name, count(*) AS n_rows FROM audience
UNION ALL SELECT 'orders', count(*) FROM orders""")
def _(spark, sf_dir, audience):
    _named(spark, audience, _HOSTILE)
    fx.base(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return count_named_tables(spark, [_HOSTILE, "orders"])


# --- dated batches ---------------------------------------------------------------------------------

@_query("arrived_since", "audience", None)
def _(spark, sf_dir, audience):
    """All batches in one table by day of arrival, added in two parts."""
    name = "batches_" + fresh_path(spark, "t").rsplit("-", 1)[-1]
    first = F.col("member_id") < "Customer#000000500"
    try:
        tables.append_batch(audience.filter(first), name)
        tables.append_batch(audience.filter(~first), name)
        return settle(tables.arrived_since(spark, name, SINCE), "arrived")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


ORACLES["arrived_since"] = ORACLES["contacts_since"]


# --- deliveries and what became of them --------------------------------------------------------------

_PAIRS = f"""
, sent AS (SELECT * FROM email_events WHERE event_type = 'delivered' AND member_id IS NOT NULL),
opened AS (SELECT * FROM email_events WHERE event_type = 'open' AND member_id IS NOT NULL),
pairs AS (SELECT s.event_id AS delivery_id, s.member_id, s.campaign_id, s.event_at AS d,
                 o.event_id AS open_id, o.event_at AS o
          FROM sent AS s LEFT JOIN opened AS o ON o.member_id = s.member_id AND o.campaign_id = s.campaign_id
               AND o.event_at >= s.event_at AND o.event_at <= s.event_at + INTERVAL '2' DAY)
SELECT delivery_id, member_id, campaign_id, {_STAMP.format('d')} AS delivered_at, open_id,
       {_STAMP.format('o')} AS opened_at FROM pairs"""


@_query("delivery_opens", "email_events", _PAIRS)
def _(spark, sf_dir, events):
    return streams.delivery_opens(events)


# The watermark is a day behind the stream that is behind; an unopened delivery comes out when its time is over.
@_query("stream_delivery_opens", "email_events", _PAIRS + """
WHERE open_id IS NOT NULL OR date_trunc('millisecond', d + INTERVAL '2' DAY) <
      date_trunc('millisecond', least((SELECT max(event_at) FROM sent), (SELECT max(event_at) FROM opened)) - INTERVAL '1' DAY)""")
def _(spark, sf_dir, _events):
    return streams.drain(streams.delivery_opens(_event_stream(spark, sf_dir), delay="1 day"), "delivery-opens")


# --- members, not events --------------------------------------------------------------------------------

@_query("unique_openers_daily", "audience email_events", f"""
SELECT strftime(event_at::DATE, '%Y-%m-%d') AS day, {_JOURNEY} AS journey, location_tag,
       count(DISTINCT e.member_id) AS openers
FROM email_events AS e LEFT JOIN audience AS a ON a.member_id = e.member_id
WHERE event_type = 'open' AND e.member_id IS NOT NULL AND {_JOURNEY} IS NOT NULL GROUP BY 1, 2, 3""")
def _(spark, sf_dir, audience, events):
    return metrics.daily_openers(audience, events).drop("sketch")


def _openers_sql() -> str:
    return "\nUNION ALL\n".join(f"""
SELECT {n} AS days, {_JOURNEY} AS journey, count(DISTINCT member_id) AS openers, true AS estimate_holds
FROM email_events WHERE event_type = 'open' AND {_JOURNEY} IS NOT NULL AND event_at < TIMESTAMP '2024-01-31'
  AND event_at >= TIMESTAMP '2024-01-31' - INTERVAL '{n}' DAY GROUP BY 2""" for n in (7, 30, 90))


@_query("unique_openers_trailing", "audience email_events", _openers_sql())
def _(spark, sf_dir, audience, events):
    """The sketches' estimates beside exact counts: within four standard errors of them."""
    daily = metrics.daily_openers(audience, events)
    estimates = metrics.trailing_openers(daily, AS_OF.date())
    opens = events.filter(p.is_event("open")).withColumn("journey", p.campaign_family())
    exact = opens.select("journey", "member_id", "event_at", F.explode(F.array(*map(F.lit, (7, 30, 90)))).alias("days"))
    back = F.date_diff(F.lit(AS_OF.date()), F.col("event_at").cast("date"))
    exact = (exact.filter(F.col("journey").isNotNull() & (back >= 1) & (back <= F.col("days")))
             .groupBy("days", "journey").agg(F.count_distinct("member_id").alias("openers")))
    error = F.abs(F.col("openers_estimate") - F.col("openers")) <= 4 * metrics.SKETCH_ERROR * F.col("openers") + 1
    return exact.join(estimates, ["days", "journey"], "left").select(
        "days", "journey", "openers", F.coalesce(error, F.lit(False)).alias("estimate_holds"))


@_query("unique_rates", "email_events", f"""
, m AS (SELECT {_JOURNEY} AS journey, member_id, bool_or(event_type = 'delivered') AS got,
               bool_or(event_type = 'open') AS opened, bool_or(event_type = 'click') AS clicked
        FROM email_events WHERE member_id IS NOT NULL AND {_JOURNEY} IS NOT NULL GROUP BY 1, 2)
SELECT journey, count(*) AS recipients, count(*) FILTER (WHERE opened) AS openers,
       count(*) FILTER (WHERE clicked) AS clickers,
       {_pct('count(*) FILTER (WHERE opened)', 'count(*)')} AS unique_open_rate,
       {_pct('count(*) FILTER (WHERE clicked)', 'count(*)')} AS unique_ctr
FROM m WHERE got GROUP BY journey""")
def _(spark, sf_dir, events):
    return metrics.unique_rates(events)


REPLICATES = 40


def _bootstrap_sql() -> str:
    steps = " + ".join(f"(u >= {s!r}::DOUBLE)::BIGINT" for s in experiments.POISSON_STEPS)
    return _OUTCOME + f"""
, facts AS (SELECT l.member_id, ab_group, {_n('open')} AS o, {_n('delivered')} AS d
            FROM labelled AS l JOIN email_events AS e ON e.member_id = l.member_id GROUP BY 1, 2),
draws AS (SELECT replicate, ab_group, o, d,
                 ('0x' || substr(md5('lift' || member_id || ':' || replicate), 1, 13))::BIGINT::DOUBLE
                 / 4503599627370496.0::DOUBLE AS u
          FROM facts, (SELECT unnest(range({REPLICATES})) AS replicate)),
sums AS (SELECT replicate, ab_group, sum(({steps}) * o)::DOUBLE AS o, sum(({steps}) * d)::DOUBLE AS d
         FROM draws GROUP BY 1, 2),
lifts AS (SELECT a.replicate, round(b.o / nullif(b.d, 0) - a.o / nullif(a.d, 0), 9) AS lift
          FROM sums AS a JOIN sums AS b ON a.replicate = b.replicate AND a.ab_group = 'A' AND b.ab_group = 'B')
"""


def _draws(audience: DataFrame, events: DataFrame) -> DataFrame:
    draws = experiments.ab_bootstrap(experiments.ab_stratified(audience), events, REPLICATES, "lift")
    return draws.withColumn("lift", F.round("lift", 9))


@_query("ab_bootstrap", "audience email_events", _bootstrap_sql() + "SELECT replicate, lift FROM lifts")
def _(spark, sf_dir, audience, events):
    return _draws(audience, events)


@_query("ab_bootstrap_interval", "audience email_events", _bootstrap_sql() + """
SELECT count(lift) AS replicates, round(quantile_cont(lift, 0.025), 7) AS low, round(quantile_cont(lift, 0.975), 7) AS high
FROM lifts""")
def _(spark, sf_dir, audience, events):
    interval = experiments.bootstrap_interval(_draws(audience, events))
    return interval.select("replicates", F.round("low", 7).alias("low"), F.round("high", 7).alias("high"))


# --- panels of the board that had no row of their own --------------------------------------------------

_panel("deltas", _delta_sql(("here", "sync", "every"), ("2024-01-17", "2024-01-03")))
_panel("low_engagement", _engagement_sql("0.25", "25", "here", "every"))
_panel("untagged", f"""
, c AS (SELECT count(*) AS contacts, count(*) - count(location_tag) AS untagged FROM audience)
SELECT contacts, untagged, {_pct('untagged', 'contacts')} AS untagged_pct,
       CASE WHEN untagged > 0.8 * contacts THEN 'WARNING' ELSE 'OK' END AS alert FROM c""")

_LOW_REGION = "Greater NATION_21 Area"


@_query("dashboard_low_stock", "audience inventory delivery_sync email_events", f"""
SELECT shop_location, car_count, CASE WHEN car_count < 20 THEN 'CRITICAL' ELSE 'WARNING' END AS alert_level
FROM (SELECT shop_location, count(*) AS car_count FROM inventory WHERE shop_location = '{_LOW_REGION}' GROUP BY 1)
WHERE car_count < 50""")
def _(spark, sf_dir, audience, inventory, sync, events):
    return dashboard(Tables(audience, inventory, sync, events), AS_OF, days=14, location=_LOW_REGION)["low_inventory"]


# --- places with a wrong letter ----------------------------------------------------------------------------

_MISSPELT = """
SELECT member_id, location_tag,
       CASE WHEN length(member_id) % 2 = 0 AND location_raw LIKE 'NATION%' THEN concat(substr(location_raw, 1, 3), substr(location_raw, 5))
            WHEN location_raw LIKE 'NATION%' AND in_segment = 1 THEN concat('nx', substr(location_raw, 2))
            WHEN location_raw LIKE 'Greater%' AND in_segment = 0 THEN replace(location_raw, 'Greater', 'Graeter')
            ELSE location_raw END AS location_raw
FROM {audience}"""


@_query("location_tag_typos", "audience metro_areas", f"""
, raw AS ({_MISSPELT.format(audience='audience').strip()}),
places AS (SELECT name, min(region) AS region FROM (
    SELECT city AS name, region FROM metro_areas UNION ALL SELECT region, region FROM metro_areas) GROUP BY 1),
asked AS (SELECT DISTINCT trim(split_part(location_raw, ',', 1)) AS text FROM raw WHERE location_tag IS NULL),
near AS (SELECT text, region FROM asked, places
         WHERE length(name) >= 4 AND (levenshtein(lower(text), lower(name)) <= 1 OR (levenshtein(lower(text), lower(name)) = 2
           AND list_sort(string_split(lower(text), '')) = list_sort(string_split(lower(name), ''))
           AND damerau_levenshtein(lower(text), lower(name)) = 1))
         QUALIFY row_number() OVER (PARTITION BY text ORDER BY damerau_levenshtein(lower(text), lower(name)), name) = 1)
SELECT member_id, coalesce(location_tag, region) AS location_tag
FROM raw LEFT JOIN near ON location_tag IS NULL AND text = trim(split_part(location_raw, ',', 1))""")
def _(spark, sf_dir, audience, lookup):
    return tag_typos(spark.sql(_MISSPELT, audience=audience), lookup).select("member_id", "location_tag")


# --- what a feed is made of -----------------------------------------------------------------------------------

_RECORDS = """
SELECT concat('{{"id":"', car_id, '","year":', CASE WHEN year % 3 = 0 AND {late} THEN concat('"', CAST(year AS VARCHAR(8)), '"')
              ELSE CAST(year AS VARCHAR(8)) END,
              CASE WHEN mileage > 20000 THEN concat(',"mileage":', CAST(mileage AS VARCHAR(8)), '.5') ELSE '' END,
              ',"photo":null,"sold":true,"tags":["a",1],"shop":{{"city":"x"}}',
              CASE WHEN {late} THEN ',"trim":"t"' ELSE ',"color":"c"' END,
              CASE WHEN year % 5 = 0 AND {late} THEN '' ELSE '}}' END) AS record FROM {inventory}"""


def _fields_sql(records: str) -> str:
    return f"""
SELECT field, CASE json_type(record, '$.' || field) WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'flag' WHEN 'NULL' THEN 'null'
         WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'record' ELSE 'number' END AS kind, count(*) AS records
FROM (SELECT record, unnest(json_keys(record)) AS field FROM {records} WHERE json_valid(record)) GROUP BY 1, 2
UNION ALL SELECT NULL, 'unreadable', count(*) FROM {records} WHERE NOT json_valid(record) HAVING count(*) > 0"""


def _records(late: str, inventory: str) -> str:
    return _RECORDS.format(late=late, inventory=inventory)


@_query("listing_fields", "inventory", f", recs AS ({_records('true', 'inventory')})" + _fields_sql("recs"))
def _(spark, sf_dir, inventory):
    inventory.createOrReplaceTempView("feed_inventory")
    return feed_fields(spark.sql(_records("true", "feed_inventory")))


@_query("listing_drift", "inventory", f"""
, r1 AS ({_records('false', 'inventory')}), r2 AS ({_records('true', 'inventory')}),
f1 AS ({_fields_sql('r1')}), f2 AS ({_fields_sql('r2')})
SELECT coalesce(f1.field, f2.field) AS field, coalesce(f1.kind, f2.kind) AS kind,
       coalesce(f1.records, 0) AS records_before, coalesce(f2.records, 0) AS records_after
FROM f1 FULL JOIN f2 ON f1.field IS NOT DISTINCT FROM f2.field AND f1.kind = f2.kind
WHERE f1.kind IS NULL OR f2.kind IS NULL""")
def _(spark, sf_dir, inventory):
    inventory.createOrReplaceTempView("feed_inventory")
    return drift(*(spark.sql(_records(late, "feed_inventory")) for late in ("false", "true")))
