"""Every registered query over the benchmark tables, and plain SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    TimestampNTZType,
    TimestampType,
)

from herald import fixtures as fx
from herald import schemas
from herald.functions import predicates as p
from herald.functions.sql import register_last_day, register_region_functions
from herald.functions.text import HTML_ESCAPES
from herald.functions.times import moment
from herald.operators import alerts, experiments, metrics, quality
from herald.operators.locations import tag_locations, tier_stats
from herald.operators.messages import (
    CARD,
    CLOSING,
    GREETING,
    OPENING,
    SUBJECT,
    delivery_payload,
    journey_stage,
    render_messages,
    weekly_recipients,
)
from herald.operators.names import clean_last_name
from herald.operators.picks import select_picks
from herald.plans.dashboard import Tables, dashboard
from herald.plans.ingest import ingest_audience
from herald.scale import fresh_path, settle
from herald.sources import listings, sinks, tables
from herald.sources.contacts import read_contacts_csv
from herald.sources.lookups import AREAS, metro_areas
from herald.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

REGION = "Greater NATION_3 Area"
AS_OF = dt.datetime(2024, 1, 31)
SINCE = dt.date(2024, 1, 15)
PICKS = 3
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


# --- helpers ---------------------------------------------------------------------------

def plain(df: DataFrame) -> DataFrame:
    """Only text, BIGINT and DOUBLE, so that both engines print the same values."""
    def cast(field):
        c = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(c, TIME_FORMAT).alias(field.name)
        if isinstance(field.dataType, DateType):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, (IntegerType, LongType)):
            return c.cast("bigint").alias(field.name)
        return c
    return df.select(*[cast(f) for f in df.schema.fields])


def _query(name: str, views: str = "", oracle: str | None = None):
    """Register a query over the named views, with SQL over the same views as CTEs."""
    names = views.split()

    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(spark, sf_dir, *[fx.view(spark, sf_dir, n) for n in names]))
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = (fx.as_ctes(*names) if names else "") + oracle
        return build
    return add


def _tenths(num: str, den: str) -> str:
    return (f"CASE WHEN ({den}) = 0 THEN NULL ELSE CAST((2000 * ({num}) + ({den})) "
            f"// (2 * ({den})) AS BIGINT) END")


def _pct(num: str, den: str) -> str:
    return f"({_tenths(num, den)}) / 10.0::DOUBLE"


def _n(kind: str, prefix: str = "") -> str:
    return f"count(*) FILTER (WHERE {prefix}event_type = '{kind}')"


_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_QUALIFIED = ("in_segment = 1 AND email IS NOT NULL AND first_name IS NOT NULL "
              "AND location_tag IS NOT NULL")
_JOURNEY = ("CASE WHEN campaign_id LIKE 'onboarding%' THEN 'onboarding' "
            "WHEN campaign_id LIKE 'weekly%' THEN 'weekly' END")


# --- cards, funnel, locations ----------------------------------------------------------

@_query("location_breakdown", "audience delivery_sync email_events inventory", f"""
SELECT au.location_tag, count(*) AS qualified, count(sy.member_id) AS in_flow,
       {_pct(_n('open', 'ev.'), 'count(*)')} AS open_rate,
       count(DISTINCT st.car_id) AS inventory_count
FROM audience AS au
LEFT JOIN inventory AS st ON st.shop_location = au.location_tag
LEFT JOIN email_events AS ev ON ev.member_id = au.member_id
LEFT JOIN delivery_sync AS sy ON sy.member_id = au.member_id
WHERE au.location_tag IS NOT NULL AND au.in_segment = 1
GROUP BY au.location_tag""")
def _(spark, sf_dir, audience, sync, events, inventory):
    return metrics.location_breakdown(audience, sync, events, inventory)


_MEMBERS = f"""
, stock AS (SELECT shop_location, count(DISTINCT car_id) AS cars FROM inventory GROUP BY 1),
mail AS (SELECT member_id, {_n('open')} AS o, {_n('click')} AS c, {_n('delivered')} AS d
         FROM email_events GROUP BY 1),
people AS (SELECT a.location_tag, sy.member_id AS synced, coalesce(o, 0) AS o,
                  coalesce(c, 0) AS c, coalesce(d, 0) AS d
           FROM audience AS a
           LEFT JOIN mail AS m ON m.member_id = a.member_id
           LEFT JOIN (SELECT DISTINCT member_id FROM delivery_sync) AS sy
             ON sy.member_id = a.member_id
           WHERE {_QUALIFIED}),
summary AS (SELECT location_tag, count(*) AS qualified, count(synced) AS in_flow,
                   {_pct('sum(o)', 'sum(d)')} AS open_rate, {_pct('sum(c)', 'sum(d)')} AS ctr
            FROM people GROUP BY location_tag)
"""


@_query("location_breakdown_members", "audience delivery_sync email_events inventory",
        _MEMBERS + """
SELECT location_tag, qualified, in_flow, open_rate, coalesce(cars, 0) AS inventory_count
FROM summary LEFT JOIN stock ON shop_location = location_tag""")
def _(spark, sf_dir, audience, sync, events, inventory):
    return metrics.location_breakdown(audience, sync, events, inventory, mode="members")


@_query("location_status", "audience delivery_sync email_events inventory", _MEMBERS + """
SELECT location_tag, qualified, in_flow, open_rate, ctr, coalesce(cars, 0) AS inventory_count,
       CASE WHEN coalesce(cars, 0) < 20 THEN 'LOW STOCK' ELSE 'OK' END AS status
FROM summary LEFT JOIN stock ON shop_location = location_tag""")
def _(spark, sf_dir, audience, sync, events, inventory):
    return metrics.location_status(audience, sync, events, inventory)


_OPEN_RATE = (f"(SELECT {_pct(_n('open'), _n('delivered'))} FROM {{0}} "
              "WHERE starts_with(campaign_id, 'onboarding'))")
_CTR = (f"(SELECT {_pct(_n('click'), _n('delivered'))} FROM {{0}} "
        "WHERE starts_with(campaign_id, 'weekly'))")


@_query("kpi_ingested", "audience", "SELECT count(*) AS t1_ingested FROM audience")
def _(spark, sf_dir, audience):
    return metrics.kpi_ingested(audience)


@_query("kpi_qualified", "audience",
        f"SELECT count(*) AS qualified FROM audience WHERE {_QUALIFIED}")
def _(spark, sf_dir, audience):
    return metrics.kpi_qualified(audience)


@_query("kpi_active", "delivery_sync", """
SELECT count(*) AS active_in_flow FROM delivery_sync
WHERE journey_status IN ('onboarding_sent', 'weekly_active')""")
def _(spark, sf_dir, sync):
    return metrics.kpi_active(sync)


@_query("kpi_onboarding_open_rate", "email_events",
        f"SELECT {_OPEN_RATE.format('email_events')} AS onboarding_open_rate")
def _(spark, sf_dir, events):
    return metrics.kpi_open_rate(events)


@_query("kpi_weekly_ctr", "email_events", f"SELECT {_CTR.format('email_events')} AS weekly_ctr")
def _(spark, sf_dir, events):
    return metrics.kpi_ctr(events)


@_query("kpi_cards", "audience delivery_sync email_events", f"""
SELECT (SELECT count(*) FROM audience) AS t1_ingested,
       (SELECT count(*) FROM audience WHERE {_QUALIFIED}) AS qualified,
       (SELECT count(*) FROM delivery_sync
        WHERE journey_status IN ('onboarding_sent', 'weekly_active')) AS active_in_flow,
       {_OPEN_RATE.format('email_events')} AS onboarding_open_rate,
       {_CTR.format('email_events')} AS weekly_ctr""")
def _(spark, sf_dir, audience, sync, events):
    return metrics.kpi_cards(audience, sync, events)


@_query("dashboard_location_cards", "audience inventory delivery_sync email_events", f"""
, here AS (SELECT * FROM audience WHERE location_tag = '{REGION}'),
mail AS (SELECT * FROM email_events
         WHERE member_id IN (SELECT member_id FROM here)
           AND event_at >= TIMESTAMP '2024-01-17' AND event_at < TIMESTAMP '2024-01-31'),
late AS (SELECT * FROM here WHERE ingested_at >= TIMESTAMP '2024-01-17'
         AND ingested_at < TIMESTAMP '2024-01-31')
SELECT (SELECT count(*) FROM late) AS t1_ingested,
       (SELECT count(*) FROM late WHERE {_QUALIFIED}) AS qualified,
       (SELECT count(*) FROM delivery_sync
        WHERE journey_status IN ('onboarding_sent', 'weekly_active')
          AND member_id IN (SELECT member_id FROM here)
          AND synced_at >= TIMESTAMP '2024-01-17'
          AND synced_at < TIMESTAMP '2024-01-31') AS active_in_flow,
       {_OPEN_RATE.format('mail')} AS onboarding_open_rate,
       {_CTR.format('mail')} AS weekly_ctr""")
def _(spark, sf_dir, audience, inventory, sync, events):
    board = Tables(audience, inventory, sync, events)
    return dashboard(board, AS_OF, days=14, location=REGION)["cards"]


_HERE = f"""
, here AS (SELECT * FROM audience WHERE location_tag = '{REGION}'),
sync AS (SELECT * FROM delivery_sync WHERE member_id IN (SELECT member_id FROM here)),
every AS (SELECT * FROM email_events WHERE member_id IN (SELECT member_id FROM here)),
mail AS (SELECT * FROM every
         WHERE event_at >= TIMESTAMP '2024-01-17' AND event_at < TIMESTAMP '2024-01-31'),
stock AS (SELECT * FROM inventory WHERE shop_location = '{REGION}')
"""


def _panel(name: str, oracle: str):
    """A panel of the board under its location and window filters."""
    @_query(f"dashboard_location_{name}", "audience inventory delivery_sync email_events", _HERE + oracle)
    def _(spark, sf_dir, audience, inventory, sync, events):
        return dashboard(Tables(audience, inventory, sync, events), AS_OF, days=14, location=REGION)[name]


_panel("journeys", f"""
SELECT {_JOURNEY} AS journey, {_n('sent')} AS sent, {_n('delivered')} AS delivered,
       {_pct(_n('open'), _n('delivered'))} AS open_rate, {_pct(_n('click'), _n('delivered'))} AS ctr,
       {_pct(_n('unsub'), _n('delivered'))} AS unsubscribe_rate
FROM mail WHERE {_JOURNEY} IS NOT NULL GROUP BY 1""")
_panel("pooled", f"""
SELECT {_n('delivered')} AS delivered, {_n('open')} AS opens, {_n('click')} AS clicks,
       {_pct(_n('open'), _n('delivered'))} AS open_rate, {_pct(_n('click'), _n('delivered'))} AS ctr
FROM mail WHERE {_JOURNEY} IS NOT NULL""")
_panel("funnel", f"""
, steps AS (
  SELECT '01 T1 Ingested' AS stage, count(*) AS n FROM here
  UNION ALL SELECT '02 Tagged', count(location_tag) FROM here
  UNION ALL SELECT '03 Qualified', count(*) FROM here WHERE {_QUALIFIED}
  UNION ALL SELECT '04 Entered Flow', count(journey_status) FROM sync)
SELECT stage, n AS count, {_pct('n', '(SELECT count(*) FROM here)')} AS share_pct FROM steps""")
_panel("inventory", f"""
SELECT count(*) AS cars_in_stock, count(DISTINCT shop_location) AS locations,
       {_STAMP.format('max(scraped_at)')} AS last_scrape,
       date_diff('minute', max(scraped_at), TIMESTAMP '2024-01-31') AS minutes_since_scrape,
       (SELECT count(*) FROM (SELECT shop_location FROM stock GROUP BY 1 HAVING count(*) < 20)) AS low_shops
FROM stock""")
_panel("low_inventory", """
SELECT shop_location, car_count, CASE WHEN car_count < 20 THEN 'CRITICAL' ELSE 'WARNING' END AS alert_level
FROM (SELECT shop_location, count(*) AS car_count FROM stock GROUP BY 1) WHERE car_count < 50""")
_panel("locations", f"""
, cars AS (SELECT shop_location, count(DISTINCT car_id) AS cars FROM stock GROUP BY 1),
m AS (SELECT member_id, {_n('open')} AS o, {_n('click')} AS c, {_n('delivered')} AS d FROM every GROUP BY 1),
people AS (SELECT a.location_tag, s.member_id AS synced, coalesce(o, 0) AS o, coalesce(c, 0) AS c,
                  coalesce(d, 0) AS d
           FROM here AS a LEFT JOIN m USING (member_id)
           LEFT JOIN (SELECT DISTINCT member_id FROM sync) AS s ON s.member_id = a.member_id
           WHERE {_QUALIFIED}),
summary AS (SELECT location_tag, count(*) AS qualified, count(synced) AS in_flow,
                   {_pct('sum(o)', 'sum(d)')} AS open_rate, {_pct('sum(c)', 'sum(d)')} AS ctr
            FROM people GROUP BY location_tag)
SELECT location_tag, qualified, in_flow, open_rate, ctr, coalesce(cars, 0) AS inventory_count,
       CASE WHEN coalesce(cars, 0) < 20 THEN 'LOW STOCK' ELSE 'OK' END AS status
FROM summary LEFT JOIN cars ON shop_location = location_tag""")


@_query("pooled_rates", "email_events", f"""
SELECT {_n('delivered')} AS delivered, {_n('open')} AS opens, {_n('click')} AS clicks,
       {_pct(_n('open'), _n('delivered'))} AS open_rate,
       {_pct(_n('click'), _n('delivered'))} AS ctr
FROM email_events WHERE {_JOURNEY} IS NOT NULL""")
def _(spark, sf_dir, events):
    return metrics.pooled_rates(events)


@_query("funnel", "audience delivery_sync", f"""
, steps AS (
  SELECT '01 T1 Ingested' AS stage, count(*) AS n FROM audience
  UNION ALL SELECT '02 Tagged', count(location_tag) FROM audience
  UNION ALL SELECT '03 Qualified', count(*) FROM audience WHERE {_QUALIFIED}
  UNION ALL SELECT '04 Entered Flow', count(journey_status) FROM delivery_sync)
SELECT stage, n AS count, {_pct('n', '(SELECT count(*) FROM audience)')} AS share_pct
FROM steps""")
def _(spark, sf_dir, audience, sync):
    return metrics.funnel(audience, sync)


@_query("journey_performance", "email_events", f"""
SELECT {_JOURNEY} AS journey, {_n('sent')} AS sent, {_n('delivered')} AS delivered,
       {_pct(_n('open'), _n('delivered'))} AS open_rate,
       {_pct(_n('click'), _n('delivered'))} AS ctr,
       {_pct(_n('unsub'), _n('delivered'))} AS unsubscribe_rate
FROM email_events WHERE {_JOURNEY} IS NOT NULL GROUP BY 1""")
def _(spark, sf_dir, events):
    return metrics.journey_performance(events)


@_query("inventory_coverage", "inventory", f"""
SELECT count(*) AS cars_in_stock, count(DISTINCT shop_location) AS locations,
       {_STAMP.format('max(scraped_at)')} AS last_scrape,
       date_diff('minute', max(scraped_at), TIMESTAMP '2024-01-31') AS minutes_since_scrape,
       (SELECT count(*) FROM (SELECT shop_location FROM inventory GROUP BY 1
                              HAVING count(*) < 20)) AS low_shops
FROM inventory""")
def _(spark, sf_dir, inventory):
    return metrics.inventory_coverage(inventory, AS_OF)


def _window(column: str, first: str, end: str) -> str:
    return f"{column} >= TIMESTAMP '{first}' AND {column} < TIMESTAMP '{end}'"


def _delta_sql(sources: tuple[str, str, str] = ("audience", "delivery_sync", "email_events"),
               starts: tuple[str, str] = ("2024-01-24", "2024-01-17")) -> str:
    now, before = (starts[0], "2024-01-31"), (starts[1], starts[0])
    people, flow, mail = sources

    def counted(table: str, column: str, test: str) -> str:
        return ", ".join(
            f"(SELECT count(*) FROM {table} WHERE {test} AND {_window(column, *w)}) AS {name}"
            for name, w in (("c", now), ("b", before)))

    def rate(kind: str) -> str:
        return ", ".join(
            f"(SELECT {_pct(_n(kind), _n('delivered'))} FROM {mail} "
            f"WHERE {_JOURNEY} IS NOT NULL AND {_window('event_at', *w)}) AS {name}"
            for name, w in (("c", now), ("b", before)))

    active = "journey_status IN ('onboarding_sent', 'weekly_active')"
    change = (f"(CASE WHEN c < b THEN -1 ELSE 1 END) * ({_tenths('abs(c - b)', 'b')}) "
              "/ 10.0::DOUBLE")
    lines = [
        ("ingested", counted(people, "ingested_at", "true"), change, "percent"),
        ("qualified", counted(people, "ingested_at", _QUALIFIED), change, "percent"),
        ("active", counted(flow, "synced_at", active), change, "percent"),
        ("open_rate", rate("open"), "(round(10 * c) - round(10 * b)) / 10.0::DOUBLE", "points"),
        ("ctr", rate("click"), "(round(10 * c) - round(10 * b)) / 10.0::DOUBLE", "points"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{m}' AS metric, c::DOUBLE AS current_value, b::DOUBLE AS previous_value, "
        f"{delta} AS delta, '{unit}' AS unit FROM (SELECT {pair})"
        for m, pair, delta, unit in lines)


@_query("period_delta", "audience delivery_sync email_events", _delta_sql())
def _(spark, sf_dir, audience, sync, events):
    return metrics.period_delta(audience, sync, events, AS_OF, days=7)


# --- alerts ----------------------------------------------------------------------------

@_query("low_inventory", "inventory", """
SELECT shop_location, car_count,
       CASE WHEN car_count < 20 THEN 'CRITICAL' ELSE 'WARNING' END AS alert_level
FROM (SELECT shop_location, count(*) AS car_count FROM inventory GROUP BY 1)
WHERE car_count < 50""")
def _(spark, sf_dir, inventory):
    return alerts.low_inventory(inventory)


@_query("stock_levels", "inventory shops", """
SELECT s.shop_location, count(car_id) AS car_count,
       CASE WHEN count(car_id) < 20 THEN 'CRITICAL' WHEN count(car_id) < 50 THEN 'WARNING'
            ELSE 'OK' END AS alert_level
FROM shops AS s LEFT JOIN inventory AS i ON i.shop_location = s.shop_location GROUP BY 1""")
def _(spark, sf_dir, inventory, shops):
    return alerts.low_inventory(inventory, shops=shops, include_ok=True)


def _engagement_sql(threshold: str, label: str, people: str = "audience", mail: str = "email_events") -> str:
    return f"""
, opened AS (SELECT location_tag, count(*) AS n, {_n('open')} AS o
             FROM {people} JOIN {mail} USING (member_id)
             WHERE location_tag IS NOT NULL GROUP BY 1)
SELECT location_tag, {_pct('o', 'n')} AS open_rate,
       CASE WHEN o < {threshold} * n THEN 'WARNING: Below {label}%' ELSE 'OK' END AS alert
FROM opened"""


@_query("low_engagement", "audience email_events", _engagement_sql("0.25", "25"))
def _(spark, sf_dir, audience, events):
    return alerts.low_engagement(audience, events)


@_query("low_engagement_20", "audience email_events", _engagement_sql("0.20", "20"))
def _(spark, sf_dir, audience, events):
    return alerts.low_engagement(audience, events, threshold=0.20)


@_query("untagged_alert", "audience", f"""
, c AS (SELECT count(*) AS contacts, count(*) - count(location_tag) AS untagged FROM audience)
SELECT contacts, untagged, {_pct('untagged', 'contacts')} AS untagged_pct,
       CASE WHEN untagged > 0.8 * contacts THEN 'WARNING' ELSE 'OK' END AS alert FROM c""")
def _(spark, sf_dir, audience):
    return alerts.untagged_alert(audience)


# --- names and locations ---------------------------------------------------------------

_NAME_STEPS = r"""
, cut AS (SELECT member_id, last_name, split_part(last_name, ',', 1) AS s1 FROM audience),
bare AS (SELECT *, regexp_replace(s1, '\(.*\)', '', 'gs') AS s2 FROM cut),
low AS (SELECT *, trim(lower(s2)) AS s3 FROM bare)
"""


@_query("name_clean", "audience", _NAME_STEPS + """
SELECT member_id, last_name, split_part(s3, ' ', -1) AS clean_last_name FROM low""")
def _(spark, sf_dir, audience):
    return clean_last_name(audience.select("member_id", "last_name"))


@_query("name_clean_steps", "audience", _NAME_STEPS + """
SELECT member_id, last_name, s1 AS step1_remove_titles, s2 AS step2_remove_parens,
       s3 AS step3_normalized, split_part(s3, ' ', -1) AS clean_last_name FROM low""")
def _(spark, sf_dir, audience):
    return clean_last_name(audience.select("member_id", "last_name"), keep_steps=True)


@_query("name_clean_documents", "", r"""
SELECT doc_id, CASE WHEN strpos(s3, ' ') > 0 THEN split_part(s3, ' ', -1) ELSE s3 END
         AS clean_last_name
FROM (SELECT doc_id, trim(lower(regexp_replace(split_part(text, ',', 1), '\(.*\)', '', 'gs'))) AS s3
      FROM documents)""")
def _(spark, sf_dir):
    texts = fx.base(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_last_name(texts, "text").select("doc_id", "clean_last_name")


def _tagged_sql(condition: str) -> str:
    return f"""
, asked AS (SELECT member_id, first_name, last_name, email, location_raw,
                   trim(split_part(location_raw, ',', 1)) AS c,
                   trim(split_part(location_raw, ',', 2)) AS s
            FROM audience WHERE {condition}),
one AS (SELECT a.*, m.region FROM asked AS a JOIN metro_areas AS m ON m.city = c AND m.state = s),
two AS (SELECT a.*, m.region FROM asked AS a JOIN metro_areas AS m
          ON contains(location_raw, m.region)
        WHERE member_id NOT IN (SELECT member_id FROM one)),
three AS (SELECT a.*, m.region FROM asked AS a JOIN metro_areas AS m ON m.state = s
          WHERE member_id NOT IN (SELECT member_id FROM one)
            AND member_id NOT IN (SELECT member_id FROM two)),
hit AS (SELECT *, 'exact_match' AS tier FROM one UNION ALL SELECT *, 'fuzzy_like' FROM two
        UNION ALL SELECT *, 'state_fallback' FROM three),
tagged AS (SELECT DISTINCT a.member_id, a.first_name, a.last_name, a.email, a.location_raw,
                  h.region AS location_tag, coalesce(h.tier, 'unmatched') AS match_tier
           FROM asked AS a LEFT JOIN hit AS h ON h.member_id = a.member_id)
"""


_REACHABLE = "in_segment = 1 AND email IS NOT NULL AND first_name IS NOT NULL"


@_query("location_tag_all", "audience metro_areas",
        _tagged_sql(_REACHABLE) + "SELECT * FROM tagged")
def _(spark, sf_dir, audience, metro):
    return tag_locations(audience, metro)


@_query("location_tag_first", "audience metro_areas", _tagged_sql("true") + """
SELECT member_id, first_name, last_name, email, location_raw,
       min(location_tag) AS location_tag, match_tier
FROM tagged GROUP BY ALL""")
def _(spark, sf_dir, audience, metro):
    return tag_locations(audience, metro, multi="first", only_reachable_segment=False)


@_query("location_tag_large_lookup", "audience metro_areas",
        _tagged_sql("true") + "SELECT * FROM tagged")
def _(spark, sf_dir, audience, metro):
    return tag_locations(audience, metro, only_reachable_segment=False, small_lookup_names=0)


@_query("tier_stats", "audience metro_areas", _tagged_sql("true") + f"""
SELECT match_tier, count(*) AS n_rows,
       {_pct('count(*)', '(SELECT count(*) FROM tagged)')} AS share_pct
FROM tagged GROUP BY 1""")
def _(spark, sf_dir, audience, metro):
    return tier_stats(tag_locations(audience, metro, only_reachable_segment=False))


# --- experiments -----------------------------------------------------------------------

def _numbered(condition: str, columns: str, by: str = "PARTITION BY location_tag") -> str:
    return f"""
, numbered AS (SELECT {columns}, row_number() OVER ({by} ORDER BY member_id) AS row_num
               FROM audience WHERE {condition}),
labelled AS (SELECT *, CASE row_num % 2 WHEN 1 THEN 'B' ELSE 'A' END AS ab_group FROM numbered)
"""


_CORE = "member_id, first_name, email, location_tag"
_EXPORT = "member_id, first_name, last_name, email, location_raw, location_tag"


@_query("ab_simple", "audience", _numbered(f"location_tag = '{REGION}'", _CORE, "")
        + "SELECT * FROM labelled")
def _(spark, sf_dir, audience):
    return experiments.ab_simple(audience, REGION)


@_query("ab_stratified", "audience", _numbered("location_tag IS NOT NULL", _CORE)
        + "SELECT * EXCLUDE (row_num) FROM labelled")
def _(spark, sf_dir, audience):
    return experiments.ab_stratified(audience)


@_query("ab_stratified_ranked", "audience", _numbered("location_tag IS NOT NULL", _CORE)
        + "SELECT * FROM labelled")
def _(spark, sf_dir, audience):
    return experiments.ab_stratified(audience, keep_row_number=True)


@_query("ab_region", "audience", _numbered(f"location_tag = '{REGION}'", _CORE)
        + "SELECT * EXCLUDE (row_num) FROM labelled")
def _(spark, sf_dir, audience):
    return experiments.ab_region(audience, REGION)


@_query("region_export", "audience",
        _numbered(f"location_tag = '{REGION}' AND {_REACHABLE}", _EXPORT)
        + "SELECT * EXCLUDE (row_num) FROM labelled")
def _(spark, sf_dir, audience):
    return experiments.region_export(audience, REGION)


@_query("ab_stratified_ordered", "audience", _numbered("location_tag IS NOT NULL", _CORE)
        + "SELECT * EXCLUDE (row_num) FROM labelled")
def _(spark, sf_dir, audience):
    return experiments.ab_stratified(audience, ordered=True)


@_query("sql_assign_ab_groups", "audience", _numbered(f"location_tag = '{REGION}'", _CORE)
        + "SELECT * EXCLUDE (row_num) FROM labelled")
def _(spark, sf_dir, audience):
    register_region_functions(spark, audience)
    return spark.sql("SELECT * FROM assign_ab_groups(:region)", {"region": REGION})


@_query("sql_export_region_audience", "audience",
        _numbered(f"location_tag = '{REGION}' AND {_REACHABLE}", _EXPORT)
        + "SELECT * EXCLUDE (row_num) FROM labelled")
def _(spark, sf_dir, audience):
    register_region_functions(spark, audience)
    return spark.sql("SELECT * FROM export_region_audience(:region)", {"region": REGION})


@_query("ab_hash_split", "audience", f"""
SELECT {_CORE}, CASE WHEN right(md5('subject-line' || member_id), 1) IN
         ('0', '2', '4', '6', '8', 'a', 'c', 'e') THEN 'A' ELSE 'B' END AS ab_group
FROM audience WHERE location_tag IS NOT NULL""")
def _(spark, sf_dir, audience):
    return experiments.ab_hash_split(audience, salt="subject-line")


_OUTCOME = _numbered("location_tag IS NOT NULL", _CORE) + f"""
, outcome AS (
  SELECT ab_group, count(DISTINCT l.member_id) AS members, {_n('sent')} AS sent,
         {_n('delivered')} AS delivered, {_n('open')} AS opens, {_n('click')} AS clicks
  FROM labelled AS l LEFT JOIN email_events AS e ON e.member_id = l.member_id GROUP BY 1)
"""


@_query("ab_results", "audience email_events", _OUTCOME + f"""
SELECT *, {_pct('opens', 'delivered')} AS open_rate, {_pct('clicks', 'delivered')} AS ctr
FROM outcome""")
def _(spark, sf_dir, audience, events):
    return experiments.ab_results(experiments.ab_stratified(audience), events)


@_query("ab_lift", "audience email_events", _OUTCOME + f"""
, pair AS (SELECT a.opens::BIGINT AS xa, a.delivered::BIGINT AS na, b.opens::BIGINT AS xb,
                  b.delivered::BIGINT AS nb
           FROM outcome AS a, outcome AS b WHERE a.ab_group = 'A' AND b.ab_group = 'B'),
rate AS (SELECT *, {_pct('xa', 'na')} AS open_rate_a, {_pct('xb', 'nb')} AS open_rate_b,
                (xa + xb)::DOUBLE / (na + nb) AS pooled FROM pair)
SELECT open_rate_a, open_rate_b,
       (round(10 * open_rate_b) - round(10 * open_rate_a)) / 10.0::DOUBLE AS lift_points,
       CASE WHEN pooled > 0 AND pooled < 1 THEN round(
         (xb::DOUBLE / nb - xa::DOUBLE / na)
         / sqrt(pooled * (1 - pooled) * (1.0::DOUBLE / na + 1.0::DOUBLE / nb)), 6) END AS z_score
FROM rate""")
def _(spark, sf_dir, audience, events):
    return experiments.ab_lift(experiments.ab_results(experiments.ab_stratified(audience), events))


# --- named tables, integrity, upsert ---------------------------------------------------

@_query("contacts_since", "audience", """
SELECT member_id, first_name, last_name, email, location_raw, in_segment::BIGINT AS in_segment
FROM audience WHERE in_segment = 1 AND ingested_at > TIMESTAMP '2024-01-15 00:00:00'""")
def _(spark, sf_dir, audience):
    audience.createOrReplaceTempView("weekly_batch_2024_01")
    return tables.contacts_since(spark, "weekly_batch_2024_01", SINCE)


@_query("last_day", "", """
SELECT strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end, count(*) AS n_orders
FROM orders GROUP BY 1""")
def _(spark, sf_dir):
    register_last_day(spark)
    return spark.sql(
        "SELECT get_last_day_of_month(CAST(o_orderdate AS DATE)) AS month_end, "
        "count(*) AS n_orders FROM {orders} GROUP BY 1",
        orders=fx.base(spark, sf_dir, "orders"))


@_query("count_rows", "", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in fx.BASE_TABLES))
def _(spark, sf_dir):
    for t in fx.BASE_TABLES:
        fx.base(spark, sf_dir, t).createOrReplaceTempView(t)
    return tables.table_counts(spark, fx.BASE_TABLES)


def _audit_sql() -> str:
    parts = []
    for t, key in schemas.PRIMARY_KEYS.items():
        parts.append(f"SELECT '{t}' AS table_name, 'primary key {key}' AS constraint_name, "
                     f"count(*) AS violations FROM (SELECT {key} FROM {t} "
                     f"WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        parts += [f"SELECT '{t}', 'not null {c}', count(*) - count({c}) FROM {t}"
                  for c in schemas.required_columns(t)]
    parts.append("SELECT 'email_events', 'foreign key member_id', count(*) FROM email_events "
                 "WHERE member_id NOT IN (SELECT member_id FROM audience)")
    return "\nUNION ALL\n".join(parts)


@_query("constraint_audit", "audience inventory delivery_sync email_events", _audit_sql())
def _(spark, sf_dir, audience, inventory, sync, events):
    return quality.audit({"audience": audience, "inventory": inventory,
                          "delivery_sync": sync, "email_events": events})


_EVENT = ("event_id, member_id, campaign_id, event_type, "
          + _STAMP.format("event_at") + " AS event_at")


@_query("orphan_events", "audience email_events",
        f"SELECT {_EVENT} FROM email_events ANTI JOIN audience USING (member_id)")
def _(spark, sf_dir, audience, events):
    return quality.orphan_events(events, audience)


@_query("orphan_events_dirty", "dirty_audience email_events", f"""
SELECT {_EVENT} FROM email_events
WHERE member_id NOT IN (SELECT member_id FROM dirty_audience
                        WHERE member_id IS NOT NULL AND first_name = 'Second')""")
def _(spark, sf_dir, dirty, events):
    """Most events name a member that this audience does not have."""
    return quality.orphan_events(events, dirty.filter(F.col("first_name") == "Second"))


@_query("constraint_audit_dirty", "dirty_audience email_events", """
, keys AS (SELECT member_id, count(*) AS n FROM dirty_audience GROUP BY 1)
SELECT 'audience' AS table_name, 'primary key member_id' AS constraint_name,
       (SELECT count(*) FROM keys WHERE n > 1 AND member_id IS NOT NULL) AS violations
UNION ALL SELECT 'audience', 'not null member_id',
       (SELECT count(*) FROM dirty_audience WHERE member_id IS NULL)
UNION ALL SELECT 'audience', 'not null email', 0
UNION ALL SELECT 'audience', 'not null first_name', 0
UNION ALL SELECT 'email_events', 'primary key event_id', 0
UNION ALL SELECT 'email_events', 'not null event_id', 0
UNION ALL SELECT 'email_events', 'foreign key member_id',
       (SELECT count(*) FROM email_events WHERE member_id NOT IN (SELECT member_id FROM dirty_audience
                                                                  WHERE member_id IS NOT NULL))""")
def _(spark, sf_dir, dirty, events):
    return quality.audit({"audience": dirty, "email_events": events})


@_query("events_without_sync", "delivery_sync email_events",
        f"SELECT {_EVENT} FROM email_events ANTI JOIN delivery_sync USING (member_id)")
def _(spark, sf_dir, sync, events):
    return quality.orphans(events, "member_id", sync, "member_id")


@_query("segment_members", "audience segment_ids",
        f"SELECT {_EXPORT} FROM audience SEMI JOIN segment_ids USING (member_id)")
def _(spark, sf_dir, audience, ids):
    return tables.segment_members(audience, ids).select(*experiments.EXPORTED)


@_query("segment_flag", "audience segment_ids", """
SELECT member_id, CAST(member_id IN (SELECT member_id FROM segment_ids) AS BIGINT) AS in_segment
FROM audience""")
def _(spark, sf_dir, audience, ids):
    return tables.segment_flag(audience, ids).select("member_id", "in_segment")


_CONTACT = (f"member_id, email, first_name, last_name, location_raw, "
            f"{_STAMP.format('ingested_at')} AS ingested_at")
_CONTACT_COLUMNS = ["member_id", "email", "first_name", "last_name", "location_raw", "ingested_at"]
_MERGED = """
, versions AS (SELECT member_id, email, first_name, last_name, location_raw, ingested_at
               FROM audience
               UNION ALL
               SELECT member_id, email, first_name, last_name, location_raw, ingested_at
               FROM contact_batch),
newest AS (SELECT * FROM versions
           QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY ingested_at DESC) = 1)
"""


@_query("upsert_latest", "audience contact_batch", _MERGED + f"SELECT {_CONTACT} FROM newest")
def _(spark, sf_dir, audience, batch):
    return tables.upsert(audience, schemas.conform(batch, schemas.AUDIENCE)).select(*_CONTACT_COLUMNS)


_DIRTY = f"""
, batch AS (SELECT member_id, email, first_name, last_name, ingested_at FROM contact_batch),
stored AS (SELECT * FROM dirty_audience WHERE member_id IN (SELECT member_id FROM batch)
           QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY ingested_at DESC) = 1),
result AS (
  SELECT member_id, email, first_name, last_name, ingested_at FROM dirty_audience
  WHERE member_id IS NULL OR member_id NOT IN (SELECT member_id FROM batch)
  UNION ALL
  SELECT b.member_id, CASE WHEN s.ingested_at > b.ingested_at THEN s.email ELSE b.email END,
         CASE WHEN s.ingested_at > b.ingested_at THEN s.first_name ELSE b.first_name END,
         CASE WHEN s.ingested_at > b.ingested_at THEN s.last_name ELSE b.last_name END,
         CASE WHEN s.ingested_at > b.ingested_at THEN s.ingested_at ELSE b.ingested_at END
  FROM batch AS b LEFT JOIN stored AS s USING (member_id))
SELECT member_id, email, first_name, last_name, {_STAMP.format('ingested_at')} AS ingested_at FROM result
"""


def _upsert_dirty(dirty: DataFrame, batch: DataFrame, **bound) -> DataFrame:
    columns = ["member_id", "email", "first_name", "last_name", "ingested_at"]
    return tables.upsert(dirty.select(columns), batch.select(columns), **bound)


@_query("upsert_dirty_base", "dirty_audience contact_batch", _DIRTY)
def _(spark, sf_dir, dirty, batch):
    return _upsert_dirty(dirty, batch)


@_query("upsert_dirty_base_large", "dirty_audience contact_batch", _DIRTY)
def _(spark, sf_dir, dirty, batch):
    """The same with nothing broadcast."""
    return _upsert_dirty(dirty, batch, max_rows=0)


@_query("ingest_keeps_columns", "audience contact_batch metro_areas", """
SELECT a.member_id, CASE WHEN newer THEN b.email ELSE a.email END AS email,
       a.in_segment::BIGINT AS in_segment, a.profile_url, 'B' AS ab_group
FROM audience AS a LEFT JOIN (SELECT member_id, email FROM contact_batch) AS b USING (member_id)
LEFT JOIN (SELECT b.member_id, b.ingested_at >= a.ingested_at AS newer
           FROM contact_batch AS b JOIN audience AS a USING (member_id)) AS n USING (member_id)
UNION ALL
SELECT member_id, email, 0, NULL, NULL FROM contact_batch
WHERE member_id NOT IN (SELECT member_id FROM audience)""")
def _(spark, sf_dir, audience, batch, metro):
    """A list without flag and profile, into an audience with A/B groups."""
    raw = batch.select("member_id", "email", "first_name", "location_raw", "ingested_at",
                       F.lit("A").alias("ab_group"))
    merged = ingest_audience(raw, metro, base=audience.withColumn("ab_group", F.lit("B")))
    return merged.select("member_id", "email", "in_segment", "profile_url", "ab_group")


@_query("snapshot_upsert", "audience contact_batch", _MERGED + f"SELECT {_CONTACT} FROM newest")
def _(spark, sf_dir, audience, batch):
    path = fresh_path(spark, "audience-store")
    tables.publish(audience, path)
    batch = schemas.conform(batch, schemas.AUDIENCE)
    tables.publish(tables.upsert(tables.current(spark, path), batch), path)
    return tables.current(spark, path).select(*_CONTACT_COLUMNS)


@_query("partial_delivery", "audience contact_batch", f"""
SELECT {_CONTACT} FROM contact_batch UNION ALL
SELECT {_CONTACT} FROM audience WHERE member_id NOT IN (SELECT member_id FROM contact_batch)""")
def _(spark, sf_dir, audience, batch):
    return tables.fill_from_previous(batch.select(*_CONTACT_COLUMNS),
                                     audience.select(*_CONTACT_COLUMNS), "member_id")


# --- contact ingest --------------------------------------------------------------------

def _as_csv(spark: SparkSession, contacts: DataFrame) -> str:
    path = fresh_path(spark, "contacts-csv")
    stamped = contacts.withColumn("ingested_at", F.date_format("ingested_at", TIME_FORMAT))
    (stamped.select("member_id", "email", "first_name", "last_name", "location_raw",
                    "in_segment", "profile_url", "ingested_at")
     .write.option("header", True).option("quote", '"').option("escape", '"').csv(path))
    return path


@_query("contacts_csv", "audience", f"""
SELECT member_id, email, first_name, trim(last_name) AS last_name, location_raw,
       in_segment::BIGINT AS in_segment, {_STAMP.format('ingested_at')} AS ingested_at
FROM audience WHERE email IS NOT NULL AND first_name IS NOT NULL""")
def _(spark, sf_dir, audience):
    good, _rejects = read_contacts_csv(spark, _as_csv(spark, audience))
    return good.drop("profile_url").withColumn("last_name", F.trim("last_name"))


@_query("contacts_csv_reordered", "audience", f"""
SELECT member_id, email, first_name, location_raw, {_STAMP.format('ingested_at')} AS ingested_at
FROM audience WHERE email IS NOT NULL AND first_name IS NOT NULL""")
def _(spark, sf_dir, audience):
    """Columns in another order, one that is not known, and two that are absent."""
    path = fresh_path(spark, "contacts-csv")
    (audience.select("location_raw", F.lit("x").alias("remark"), "email",
                     F.date_format("ingested_at", TIME_FORMAT).alias("ingested_at"), "first_name", "member_id")
     .write.option("header", True).option("quote", '"').option("escape", '"').csv(path))
    good, _rejects = read_contacts_csv(spark, path)
    return good.select("member_id", "email", "first_name", "location_raw", "ingested_at")


@_query("contacts_csv_rejects", "audience", """
SELECT CASE WHEN email IS NULL THEN 'missing email' ELSE 'missing first_name' END
         AS reject_reason, count(*) AS n_rows
FROM audience WHERE email IS NULL OR first_name IS NULL GROUP BY 1""")
def _(spark, sf_dir, audience):
    _good, rejects = read_contacts_csv(spark, _as_csv(spark, audience))
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


@_query("ingest_audience", "audience contact_batch metro_areas segment_ids", r"""
, fresh AS (
  SELECT b.member_id, b.email, b.first_name, b.location_raw, b.ingested_at,
         split_part(trim(lower(split_part(b.last_name, ',', 1))), ' ', -1) AS last_name,
         CAST(b.member_id IN (SELECT member_id FROM segment_ids) AS BIGINT) AS in_segment,
         coalesce(
           (SELECT min(region) FROM metro_areas
            WHERE city = split_part(b.location_raw, ', ', 1)
              AND state = split_part(b.location_raw, ', ', 2)),
           (SELECT min(region) FROM metro_areas WHERE contains(b.location_raw, region)))
           AS location_tag
  FROM contact_batch AS b),
every AS (
  SELECT member_id, email, first_name, last_name, location_raw, in_segment::BIGINT AS in_segment,
         location_tag, ingested_at FROM audience
  UNION ALL
  SELECT member_id, email, first_name, last_name, location_raw, in_segment, location_tag,
         ingested_at FROM fresh)
SELECT * EXCLUDE (ingested_at), strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at
FROM every QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY ingested_at DESC) = 1""")
def _(spark, sf_dir, audience, batch, metro, ids):
    merged = ingest_audience(batch, metro, base=audience, segment_ids=ids)
    return merged.select("member_id", "email", "first_name", "last_name", "location_raw",
                         "in_segment", "location_tag", "ingested_at")


_BUILT_IN = ", ".join("('{}', '{}', '{}')".format(*(v.replace("'", "''") for v in a)) for a in AREAS)


@_query("location_tag_built_in", "audience", f"""
, areas AS (SELECT * FROM (VALUES {_BUILT_IN}) AS a(city, state, region)),
numbered AS (SELECT *, row_number() OVER (ORDER BY city) - 1 AS n FROM areas),
raw AS (SELECT member_id, length(email) % 9 AS n FROM audience)
SELECT r.member_id, a.region AS location_tag
FROM raw AS r LEFT JOIN numbered AS a ON a.n = r.n""")
def _(spark, sf_dir, audience):
    """The areas that come with the library, over contacts that name their city."""
    areas = sorted(AREAS)
    raw = F.array(*[F.lit(f"{city}, {state}") for city, state, _ in areas])
    place = F.coalesce(F.try_element_at(raw, (F.length("email") % 9 + 1).cast("int")), F.lit("Remote"))
    place = F.when(F.length("email") % 9 < len(areas), place).otherwise("Remote")
    rows = audience.withColumn("location_raw", place)
    return tag_locations(rows, metro_areas(spark), multi="first", only_reachable_segment=False,
                         dedupe=False).select("member_id", "location_tag")


@_query("quoted_table_name", "audience", "SELECT in_segment::BIGINT AS in_segment, count(*) AS n_rows "
                                         "FROM audience GROUP BY 1")
def _(spark, sf_dir, audience):
    """A table whose name would be SQL if it were not quoted."""
    name = "batch`; DROP TABLE x --"
    audience.createOrReplaceTempView("`" + name.replace("`", "``") + "`")
    return tables.named_table(spark, name).groupBy("in_segment").agg(F.count(F.lit(1)).alias("n_rows"))


@_query("table_defaults_ddl", "contact_batch", """
SELECT count(*) AS n_rows, 0::BIGINT AS flagged, count(*) AS stamped FROM contact_batch""")
def _(spark, sf_dir, batch):
    """Tables made from the stated schemas; rows that leave columns out take their defaults."""
    database = f"ddl_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        schemas.create_tables(spark, database)
        spark.sql(f"INSERT INTO {database}.audience (member_id, email, first_name) "
                  "SELECT member_id, email, first_name FROM {b}", b=batch)
        stored = spark.table(f"{database}.audience").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("in_segment").alias("flagged"),
            F.count("ingested_at").alias("stamped"))
        result = settle(stored, "ddl")
        schemas.reset_tables(spark, database)
        return result
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@_query("run_stats", "audience email_events", f"""
SELECT '2024-01-31' AS run_id, 'qualified' AS stage, count(*) AS rows_in,
       count(*) FILTER (WHERE {_QUALIFIED}) AS kept,
       count(*) - count(*) FILTER (WHERE {_QUALIFIED}) AS rejected FROM audience
UNION ALL
SELECT '2024-01-31', 'journey events', count(*), count({_JOURNEY}), count(*) - count({_JOURNEY})
FROM email_events""")
def _(spark, sf_dir, audience, events):
    return quality.run_stats("2024-01-31", {
        "qualified": (audience, p.qualified()),
        "journey events": (events, p.campaign_family().isNotNull())})


# --- sources and sinks -----------------------------------------------------------------

@_query("apply_defaults", "contact_batch", """
SELECT member_id, 0::BIGINT AS in_segment, '2024-01-31 00:00:00' AS ingested_at
FROM contact_batch""")
def _(spark, sf_dir, batch):
    bare = schemas.conform(batch.select("member_id", "email", "first_name"), schemas.AUDIENCE)
    return (schemas.apply_defaults(bare, "audience", now=AS_OF)
            .select("member_id", "in_segment", "ingested_at"))


@_query("replace_inventory", "inventory", """
SELECT shop_location, count(*) AS n_cars, min(scraped_at)::VARCHAR AS oldest FROM inventory
WHERE scraped_at >= TIMESTAMP '2024-01-25' GROUP BY 1""")
def _(spark, sf_dir, inventory):
    path = fresh_path(spark, "stock-store")
    tables.replace_inventory(inventory, path)
    tables.replace_inventory(inventory.filter(F.col("scraped_at") >= "2024-01-25"), path)
    return tables.current(spark, path).groupBy("shop_location").agg(
        F.count(F.lit(1)).alias("n_cars"), F.min("scraped_at").alias("oldest"))


@_query("read_with_fallback", "inventory", """
SELECT make, count(*) AS n_cars, sum(price)::DOUBLE AS total_price FROM inventory GROUP BY 1""")
def _(spark, sf_dir, inventory):
    missing, bare, empty, last = (fresh_path(spark, f"stock-{n}") for n in ("none", "bare", "empty", "last"))
    tables.make_folder(spark, bare)
    inventory.limit(0).write.parquet(empty)
    inventory.write.parquet(last)
    stock = tables.read_with_fallback(spark, [missing, bare, empty, last])
    return stock.groupBy("make").agg(F.count(F.lit(1)).alias("n_cars"),
                                     F.sum("price").alias("total_price"))


# --- stock -----------------------------------------------------------------------------

_CAR = ("car_id, year::BIGINT AS year, make, model, trim, mileage::BIGINT AS mileage, "
        "price::DOUBLE AS price, shop_location")


def _listing_pages(inventory: DataFrame) -> DataFrame:
    """Fetched pages of up to twenty cards, in the markup the parser knows. Every seventh car
    has an ampersand in its name, written as an entity."""
    card = F.concat(
        F.lit('<article class="listing" data-shop="'), "shop_location", F.lit('"><a href="'),
        "product_url", F.lit('"><img alt="" src="'), "photo_url", F.lit('"></a><h2>'),
        F.concat_ws(" ", "year", "make", "model"), F.when(_seventh(), " &amp; more").otherwise(""),
        F.lit('</h2><p class="trim">'), "trim", F.lit("</p><p>$"), F.format_number("price", 2), F.lit("</p><p>"),
        F.format_number("mileage", 0), F.lit(" mi</p></article>"))
    number = F.substring("car_id", 2, 12).cast("bigint")
    return (inventory.select(F.floor(number / 20).alias("page_id"), card.alias("card"))
            .groupBy("page_id").agg(F.array_join(F.collect_list("card"), "\n").alias("cards"))
            .select("page_id", F.concat(F.lit("<html><body>"), "cards",
                                        F.lit("</body></html>")).alias("html")))


def _seventh():
    return F.substring("car_id", 2, 12).cast("bigint") % 7 == 0


_LISTED = f"""
SELECT * REPLACE (CASE WHEN substr(car_id, 2)::BIGINT % 7 = 0 THEN model || ' & more' ELSE model END AS model)
FROM (SELECT {_CAR}, photo_url, product_url FROM inventory)"""


@_query("parse_listings", "inventory", _LISTED)
def _(spark, sf_dir, inventory):
    cars, _rejects = listings.parse_listings(_listing_pages(inventory))
    return cars.drop("scraped_at")


@_query("parse_listings_rejects", "inventory", """
SELECT 'missing car_id' AS reject_reason, count(*) AS n_rows,
       sum(CASE WHEN make = 'Brand#1' THEN 1 ELSE 0 END)::BIGINT AS with_brand
FROM inventory WHERE make IN ('Brand#1', 'Brand#2')""")
def _(spark, sf_dir, inventory):
    """Cards of two makes carry no id."""
    bare = F.col("make").isin("Brand#1", "Brand#2")
    link = F.when(bare, "https://example.com/contact.html").otherwise(F.col("product_url"))
    _cars, rejects = listings.parse_listings(_listing_pages(inventory.withColumn("product_url", link)))
    return rejects.groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("listing").contains("Brand#1 ").cast("bigint")).alias("with_brand"))


@_query("stock_unique", "inventory", """
SELECT shop_location, count(*) AS n_cars, count(DISTINCT car_id) AS n_ids FROM inventory GROUP BY 1""")
def _(spark, sf_dir, inventory):
    """Every page fetched twice: the stock still has one row per car."""
    pages = _listing_pages(inventory)
    cars, _rejects = listings.parse_listings(pages.unionByName(pages))
    path = fresh_path(spark, "stock-store")
    tables.replace_inventory(schemas.apply_defaults(cars, "inventory", AS_OF), path)
    return tables.current(spark, path).groupBy("shop_location").agg(
        F.count(F.lit(1)).alias("n_cars"), F.countDistinct("car_id").alias("n_ids"))


@_query("parse_listing_records", "inventory", f"SELECT {_CAR} FROM inventory")
def _(spark, sf_dir, inventory):
    record = F.struct(
        F.col("car_id").alias("id"), F.concat_ws(" ", "year", "make", "model").alias("title"),
        "trim", F.concat(F.lit("$"), F.format_number("price", 2)).alias("price"),
        F.concat(F.format_number("mileage", 0), F.lit(" mi")).alias("mileage"),
        F.col("shop_location").alias("shop"))
    parsed, _rejects = listings.parse_listing_records(inventory.select(F.to_json(record).alias("record")))
    return parsed.drop("scraped_at", "photo_url", "product_url")


@_query("page_fields", "", r"""
SELECT page_id, url, nullif(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 's'), '') AS title,
       len(regexp_extract_all(html, '<a [^>]*href="([^"]*)"')) AS n_links FROM pages""")
def _(spark, sf_dir):
    return listings.page_fields(fx.base(spark, sf_dir, "pages"))


@_query("shop_normalize", "inventory shops", """
SELECT car_id, CASE WHEN make = 'Brand#1' THEN 'unknown lot' ELSE shop_location END
         AS shop_location,
       CASE WHEN make = 'Brand#1' THEN 'reject' ELSE 'known' END AS outcome
FROM inventory""")
def _(spark, sf_dir, inventory, shops):
    tag = F.replace(F.replace(F.col("shop_location"), F.lit("Greater "), F.lit("")),
                    F.lit(" Area"), F.lit(""))
    written = (F.when(F.col("make") == "Brand#1", "unknown lot")
               .when(F.col("make") == "Brand#2", F.concat(F.lit("  "), tag))
               .when(F.col("make") == "Brand#3", F.upper("shop_location"))
               .otherwise(F.col("shop_location")))
    known, rejects = listings.normalize_shops(
        inventory.select("car_id", written.alias("shop_location")), shops)
    return (known.withColumn("outcome", F.lit("known"))
            .unionByName(rejects.withColumn("outcome", F.lit("reject"))))


# --- picks and messages ----------------------------------------------------------------

_ORDER = "ORDER BY scraped_at DESC, price, car_id"


def _picks_sql(fill: bool) -> str:
    pool = f"""
  UNION ALL
  SELECT r.member_id, r.location_tag, 1, p.rk, p.* EXCLUDE (rk), 'pool'
  FROM ready AS r CROSS JOIN pool AS p
  WHERE NOT EXISTS (SELECT 1 FROM own AS o
                    WHERE o.shop_location = r.location_tag AND o.car_id = p.car_id)"""
    return f"""
, ready AS (SELECT member_id, first_name, location_tag FROM audience WHERE {_QUALIFIED}),
own AS (SELECT *, row_number() OVER (PARTITION BY shop_location {_ORDER}) AS rk
        FROM inventory QUALIFY rk <= {PICKS}),
pool AS (SELECT *, row_number() OVER ({_ORDER}) AS rk FROM inventory QUALIFY rk <= {PICKS}),
offered AS (
  SELECT r.member_id, r.location_tag, 0 AS grp, o.rk, o.* EXCLUDE (rk), 'shop' AS origin
  FROM ready AS r JOIN own AS o ON o.shop_location = r.location_tag {pool if fill else ''}),
chosen AS (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY grp, rk) AS position
           FROM offered QUALIFY position <= {PICKS})
"""


_CHOSEN = (f"SELECT member_id, location_tag, position, car_id, year::BIGINT AS year, make, model, "
           f"trim, mileage::BIGINT AS mileage, price::DOUBLE AS price, photo_url, product_url, "
           f"{_STAMP.format('scraped_at')} AS scraped_at, origin FROM chosen")


@_query("select_picks", "audience inventory", _picks_sql(True) + _CHOSEN)
def _(spark, sf_dir, audience, inventory):
    return select_picks(audience.filter(p.qualified()), inventory, PICKS)


@_query("select_picks_own_shop", "audience inventory", _picks_sql(False) + _CHOSEN)
def _(spark, sf_dir, audience, inventory):
    return select_picks(audience.filter(p.qualified()), inventory, PICKS, fill=False)


@_query("picks_coverage", "audience inventory", _picks_sql(False) + f"""
SELECT count(*) AS recommended, count(DISTINCT member_id) AS messages,
       CAST((2 * 10 * count(*) + count(DISTINCT member_id))
            // (2 * count(DISTINCT member_id)) AS BIGINT) / 10.0::DOUBLE
         AS avg_cars_per_message, {PICKS}::BIGINT AS slots FROM chosen""")
def _(spark, sf_dir, audience, inventory):
    picks = select_picks(audience.filter(p.qualified()), inventory, PICKS, fill=False)
    return metrics.picks_coverage(picks, PICKS)


def _replaced(template: str, **slots: str) -> str:
    sql = "'" + template.replace("'", "''") + "'"
    for slot, value in slots.items():
        sql = f"replace({sql}, '{{{slot}}}', {value})"
    return sql


def _escaped(value: str) -> str:
    for raw, safe in HTML_ESCAPES:
        value = f"replace({value}, '{raw}', '{safe}')"
    return value


_TITLE = _escaped("concat_ws(' ', c.year::VARCHAR, c.make, c.model)")
_SHOP = _escaped("r.location_tag")
_MESSAGE = _picks_sql(True) + f"""
, body AS (
  SELECT c.member_id, string_agg({_TITLE}, ', ' ORDER BY position) AS titles,
         string_agg({_replaced(
             CARD, number="lpad(position::VARCHAR, 2, '0')", title=_TITLE, trim=_escaped("c.trim"),
             price="format('{:,}', round(c.price, 0)::BIGINT)",
             mileage="format('{:,}', c.mileage::BIGINT)", photo=_escaped("c.photo_url"),
             link=_escaped("c.product_url"))}, '' ORDER BY position) AS cards
  FROM chosen AS c GROUP BY 1)
SELECT r.member_id, {_replaced(SUBJECT, shop='r.location_tag')} AS subject,
       concat({_replaced(OPENING, shop=_SHOP, titles='b.titles')},
              {_replaced(GREETING, first_name=_escaped('r.first_name'))}, b.cards,
              {_replaced(CLOSING, shop=_SHOP, phone=_escaped('s.phone'), address=_escaped('s.address'),
                         hours=_escaped('s.hours'))}) AS html
FROM ready AS r JOIN body AS b USING (member_id) JOIN shops AS s ON shop_location = r.location_tag
"""


@_query("messages", "audience inventory shops", _MESSAGE)
def _(spark, sf_dir, audience, inventory, shops):
    """Some shops have two records; a contact still has one message."""
    return render_messages(audience.filter(p.qualified()), inventory, shops.unionByName(shops.limit(5)), PICKS)


@_query("delivery_payload", "audience", f"""
SELECT member_id, to_json({{
  'email_address': email,
  'merge_fields': {{'EMAIL': email, 'FNAME': first_name, 'LNAME': coalesce(last_name, ''),
                   'STD_LOC': coalesce(std_location, ''), 'LK_URL': coalesce(profile_url, '')}},
  'tags': [concat('cac-', location_tag), 'source-linkedin']}})::VARCHAR AS payload
FROM audience WHERE {_QUALIFIED}""")
def _(spark, sf_dir, audience):
    return delivery_payload(audience.filter(p.qualified()))


@_query("messages_sink", "audience inventory shops", _MESSAGE)
def _(spark, sf_dir, audience, inventory, shops):
    path = fresh_path(spark, "messages")
    sinks.write_messages(
        render_messages(audience.filter(p.qualified()), inventory, shops, PICKS), path, "json")
    return spark.read.schema("member_id STRING, subject STRING, html STRING").json(path)


@_query("payloads_sink", "audience", f"""
SELECT email, concat('cac-', location_tag) AS tag FROM audience WHERE {_QUALIFIED}""")
def _(spark, sf_dir, audience):
    path = fresh_path(spark, "payloads")
    sinks.write_payloads(delivery_payload(audience.filter(p.qualified())), path)
    return spark.read.schema("email_address STRING, tags ARRAY<STRING>").json(path).select(
        F.col("email_address").alias("email"), F.col("tags")[0].alias("tag"))


@_query("journey_stage", "audience delivery_sync", """
SELECT a.member_id, date_diff('day', synced_at::DATE, DATE '2024-01-20') AS days_in_flow,
       CASE WHEN synced_at IS NULL THEN 'pending_onboarding'
            WHEN date_diff('day', synced_at::DATE, DATE '2024-01-20') >= 3 THEN 'weekly'
            ELSE 'onboarding' END AS stage
FROM audience AS a LEFT JOIN delivery_sync AS s USING (member_id)""")
def _(spark, sf_dir, audience, sync):
    return journey_stage(audience, sync, dt.date(2024, 1, 20))


@_query("weekly_recipients", "audience delivery_sync", f"""
SELECT member_id, email FROM audience WHERE {_QUALIFIED} AND member_id IN (
  SELECT member_id FROM delivery_sync
  GROUP BY 1 HAVING date_diff('day', min(synced_at)::DATE, DATE '2024-01-20') >= 3)""")
def _(spark, sf_dir, audience, sync):
    ready = audience.filter(p.qualified())
    return weekly_recipients(ready, sync, dt.date(2024, 1, 20)).select("member_id", "email")


@_query("keep_ab_groups", "audience", """
SELECT member_id, CASE WHEN location_tag IS NULL THEN NULL WHEN right(member_id, 1) = '1' THEN 'A'
         WHEN right(md5(member_id), 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e') THEN 'A' ELSE 'B'
       END AS ab_group FROM audience""")
def _(spark, sf_dir, audience):
    """Some contacts have a group already and keep it."""
    given = F.when(F.col("member_id").endswith("1") & F.col("location_tag").isNotNull(), "A")
    return experiments.fill_groups(audience.withColumn("ab_group", given)).select("member_id", "ab_group")


# --- elementary operators over whole tables --------------------------------------------

@_query("scalar_text", "audience", r"""
SELECT member_id, split_part(location_raw, ',', 1) AS part1, split_part(location_raw, ',', 2) AS part2,
       split_part(location_raw, ',', 3) AS part3, trim(split_part(location_raw, ',', 2)) AS trimmed,
       lower(last_name) AS lowered, reverse(member_id) AS reversed,
       strpos(last_name, ' ') AS first_space, split_part(last_name, ' ', -1) AS last_word,
       regexp_replace(last_name, '\(.*\)', '', 'gs') AS no_parens,
       concat('%', coalesce(location_tag, ''), '%') AS pattern,
       coalesce(location_tag, std_location, 'none') AS first_known,
       nullif(location_raw, 'Remote') AS not_remote
FROM audience""")
def _(spark, sf_dir, audience):
    raw, last = F.col("location_raw"), F.col("last_name")
    part = [F.split_part(raw, F.lit(","), F.lit(n)) for n in (1, 2, 3)]
    return audience.select(
        "member_id", part[0].alias("part1"), part[1].alias("part2"), part[2].alias("part3"),
        F.trim(part[1]).alias("trimmed"), F.lower(last).alias("lowered"),
        F.reverse("member_id").alias("reversed"), F.instr(last, " ").alias("first_space"),
        F.substring_index(last, " ", -1).alias("last_word"),
        F.regexp_replace(last, r"(?s)\(.*\)", "").alias("no_parens"),
        F.concat(F.lit("%"), F.coalesce("location_tag", F.lit("")), F.lit("%")).alias("pattern"),
        F.coalesce("location_tag", "std_location", F.lit("none")).alias("first_known"),
        F.nullif(raw, F.lit("Remote")).alias("not_remote"))


@_query("scalar_dates", "", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
       strftime(date_trunc('month', o_orderdate) + INTERVAL '1' MONTH - INTERVAL '1' DAY,
                '%Y-%m-%d') AS month_end,
       strftime(o_orderdate::DATE, '%Y-%m-%d') AS day,
       (o_orderdate > TIMESTAMP '1998-01-01')::BIGINT AS after_new_year
FROM orders""")
def _(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    start = F.trunc(day, "MM")
    return fx.base(spark, sf_dir, "orders").select(
        "o_orderkey", start.alias("month_start"),
        F.date_sub(F.add_months(start, 1), 1).alias("month_end"), day.alias("day"),
        (F.col("o_orderdate") > moment(dt.datetime(1998, 1, 1))).cast("bigint")
        .alias("after_new_year"))


@_query("scalar_numbers", "", """
SELECT l_orderkey, l_linenumber, l_orderkey % 2 AS parity, round(100.0 * l_discount, 1)::DOUBLE AS pct,
       l_quantity / nullif(l_linenumber - 1, 0) AS per_earlier_line,
       CASE WHEN l_quantity < 20 THEN 'low' WHEN l_quantity < 50 THEN 'middle' END AS level
FROM lineitem""")
def _(spark, sf_dir):
    quantity = F.col("l_quantity")
    earlier = F.nullif(F.col("l_linenumber") - 1, F.lit(0))
    return fx.base(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 2).alias("parity"),
        F.round(F.lit(100.0) * F.col("l_discount"), 1).alias("pct"),
        (quantity / earlier).alias("per_earlier_line"),
        F.when(quantity < 20, "low").when(quantity < 50, "middle").alias("level"))


@_query("row_predicates", "email_events", """
SELECT event_type, count(*) AS events, count(DISTINCT member_id) AS members,
       count(*) FILTER (WHERE campaign_id LIKE 'weekly%') AS weekly,
       count(*) FILTER (WHERE contains(campaign_id, 'day')) AS day_campaigns,
       count(*) FILTER (WHERE event_at > TIMESTAMP '2024-01-15') AS later
FROM email_events WHERE event_type IN ('open', 'click', 'delivered') AND member_id IS NOT NULL
GROUP BY event_type HAVING count(*) > 10""")
def _(spark, sf_dir, events):
    campaign = F.col("campaign_id")
    return (events.filter(F.col("event_type").isin("open", "click", "delivered")
                          & F.col("member_id").isNotNull())
            .groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("member_id").alias("members"),
                 F.count_if(campaign.like("weekly%")).alias("weekly"),
                 F.count_if(campaign.contains("day")).alias("day_campaigns"),
                 F.count_if(F.col("event_at") > moment(dt.datetime(2024, 1, 15))).alias("later"))
            .filter(F.col("events") > 10))


# --- windows and streams ---------------------------------------------------------------

def _rates_sql(source: str, start: str, days: int, extra: str = "") -> str:
    return f"""
SELECT {_STAMP.format(f'({start})')} AS window_start,
       {_STAMP.format(f"(({start}) + INTERVAL '{days}' DAY)")} AS window_end,
       {_JOURNEY} AS journey, {_n('delivered')} AS delivered, {_n('open')} AS opens,
       {_n('click')} AS clicks, {_pct(_n('open'), _n('delivered'))} AS open_rate,
       {_pct(_n('click'), _n('delivered'))} AS ctr
FROM {source} WHERE {_JOURNEY} IS NOT NULL GROUP BY 1, 2, 3 {extra}"""


_DAY = "date_trunc('day', event_at)::TIMESTAMP"
_SHIFTED = ("(SELECT *, date_trunc('day', event_at)::TIMESTAMP "
            "- to_days(CAST(unnest(range(7)) AS INTEGER)) AS first_day FROM email_events)")
# A stream closes a window once the newest event is a day past its end.
_CLOSED = (f"HAVING {{0}} <= (SELECT max(event_at) - INTERVAL '1' DAY FROM email_events "
           f"WHERE {_JOURNEY} IS NOT NULL)")


@_query("events_daily_rates", "email_events", _rates_sql("email_events", _DAY, 1))
def _(spark, sf_dir, events):
    return streams.daily_rates(events)


@_query("events_sliding_rates", "email_events", _rates_sql(_SHIFTED, "first_day", 7))
def _(spark, sf_dir, events):
    return streams.sliding_rates(events, days=7)


@_query("events_sliding_rates_30", "email_events",
        _rates_sql(_SHIFTED.replace("range(7)", "range(30)"), "first_day", 30))
def _(spark, sf_dir, events):
    return streams.sliding_rates(events, days=30)


@_query("events_sliding_rates_90", "email_events",
        _rates_sql(_SHIFTED.replace("range(7)", "range(90)"), "first_day", 90))
def _(spark, sf_dir, events):
    return streams.sliding_rates(events, days=90)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fx.base(spark, sf_dir, "events").schema
    raw = streams.file_stream(spark, sf_dir, schema, pattern="events.parquet")
    return schemas.conform(spark.sql(fx.EMAIL_EVENTS, events=raw), schemas.EMAIL_EVENTS)


@_query("stream_daily_rates", "email_events", _rates_sql(
    "email_events", _DAY, 1, _CLOSED.format(f"min({_DAY}) + INTERVAL '1' DAY")))
def _(spark, sf_dir, _events):
    rates = streams.daily_rates(_event_stream(spark, sf_dir), delay="1 day")
    return streams.drain(rates, "daily-rates")


@_query("stream_sliding_rates", "email_events", _rates_sql(
    _SHIFTED, "first_day", 7, _CLOSED.format("min(first_day) + INTERVAL '7' DAY")))
def _(spark, sf_dir, _events):
    rates = streams.sliding_rates(_event_stream(spark, sf_dir), days=7, delay="1 day")
    return streams.drain(rates, "sliding-rates")


@_query("stream_dedupe", "email_events", f"SELECT {_EVENT} FROM email_events")
def _(spark, sf_dir, _events):
    twice = (_event_stream(spark, sf_dir)
             .withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy"))
    return streams.drain(streams.dedupe_events(twice), "deduped")


@_query("stream_contacts", "audience contact_batch", _MERGED + f"SELECT {_CONTACT} FROM newest")
def _(spark, sf_dir, audience, batch):
    inbox, store = fresh_path(spark, "inbox"), fresh_path(spark, "contact-store")
    batch = schemas.conform(batch, schemas.AUDIENCE)
    state = fresh_path(spark, "contact-state")
    for arrivals in (audience, batch):  # two deliveries, each taken in as it comes
        arrivals.write.mode("append").parquet(inbox)
        stream = streams.file_stream(spark, inbox, schemas.AUDIENCE)
        merged = streams.ingest_contacts(stream, store, state)
    return merged.select(*_CONTACT_COLUMNS)


from herald import registry_updates  # noqa: E402, F401  (registers its queries)
