"""Cards, funnel, per-location and per-journey metrics.

Every base table is scanned once per metric set: conditions become conditional counts
next to each other, and events shrink to one row per member before any join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herald.functions import predicates as p
from herald.functions.rates import change_pct, pct, tenths
from herald.functions.times import instant, moment

# Stage labels of the funnel, and the stock below which a location is low.
FUNNEL_STAGES = ["01 T1 Ingested", "02 Tagged", "03 Qualified", "04 Entered Flow"]
LOW_STOCK_BELOW = 20


def _one_row(*parts: DataFrame) -> DataFrame:
    """Side-by-side one-row aggregates, without a join."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _count(condition: Column, alias: str) -> Column:
    return F.count_if(condition).alias(alias)


# --- cards -----------------------------------------------------------------------------

def kpi_ingested(audience: DataFrame) -> DataFrame:
    return audience.agg(F.count(F.lit(1)).alias("t1_ingested"))


def kpi_qualified(audience: DataFrame) -> DataFrame:
    return audience.filter(p.qualified()).agg(F.count(F.lit(1)).alias("qualified"))


def kpi_active(sync: DataFrame) -> DataFrame:
    return sync.filter(p.active()).agg(F.count(F.lit(1)).alias("active_in_flow"))


def _campaign_rate(events: DataFrame, prefix: str, kind: str, alias: str) -> DataFrame:
    return (events.filter(F.col("campaign_id").startswith(prefix))
            .agg(pct(F.count_if(p.is_event(kind)),
                     F.count_if(p.is_event("delivered"))).alias(alias)))


def kpi_open_rate(events: DataFrame) -> DataFrame:
    return _campaign_rate(events, p.ONBOARDING_PREFIX, "open", "onboarding_open_rate")


def kpi_ctr(events: DataFrame) -> DataFrame:
    return _campaign_rate(events, p.WEEKLY_PREFIX, "click", "weekly_ctr")


def kpi_cards(audience: DataFrame, sync: DataFrame, events: DataFrame) -> DataFrame:
    """The five cards in one row; one pass over each of the three tables."""
    family = p.campaign_family()
    people = audience.agg(F.count(F.lit(1)).alias("t1_ingested"),
                          _count(p.qualified(), "qualified"))
    flow = sync.agg(_count(p.active(), "active_in_flow"))
    onboarding, weekly = family == "onboarding", family == "weekly"
    mail = (events.filter(family.isNotNull()).agg(
        pct(F.count_if(onboarding & p.is_event("open")),
            F.count_if(onboarding & p.is_event("delivered"))).alias("onboarding_open_rate"),
        pct(F.count_if(weekly & p.is_event("click")),
            F.count_if(weekly & p.is_event("delivered"))).alias("weekly_ctr")))
    return _one_row(people, flow, mail)


def pooled_rates(events: DataFrame) -> DataFrame:
    """Rates over both journeys together, so each journey weighs by what it delivered."""
    counts = events.filter(p.campaign_family().isNotNull()).agg(
        _count(p.is_event("delivered"), "delivered"),
        _count(p.is_event("open"), "opens"),
        _count(p.is_event("click"), "clicks"))
    return counts.withColumns({"open_rate": pct(F.col("opens"), F.col("delivered")),
                               "ctr": pct(F.col("clicks"), F.col("delivered"))})


# --- funnel ----------------------------------------------------------------------------

def funnel(audience: DataFrame, sync: DataFrame) -> DataFrame:
    people = audience.agg(F.count(F.lit(1)).alias("n1"), _count(p.tagged(), "n2"),
                          _count(p.qualified(), "n3"))
    flow = sync.agg(_count(p.entered_flow(), "n4"))
    counts = _one_row(people, flow)
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"n{i}").alias("count"),
                                F.col("n1").alias("base"))
                       for i, s in enumerate(FUNNEL_STAGES, 1)])
    return (counts.select(F.inline(stages))
            .select("stage", "count", pct(F.col("count"), F.col("base")).alias("share_pct"))
            .orderBy("stage"))


# --- per location ----------------------------------------------------------------------

def events_per_member(events: DataFrame) -> DataFrame:
    """One row per member; map-side sums keep a very busy member from skewing the shuffle."""
    return (events.filter(F.col("member_id").isNotNull())
            .groupBy("member_id")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 _count(p.is_event("sent"), "n_sent"),
                 _count(p.is_event("delivered"), "n_delivered"),
                 _count(p.is_event("open"), "n_opens"),
                 _count(p.is_event("click"), "n_clicks")))


def cars_per_location(inventory: DataFrame, exact: bool = True) -> DataFrame:
    """Rows and distinct cars per shop. ``exact=False`` estimates the latter (2% deviation)
    and saves the shuffle of all car ids."""
    cars = (F.count_distinct("car_id") if exact
            else F.approx_count_distinct("car_id", 0.02))
    return (inventory.groupBy(F.col("shop_location").alias("location_tag"))
            .agg(F.count(F.lit(1)).alias("n_rows"), cars.alias("inventory_count")))


def _member_facts(contacts: DataFrame, sync: DataFrame, events: DataFrame) -> DataFrame:
    """Contacts with their own sync and event counts; all three meet on member_id."""
    synced = sync.groupBy("member_id").agg(F.count(F.lit(1)).alias("n_sync"))
    return (contacts.select("member_id", "location_tag")
            .join(synced, "member_id", "left")
            .join(events_per_member(events), "member_id", "left")
            .na.fill(0, ["n_sync", "n_events", "n_delivered", "n_opens", "n_clicks"]))


def location_breakdown(audience: DataFrame, sync: DataFrame, events: DataFrame,
                       inventory: DataFrame, mode: str = "literal",
                       exact_stock: bool = True) -> DataFrame:
    """Audience, flow, opens and stock per location.

    ``literal`` gives the numbers of joining contacts to sync rows, events and cars and
    counting joined rows. That join is never built: a contact with s sync rows and e events
    at a location with c cars stands for max(1,s) * max(1,e) * max(1,c) joined rows, so
    sums of those products are enough. ``members`` counts each contact once.
    """
    if mode not in ("literal", "members"):
        raise ValueError(f"unknown mode {mode!r}")
    cars = cars_per_location(inventory, exact_stock)
    if mode == "members":
        return _breakdown_members(audience, sync, events, cars)
    one = F.lit(1)
    members = (_member_facts(audience.filter(p.segment_tagged()), sync, events)
               .withColumn("weight", F.greatest("n_sync", one) * F.greatest("n_events", one)))
    per_location = members.groupBy("location_tag").agg(
        F.sum("weight").alias("weight"),
        F.sum(F.when(F.col("n_sync") > 0, F.col("weight")).otherwise(0)).alias("flow_weight"),
        F.sum(F.greatest("n_sync", one) * F.col("n_opens")).alias("open_weight"))
    fan = F.greatest(F.coalesce("n_rows", F.lit(0)), one)
    return (per_location.join(cars, "location_tag", "left")
            .select("location_tag",
                    (F.col("weight") * fan).alias("qualified"),
                    (F.col("flow_weight") * fan).alias("in_flow"),
                    pct(F.col("open_weight"), F.col("weight")).alias("open_rate"),
                    F.coalesce("inventory_count", F.lit(0)).alias("inventory_count"))
            .orderBy(F.desc("qualified"), "location_tag"))


def _members_by_location(audience: DataFrame, sync: DataFrame, events: DataFrame) -> DataFrame:
    return (_member_facts(audience.filter(p.qualified()), sync, events)
            .groupBy("location_tag")
            .agg(F.count(F.lit(1)).alias("qualified"),
                 _count(F.col("n_sync") > 0, "in_flow"),
                 pct(F.sum("n_opens"), F.sum("n_delivered")).alias("open_rate"),
                 pct(F.sum("n_clicks"), F.sum("n_delivered")).alias("ctr")))


def _breakdown_members(audience: DataFrame, sync: DataFrame, events: DataFrame,
                       cars: DataFrame) -> DataFrame:
    return (_members_by_location(audience, sync, events)
            .join(cars, "location_tag", "left")
            .select("location_tag", "qualified", "in_flow", "open_rate",
                    F.coalesce("inventory_count", F.lit(0)).alias("inventory_count"))
            .orderBy(F.desc("qualified"), "location_tag"))


def location_status(audience: DataFrame, sync: DataFrame, events: DataFrame,
                    inventory: DataFrame, low_below: int = LOW_STOCK_BELOW) -> DataFrame:
    """The location table of the board: contacts counted once, CTR, stock and a badge."""
    stock = F.coalesce("inventory_count", F.lit(0))
    return (_members_by_location(audience, sync, events)
            .join(cars_per_location(inventory), "location_tag", "left")
            .select("location_tag", "qualified", "in_flow", "open_rate", "ctr",
                    stock.alias("inventory_count"),
                    F.when(stock < low_below, "LOW STOCK").otherwise("OK").alias("status"))
            .orderBy("location_tag"))


# --- journeys and stock ----------------------------------------------------------------

def journey_performance(events: DataFrame) -> DataFrame:
    counts = (events.withColumn("journey", p.campaign_family())
              .filter(F.col("journey").isNotNull())
              .groupBy("journey")
              .agg(_count(p.is_event("sent"), "sent"),
                   _count(p.is_event("delivered"), "delivered"),
                   _count(p.is_event("open"), "opens"),
                   _count(p.is_event("click"), "clicks"),
                   _count(p.is_event("unsub"), "unsubs")))
    base = F.col("delivered")
    return counts.select("journey", "sent", "delivered",
                         pct(F.col("opens"), base).alias("open_rate"),
                         pct(F.col("clicks"), base).alias("ctr"),
                         pct(F.col("unsubs"), base).alias("unsubscribe_rate"))


def inventory_coverage(inventory: DataFrame, as_of: dt.datetime,
                       low_below: int = LOW_STOCK_BELOW) -> DataFrame:
    """Cars, locations, age of the last scrape and shops low on stock, from per-shop sums."""
    per_shop = inventory.groupBy("shop_location").agg(
        F.count(F.lit(1)).alias("cars"), F.max("scraped_at").alias("scraped"))
    totals = per_shop.agg(F.coalesce(F.sum("cars"), F.lit(0)).alias("cars_in_stock"),
                          F.count("shop_location").alias("locations"),
                          F.max("scraped").alias("last"),
                          _count(F.col("cars") < low_below, "low_shops"))
    age = F.timestamp_diff("MINUTE", instant(F.col("last")), instant(moment(as_of)))
    return totals.select("cars_in_stock", "locations",
                         F.date_format("last", "yyyy-MM-dd HH:mm:ss").alias("last_scrape"),
                         age.alias("minutes_since_scrape"), "low_shops")


def picks_coverage(picks: DataFrame, k: int) -> DataFrame:
    """Cars recommended and average cars per message, out of ``k``."""
    per_member = picks.groupBy("member_id").agg(F.count(F.lit(1)).alias("n"))
    totals = per_member.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("recommended"),
                            F.count(F.lit(1)).alias("messages"))
    # The average in tenths: 1000 * n / (100 * messages).
    average = tenths(F.col("recommended"), F.col("messages") * 100) / F.lit(10.0)
    return totals.select("recommended", "messages", average.alias("avg_cars_per_message"),
                         F.lit(k).alias("slots"))


# --- period deltas ---------------------------------------------------------------------

def period_delta(audience: DataFrame, sync: DataFrame, events: DataFrame,
                 as_of: dt.datetime, days: int) -> DataFrame:
    """Each card now and one window earlier: percent change of counts, points of rates."""
    def windows(column: str) -> list[tuple[str, Column]]:
        return [("now", p.trailing(column, as_of, days)),
                ("before", p.trailing(column, as_of, days, periods_back=1))]

    def span(column: str) -> Column:
        return p.trailing(column, as_of, 2 * days)

    people = audience.filter(span("ingested_at")).agg(*[
        _count(test & w, f"{name}_{when}")
        for when, w in windows("ingested_at")
        for name, test in [("ingested", F.lit(True)), ("qualified", p.qualified())]])
    flow = sync.filter(span("synced_at")).agg(*[
        _count(p.active() & w, f"active_{when}") for when, w in windows("synced_at")])
    mail = (events.filter(span("event_at") & p.campaign_family().isNotNull()).agg(*[
        _count(p.is_event(kind) & w, f"{kind}_{when}")
        for when, w in windows("event_at") for kind in ("delivered", "open", "click")]))
    row = _one_row(people, flow, mail)

    def count_line(name: str) -> Column:
        now, before = F.col(f"{name}_now"), F.col(f"{name}_before")
        return _line(name, now.cast("double"), before.cast("double"),
                     change_pct(now, before), "percent")

    def rate_line(name: str, kind: str) -> Column:
        now = tenths(F.col(f"{kind}_now"), F.col("delivered_now"))
        before = tenths(F.col(f"{kind}_before"), F.col("delivered_before"))
        return _line(name, now / F.lit(10.0), before / F.lit(10.0),
                     (now - before) / F.lit(10.0), "points")

    return row.select(F.inline(F.array(
        count_line("ingested"), count_line("qualified"), count_line("active"),
        rate_line("open_rate", "open"), rate_line("ctr", "click"))))


def _line(metric: str, now: Column, before: Column, delta: Column, unit: str) -> Column:
    return F.struct(F.lit(metric).alias("metric"), now.alias("current_value"),
                    before.alias("previous_value"), delta.alias("delta"),
                    F.lit(unit).alias("unit"))


# --- unique openers --------------------------------------------------------------------

#: Registers of a sketch as a power of two: the estimate deviates by about 1.6% (one standard error).
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def daily_openers(audience: DataFrame, events: DataFrame) -> DataFrame:
    """(day, journey, location_tag, openers, sketch): members who opened on a day, exactly, and a sketch
    of them that can be united over days, journeys and locations. Repeated opens count once; contacts
    without a location are a location of NULL.

    Members and days are told apart before the join, so a member who opens all day is one row.
    """
    opens = (events.filter(p.is_event("open") & F.col("member_id").isNotNull())
             .select("member_id", p.campaign_family().alias("journey"), F.col("event_at").cast("date").alias("day"))
             .filter(F.col("journey").isNotNull() & F.col("day").isNotNull()).distinct())
    place = audience.select("member_id", "location_tag")
    return (opens.join(place, "member_id", "left").groupBy("day", "journey", "location_tag")
            .agg(F.count_distinct("member_id").alias("openers"),
                 F.hll_sketch_agg("member_id", F.lit(SKETCH_BITS)).alias("sketch")))


def trailing_openers(daily: DataFrame, as_of: dt.date, days: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """(days, journey, openers_estimate): different openers of the windows that end before ``as_of``, from the
    daily sketches alone: one pass over a row per day, journey and location, whatever the events are."""
    spans = F.explode(F.array(*[F.lit(n) for n in days])).alias("days")
    rows = daily.select(spans, "day", "journey", "sketch")
    back = F.date_diff(F.lit(as_of), F.col("day"))
    rows = rows.filter((back >= 1) & (back <= F.col("days")))
    return rows.groupBy("days", "journey").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("openers_estimate"))


def unique_rates(events: DataFrame) -> DataFrame:
    """(journey, recipients, openers, clickers, unique_open_rate, unique_ctr): members, not events, so that
    no rate is above 100. A member counts as recipient of a journey once something was delivered; openers
    and clickers are counted among them."""
    per_member = (events.filter(F.col("member_id").isNotNull()).withColumn("journey", p.campaign_family())
                  .filter(F.col("journey").isNotNull()).groupBy("journey", "member_id")
                  .agg(*[F.bool_or(p.is_event(kind)).alias(name) for name, kind in
                         (("got", "delivered"), ("opened", "open"), ("clicked", "click"))]))
    counts = per_member.filter("got").groupBy("journey").agg(
        F.count(F.lit(1)).alias("recipients"), _count(F.col("opened"), "openers"), _count(F.col("clicked"), "clickers"))
    return counts.select("*", pct(F.col("openers"), F.col("recipients")).alias("unique_open_rate"),
                         pct(F.col("clickers"), F.col("recipients")).alias("unique_ctr"))
