import datetime as dt
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from herald import schemas
from herald.functions.rates import above, below, change_pct, pct
from herald.operators import alerts, experiments, metrics
from herald.plans.dashboard import Tables, dashboard, register_views


def half_up(x: Fraction) -> float:
    tenth = abs(x) * 10
    whole = int(tenth + Fraction(1, 2))
    return (1 if x >= 0 else -1) * whole / 10


def people(spark, rows):
    """rows: (member_id, tag, segment) or longer (…, email, first_name)."""
    full = [(r[0], r[3] if len(r) > 3 else "e", r[4] if len(r) > 4 else "f", r[1], r[2]) for r in rows]
    return spark.createDataFrame(
        full, "member_id STRING, email STRING, first_name STRING, location_tag STRING, in_segment INT")


def synced(spark, rows):
    return spark.createDataFrame(rows, "member_id STRING, journey_status STRING")


def mail(spark, rows):
    return spark.createDataFrame(rows, "member_id STRING, campaign_id STRING, event_type STRING")


def stock(spark, rows):
    return spark.createDataFrame(rows, "car_id STRING, shop_location STRING")


def test_pct_is_exact(spark):
    pairs = [(x, n) for n in range(0, 90) for x in range(0, n + 5)]
    pairs += [(1_234_951, 10_000_000), (10**14 + 1, 3 * 10**14), (0, 10**15)]
    df = spark.createDataFrame(pairs, "x BIGINT, n BIGINT").select("x", "n", pct(F.col("x"), F.col("n")).alias("p"))
    for x, n, p in df.collect():
        assert p == (None if n == 0 else half_up(Fraction(100 * x, n))), (x, n)


def test_change_pct(spark):
    rows = [(1082, 1000), (918, 1000), (1000, 1000), (5, 0), (995, 1000), (9995, 10000), (0, 7), (99999, 100000)]
    df = spark.createDataFrame(rows, "a BIGINT, b BIGINT")
    got = [r[0] for r in df.select(change_pct(F.col("a"), F.col("b"))).collect()]
    assert got == [8.2, -8.2, 0.0, None, -0.5, -0.1, -100.0, 0.0]
    assert str(got[-1]) == "0.0"


def test_thresholds_compare_whole_numbers(spark):
    df = spark.createDataFrame([(1, 4), (25, 100), (249, 1000), (4, 5), (801, 1000)], "x INT, n INT")
    got = [tuple(r) for r in df.select(below(F.col("x"), F.col("n"), 0.25),
                                       above(F.col("x"), F.col("n"), 0.80)).collect()]
    assert got == [(False, False), (False, False), (True, False), (False, False), (False, True)]


def board_people(spark):
    """12,438 contacts of which 9,702 are tagged and 3,217 qualify."""
    n = spark.range(12_438)
    return n.select(F.col("id").cast("string").alias("member_id"), F.lit("e").alias("email"),
                    F.lit("f").alias("first_name"),
                    F.when(F.col("id") < 9_702, "x").alias("location_tag"),
                    F.when(F.col("id") < 3_217, 1).otherwise(0).alias("in_segment"))


def test_funnel_shares(spark):
    flow = spark.range(2_984).select(F.col("id").cast("string").alias("member_id"),
                                     F.lit("weekly_active").alias("journey_status"))
    got = [tuple(r) for r in metrics.funnel(board_people(spark), flow).collect()]
    assert got == [("01 T1 Ingested", 12_438, 100.0), ("02 Tagged", 9_702, 78.0),
                   ("03 Qualified", 3_217, 25.9), ("04 Entered Flow", 2_984, 24.0)]


def many(spark, campaign, counts):
    parts = [spark.range(n).select(F.lit("m").alias("member_id"), F.lit(campaign).alias("campaign_id"),
                                   F.lit(kind).alias("event_type")) for kind, n in counts.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def test_pooled_rate_weighs_journeys_by_deliveries(spark):
    events = (many(spark, "onboarding_1", {"sent": 2984, "delivered": 2841, "open": 1173})
              .unionByName(many(spark, "weekly_1", {"sent": 14287, "delivered": 13612, "open": 4451}))
              .unionByName(many(spark, "other", {"delivered": 999})))
    assert metrics.pooled_rates(events).first().open_rate == 34.2
    rows = {r.journey: r for r in metrics.journey_performance(events).collect()}
    assert (rows["onboarding"].sent, rows["onboarding"].open_rate) == (2984, 41.3)
    assert (rows["weekly"].delivered, rows["weekly"].open_rate) == (13612, 32.7)


def test_rates_without_deliveries_are_null(spark):
    none = mail(spark, [("m", "onboarding_1", "open")])
    assert metrics.kpi_open_rate(none).first()[0] is None
    assert metrics.kpi_ctr(none).first()[0] is None
    empty = mail(spark, [])
    row = metrics.kpi_cards(people(spark, []), synced(spark, []), empty).first()
    assert tuple(row) == (0, 0, 0, None, None)


def test_cards(spark):
    aud = people(spark, [("1", "x", 1), ("2", None, 1), ("3", "x", 0), ("4", "x", 1, None),
                         ("5", "x", 1, "e", None), ("6", "x", None)])
    flow = synced(spark, [("1", "onboarding_sent"), ("2", "weekly_active"), ("3", "paused"), ("4", None)])
    ev = mail(spark, [("1", "onboarding_1", k) for k in ("delivered", "delivered", "open")]
              + [("1", "weekly_1", k) for k in ("delivered", "click", "click")]
              + [("1", None, "open"), ("1", "my_weekly", "click")])
    assert tuple(metrics.kpi_cards(aud, flow, ev).first()) == (6, 1, 2, 50.0, 200.0)
    assert metrics.kpi_ingested(aud).first()[0] == 6
    assert metrics.kpi_qualified(aud).first()[0] == 1
    assert metrics.kpi_active(flow).first()[0] == 2


def joined_breakdown(aud, flow, ev, inv):
    """The same numbers from the join itself."""
    j = (aud.filter("in_segment = 1 AND location_tag IS NOT NULL").alias("a")
         .join(flow.withColumnRenamed("member_id", "s"), F.col("a.member_id") == F.col("s"), "left")
         .join(ev.withColumnRenamed("member_id", "e"), F.col("a.member_id") == F.col("e"), "left")
         .join(inv, F.col("location_tag") == F.col("shop_location"), "left"))
    return j.groupBy("location_tag").agg(
        F.count(F.lit(1)).alias("qualified"), F.count("s").alias("in_flow"),
        pct(F.count_if(F.col("event_type") == "open"), F.count(F.lit(1))).alias("open_rate"),
        F.count_distinct("car_id").alias("inventory_count"))


@pytest.mark.parametrize("seed", [1, 2])
def test_breakdown_equals_the_join(spark, seed):
    rng = random.Random(seed)
    aud = people(spark, [(f"m{i}", rng.choice(["x", "y", "z", None]), rng.choice([0, 1])) for i in range(60)]
                 + [("m1", "x", 1)])
    flow = synced(spark, [(f"m{rng.randrange(70)}", "s") for _ in range(50)])
    ev = mail(spark, [(rng.choice([f"m{rng.randrange(70)}", None]), "c", rng.choice(["open", "click"]))
                      for _ in range(150)])
    inv = stock(spark, [(f"c{rng.randrange(8)}", rng.choice(["x", "y", "w"])) for _ in range(20)])
    got = metrics.location_breakdown(aud, flow, ev, inv)
    want = joined_breakdown(aud, flow, ev, inv)
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())


def test_location_board_adds_up(spark):
    """Rows of the location table sum to the cards: 3,217 qualified, 2,984 in flow, 847 cars."""
    cities = {"A": (412, 389, 132), "B": (287, 265, 94), "C": (521, 488, 156), "D": (438, 410, 118),
              "E": (683, 641, 147), "F": (524, 487, 182), "G": (352, 304, 18)}
    aud = people(spark, [(f"{c}{i}", c, 1) for c, (q, _, _) in cities.items() for i in range(q)])
    flow = synced(spark, [(f"{c}{i}", "weekly_active") for c, (_, f, _) in cities.items() for i in range(f)])
    inv = stock(spark, [(f"{c}{i}", c) for c, (_, _, n) in cities.items() for i in range(n)])
    ev = mail(spark, [("A0", "weekly", k) for k in ("delivered", "delivered", "open")])
    rows = {r.location_tag: r for r in metrics.location_status(aud, flow, ev, inv).collect()}
    assert {c: (r.qualified, r.in_flow, r.inventory_count) for c, r in rows.items()} == cities
    assert rows["G"].status == "LOW STOCK" and rows["B"].status == "OK"
    assert (rows["A"].open_rate, rows["A"].ctr, rows["B"].open_rate) == (50.0, 0.0, None)
    totals = [sum(r[i] for r in rows.values()) for i in (1, 2, 5)]
    assert totals == [3217, 2984, 847]
    assert metrics.kpi_qualified(aud).first()[0] == 3217


def test_stock_can_be_estimated(spark):
    inv = stock(spark, [(f"c{i % 40}", "x") for i in range(100)])
    exact, rough = (metrics.cars_per_location(inv, exact=e).first() for e in (True, False))
    assert exact.inventory_count == 40 and abs(rough.inventory_count - 40) <= 3
    assert exact.n_rows == rough.n_rows == 100


def test_breakdown_mode_is_checked(spark):
    with pytest.raises(ValueError):
        metrics.location_breakdown(None, None, None, None, mode="other")


def test_period_delta(spark):
    as_of = dt.datetime(2024, 1, 15)
    day = dt.timedelta(days=1)
    stamps = [as_of - day, as_of - 7 * day, as_of - 8 * day, as_of, as_of - 15 * day]
    aud = spark.createDataFrame(
        [(str(i), "e", "f", "x", 1, s) for i, s in enumerate(stamps)],
        "member_id STRING, email STRING, first_name STRING, location_tag STRING, in_segment INT, "
        "ingested_at TIMESTAMP_NTZ")
    flow = spark.createDataFrame([], "member_id STRING, journey_status STRING, synced_at TIMESTAMP_NTZ")
    ev = spark.createDataFrame(
        [("m", "weekly_1", k, as_of - n * day) for k, n in
         [("delivered", 1), ("delivered", 1), ("open", 1), ("delivered", 9), ("delivered", 9),
          ("delivered", 9), ("open", 9)]],
        "member_id STRING, campaign_id STRING, event_type STRING, event_at TIMESTAMP_NTZ")
    rows = {r.metric: tuple(r)[1:] for r in
            metrics.period_delta(aud, flow, ev, as_of, 7).collect()}
    assert rows["ingested"] == (2.0, 1.0, 100.0, "percent")
    assert rows["active"] == (0.0, 0.0, None, "percent")
    assert rows["open_rate"] == (50.0, 33.3, 16.7, "points")
    assert rows["ctr"] == (0.0, 0.0, 0.0, "points")


def test_inventory_coverage(spark):
    inv = spark.createDataFrame(
        [(f"c{i}", "big" if i < 25 else "small", dt.datetime(2024, 1, 1, 9, i)) for i in range(30)],
        "car_id STRING, shop_location STRING, scraped_at TIMESTAMP_NTZ")
    row = metrics.inventory_coverage(inv, dt.datetime(2024, 1, 1, 9, 41, 30)).first()
    assert tuple(row) == (30, 2, "2024-01-01 09:29:00", 12, 1)
    assert metrics.inventory_coverage(inv.limit(0), dt.datetime(2024, 1, 1)).first().cars_in_stock == 0


def test_low_inventory_levels(spark):
    sizes = {"a": 19, "b": 20, "c": 49, "d": 50}
    inv = stock(spark, [(f"{s}{i}", s) for s, n in sizes.items() for i in range(n)])
    got = {r.shop_location: r.alert_level for r in alerts.low_inventory(inv).collect()}
    assert got == {"a": "CRITICAL", "b": "WARNING", "c": "WARNING"}
    shops = spark.createDataFrame([("a",), ("e",)], "shop_location STRING")
    every = {r.shop_location: (r.car_count, r.alert_level) for r in
             alerts.low_inventory(inv, shops=shops, include_ok=True).collect()}
    assert every["d"] == (50, "OK") and every["e"] == (0, "CRITICAL") and len(every) == 5


def test_low_engagement_uses_unrounded_share(spark):
    # 2,499 of 10,000 prints as 25.0 but is below a quarter.
    ev = many(spark, "c", {"open": 2499, "sent": 7501}).unionByName(
        many(spark, "c", {"open": 1, "sent": 3}).withColumn("member_id", F.lit("q")))
    aud = people(spark, [("m", "x", 0), ("q", "y", 0), ("r", "z", 1), ("s", None, 1)])
    got = {r.location_tag: (r.open_rate, r.alert) for r in alerts.low_engagement(aud, ev).collect()}
    assert got == {"x": (25.0, "WARNING: Below 25%"), "y": (25.0, "OK")}


def test_untagged_alert_is_strict(spark):
    def alert(untagged):
        rows = [(str(i), None if i < untagged else "x", 0) for i in range(10)]
        return alerts.untagged_alert(people(spark, rows)).first().alert
    assert alert(8) == "OK" and alert(9) == "WARNING"
    assert alerts.untagged_alert(people(spark, [])).first().alert == "OK"


def test_ab_outcome(spark):
    aud = spark.createDataFrame([("a1", "A"), ("a2", "A"), ("b1", "B"), ("n", None)],
                                "member_id STRING, ab_group STRING")
    ev = mail(spark, [("a1", "c", "delivered")] * 100 + [("a1", "c", "open")] * 30
              + [("b1", "c", "delivered")] * 100 + [("b1", "c", "open")] * 45
              + [("n", "c", "open")])
    res = experiments.ab_results(aud, ev)
    rows = {r.ab_group: r for r in res.collect()}
    assert (rows["A"].members, rows["A"].open_rate, rows["B"].opens) == (2, 30.0, 45)
    lift = experiments.ab_lift(res).first()
    assert tuple(lift) == (30.0, 45.0, 15.0, pytest.approx(2.19089, abs=1e-4))


def test_dashboard_filters(spark):
    as_of = dt.datetime(2024, 2, 1)
    aud = schemas.conform(spark.createDataFrame(
        [("1", "e", "f", "x", 1, as_of - dt.timedelta(days=2)), ("2", "e", "f", "y", 1, as_of - dt.timedelta(days=2)),
         ("3", "e", "f", "x", 1, as_of - dt.timedelta(days=40))],
        "member_id STRING, email STRING, first_name STRING, location_tag STRING, in_segment INT, "
        "ingested_at TIMESTAMP_NTZ"), schemas.AUDIENCE)
    flow = schemas.conform(spark.createDataFrame(
        [("1", "weekly_active", as_of - dt.timedelta(days=1)), ("2", "weekly_active", as_of - dt.timedelta(days=1))],
        "member_id STRING, journey_status STRING, synced_at TIMESTAMP_NTZ"), schemas.DELIVERY_SYNC)
    ev = schemas.conform(spark.createDataFrame(
        [(str(i), m, "weekly_1", k, as_of - dt.timedelta(days=d)) for i, (m, k, d) in enumerate(
            [("1", "delivered", 1), ("1", "click", 1), ("2", "delivered", 1), ("1", "click", 45)])],
        "event_id STRING, member_id STRING, campaign_id STRING, event_type STRING, "
        "event_at TIMESTAMP_NTZ"), schemas.EMAIL_EVENTS)
    inv = schemas.conform(spark.createDataFrame([("c", "x")], "car_id STRING, shop_location STRING"),
                          schemas.INVENTORY)
    board = Tables(aud, inv, flow, ev)
    everything = dashboard(board, as_of, days=30)
    assert tuple(everything["cards"].first()) == (2, 2, 2, None, 50.0)
    here = dashboard(board, as_of, days=30, location="x")
    assert tuple(here["cards"].first()) == (1, 1, 1, None, 100.0)
    for name in register_views(here):
        assert spark.table(name).collect() is not None, name
    assert spark.sql("SELECT count FROM board_funnel WHERE stage LIKE '01%'").first()[0] == 2
