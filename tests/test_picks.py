import datetime as dt
import random

import pytest

from herald import schemas
from herald.operators.messages import delivery_payload, journey_stage, render_messages
from herald.operators.metrics import picks_coverage
from herald.operators.picks import best_per_shop, select_picks


def cars(spark, rows):
    """rows: (car_id, shop, day, price)"""
    return schemas.conform(spark.createDataFrame(
        [(c, s, None if d is None else dt.datetime(2024, 1, d), p, 2020, "M", f"model {c}") for c, s, d, p in rows],
        "car_id STRING, shop_location STRING, scraped_at TIMESTAMP_NTZ, price INT, year INT, "
        "make STRING, model STRING"), schemas.INVENTORY)


def people(spark, rows):
    return spark.createDataFrame(rows, "member_id STRING, location_tag STRING")


def picked(df):
    out = {}
    for r in df.orderBy("member_id", "position").collect():
        out.setdefault(r.member_id, []).append((r.position, r.car_id, r.origin))
    return out


STOCK = [("a1", "A", 5, 10), ("a2", "A", 5, 9), ("a3", "A", 6, 50), ("a4", "A", 1, 1),
         ("b1", "B", 9, 5), ("c1", "C", 9, 6), ("c2", "C", None, 1)]


def test_own_shop_first_then_pool(spark):
    got = picked(select_picks(people(spark, [("p", "A"), ("q", "B"), ("r", "Z"), ("s", None)]),
                              cars(spark, STOCK), k=3))
    assert got["p"] == [(1, "a3", "shop"), (2, "a2", "shop"), (3, "a1", "shop")]
    assert got["q"] == [(1, "b1", "shop"), (2, "c1", "pool"), (3, "a3", "pool")]
    assert got["r"] == got["s"] == [(1, "b1", "pool"), (2, "c1", "pool"), (3, "a3", "pool")]


def test_without_fill(spark):
    got = picked(select_picks(people(spark, [("p", "A"), ("q", "B"), ("r", "Z")]),
                              cars(spark, STOCK), k=2, fill=False))
    assert got == {"p": [(1, "a3", "shop"), (2, "a2", "shop")], "q": [(1, "b1", "shop")]}


def test_no_stock(spark):
    assert select_picks(people(spark, [("p", "A")]), cars(spark, [])).count() == 0


@pytest.mark.parametrize("k", [1, 3, 5])
def test_random_stock(spark, k):
    rng = random.Random(k)
    stock = [(f"c{i:03d}", rng.choice("AABCD"), rng.choice([None, 1, 2, 3]), rng.randrange(4))
             for i in range(60)]
    stock += [("solo", "E", 1, 1)]
    tags = ["A", "B", "E", "Z", None]
    got = picked(select_picks(people(spark, [(str(i), t) for i, t in enumerate(tags)]), cars(spark, stock), k=k))

    def rank(c):
        return (c[2] is None, -(c[2] or 0), c[3], c[0])
    everything = sorted(stock, key=rank)
    for i, tag in enumerate(tags):
        own = [c[0] for c in everything if c[1] == tag][:k]
        rest = [c[0] for c in everything[:k] if c[0] not in own]
        assert [c for _, c, _ in got[str(i)]] == (own + rest)[:k], tag


def test_shop_ranking_prunes_before_the_shuffle(spark):
    from plans import physical
    text = physical(best_per_shop(cars(spark, STOCK).repartition(3), 3))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_coverage(spark):
    picks = select_picks(people(spark, [("p", "A"), ("q", "B"), ("r", "B")]), cars(spark, STOCK), k=5, fill=False)
    assert tuple(picks_coverage(picks, 5).first()) == (6, 3, 2.0, 5)
    picks = spark.createDataFrame([("a",)] * 14 + [("b",)] * 9 + [("c",)] * 3, "member_id STRING")
    assert tuple(picks_coverage(picks, 5).first()) == (26, 3, 8.7, 5)


def audience(spark, rows):
    return schemas.conform(spark.createDataFrame(
        rows, "member_id STRING, first_name STRING, location_tag STRING, email STRING"), schemas.AUDIENCE)


def test_messages_escape_and_cover_every_contact(spark):
    stock = cars(spark, STOCK).withColumn("trim", schemas.F.lit('<b>"Sport" & more</b>'))
    shops = spark.createDataFrame([("A", "1 Main & Co", "555", "9-5", "a")],
                                  "shop_location STRING, address STRING, phone STRING, hours STRING, tag STRING")
    aud = audience(spark, [("p", "<Ann>", "A", "p@x"), ("q", "Bob", "Z", "q@x")])
    rows = {r.member_id: r for r in render_messages(aud, stock, shops, 2).collect()}
    assert rows["p"].subject == "This week's picks from A"
    html = rows["p"].html
    assert "Hi &lt;Ann&gt;," in html and "1 Main &amp; Co | 9-5" in html and "Call 555." in html
    assert "&lt;b&gt;&quot;Sport&quot; &amp; more&lt;/b&gt;" in html
    assert html.index("Pick 01") < html.index("2020 M model a3</h2>") < html.index("Pick 02")
    assert html.count('class="pick"') == 2 and "$50 | " in html
    # No shop record and no stock of its own: the pool fills in, empty details stay empty.
    assert "2020 M model b1" in rows["q"].html and "Call ." in rows["q"].html


def test_payload(spark):
    aud = audience(spark, [("p", 'A"n', "Dallas", "p@x"), ("q", None, None, "q@x")])
    got = {r.member_id: r.payload for r in delivery_payload(aud).collect()}
    assert got["p"] == (
        '{"email_address":"p@x","merge_fields":{"EMAIL":"p@x","FNAME":"A\\"n","LNAME":"",'
        '"STD_LOC":"","LK_URL":""},"tags":["cac-Dallas","source-linkedin"]}')
    assert got["q"].endswith('"tags":["source-linkedin"]}')
    other = delivery_payload(aud, tag_prefix="loc-", source_tag="import").first().payload
    assert '"tags":["loc-Dallas","import"]' in other


def test_journey_stage(spark):
    aud = audience(spark, [(m, "f", "x", "e") for m in "abcd"])
    sync = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 7, 23)), ("b", dt.datetime(2024, 1, 8, 1)), ("c", dt.datetime(2024, 1, 10)),
         ("a", dt.datetime(2024, 1, 10))], "member_id STRING, synced_at TIMESTAMP_NTZ")
    got = {r.member_id: (r.days_in_flow, r.stage) for r in journey_stage(aud, sync, dt.date(2024, 1, 10)).collect()}
    assert got == {"a": (3, "weekly"), "b": (2, "onboarding"), "c": (0, "onboarding"),
                   "d": (None, "pending_onboarding")}
