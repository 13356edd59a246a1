import random

import pytest

from herald.operators.locations import tag_locations, tier_stats
from herald.sources.lookups import AREAS as METRO
from herald.sources.lookups import metro_areas

CASES = [
    ("Dallas, TX", "Dallas-Fort Worth Metroplex", "exact_match"),
    (" Dallas ,  TX, US", "Dallas-Fort Worth Metroplex", "exact_match"),
    ("Greater Boston", "Greater Boston", "fuzzy_like"),
    ("near Greater Boston now", "Greater Boston", "fuzzy_like"),
    ("greater boston", None, "unmatched"),
    ("Plano, TX", "Dallas-Fort Worth Metroplex", "state_fallback"),
    ("Dallas, Texas", None, "unmatched"),
    ("DFW Metroplex", None, "unmatched"),
    ("Dallas", None, "unmatched"),
    ("", None, "unmatched"),
    (None, None, "unmatched"),
    ("Greater Boston, TX", "Greater Boston", "fuzzy_like"),
    ("Dallas, TX near Greater Boston", "Greater Boston", "fuzzy_like"),
]
SMALL, LARGE = 256, 0


def contacts(spark, texts, segment=1):
    rows = [(f"m{i:04d}", f"F{i}", None, f"{i}@example.com", t, segment)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "member_id STRING, first_name STRING, last_name STRING, email STRING, "
              "location_raw STRING, in_segment INT")


def lookup(spark, rows):
    return spark.createDataFrame(rows, "city STRING, state STRING, region STRING")


def tagged(df):
    return sorted(((r.member_id, r.location_tag or "", r.match_tier) for r in df.collect()))


@pytest.mark.parametrize("path", [SMALL, LARGE])
def test_cases(spark, path):
    df = tag_locations(contacts(spark, [c[0] for c in CASES]), lookup(spark, METRO),
                       small_lookup_names=path)
    want = [(f"m{i:04d}", c[1] or "", c[2]) for i, c in enumerate(CASES)]
    assert tagged(df) == want


def by_hand(text, areas):
    if text is None:
        return [("", "unmatched")]
    parts = [x.strip(" ") for x in text.split(",")] + ["", ""]
    tiers = [
        ("exact_match", {r for c, s, r in areas if (c, s) == (parts[0], parts[1])}),
        ("fuzzy_like", {r for _, _, r in areas if r in text}),
        ("state_fallback", {r for _, s, r in areas if s == parts[1]}),
    ]
    for tier, regions in tiers:
        if regions:
            return [(r, tier) for r in sorted(regions)]
    return [("", "unmatched")]


def random_world(seed, areas=60, texts=300):
    rng = random.Random(seed)
    words = ["Bay", "Greater", "Area", "New", "x", "a%b", "c_d", "North", "é"]
    names = [" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(areas)]
    places = [(rng.choice("ABCDE"), rng.choice(["TX", "MA", "IL"]), n) for n in names]
    made = []
    for _ in range(texts):
        kind = rng.random()
        if kind < 0.3:
            made.append(f"{rng.choice('ABCDEFG')}, {rng.choice(['TX', 'MA', 'ZZ'])}")
        elif kind < 0.7:
            made.append(" ".join(rng.choices(words, k=rng.randint(1, 7))))
        else:
            made.append(rng.choice(["Remote", None, ", TX", "q, ZZ, r"]))
    return places, made


@pytest.mark.parametrize("path", [SMALL, LARGE])
@pytest.mark.parametrize("multi", ["all", "first"])
def test_random_worlds(spark, path, multi):
    places, texts = random_world(7)
    df = tag_locations(contacts(spark, texts), lookup(spark, places), multi=multi,
                       small_lookup_names=path)
    want = []
    for i, t in enumerate(texts):
        hits = by_hand(t, places)
        want += [(f"m{i:04d}", *h) for h in (hits if multi == "all" else hits[:1])]
    assert tagged(df) == sorted(want)


@pytest.mark.parametrize("path", [SMALL, LARGE])
def test_empty_lookup(spark, path):
    df = tag_locations(contacts(spark, ["Dallas, TX", None]), lookup(spark, []),
                       small_lookup_names=path)
    assert [t[2] for t in tagged(df)] == ["unmatched", "unmatched"]


@pytest.mark.parametrize("path", [SMALL, LARGE])
def test_odd_names(spark, path):
    odd = [("a", "b", ""), ("c", "d", "x"), ("e", "f", None), ("e", "f", "long enough name")]
    texts = ["", "x", None, "yxy", "e, f", "a long enough name", "e"]
    df = tag_locations(contacts(spark, texts), lookup(spark, odd), small_lookup_names=path)
    known = [o for o in odd if o[2] is not None]
    want = [(f"m{i:04d}", *h) for i, t in enumerate(texts) for h in by_hand(t, known)]
    assert tagged(df) == sorted(want)


def test_copies_collapse_unless_told_otherwise(spark):
    twice = contacts(spark, ["Dallas, TX"]).unionByName(contacts(spark, ["Dallas, TX"]))
    assert tag_locations(twice, lookup(spark, METRO)).count() == 1
    assert tag_locations(twice, lookup(spark, METRO), dedupe=False).count() == 2


def test_only_reachable_members_of_the_segment(spark):
    both = contacts(spark, ["Dallas, TX"], segment=0)
    assert tag_locations(both, lookup(spark, METRO)).count() == 0
    assert tag_locations(both, lookup(spark, METRO), only_reachable_segment=False).count() == 1


def test_small_lookup_plan_shuffles_only_to_dedupe(spark):
    from plans import physical
    text = physical(tag_locations(contacts(spark, ["a"]), lookup(spark, METRO), dedupe=False))
    fact_side = text.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in fact_side
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_tier_stats(spark):
    df = tier_stats(tag_locations(contacts(spark, [c[0] for c in CASES]), metro_areas(spark)))
    got = {r.match_tier: (r.n_rows, r.share_pct) for r in df.collect()}
    assert got["exact_match"] == (2, 15.4) and sum(n for n, _ in got.values()) == len(CASES)


def test_near_names(spark):
    from herald.operators.typos import near_names

    names = spark.createDataFrame([("Dallas",), ("Boston",), ("Rye",), ("Austin",), ("Houston",)], "name STRING")
    asked = ["dallas", "Dalas", "Dallass", "Dxllas", "Dalals", "Dxlxas", "Bostno", "Rye", "Ry", "", None, "ustin", "Husto", "allasD", "D" * 5000]
    got = {(r.text, r.name, r.distance) for r in near_names(
        spark.createDataFrame([(a,) for a in asked], "text STRING"), names).collect()}
    assert got == {("dallas", "Dallas", 0), ("Dalas", "Dallas", 1), ("Dallass", "Dallas", 1), ("Dxllas", "Dallas", 1),
                   ("Dalals", "Dallas", 1), ("Bostno", "Boston", 1), ("ustin", "Austin", 1)}
    assert near_names(spark.createDataFrame([("x",)], "text STRING"), names.limit(0)).count() == 0
