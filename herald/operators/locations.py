"""Three-tier assignment of free-text locations to regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herald.functions import predicates as p
from herald.functions.rates import pct
from herald.scale import fits_broadcast, keyed_join, settle

# The tier labels.
EXACT, FUZZY, STATE, UNMATCHED = "exact_match", "fuzzy_like", "state_fallback", "unmatched"
TAGGED_FROM = ["member_id", "first_name", "last_name", "email", "location_raw"]

# Up to this many region names are searched row by row, next to the scan.
SMALL_LOOKUP_NAMES = 256
# Longest piece of a region name used to look it up inside a text.
GRAM_LENGTH = 8


def _part(n: int) -> Column:
    return F.trim(F.split_part(F.col("location_raw"), F.lit(","), F.lit(n)))


def tag_locations(audience: DataFrame, lookup: DataFrame, multi: str = "all",
                  only_reachable_segment: bool = True, dedupe: bool = True,
                  keep: Sequence[str] = TAGGED_FROM,
                  small_lookup_names: int = SMALL_LOOKUP_NAMES) -> DataFrame:
    """The ``keep`` columns of contacts with ``location_tag`` and ``match_tier``.

    Tiers, first hit wins: city and state equal; the raw text contains a region name
    (case-sensitive); state equal. A tier may hit several regions: ``multi='all'`` keeps a
    row for each, ``'first'`` the smallest name. Contacts without a hit stay, untagged.
    ``dedupe`` collapses equal contact rows and is the only shuffle for a small lookup; pass
    False when member_id is known to be unique.
    """
    if multi not in ("all", "first"):
        raise ValueError(f"unknown multi {multi!r}")
    if only_reachable_segment:
        audience = audience.filter(p.in_segment() & p.reachable())
    contacts = audience.select(*keep)
    areas = lookup.select("city", "state", "region").filter(F.col("region").isNotNull())
    names = _names_if_few(areas, small_lookup_names)
    if names is not None:
        return _tag_by_row(contacts.distinct() if dedupe else contacts, areas, names, multi)
    return _tag_by_text(settle(contacts.distinct(), "contacts") if dedupe else contacts,
                        areas, multi)


def _names_if_few(areas: DataFrame, most: int) -> list[str] | None:
    """The region names, if there are at most ``most`` and the lookup fits a broadcast."""
    if not fits_broadcast(areas):
        return None
    names = [r.region for r in areas.select("region").distinct().limit(most + 1).collect()]
    return sorted(names) if len(names) <= most else None


def _tag_by_row(contacts: DataFrame, areas: DataFrame, regions: list[str],
                multi: str) -> DataFrame:
    """Two broadcast lookups that return one list each, and a scan of the few names.

    Neither lookup multiplies rows, and the scan runs only where the exact tier missed.
    """
    def hit(region: Column, tier: str) -> Column:
        return F.struct(region.alias("region"), F.lit(tier).alias("tier"))

    def hits(tier: str) -> Column:
        return F.collect_set(hit(F.col("region"), tier))

    by_city = (areas.groupBy(F.col("city").alias("_city"), F.col("state").alias("_state"))
               .agg(hits(EXACT).alias("_exact")))
    by_state = areas.groupBy(F.col("state").alias("_fallback")).agg(hits(STATE).alias("_byst"))
    joined = (contacts
              .join(F.broadcast(by_city),
                    (_part(1) == F.col("_city")) & (_part(2) == F.col("_state")), "left")
              .join(F.broadcast(by_state), _part(2) == F.col("_fallback"), "left"))
    none = hit(F.lit(None).cast("string"), UNMATCHED)
    tiers = [F.col("_exact")]
    if regions:
        named = F.array(*[hit(F.lit(r), FUZZY) for r in regions])
        inside = F.filter(named, lambda a: F.contains(F.col("location_raw"), a["region"]))
        tiers.append(F.nullif(inside, F.slice(named, 1, 0)))
    found = F.coalesce(*tiers, F.col("_byst"), F.array(none))
    if multi == "first":
        found = F.array(F.array_min(found))
    return (joined.select(*contacts.columns, F.inline(found))
            .withColumnsRenamed({"region": "location_tag", "tier": "match_tier"}))


def _tag_by_text(contacts: DataFrame, areas: DataFrame, multi: str) -> DataFrame:
    """For a large lookup: match each distinct text once, then bring the hits back.

    Each tier works on the texts the one before left over, and every step is an equi join.
    """
    areas = areas.distinct()
    texts = settle(
        contacts.select("location_raw").filter(F.col("location_raw").isNotNull()).distinct()
        .withColumns({"city": _part(1), "state": _part(2)}), "texts")

    def matched(hits: DataFrame, tier: str) -> DataFrame:
        hits = hits.select("location_raw", "region")
        hits = (hits.groupBy("location_raw").agg(F.min("region").alias("region"))
                if multi == "first" else hits.distinct())
        return settle(hits.withColumn("tier", F.lit(tier)), tier)

    def left_over(pool: DataFrame, hits: DataFrame) -> DataFrame:
        return pool.join(hits.select("location_raw").distinct(), "location_raw", "left_anti")

    exact = matched(keyed_join(texts, areas, ["city", "state"], "inner"), EXACT)
    rest = left_over(texts, exact)
    fuzzy = matched(_texts_containing(rest, areas.select("region").distinct()), FUZZY)
    rest = left_over(rest, fuzzy)
    state = matched(keyed_join(rest, areas.select("state", "region").distinct(),
                               ["state"], "inner"), STATE)
    hits = exact.unionByName(fuzzy).unionByName(state)
    return (keyed_join(contacts, hits, ["location_raw"])
            .select(*contacts.columns, F.col("region").alias("location_tag"),
                    F.coalesce("tier", F.lit(UNMATCHED)).alias("match_tier")))


def _grams(text: Column, size: Column) -> Column:
    """All distinct pieces of ``size`` characters; a shorter text is its own piece."""
    last = F.greatest(F.length(text) - size + 1, F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last),
                                        lambda i: F.substring(text, i, size)))


def _texts_containing(texts: DataFrame, regions: DataFrame) -> DataFrame:
    """(text, region) pairs where the text contains the region, by equi join on one piece.

    A text containing a region contains every piece of it, so any single piece finds the
    pair; the piece fewest regions share keeps wrong candidates rare. ``contains`` decides.
    Names of different lengths need pieces of different sizes, at most nine. Every text is cut
    once into its pieces of all sizes and written, then one join serves them all.
    """
    size = F.least(F.length("region"), F.lit(GRAM_LENGTH))
    sizes = sorted(r.n for r in regions.select(size.alias("n")).distinct().collect())
    if not sizes:
        return texts.select("location_raw", F.lit("").alias("region")).limit(0)
    pieces = settle(regions.select("region", F.explode(_grams(F.col("region"), size)).alias("gram")),
                    "region-pieces")
    shared = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("uses"))
    index = (keyed_join(pieces, shared, ["gram"], "inner")
             .groupBy("region").agg(F.min(F.struct("uses", "gram")).alias("best"))
             .select("region", F.col("best.gram").alias("gram")))
    every = F.flatten(F.array(*[_grams(F.col("location_raw"), F.lit(n)) for n in sizes]))
    cut = settle(texts.select("location_raw", F.explode(F.array_distinct(every)).alias("gram")),
                 "text-pieces")
    return (keyed_join(cut, settle(index, "region-index"), ["gram"], "inner")
            .filter(F.contains("location_raw", F.col("region"))).select("location_raw", "region"))


def tier_stats(tagged: DataFrame) -> DataFrame:
    """Rows and share per tier; the window runs over the four counts only."""
    counts = tagged.groupBy("match_tier").agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy())
    return counts.select("match_tier", "n_rows", pct(F.col("n_rows"), total).alias("share_pct"))
