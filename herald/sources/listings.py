"""Stock listings: fields out of fetched pages or records, and shop names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herald.scale import keyed_join
from herald.schemas import INVENTORY, conform

# The markup of a listing card.
CARD_START = r'<article class="listing"'
CARD_FIELDS = {
    "car_id": r'product-details\.html\?id=([^"&]+)',
    "title": r"<h2[^>]*>([^<]*)</h2>",
    "trim": r'<p class="trim">([^<]*)</p>',
    "price": r"\$([0-9][0-9,]*(?:\.[0-9]+)?)",
    "mileage": r"([0-9][0-9,]*) mi\b",
    "photo_url": r'<img[^>]*src="([^"]+)"',
    "product_url": r'href="([^"]*product-details\.html[^"]*)"',
    "shop_location": r'data-shop="([^"]*)"',
}
# The keys of a listing record.
RECORD_SCHEMA = ("id STRING, title STRING, trim STRING, price STRING, mileage STRING, "
                 "photo STRING, url STRING, shop STRING")
TITLE = r"^\s*([0-9]{4})\s+(\S+)\s+(.*?)\s*$"


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def plain_number(text: Column) -> Column:
    """'$38,900' or '32,400 mi' without its symbols; NULL when no number is left."""
    return F.regexp_replace(text, r"[^0-9.]", "")


# The entities of a page's text, ampersand last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def unescape_html(text: Column) -> Column:
    for safe, raw in ENTITIES:
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _typed(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(cars, rejects): listing texts to stock columns, title into year, make, model, numbers
    typed; and the listings without a readable id, as ``listing`` text with a reason."""
    title = F.col("title")
    typed = df.withColumns({
        "year": _first(title, TITLE).try_cast("int"),
        "make": _first(title, TITLE, 2),
        "model": _first(title, TITLE, 3),
        "price": plain_number(F.col("price")).try_cast("decimal(10,2)"),
        "mileage": plain_number(F.col("mileage")).try_cast("int"),
    })
    rejects = df.filter(F.col("car_id").isNull()).select(
        F.col(source).alias("listing"), F.lit("missing car_id").alias("reject_reason"))
    return conform(typed.filter(F.col("car_id").isNotNull()), INVENTORY), rejects


def parse_listings(pages: DataFrame, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """(cars, rejects) from fetched pages; a page may hold any number of cards. A car that is
    listed twice is two rows here and one in the stock."""
    cards = F.split(F.col(html), CARD_START)
    rest = F.slice(cards, 2, F.greatest(F.size(cards) - 1, F.lit(0)))
    passthrough = [c for c in ("scraped_at",) if c in pages.columns]
    blocks = pages.select(F.explode(rest).alias("card"), *passthrough)
    return _typed(blocks.select(
        *[unescape_html(_first(F.col("card"), rx)).alias(name) for name, rx in CARD_FIELDS.items()],
        "card", *passthrough), "card")


def parse_listing_records(records: DataFrame, column: str = "record") -> tuple[DataFrame, DataFrame]:
    """(cars, rejects) from one JSON record per row."""
    passthrough = [c for c in ("scraped_at",) if c in records.columns]
    fields = records.select(F.from_json(column, RECORD_SCHEMA).alias("r"),
                            F.col(column).alias("_record"), *passthrough)
    return _typed(fields.select(
        F.col("r.id").alias("car_id"), "r.title", "r.trim", "r.price", "r.mileage",
        F.col("r.photo").alias("photo_url"), F.col("r.url").alias("product_url"),
        F.col("r.shop").alias("shop_location"), "_record", *passthrough), "_record")


def parse_fetched(fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cars, rejects) from whichever was fetched: JSON in ``record`` or pages in ``html``."""
    return (parse_listing_records(fetched) if "record" in fetched.columns
            else parse_listings(fetched))


def page_fields(pages: DataFrame) -> DataFrame:
    """Title and link count of any fetched page."""
    return pages.select(
        "page_id", "url",
        _first(F.col("html"), r"(?s)<title[^>]*>(.*?)</title>").alias("title"),
        F.size(F.regexp_extract_all("html", F.lit(r'<a [^>]*href="([^"]*)"'), 1))
        .cast("bigint").alias("n_links"))


def normalize_shops(stock: DataFrame, shops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, rejects): shop names brought to the tag vocabulary.

    A shop answers to its location name and its tag, whatever the case or outer spaces.
    """
    def plain(c: str) -> Column:
        return F.lower(F.trim(F.col(c)))

    alias = (shops.select(plain("shop_location").alias("_alias"), "shop_location")
             .unionByName(shops.select(plain("tag").alias("_alias"), "shop_location"))
             .groupBy("_alias").agg(F.min("shop_location").alias("_known")))
    matched = keyed_join(stock.withColumn("_alias", plain("shop_location")), alias, ["_alias"])
    known = matched.filter(F.col("_known").isNotNull()).withColumn("shop_location", F.col("_known"))
    rejects = matched.filter(F.col("_known").isNull())
    return known.select(*stock.columns), rejects.select(*stock.columns)
