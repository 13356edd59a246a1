"""Stock picks per contact: own shop first, then the global pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herald.scale import keyed_join, settle

CARD = ["car_id", "year", "make", "model", "trim", "mileage", "price", "photo_url",
        "product_url", "scraped_at"]


def pick_order() -> list[Column]:
    """Newest first, then cheapest; car_id makes the order total."""
    return [F.desc_nulls_last("scraped_at"), F.asc_nulls_last("price"), F.asc("car_id")]


def _list_of_cards(origin: str) -> Column:
    ranked = F.struct("_rank", F.struct(*CARD, F.lit(origin).alias("origin")).alias("card"))
    return F.transform(F.sort_array(F.collect_list(ranked)), lambda e: e["card"])


def best_per_shop(inventory: DataFrame, k: int) -> DataFrame:
    """The best ``k`` cars of every shop.

    Spark keeps the first ``k`` of each shop inside every input partition before the
    shuffle, so a shop with a third of the stock sends k rows per task, not all of them.
    """
    rank = Window.partitionBy("shop_location").orderBy(*pick_order())
    return (inventory.select("shop_location", *CARD)
            .withColumn("_rank", F.row_number().over(rank))
            .filter(F.col("_rank") <= k))


def pick_lists(inventory: DataFrame, k: int = 3, fill: bool = True) -> tuple[DataFrame, Column]:
    """(lists, pool): up to ``k`` cards per shop location, and the k best cars overall.

    ``fill`` tops a short list up from the pool without repeating a car: at most len(own)
    of the pool are already listed, so what is missing can always be filled. The overall
    best are among the best of each shop, so the stock is read once.
    """
    best = settle(best_per_shop(inventory, k), "best-cars")
    lists = (best.groupBy(F.col("shop_location").alias("location_tag"))
             .agg(_list_of_cards("shop").alias("cards")))
    pool = (best.orderBy(*pick_order()).limit(k)
            .withColumn("_rank", F.row_number().over(Window.orderBy(*pick_order())))
            .agg(_list_of_cards("pool")).scalar())
    if fill:
        missing = F.filter("pool",
                           lambda c: ~F.array_contains(F.col("cards.car_id"), c["car_id"]))
        lists = (lists.withColumn("pool", pool)
                 .withColumn("cards", F.slice(F.concat("cards", missing), 1, k))
                 .drop("pool"))
    return lists, pool


def select_picks(audience: DataFrame, inventory: DataFrame, k: int = 3,
                 fill: bool = True) -> DataFrame:
    """Up to ``k`` cars for each contact, numbered from 1.

    The choice depends on the location only, so it is made once per shop and looked up. A
    contact whose location has no shop gets the pool, or nothing without ``fill``.
    """
    lists, pool = pick_lists(inventory, k, fill)
    contacts = audience.select("member_id", "location_tag")
    joined = keyed_join(contacts, lists, ["location_tag"])
    cards = F.coalesce("cards", pool) if fill else F.col("cards")
    return (joined.select("member_id", "location_tag", F.posexplode(cards).alias("_at", "card"))
            .select("member_id", "location_tag", (F.col("_at") + 1).alias("position"), "card.*"))
