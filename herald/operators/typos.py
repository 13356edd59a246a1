"""Place names with a letter too many, too few, wrong or swapped: an extra tier, off unless it is called.

Two strings are at most one edit apart only if they share a string that each of them becomes by leaving
out at most one letter. So names and texts are expanded to these, joined on equality, and the few pairs
that meet are measured. Distinct texts are expanded, not contacts, and only those no longer than a name can be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herald.scale import keyed_join, settle

#: Shorter names are too alike to be corrected.
LEAST_LETTERS = 4


def _neighbours(text: Column) -> Column:
    """The text and every string it becomes by leaving out one letter."""
    cut = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(
        F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))
    return F.array_distinct(F.concat(F.array(text), cut))


def near_names(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(text, name, distance): per text of ``texts`` the nearest name of ``names`` (name) at most one edit or one swap of
    neighbours away, upper and lower case being the same; a tie goes to the first name in order. NULLs match nothing."""
    known = names.select(F.col("name")).filter(F.length("name") >= LEAST_LETTERS).distinct()
    known = settle(known.withColumn("low", F.lower("name")), "known-names")
    longest = known.agg(F.max(F.length("low"))).first()[0] or 0
    asked = texts.select("text").filter(F.col("text").isNotNull()).distinct().withColumn("asked", F.lower("text"))
    asked = asked.filter(F.length("asked").between(LEAST_LETTERS - 1, longest + 1))
    index = known.select("name", "low", F.explode(_neighbours(F.col("low"))).alias("key"))
    wanted = asked.select("text", "asked", F.explode(_neighbours(F.col("asked"))).alias("key"))
    met = wanted.join(index, "key").select("text", "asked", "name", "low").distinct()
    distance = F.levenshtein("asked", "low")
    # a swap is two edits, but leaves the same letters, of which two stand elsewhere
    mine, theirs = F.split("asked", ""), F.split("low", "")
    moved = F.size(F.filter(F.zip_with(mine, theirs, lambda a, b: a != b), lambda x: x))
    swapped = (distance == 2) & (F.array_sort(mine) == F.array_sort(theirs)) & (moved == 2)
    met = met.withColumn("distance", F.when(swapped, 1).otherwise(distance)).filter(F.col("distance") <= 1)
    best = Window.partitionBy("text").orderBy("distance", "name")
    return (met.withColumn("n", F.row_number().over(best)).filter("n = 1").select("text", "name", "distance"))


def tag_typos(contacts: DataFrame, lookup: DataFrame) -> DataFrame:
    """``contacts`` with a tag for those that have none and whose city or region is a near miss of one of the
    lookup's, which has rows (city, state, region); aliases are rows of it as well. Of several rows with the
    city or region, the first region in order counts."""
    places = lookup.select(F.col("city").alias("name"), "region").unionByName(
        lookup.select(F.col("region").alias("name"), "region")).filter(F.col("name").isNotNull())
    places = places.groupBy("name").agg(F.min("region").alias("region"))
    city = F.trim(F.split_part("location_raw", F.lit(","), F.lit(1)))
    rows = contacts.withColumn("_place", F.when(F.col("location_tag").isNull(), city))
    found = near_names(rows.select(F.col("_place").alias("text")), places).join(places, "name")
    found = settle(found.select(F.col("text").alias("_place"), "region"), "near-places")
    return (keyed_join(rows, found, ["_place"], "left")
            .withColumn("location_tag", F.coalesce("location_tag", "region")).select(*contacts.columns))
