"""From a contact list to audience rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herald import schemas
from herald.operators.locations import EXACT, tag_locations
from herald.operators.names import clean_last_name
from herald.sources.tables import latest_per_key, segment_flag, upsert


def prepare_contacts(raw: DataFrame, lookup: DataFrame, segment_ids: DataFrame | None = None,
                     now: dt.datetime | None = None) -> DataFrame:
    """Readable contact rows to audience rows: defaults, one row per member, cleaned last
    name, segment flag, one location tag each. Rows without an id are left out, and the A/B
    group never comes from a contact list."""
    raw = raw.filter(F.col("member_id").isNotNull()).drop("ab_group")
    rows = schemas.apply_defaults(schemas.conform(raw, schemas.AUDIENCE), "audience", now)
    rows = latest_per_key(rows, "member_id", ["ingested_at"])
    if segment_ids is not None:
        rows = segment_flag(rows, segment_ids)
    rows = clean_last_name(rows).withColumns({
        "full_name": F.coalesce("full_name", F.concat_ws(" ", "first_name", F.trim("last_name"))),
        "last_name": F.col("clean_last_name"),
    }).drop("clean_last_name", "location_tag")
    tagged = tag_locations(rows, lookup, multi="first", only_reachable_segment=False,
                           dedupe=False, keep=rows.columns)
    city = F.trim(F.split_part("location_raw", F.lit(","), F.lit(1)))
    tagged = tagged.withColumn("std_location", F.coalesce(
        "std_location", F.when(F.col("match_tier") == EXACT, city).otherwise(F.col("location_tag"))))
    return schemas.conform(tagged, schemas.AUDIENCE)


def brought_columns(given: Sequence[str], with_segment: bool) -> list[str]:
    """The audience columns that a list with the ``given`` columns says something about."""
    given = set(given) - {"ab_group"}
    derived = {"member_id", "ingested_at"}
    if with_segment:
        derived.add("in_segment")
    if given & {"first_name", "last_name"}:
        derived.add("full_name")
    if "location_raw" in given:
        derived |= {"location_tag", "std_location"}
    return [c for c in schemas.AUDIENCE.names if c in given - {"location_tag"} or c in derived]


def new_member() -> dict[str, Column]:
    """What a new member gets in columns that its list lacks."""
    return {"in_segment": F.lit(0)}


def known_batch(raw: DataFrame, lookup: DataFrame, segment_ids: DataFrame | None = None,
                now: dt.datetime | None = None) -> DataFrame:
    """What a list says about an audience that exists: prepared rows, only the columns it brings."""
    prepared = prepare_contacts(raw, lookup, segment_ids, now)
    return prepared.select(brought_columns(raw.columns, segment_ids is not None))


def ingest_audience(raw: DataFrame, lookup: DataFrame, base: DataFrame | None = None,
                    segment_ids: DataFrame | None = None,
                    now: dt.datetime | None = None) -> DataFrame:
    """The audience after taking in ``raw``. A known member keeps what the list does not
    bring: columns it lacks, and always the A/B group. Defaults are for new members."""
    if base is None:
        return prepare_contacts(raw, lookup, segment_ids, now)
    return upsert(base, known_batch(raw, lookup, segment_ids, now), defaults=new_member())
