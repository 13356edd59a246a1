"""Message rows, delivery payloads and journey stages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herald.functions.text import escape_html, fill, thousands
from herald.operators.picks import pick_lists
from herald.scale import keyed_join, settle

# Texts of a message; names in braces are filled in.
SUBJECT = "This week's picks from {shop}"
OPENING = '<html><body><div class="preheader">Fresh this week at {shop}: {titles}</div>'
GREETING = "<h1>Hi {first_name}, here is what we picked for you.</h1>"
CARD = ('<div class="pick"><span>Pick {number}</span><h2>{title}</h2><p>{trim}</p>'
        "<p>${price} | {mileage} mi</p>"
        '<img src="{photo}"><a href="{link}">View details</a></div>')
CLOSING = ('<p>See everything at {shop}. Call {phone}.</p>'
           '<footer>{address} | {hours}</footer></body></html>')

# Tags and merge fields the mail provider expects.
TAG_PREFIX = "cac-"
SOURCE_TAG = "source-linkedin"
MERGE_FIELDS = {
    "EMAIL": "email",
    "FNAME": "first_name",
    "LNAME": "last_name",
    "STD_LOC": "std_location",
    "LK_URL": "profile_url",
}
WEEKLY_FROM_DAY = 3


def _title(card: Column) -> Column:
    return escape_html(F.concat_ws(" ", card["year"].cast("string"), card["make"], card["model"]))


def _card_html(card: Column, index: Column) -> Column:
    return fill(CARD, number=F.lpad((index + 1).cast("string"), 2, "0"), title=_title(card),
                trim=escape_html(card["trim"]), price=thousands(card["price"]),
                mileage=thousands(card["mileage"]), photo=escape_html(card["photo_url"]),
                link=escape_html(card["product_url"]))


def _parts(cards: Column, shop: Column) -> list[Column]:
    """Everything in a message that does not depend on who reads it. The subject is plain text,
    the rest is HTML and escaped once."""
    subject, shop = fill(SUBJECT, shop=shop), escape_html(shop)
    titles = F.array_join(F.transform(cards, _title), ", ")
    return [
        subject.alias("subject"),
        fill(OPENING, shop=shop, titles=titles).alias("opening"),
        F.concat(F.array_join(F.transform(cards, _card_html), ""),
                 fill(CLOSING, shop=shop, phone=escape_html(F.col("phone")),
                      address=escape_html(F.col("address")),
                      hours=escape_html(F.col("hours")))).alias("rest"),
    ]


def render_messages(audience: DataFrame, inventory: DataFrame, shops: DataFrame,
                    k: int = 3) -> DataFrame:
    """(member_id, subject, html), one row per contact with a location; those without get none.

    All but the greeting is the same for a whole location, so that text is built once per
    location and a contact's message is one lookup and one concatenation.
    """
    lists, pool = pick_lists(inventory, k)
    tags = audience.select("location_tag").distinct()
    info = (shops.groupBy(F.col("shop_location").alias("location_tag"))  # one record per shop
            .agg(F.min(F.struct("address", "phone", "hours")).alias("_shop"))
            .select("location_tag", "_shop.*"))
    parts = (tags.join(lists, "location_tag", "left").join(info, "location_tag", "left")
             .withColumn("cards", F.coalesce("cards", pool))
             .select("location_tag", *_parts(F.col("cards"), F.col("location_tag"))))
    contacts = audience.select("member_id", "first_name", "location_tag")
    greeting = fill(GREETING, first_name=escape_html(F.col("first_name")))
    return (keyed_join(contacts, settle(parts, "message-parts"), ["location_tag"], "inner")
            .select("member_id", "subject",
                    F.concat("opening", greeting, "rest").alias("html")))


def delivery_payload(audience: DataFrame, tag_prefix: str = TAG_PREFIX,
                     source_tag: str = SOURCE_TAG) -> DataFrame:
    """(member_id, payload): merge fields and tags of each contact as JSON."""
    fields = F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(f)
                        for f, c in MERGE_FIELDS.items()])
    tags = F.array(F.concat(F.lit(tag_prefix), "location_tag"), F.lit(source_tag))
    document = F.struct(F.col("email").alias("email_address"), fields.alias("merge_fields"),
                        F.array_compact(tags).alias("tags"))
    return audience.select("member_id", F.to_json(document).alias("payload"))


def journey_stage(audience: DataFrame, sync: DataFrame, as_of: dt.date) -> DataFrame:
    """Where each contact is: not synced yet, in the welcome days, or on the weekly mail."""
    synced = sync.groupBy("member_id").agg(F.min("synced_at").alias("synced_at"),
                                           F.lit(True).alias("_synced"))
    days = F.date_diff(F.lit(as_of), F.col("synced_at").cast("date"))
    stage = (F.when(F.col("_synced").isNull(), "pending_onboarding")
             .when(days >= WEEKLY_FROM_DAY, "weekly").otherwise("onboarding"))
    return (audience.select("member_id").join(synced, "member_id", "left")
            .select("member_id", days.cast("bigint").alias("days_in_flow"),
                    stage.alias("stage")))


def weekly_recipients(audience: DataFrame, sync: DataFrame, as_of: dt.date) -> DataFrame:
    """The contacts whose welcome days are over: those who get the weekly mail."""
    weekly = journey_stage(audience, sync, as_of).filter(F.col("stage") == "weekly")
    return audience.join(weekly.select("member_id"), "member_id", "left_semi")
