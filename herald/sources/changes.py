"""What changed between two versions of a table, and the payloads that follow from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herald.functions import predicates as p
from herald.operators.messages import MERGE_FIELDS, SOURCE_TAG, TAG_PREFIX, delivery_payload
from herald.scale import keyed_join, settle

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def _signed(before: DataFrame, after: DataFrame) -> DataFrame:
    return (before.withColumn("_sign", F.lit(-1).cast("bigint"))
            .unionByName(after.withColumn("_sign", F.lit(1).cast("bigint"))))


def _keyed(df: DataFrame, key: str) -> DataFrame:
    """A key that equals itself even where it is NULL."""
    return df.withColumns({"_none": F.col(key).isNull(), "_key": F.coalesce(F.col(key).cast("string"), F.lit(""))})


def _row_hash(columns: Sequence[str]) -> Column:
    # a NULL alone would leave the hash as it was, so (NULL, 'a') would equal ('a', NULL)
    return F.xxhash64(F.lit(0), *[v for c in columns for v in (F.col(c).isNull(), F.col(c))])


def changes(before: DataFrame, after: DataFrame, key: str,
            columns: Sequence[str] | None = None) -> DataFrame:
    """(key, change, changed_columns, rows_before, rows_after), one row per key whose rows differ.

    Versions are compared by a 64-bit hash of each row, NULL being a value: (key, hash) counts that do
    not cancel out mark the changed keys, so unchanged rows move as two numbers and nothing else of
    them. Only changed keys are looked at column by column. A key with several rows, the NULL key
    included, is one key: it changed if its rows, as a bag, did, and a column of it did if its values,
    as a bag, did. Counts and sums of hashes are built up in the tasks, so that a busy key costs a row
    per task. Rows of one key that only swapped values among each other are an update that names no
    column. ``columns`` are those compared; by default all but the key.
    """
    columns = [c for c in (columns or after.columns) if c != key]
    both = _keyed(_signed(before.select(key, *columns), after.select(key, *columns)), key)
    marks = both.select("_none", "_key", "_sign", _row_hash(columns).alias("_hash"))
    differ = (marks.groupBy("_none", "_key", "_hash").agg(F.sum("_sign").alias("_n"))
              .filter(F.col("_n") != 0).select("_none", "_key").distinct())
    changed = keyed_join(both, settle(differ, "changed-keys"), ["_none", "_key"], "left_semi")

    def hash_sum(c: str) -> Column:
        # NULL and the column's place are part of the hash
        return F.sum(F.xxhash64(F.lit(columns.index(c)), F.col(c).isNull(), F.col(c)).cast("decimal(38,0)") * F.col("_sign"))

    per_key = changed.groupBy("_none", "_key").agg(
        F.first(key).alias(key), F.count_if(F.col("_sign") < 0).alias("rows_before"),
        F.count_if(F.col("_sign") > 0).alias("rows_after"),
        *[hash_sum(c).alias(f"_sum_{i}") for i, c in enumerate(columns)])
    kind = (F.when(F.col("rows_before") == 0, INSERT).when(F.col("rows_after") == 0, DELETE).otherwise(UPDATE))
    names = F.array_compact(F.array(*[F.when(F.col(f"_sum_{i}") != 0, F.lit(c)) for i, c in enumerate(columns)]))
    return per_key.select(key, kind.alias("change"),
                          F.when(kind == UPDATE, names).alias("changed_columns"), "rows_before", "rows_after")


def changed_payloads(before: DataFrame, after: DataFrame, tag_prefix: str = TAG_PREFIX,
                     source_tag: str = SOURCE_TAG) -> DataFrame:
    """(member_id, change, changed_columns, payload): what the mail provider has to be told.

    Contacts that qualify are compared by the columns a payload is made of, so a contact that no longer
    qualifies is a delete and a new arrival time is no change. A delete has no payload; a contact with several rows has one per row.
    """
    used = list(dict.fromkeys(["member_id", "email", *MERGE_FIELDS.values(), "location_tag"]))
    old, new = (v.filter(p.qualified()).select(*used) for v in (before, after))
    feed = settle(changes(old, new, "member_id").select("member_id", "change", "changed_columns"), "changes")
    send = feed.filter(F.col("member_id").isNotNull() & (F.col("change") != DELETE))
    ready = keyed_join(new, send.select("member_id"), ["member_id"], "left_semi")
    payloads = delivery_payload(ready, tag_prefix, source_tag)
    told = keyed_join(payloads, send, ["member_id"], "inner").select("member_id", "change", "changed_columns", "payload")
    gone = feed.filter(F.col("member_id").isNotNull() & (F.col("change") == DELETE))
    return told.unionByName(gone.withColumn("payload", F.lit(None).cast("string")))
