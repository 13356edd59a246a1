"""The per-location tables of the board, kept up to date from what is new.

The breakdown sums max(1, syncs) * max(1, events) over contacts, times the cars of their location. A batch of
new events changes the counts of the members it names and nothing else, so their old contribution is taken off
their location's sums and the new one put on. Counts per member are a bucketed table, of which a batch touches the
buckets of its members; the sums are a small table with a row per location. Events are read once, in their batch.

Both tables move together: the sums name the version of the counts they belong to and the last batch they hold, and
they are published last. After a failed run the sums still name the old counts, and the batch is taken in again; a
batch that was taken in already is passed over. ``member_id`` is the contacts' key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herald.functions import predicates as p
from herald.functions.rates import pct
from herald.operators.metrics import LOW_STOCK_BELOW, cars_per_location, events_per_member
from herald.scale import settle
from herald.sources.buckets import BucketTable
from herald.sources.tables import current, latest_per_key, publish

COUNTS = ["n_sync", "n_events", "n_delivered", "n_opens", "n_clicks"]
PLACE = ["location_tag", "in_breakdown", "is_qualified"]
KEPT_VERSIONS = 3


def _place(audience: DataFrame) -> DataFrame:
    return audience.select("member_id", "location_tag",
                           F.coalesce(p.segment_tagged(), F.lit(False)).alias("in_breakdown"),
                           F.coalesce(p.qualified(), F.lit(False)).alias("is_qualified"))


def _contributions() -> dict[str, Column]:
    """What a member adds to each of its location's sums."""
    one, here, ready = F.lit(1), F.col("in_breakdown").cast("bigint"), F.col("is_qualified").cast("bigint")
    syncs = F.greatest("n_sync", one)
    weight = syncs * F.greatest("n_events", one)
    synced = (F.col("n_sync") > 0).cast("bigint")
    return {"members": here, "weight": here * weight, "flow_weight": here * weight * synced,
            "open_weight": here * syncs * F.col("n_opens"), "qualified": ready, "in_flow": ready * synced,
            "opens": ready * F.col("n_opens"), "delivered": ready * F.col("n_delivered"),
            "clicks": ready * F.col("n_clicks")}


SUMS = ["members", "weight", "flow_weight", "open_weight", "qualified", "in_flow", "opens", "delivered", "clicks"]


def _sums(members: DataFrame, sign: int) -> DataFrame:
    rows = members.filter(F.col("location_tag").isNotNull() & (F.col("in_breakdown") | F.col("is_qualified")))
    return rows.groupBy("location_tag").agg(*[
        (F.lit(sign) * F.sum(c)).cast("bigint").alias(n) for n, c in _contributions().items()])


@dataclass(frozen=True)
class Breakdown:
    """The maintained state under ``path``."""

    path: str
    buckets: int = 1024

    @property
    def _members(self) -> BucketTable:
        return BucketTable(f"{self.path}/members", "member_id", self.buckets)

    @property
    def _locations(self) -> str:
        return f"{self.path}/locations"

    def _about(self, spark: SparkSession):
        """The row that says which counts and batch the sums belong to."""
        state = current(spark, self._locations)
        return None if state is None else state.filter(F.col("location_tag").isNull()).first()

    def _publish(self, sums: DataFrame, version: int, batch: int) -> None:
        about = sums.sparkSession.createDataFrame(
            [(version, batch)], "members_version bigint, batch bigint").withColumn("location_tag", F.lit(None).cast("string"))
        publish(sums.unionByName(about, allowMissingColumns=True).coalesce(1), self._locations, keep=KEPT_VERSIONS)

    def start(self, audience: DataFrame, sync: DataFrame) -> None:
        """Begin with these contacts and syncs, and no events."""
        synced = _sync_counts(sync)
        members = _place(audience).join(synced, "member_id", "full").select(
            "member_id", *_filled(PLACE), *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) if c == "n_sync"
                                               else F.lit(0).cast("bigint").alias(c) for c in COUNTS])
        spark = audience.sparkSession
        version = self._members.write(members, KEPT_VERSIONS)
        self._publish(_sums(self._members.read(spark, version), 1), version, -1)

    def take_events(self, events: DataFrame, batch: int) -> bool:
        """Take in new events; False if the batch was taken in before."""
        fresh = events_per_member(events).select("member_id", *COUNTS[1:])
        return self._take(fresh, batch, added=COUNTS[1:])

    def take_syncs(self, sync: DataFrame, batch: int) -> bool:
        return self._take(_sync_counts(sync), batch, added=["n_sync"])

    def take_contacts(self, contacts: DataFrame, batch: int) -> bool:
        """New and changed contacts: one row per member, as the audience holds it now."""
        rows = latest_per_key(contacts.filter(F.col("member_id").isNotNull()), "member_id", ["ingested_at"])
        return self._take(_place(rows), batch, added=[], placed=True)

    def _take(self, fresh: DataFrame, batch: int, added: list[str], placed: bool = False) -> bool:
        spark = fresh.sparkSession
        about = self._about(spark)
        if about is None:
            raise FileNotFoundError(f"no breakdown was started under {self.path}")
        if batch <= about.batch:
            return False
        fresh = settle(fresh, "member-changes")
        stored = self._members.read(spark, about.members_version, self._members.touched(fresh, about.members_version))
        names = fresh.select("member_id", *[F.col(c).alias(f"_{c}") for c in fresh.columns if c != "member_id"])
        both = settle(names.join(stored, "member_id", "left"), "member-counts")
        new = both.select(
            "member_id",
            *([F.col(f"_{c}").alias(c) for c in PLACE] if placed else _filled(PLACE)),
            *[(_known(c) + (F.col(f"_{c}") if c in added else F.lit(0))).cast("bigint").alias(c) for c in COUNTS])
        old = both.select("member_id", *_filled(PLACE), *[_known(c).alias(c) for c in COUNTS])
        state = current(spark, self._locations).filter(F.col("location_tag").isNotNull())
        sums = (state.select("location_tag", *SUMS).unionByName(_sums(old, -1)).unionByName(_sums(new, 1))
                .groupBy("location_tag").agg(*[F.sum(c).alias(c) for c in SUMS])
                .filter((F.col("members") > 0) | (F.col("qualified") > 0)))
        version = self._members.put(new, about.members_version, KEPT_VERSIONS)
        self._publish(sums, version, batch)
        return True

    def _read(self, spark: SparkSession) -> DataFrame:
        return current(spark, self._locations).filter(F.col("location_tag").isNotNull())

    def location_breakdown(self, inventory: DataFrame) -> DataFrame:
        """The same rows as ``metrics.location_breakdown`` over everything taken in so far."""
        rows = self._read(inventory.sparkSession).filter(F.col("members") > 0)
        fan = F.greatest(F.coalesce("n_rows", F.lit(0)), F.lit(1))
        return rows.join(cars_per_location(inventory), "location_tag", "left").select(
            "location_tag", (F.col("weight") * fan).alias("qualified"), (F.col("flow_weight") * fan).alias("in_flow"),
            pct(F.col("open_weight"), F.col("weight")).alias("open_rate"),
            F.coalesce("inventory_count", F.lit(0)).alias("inventory_count"))

    def location_status(self, inventory: DataFrame, low_below: int = LOW_STOCK_BELOW) -> DataFrame:
        """The same rows as ``metrics.location_status``."""
        rows = self._read(inventory.sparkSession).filter(F.col("qualified") > 0)
        stock = F.coalesce("inventory_count", F.lit(0))
        return rows.join(cars_per_location(inventory), "location_tag", "left").select(
            "location_tag", "qualified", "in_flow", pct(F.col("opens"), F.col("delivered")).alias("open_rate"),
            pct(F.col("clicks"), F.col("delivered")).alias("ctr"), stock.alias("inventory_count"),
            F.when(stock < low_below, "LOW STOCK").otherwise("OK").alias("status"))

    def follow(self, events: DataFrame, checkpoint: str) -> None:
        """Take in every batch of a stream of events that has arrived. Batches are numbered by the
        stream, so a state that follows one takes events from nowhere else."""
        def take(rows: DataFrame, number: int) -> None:
            self.take_events(rows, number)

        (events.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())


def _known(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0).cast("bigint"))


def _filled(columns: list[str]) -> list[Column]:
    return [F.col(c) if c == "location_tag" else F.coalesce(F.col(c), F.lit(False)).alias(c) for c in columns]


def _sync_counts(sync: DataFrame) -> DataFrame:
    return (sync.filter(F.col("member_id").isNotNull()).groupBy("member_id")
            .agg(F.count(F.lit(1)).alias("n_sync")))
