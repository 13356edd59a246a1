"""One weekly run: contacts, stock, messages and payloads, each read from the step before."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from herald import schemas
from herald.functions import predicates as p
from herald.operators.experiments import fill_groups
from herald.operators.messages import delivery_payload, render_messages, weekly_recipients
from herald.operators.quality import observed_stats, run_stats, watched
from herald.plans.ingest import ingest_audience, known_batch, new_member
from herald.scale import settle, settled_for
from herald.sources.buckets import BucketTable
from herald.sources.changes import changed_payloads
from herald.sources.contacts import checked_contacts, split_contacts
from herald.sources.listings import normalize_shops, parse_fetched
from herald.sources.sinks import write_messages, write_payloads
from herald.sources.tables import (
    current,
    fill_from_previous,
    latest_per_key,
    publish,
    replace_inventory,
)


# Versions of the audience and the stock that a run leaves behind.
KEPT_VERSIONS = 4
AUDIENCE_LAYOUT = ["location_tag", "in_segment", "member_id"]


@dataclass(frozen=True)
class Store:
    """Where a deployment keeps its tables; any folder all executors can reach. With ``buckets``,
    the audience is a table of so many buckets, and a run rewrites only those that its list touches."""

    root: str
    buckets: int | None = None

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def audience_buckets(self) -> BucketTable | None:
        return BucketTable(self.at("audience-buckets"), "member_id", self.buckets) if self.buckets else None

    def audience(self, spark: SparkSession, back: int = 0) -> DataFrame | None:
        """The stored audience; ``back`` versions before the newest, None if there is none."""
        table = self.audience_buckets
        if table:
            done = table.versions(spark)
            return table.read(spark, done[-1 - back]) if len(done) > back else None
        return current(spark, self.at("audience"), back)


def take_in_stock(spark: SparkSession, store: Store, fetched: DataFrame | None,
                  shops: DataFrame, run_id: str, now: dt.datetime, dry_run: bool = False) -> DataFrame:
    """The stock after a fetch, stored unless it is a dry run. Listings without an id and cars of
    unknown shops are kept aside. A shop that the fetch has no car of keeps its previous cars, so a
    partial or missing fetch empties no shop."""
    stock = current(spark, store.at("inventory"))
    if fetched is not None:
        cars, unreadable = parse_fetched(fetched)
        known, unknown = normalize_shops(cars, shops)
        if not dry_run:
            unknown.write.mode("overwrite").parquet(store.at(f"rejects/stock/run={run_id}"))
            unreadable.write.mode("overwrite").parquet(store.at(f"rejects/listings/run={run_id}"))
        known = schemas.apply_defaults(known, "inventory", now)
        if stock is not None:
            known = fill_from_previous(known, stock, "shop_location")
        if dry_run:
            return latest_per_key(known, "car_id", ["scraped_at"])
        if not known.isEmpty():
            replace_inventory(known, store.at("inventory"), KEPT_VERSIONS)
            stock = current(spark, store.at("inventory"))
    if stock is None:
        raise FileNotFoundError("no stock from this run or an earlier one")
    return stock


def contact_lines(spark: SparkSession, contacts_csv: str) -> tuple[DataFrame, Observation] | None:
    """The checked lines of a contact list and their counts; None if it is missing or empty. The list
    is parsed once: everything after reads the checked lines, and they are counted as they are written."""
    try:
        lines = checked_contacts(spark, contacts_csv)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    lines, seen = watched(lines, "contacts", F.col("reject_reason").isNull())
    lines = settle(lines, "contact-lines")
    return (lines, seen) if seen.get["rows_in"] else None


def weekly_run(spark: SparkSession, store: Store, contacts_csv: str, lookup: DataFrame,
               shops: DataFrame, pages: DataFrame | None = None,
               segment_ids: DataFrame | None = None, now: dt.datetime | None = None,
               k: int = 3, dry_run: bool = False, sync: DataFrame | None = None,
               only_changes: bool = False) -> dict[str, DataFrame]:
    """A failing step ends the run, so nothing after it is written; repeating the run with
    the same ``now`` replaces what it wrote. Without a contact list the stored audience is used
    as it is. Contacts get an A/B group once and keep it. With ``sync``, the delivery records, the
    weekly mail goes to contacts past their welcome days; without, to all that qualify.
    ``only_changes`` makes payloads of what changed since the run before: ``payload_changes`` holds new,
    changed and dropped contacts, ``payloads`` the documents of the first two.

    ``dry_run`` writes nothing to the store and returns what would be written; what it settled
    on the way stays until ``clear_settled``. A real run removes that at its end."""
    now = now or dt.datetime.now()
    args = (spark, store, contacts_csv, lookup, shops, pages, segment_ids, now, k, dry_run, sync, only_changes)
    if dry_run:
        return _run(*args)
    with settled_for(spark):
        return _run(*args)


def _take_in(spark, store, known, good, lookup, segment_ids, now, watch) -> DataFrame:
    """Store the audience with the list merged in, and read it back."""
    table = store.audience_buckets
    if table and known is not None:
        table.merge(known_batch(good, lookup, segment_ids, now), defaults=new_member(),
                    keep=KEPT_VERSIONS, finish=fill_groups)
    else:
        audience = fill_groups(ingest_audience(good, lookup, known, segment_ids, now))
        if table:
            table.write(audience, KEPT_VERSIONS)
        else:
            # The history load is laid out by location; a weekly merge leaves most rows where they are.
            publish(audience, store.at("audience"), cluster_by=AUDIENCE_LAYOUT if known is None else (),
                    keep=KEPT_VERSIONS, watch=watch)
    return store.audience(spark)


def _run(spark, store, contacts_csv, lookup, shops, pages, segment_ids, now, k, dry_run, sync, only_changes):
    run_id = now.strftime("%Y%m%dT%H%M%S")
    known = store.audience(spark)
    found = contact_lines(spark, contacts_csv)
    if found is None and known is None:
        raise FileNotFoundError(f"no contacts in {contacts_csv} and none from an earlier run")
    seen: dict[str, Observation] = {}
    rejects = None

    def watch(rows: DataFrame) -> DataFrame:
        rows, seen["qualified"] = watched(rows, "qualified", p.qualified())
        return rows

    if found is None:
        audience = known
    else:
        lines, seen["contacts"] = found
        good, rejects = split_contacts(lines)
        if dry_run:
            audience = fill_groups(ingest_audience(good, lookup, known, segment_ids, now))
        else:
            audience = _take_in(spark, store, known, good, lookup, segment_ids, now, watch)
            rejects.write.mode("overwrite").parquet(store.at(f"rejects/contacts/run={run_id}"))
    stock = take_in_stock(spark, store, pages, shops, run_id, now, dry_run)
    ready = audience.filter(p.qualified())
    recipients = ready if sync is None else weekly_recipients(ready, sync, now.date())
    messages = render_messages(recipients, stock, shops, k)
    # If the audience was not written as a whole, it is counted as payloads are made of it.
    unseen = not dry_run and "qualified" not in seen
    changed = None
    if only_changes and known is not None:
        changed = changed_payloads(known, audience)
        if not dry_run:
            changed.write.mode("overwrite").parquet(store.at(f"payload_changes/run={run_id}"))
            changed = spark.read.parquet(store.at(f"payload_changes/run={run_id}"))
        payloads = changed.filter(F.col("payload").isNotNull())
    else:
        payloads = delivery_payload(watch(audience).filter(p.qualified()) if unseen else ready)
    if dry_run:
        stats = run_stats(run_id, {"qualified": (audience, p.qualified())})
        if "contacts" in seen:
            stats = observed_stats(spark, run_id, seen).unionByName(stats)
    else:
        write_messages(messages, store.at(f"messages/run={run_id}"), mode="overwrite")
        write_payloads(payloads, store.at(f"payloads/run={run_id}"), mode="overwrite")
        stats = observed_stats(spark, run_id, seen)
        if "qualified" not in seen:
            stats = stats.unionByName(run_stats(run_id, {"qualified": (audience, p.qualified())}))
        stats.write.mode("overwrite").parquet(store.at(f"run_stats/run={run_id}"))
        messages = spark.read.parquet(store.at(f"messages/run={run_id}"))
        stats = spark.read.parquet(store.at(f"run_stats/run={run_id}"))
        if found is not None:  # what was settled goes with the run
            rejects = spark.read.schema(rejects.schema).parquet(store.at(f"rejects/contacts/run={run_id}"))
    return {"audience": audience, "inventory": stock, "rejects": rejects,
            "messages": messages, "payloads": payloads, "changes": changed, "stats": stats}
