"""One weekly run from the command line, for ``spark-submit`` or ``python -m herald.run``."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from herald import schemas
from herald.plans.weekly import Store, weekly_run
from herald.session import build_session
from herald.sources.contacts import csv_by_header
from herald.sources.lookups import metro_areas


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="herald.run", description=__doc__)
    parser.add_argument("--csv", required=True, help="contact list, a file or a folder")
    parser.add_argument("--store", required=True, help="folder of the deployment's tables")
    parser.add_argument("--shops", required=True, help="shop records as CSV with a header")
    parser.add_argument("--pages", help="fetched listings as Parquet: html or record column")
    parser.add_argument("--segment-ids", help="member ids of the segment as CSV with a header")
    parser.add_argument("--skip-scrape", action="store_true", help="keep the previous stock")
    parser.add_argument("--dry-run", action="store_true", help="write nothing at all: audience, stock and messages stay as they are")
    parser.add_argument("--sync", help="delivery records as Parquet: weekly mail goes to contacts "
                        "past their welcome days")
    parser.add_argument("--buckets", type=int, help="keep the audience in so many buckets, of which a run "
                        "rewrites those that its list touches; about 256 MB each")
    parser.add_argument("--only-changes", action="store_true",
                        help="payloads only for contacts that changed since the run before")
    parser.add_argument("--picks", type=int, default=3)
    parser.add_argument("--shuffle-partitions", type=int, default=4096)
    parser.add_argument("--now", type=dt.datetime.fromisoformat, help="time of the run, for replays")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session("herald-weekly", shuffle_partitions=args.shuffle_partitions)

    def table(path: str, schema):
        required = [f.name for f in schema.fields if not f.nullable]
        return schemas.conform(csv_by_header(spark, path, required), schema)

    pages = None if args.skip_scrape or not args.pages else spark.read.parquet(args.pages)
    ids = table(args.segment_ids, schemas.SEGMENT_IDS) if args.segment_ids else None
    result = weekly_run(spark, Store(args.store, args.buckets), args.csv, metro_areas(spark),
                        table(args.shops, schemas.SHOPS), pages, ids, args.now, args.picks,
                        args.dry_run, spark.read.parquet(args.sync) if args.sync else None,
                        args.only_changes)
    result["stats"].show(truncate=False)


if __name__ == "__main__":
    main()
