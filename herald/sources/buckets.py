"""A keyed table in buckets, of which a merge rewrites only those its batch touches.

A bucket is a hash of the key. Each run writes the buckets it changes into a folder of its own,
partitioned by bucket, and then a manifest: which run holds each bucket. Readers go by the newest
manifest that was written to the end, so a run that dies leaves the table as it was, and files of
untouched buckets are neither read nor written again. (Overwriting partitions in place would delete
a bucket before its successor is moved in; a run that died in between would leave neither.)

Choose as many buckets as make one about 256 MB. The manifest, and with it what the driver handles,
has a row per bucket. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from herald.scale import fits_broadcast, remove, settle
from herald.sources.tables import (
    _open,
    _version_path,
    _versions,
    complete_versions,
    exists,
    latest_per_key,
    latest_version,
    upsert,
)


@dataclass(frozen=True)
class Manifest:
    """What a version consists of: the run that holds each bucket, and how rows look."""

    version: int
    buckets: int
    schema: StructType
    runs: dict[int, int]


@dataclass(frozen=True)
class BucketTable:
    path: str
    key: str = "member_id"
    buckets: int = 1024

    @property
    def _manifests(self) -> str:
        return f"{self.path}/manifest"

    def _run(self, run: int) -> str:
        return f"{self.path}/run={run:06d}"

    def bucket(self, df: DataFrame, buckets: int) -> Column:
        """Rows without a key spread by all they hold."""
        columns = sorted(c for c in df.columns if c != self.key)
        loose = F.xxhash64(*columns) if columns else F.lit(0)
        return F.pmod(F.when(F.col(self.key).isNull(), loose).otherwise(F.xxhash64(self.key)),
                      F.lit(buckets)).cast("int")

    # --- reading -----------------------------------------------------------------------

    def versions(self, spark: SparkSession) -> list[int]:
        return complete_versions(spark, self._manifests)

    def manifest(self, spark: SparkSession, version: int | None = None) -> Manifest | None:
        version = version or latest_version(spark, self._manifests)
        if not version:
            return None
        rows = spark.read.parquet(_version_path(self._manifests, version)).collect()  # a row per bucket
        about = next(r for r in rows if r.bucket is None)
        return Manifest(version, about.run, StructType.fromJson(json.loads(about.schema)),
                        {r.bucket: r.run for r in rows if r.bucket is not None})

    def read(self, spark: SparkSession, version: int | None = None,
             only: Iterable[int] | None = None) -> DataFrame | None:
        """The newest version, or the given one; of ``only`` these buckets. None before the first."""
        made = self.manifest(spark, version)
        return None if made is None else self._read(spark, made, only)

    def _read(self, spark: SparkSession, made: Manifest, only: Iterable[int] | None) -> DataFrame:
        wanted = made.runs if only is None else made.runs.keys() & set(only)
        paths = [f"{self._run(made.runs[b])}/bucket={b}" for b in sorted(wanted)]
        if not paths:
            return spark.createDataFrame([], made.schema)
        return spark.read.schema(made.schema).parquet(*paths)

    def touched(self, rows: DataFrame, version: int | None = None) -> list[int]:
        """The buckets that hold the keys of ``rows``; at most as many as there are buckets."""
        made = self.manifest(rows.sparkSession, version)
        return [r[0] for r in rows.select(self.bucket(rows, made.buckets)).distinct().collect()]

    # --- writing -----------------------------------------------------------------------

    def write(self, df: DataFrame, keep: int | None = None) -> int:
        """The whole table anew; returns the version."""
        return self._commit(df, {}, self.buckets, keep)

    def put(self, rows: DataFrame, base: int | None = None, keep: int | None = None) -> int:
        """``rows`` take the place of all stored rows with their keys; the rest stays."""
        return self._rewrite(rows, lambda stored, fresh: self._without(stored, fresh).unionByName(
            fresh.select(*stored.columns)), base, keep)

    def merge(self, batch: DataFrame, order: str = "ingested_at",
              defaults: dict[str, Column] | None = None, keep: int | None = None,
              finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> int:
        """``tables.upsert`` of the batch; same meaning, but only touched buckets are rewritten.
        ``finish`` is applied to the rows of these before they are written."""
        batch = batch.filter(F.col(self.key).isNotNull())
        ranked = [order] if order in batch.columns else []
        return self._rewrite(
            latest_per_key(batch, self.key, ranked),
            lambda stored, fresh: finish(upsert(stored, fresh, self.key, order, defaults)), None, keep)

    def _without(self, stored: DataFrame, fresh: DataFrame) -> DataFrame:
        keys = fresh.select(self.key).distinct()
        return stored.join(F.broadcast(keys) if fits_broadcast(keys) else keys, self.key, "left_anti")

    def _rewrite(self, rows: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame],
                 base: int | None, keep: int | None) -> int:
        spark = rows.sparkSession
        made = self.manifest(spark, base)
        if made is None:
            return self.write(rows, keep)
        fresh = settle(rows, "bucket-batch")
        touched = self.touched(fresh, made.version)
        if not touched:
            return made.version
        stored = self._read(spark, made, touched)
        rest = {b: r for b, r in made.runs.items() if b not in set(touched)}
        return self._commit(change(stored, fresh).select(*made.schema.names), rest, made.buckets, keep)

    def _commit(self, df: DataFrame, rest: dict[int, int], buckets: int, keep: int | None) -> int:
        """Write the rows as a run, then the manifest that names it beside the runs of the rest."""
        spark = df.sparkSession
        run = max([0, *self._runs(spark), *_versions(spark, self._manifests)]) + 1
        # AQE splits what a hot key or rows without one make large, and joins what is small.
        named = df.withColumn("bucket", self.bucket(df, buckets)).hint("rebalance", F.col("bucket"))
        named.write.partitionBy("bucket").parquet(self._run(run))
        runs = rest | dict.fromkeys(self._stored(spark, run), run)
        rows = [(None, buckets, df.schema.json()), *((b, r, None) for b, r in sorted(runs.items()))]
        made = spark.createDataFrame(rows, "bucket int, run int, schema string").coalesce(1)
        made.write.parquet(_version_path(self._manifests, run))
        if keep:
            self.clean(spark, keep)
        return run

    def _folders(self, spark: SparkSession, path: str, prefix: str) -> list[int]:
        if not exists(spark, path):
            return []
        fs, location = _open(spark, path)
        names = [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    def _runs(self, spark: SparkSession) -> list[int]:
        return self._folders(spark, self.path, "run=")

    def _stored(self, spark: SparkSession, run: int) -> list[int]:
        return self._folders(spark, self._run(run), "bucket=")

    def clean(self, spark: SparkSession, keep: int) -> None:
        """Leave the newest ``keep`` versions and the buckets they name. What unfinished runs left goes too."""
        done = self.versions(spark)[-keep:]
        named = {(run, b) for v in done for b, run in self.manifest(spark, v).runs.items()}
        for version in _versions(spark, self._manifests):
            if version not in done:
                remove(spark, _version_path(self._manifests, version))
        for run in self._runs(spark):
            stored = self._stored(spark, run)
            if not any((run, b) in named for b in stored):
                remove(spark, self._run(run))
                continue
            for b in stored:
                if (run, b) not in named:
                    remove(spark, f"{self._run(run)}/bucket={b}")

