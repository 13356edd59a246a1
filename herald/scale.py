"""Helpers that keep joins and reused results safe when one key is hot or data is large."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after it was measured and found to be within both bounds.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 32 * 1024 * 1024
# A hot key's rows are dealt out in so many pieces per task's mean share of the rows. Pieces
# meet in a task by chance, so they have to be small beside that share.
PIECES = 16

_settled: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own. A ``file:`` folder
    is taken at its word on a cluster: it may be a mount that all machines share.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="herald-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    The result no longer depends on executor memory, has a known size, and gives
    the same rows to every later read.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    _settled.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_settled(spark: SparkSession, since: int = 0) -> int:
    """Delete what ``settle`` wrote in this process, once results built on it are no longer
    needed; with ``since``, all but the first so many. Returns the number of folders removed."""
    removed = 0
    while len(_settled) > since:
        removed += remove(spark, _settled.pop())
    return removed


@contextlib.contextmanager
def settled_for(spark: SparkSession):
    """What is settled inside is deleted at the end, also after a failure. Nothing lazy that
    reads it may be used afterwards."""
    before = len(_settled)
    try:
        yield
    finally:
        clear_settled(spark, before)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure up to ``max_rows + 1`` rows, as text. ``take`` reads a few partitions and
    stops once it has enough, and only the sizes come back, so a large ``df`` costs little."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    sizes = [row[0] for row in df.select(size).take(max_rows + 1)]
    return len(sizes) <= max_rows and sum(sizes) <= max_bytes


def keyed_join(fact: DataFrame, side: DataFrame, on: list[str], how: str = "left",
               max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a large, possibly skewed ``fact`` to ``side`` on equal keys.

    ``side`` is measured first. Small: it is broadcast and ``fact`` stays where it is.
    Large: both are shuffled, and hot keys are salted. Works for the join types that keep
    or drop whole fact rows (inner, left, left_semi, left_anti).
    """
    if fits_broadcast(side, max_rows):
        return fact.join(F.broadcast(side), on, how)
    return _salted_join(fact, side, on, how)


def _hash(on: list[str]):
    return F.xxhash64(*on)


def hot_keys(fact: DataFrame, on: list[str]) -> DataFrame:
    """(hash of the key, salts) of every key with more rows than a task's mean share: fewer than
    there are shuffle partitions, and two numbers each whatever the keys are, so the table may
    be broadcast. Salts follow the measured count. One pass over the key columns of ``fact``."""
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = settle(fact.groupBy(_hash(on).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows")),
                    "key-counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    share = max(1.0, total / tasks)
    return settle(counts.filter(F.col("_rows") > share).select(
        "_hash", F.ceil(F.col("_rows") * PIECES / share).cast("int").alias("_salts")), "hot-keys")


def _salted_join(fact: DataFrame, side: DataFrame, on: list[str], how: str) -> DataFrame:
    """Every fact row meets one copy of its side rows; only hot keys have more than one.

    ``fact`` is read twice: once to count its keys, once to give its rows salts. Salts number
    the rows, so equal rows spread as well, and are settled, so a task that runs again finds the
    same ones. Rows with a NULL key match nothing, and spread like those of any hot key. Without
    a hot key this is a plain join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    hot = hot_keys(fact, on)
    if hot.isEmpty():
        return fact.join(side, on, how)
    salts, few = F.coalesce("_salts", F.lit(1)), F.broadcast(hot)
    rows = settle(fact.withColumn("_hash", _hash(on)).join(few, "_hash", "left").withColumn(
        "_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), salts).cast("int"))
        .drop("_hash", "_salts"), "salted")
    copies = side.withColumn("_hash", _hash(on)).join(few, "_hash", "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_hash", "_salts")
    return rows.join(copies, [*on, "_salt"], how).drop("_salt")
