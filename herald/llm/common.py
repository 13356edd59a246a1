"""What the corpus operators share: Arrow batches of texts, tokens, sorted arrays in the
shared folder, and runs of rows with one key."""

from __future__ import annotations

import contextlib
import fcntl
import mmap
import os
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald.scale import fresh_path, settle

#: The white space that the contracts name: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: Texts are worked on in pieces of about so many bytes, whatever the size of Arrow's batches.
PIECE_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where neither the path nor the working folder
    leads to it: as a zip file that Spark hands out."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if root in map(os.path.abspath, filter(None, paths)) or getattr(context, "_herald_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="herald-"), "herald")
    context.addPyFile(shutil.make_archive(base, "zip", root, "herald"))
    context._herald_shipped = True


# --- texts -----------------------------------------------------------------------------

def texts(docs: DataFrame) -> DataFrame:
    """Only what the operators read: ``doc_id``, and ``text`` with NULL as the empty text."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds at most ``limit`` bytes, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0)
                         .to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def words_lower(text: bytes) -> list[bytes]:
    """Words between white space, with A-Z lower-cased: ``bytes`` knows ASCII only."""
    return text.lower().split()


class WordHashes(dict):
    """64-bit hash per word, remembered for the words met last."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; fewer words make one shingle."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    acc = np.full(n, width, np.uint64)
    for i in range(width):
        acc = mixed(acc * _MIX + hashes[i:i + n])
    return np.unique(acc)


# --- arrays as bytes -------------------------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned values as compressed differences."""
    values = np.ascontiguousarray(values, "<u8")
    gaps = np.diff(values, prepend=np.zeros(1, "<u8")).view(np.uint8).reshape(-1, 8)
    used = 8
    while used > 1 and not gaps[:, used - 1].any():
        used -= 1
    return bytes([used]) + zstandard.compress(np.ascontiguousarray(gaps[:, :used].T).tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    used = blob[0]
    planes = np.frombuffer(zstandard.decompress(blob[1:]), np.uint8).reshape(used, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :used] = planes.T
    return np.cumsum(gaps.reshape(-1).view("<u8"), dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Counts, mostly small, as compressed byte planes."""
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    used = 8
    while used > 1 and not planes[:, used - 1].any():
        used -= 1
    return bytes([used]) + zstandard.compress(np.ascontiguousarray(planes[:, :used].T).tobytes(), 1)


def unpack_counts(blob: bytes) -> np.ndarray:
    used = blob[0]
    planes = np.frombuffer(zstandard.decompress(blob[1:]), np.uint8).reshape(used, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :used] = planes.T
    return out.reshape(-1).view("<u8")


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


# --- files in the shared folder --------------------------------------------------------

def shards(spark: SparkSession, each: int = 4) -> int:
    """How many shards a table of keys gets: a few per shuffle partition, so that
    ``spark.sql.shuffle.partitions``, which grows with the data, bounds a shard's size."""
    return each * int(spark.conf.get("spark.sql.shuffle.partitions"))


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Shards are ranges of the hash, so that shard by shard the keys are in order."""
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def cut_by_shard(keys: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    """Where each shard present begins and ends in sorted keys."""
    owner = shard_of(keys, n).astype(np.int64)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    for i, start in enumerate(first):
        stop = first[i + 1] if i + 1 < len(first) else len(keys)
        yield int(owner[start]), slice(int(start), int(stop))


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder's address below the one that all executors share."""
    return fresh_path(spark, name)


def _local(address: str) -> str | None:
    parts = urlparse(address)
    return (parts.path if parts.scheme else address) if parts.scheme in ("", "file") else None


def put(address: str, data: bytes) -> None:
    """Write a file whole or not at all: a task that runs twice leaves the same file."""
    if path := _local(address):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
        return
    store, path = pafs.FileSystem.from_uri(address)
    part = f"{path}.{uuid.uuid4().hex}"
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, path)


#: Bytes of copies from an object store that a machine keeps, and seconds after which an unused one goes.
COPIES, UNUSED = 32 << 30, 3600


def _copy(address: str) -> str:
    """A machine's one copy of a file in an object store or HDFS. The first process that needs it
    makes it, the others wait. Then the copies unused for longest go until the rest is within
    ``COPIES`` bytes; a running task that has mapped one keeps it, as the system frees a file after its last map."""
    folder = os.path.join(tempfile.gettempdir(), "herald-copies")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, xxhash.xxh3_128_hexdigest(address))
    with open(os.path.join(folder, "lock-" + path[-2:]), "a") as lock:  # 256 locks: few files wait for each other
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(path):
            store, remote = pafs.FileSystem.from_uri(address)
            part = f"{path}.{uuid.uuid4().hex}"
            with open(part, "wb") as out, store.open_input_stream(remote) as src:
                shutil.copyfileobj(src, out)
            os.replace(part, path)
        os.utime(path)
        _tidy(folder, path)
        return path


def _tidy(folder: str, but: str) -> None:
    found, old = [], time.time() - UNUSED
    for entry in os.scandir(folder):
        with contextlib.suppress(FileNotFoundError):  # another process was faster
            seen = entry.stat()
            unfinished = "." in entry.name and seen.st_mtime >= old
            if not entry.name.startswith("lock-") and entry.path != but and not unfinished:
                found.append((seen.st_mtime, seen.st_size, entry.path))
    left = COPIES - os.stat(but).st_size
    for used, size, path in sorted(found, reverse=True):
        left -= size
        if left < 0 or used < old:
            with contextlib.suppress(FileNotFoundError):
                os.remove(path)


def _opened(address: str):
    if path := _local(address):
        return open(path, "rb")
    while True:
        path = _copy(address)
        with contextlib.suppress(FileNotFoundError):  # the copy went before it was opened
            return open(path, "rb")


def mapped(address: str, dtype: str) -> np.ndarray:
    """A shared file as a memory-mapped array; see ``_copy`` for files in an object store or HDFS."""
    with _opened(address) as f:
        size = os.fstat(f.fileno()).st_size
        if not size:
            return np.empty(0, dtype)
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), dtype)


class SortedTable:
    """Sorted 64-bit keys, in shards by range, with columns beside them; all memory-mapped."""

    def __init__(self, folder: str, n: int, present: dict[int, int], columns: dict[str, str]):
        self.folder, self.n, self.present, self.columns = folder, n, present, columns
        self._open: dict[tuple[int, str], np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def part(self, shard: int, column: str) -> np.ndarray:
        at = (shard, column)
        if at not in self._open:
            dtype = "<u8" if column == "keys" else self.columns[column]
            self._open[at] = mapped(f"{self.folder}/{column}-{shard:06d}", dtype)
        return self._open[at]

    def find(self, keys: np.ndarray, column: str, absent) -> np.ndarray:
        """The column's values for sorted keys."""
        out = np.full(len(keys), absent, self.columns[column])
        for shard, at in cut_by_shard(keys, self.n):
            if shard not in self.present:
                continue
            have = self.part(shard, "keys")
            place = np.minimum(np.searchsorted(have, keys[at]), len(have) - 1)
            found = have[place] == keys[at]
            out[at][found] = self.part(shard, column)[place[found]]
        return out


def write_shard(folder: str, shard: int, **columns: np.ndarray) -> None:
    for name, values in columns.items():
        put(f"{folder}/{name}-{shard:06d}", np.ascontiguousarray(values).tobytes())


def settle_narrow(df: DataFrame, name: str) -> DataFrame:
    """Settle rows of a few numbers each: an eighth of the shuffle partitions is enough for them,
    and as many files."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(df.coalesce(max(1, parts // 8)), name)


# --- rows with one key -----------------------------------------------------------------

def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of one key after the other, from batches sorted by it. Only used where the size
    of a key's group is bounded by what precedes it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key)
        change = pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1))
        cuts = [0, *(np.flatnonzero(change.to_numpy(zero_copy_only=False)) + 1).tolist(),
                batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            part = batch.slice(start, stop - start)
            if held and held[-1].column(key)[0] != part.column(key)[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups, many at a time, from batches sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key)
        start = int(np.argmax((column.to_numpy(zero_copy_only=False) == column[-1].as_py())))
        if held and (start or held[-1].column(key)[-1] != column[0]):
            if start:
                held.append(batch.slice(0, start))
            yield pa.Table.from_batches(held)
            held = []
        elif start:
            yield pa.Table.from_batches([batch.slice(0, start)])
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def by_key(df: DataFrame, n: int, key: str, *order: str) -> DataFrame:
    """Rows of a key in one partition, one after the other."""
    return df.repartition(n, key).sortWithinPartitions(key, *order)
