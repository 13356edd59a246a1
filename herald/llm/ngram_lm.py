"""An interpolated modified Kneser-Ney model of order two, counted in Spark and stored as sorted
hash arrays in the shared folder, which scoring workers map into memory.

1. Words: scan tasks count their words and send compressed sorted hashes with counts to shards
   by hash range. A word's number is its rank among all hashes, so numbers need no dictionary.
2. Pairs of neighbouring words are counted the same way under the key ``first << 32 | second``.
   Pairs of a frequent first word are dealt over as many shards as its count calls for.
3. Each shard of pairs leaves, per word, in how many kinds of pairs it stands (by count 1, 2,
   3 or more) as first, and in how many as second; these are added up per word range.
4. Scoring looks up the distinct pairs of a batch in the mapped arrays.

Tokens are words between white space with A-Z lower-cased, then one end token per text; the
context of the first token is the start. Words outside the training texts share one place beside
the V known ones in the uniform base distribution. Discounts come from the counts of counts;
where those leave none, half, one and one and a half are used.

NULL and empty texts are the end token alone. NULL ids are hashed as the empty text and so may
be trained on. Rows are scored one by one, so repeated rows repeat. A corpus without training
texts gives every token probability one over one, an empty table no rows. Texts of any length are counted and scored
in one piece each. Counts are whole at any size; 2^32 - 1 different words and more stop the training with an error.
Other columns than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm import common
from herald.llm.common import (
    by_key,
    cut_by_shard,
    mapped,
    pack,
    pack_counts,
    pieces,
    runs,
    summed,
    texts,
    unpack,
    unpack_counts,
    utf8,
    words_lower,
    write_shard,
)

FOLDS, HELD_OUT = 7, 2
#: Distinct words and distinct pairs that a scan task holds before it sends them off.
WORDS_HELD, PAIRS_HELD = 400_000, 2_000_000
REMEMBERED = 300_000
#: Pair keys hold two word numbers of 32 bits, the start's among them.
MOST_WORDS = (1 << 32) - 1
#: A shard whose pair counts are all smaller keeps them in 32 bits, any other in 64.
NARROW = 1 << 32
#: The end token: no word holds white space.
END = b" end"
_U32 = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def fold(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def training(batch: pa.RecordBatch) -> list[list[bytes]]:
    return [words_lower(t) + [END] for d, t in zip(batch.column("doc_id").to_pylist(), utf8(batch))
            if fold(d) != HELD_OUT]


def hash_words(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64)


def cut(owner: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values."""
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    for start, stop in zip(first, [*first[1:], len(owner)]):
        yield int(owner[start]), slice(int(start), int(stop))


SENT = "shard int, keys binary, counts binary"


def sent(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in parts], pa.int32()), pa.array([pack(p[1]) for p in parts], pa.binary()),
         pa.array([pack_counts(p[2]) for p in parts], pa.binary())], ["shard", "keys", "counts"])


def received(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All of a shard, added up. What a shard holds is bounded by the number of shards."""
    return summed(np.concatenate([unpack(k) for k in group.column("keys").to_pylist()]),
                  np.concatenate([unpack_counts(c) for c in group.column("counts").to_pylist()]))


# --- words -----------------------------------------------------------------------------

@dataclass
class Words:
    """Hashes of all training words in order, shard by shard, with their counts."""

    folder: str
    n: int
    sizes: list[int]  # words per shard

    def __post_init__(self):
        self.starts = np.cumsum([0, *self.sizes])
        self.size = int(self.starts[-1])
        self._open: dict = {}
        self._known: dict[bytes, int] = {}

    def __getstate__(self):
        return {"folder": self.folder, "n": self.n, "sizes": self.sizes}

    def __setstate__(self, state):
        self.__init__(**state)

    def column(self, name: str, shard: int, dtype: str) -> np.ndarray:
        if (name, shard) not in self._open:
            self._open[name, shard] = mapped(f"{self.folder}/{name}-{shard:06d}", dtype)
        return self._open[name, shard]

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of sorted hashes; ``size`` + 1 for unknown ones (``size`` is the start)."""
        out = np.full(len(hashes), self.size + 1, np.int64)
        for shard, at in cut_by_shard(hashes, self.n):
            if self.sizes[shard]:
                have = self.column("keys", shard, "<u8")
                place = np.minimum(np.searchsorted(have, hashes[at]), len(have) - 1)
                found = have[place] == hashes[at]
                out[at][found] = place[found] + self.starts[shard]
        return out

    def numbers(self, lists: list[list[bytes]]) -> list[np.ndarray]:
        """The number of every word; those met last are remembered."""
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*lists).difference(known.keys()))
        if new:
            hashes = hash_words(new)
            order = np.argsort(hashes)
            ranks = np.empty(len(new), np.int64)
            ranks[order] = self.rank(hashes[order])
            known.update(zip(new, ranks.tolist()))
        return [np.fromiter(map(known.__getitem__, w), np.int64, len(w)) for w in lists]

    def values(self, name: str, numbers: np.ndarray, dtype: str) -> np.ndarray:
        """A column at sorted numbers; 0 for the start and unknown words."""
        out = np.zeros(len(numbers), dtype)
        shard = np.searchsorted(self.starts, numbers, "right") - 1
        for s, at in cut(np.minimum(shard, self.n)):
            if s < self.n:
                out[at] = self.column(name, s, dtype)[numbers[at] - self.starts[s]]
        return out


def count_words(rows: DataFrame) -> tuple[Words, int]:
    """The words of the training texts, and the number of tokens."""
    spark = rows.sparkSession
    n, folder = common.shards(spark, 1), common.new_folder(spark, "lm-words")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            hashes = hash_words(counts)
            keys, total = summed(hashes, np.fromiter(counts.values(), np.uint64, len(counts)))
            return sent([(s, keys[at], total[at]) for s, at in cut_by_shard(keys, n)])

        counts: Counter = Counter()
        for batch in pieces(batches):
            for words in training(batch):
                counts.update(words)
            if len(counts) > WORDS_HELD:
                yield flush()
                counts.clear()
        if counts:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "shard"):
            shard = group.column("shard")[0].as_py()
            keys, counts = received(group)
            write_shard(folder, shard, keys=keys, count=counts.astype("<u8"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([len(keys)], pa.int64()),
                 pa.array([int(counts.sum())], pa.int64())], ["shard", "words", "tokens"])

    built = by_key(rows.mapInArrow(send, SENT), n, "shard").mapInArrow(
        merge, "shard int, words bigint, tokens bigint").collect()  # a row per shard
    sizes = [0] * n
    for row in built:
        sizes[row.shard] = row.words
    return Words(folder, n, sizes), sum(r.tokens for r in built)


# --- pairs -----------------------------------------------------------------------------

@dataclass
class Pairs:
    """Pair keys in order in each shard, with counts."""

    folder: str
    n: int
    words: int
    tokens: int
    present: frozenset = frozenset()

    def __post_init__(self):
        self._open: dict = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_open"}

    def __setstate__(self, state):
        self.__dict__.update(state, _open={})

    def shard(self, first: np.ndarray, second: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Shards are ranges of the first word's number. A first word with more than a shard's
        share of the tokens has its seconds dealt over that many shards."""
        width = (count.astype(np.int64) * self.n) // max(1, self.tokens) + 1
        base = first.astype(np.int64) * self.n // (self.words + 1)
        return (base + second.astype(np.int64) * width // (self.words + 1)) % self.n

    def find(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Counts of keys, sorted by shard and key."""
        out = np.zeros(len(keys), np.int64)
        for s, at in cut(shard):
            if s in self.present:
                if s not in self._open:
                    have, raw = (mapped(f"{self.folder}/{c}-{s:06d}", d) for c, d in (("keys", "<u8"), ("count", "u1")))
                    self._open[s] = have, raw.view("<u4" if len(raw) == 4 * len(have) else "<u8")
                have, counts = self._open[s]
                place = np.minimum(np.searchsorted(have, keys[at]), len(have) - 1)
                found = have[place] == keys[at]
                out[at][found] = counts[place[found]]
        return out


def bigrams(words: Words, lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(first, second) numbers of every token of the texts; the start precedes each text."""
    numbers = words.numbers(lists)
    second = np.concatenate([*numbers, np.empty(0, np.int64)])
    first = np.empty_like(second)
    first[1:] = second[:-1]
    starts = np.cumsum([0, *map(len, lists)])[:-1]
    first[starts[starts < len(first)]] = words.size
    return first, second


def count_of(words: Words, tokens_as_start: int, numbers: np.ndarray, name="count") -> np.ndarray:
    """Counts at any numbers; the start has as many as there are texts."""
    distinct, back = np.unique(numbers, return_inverse=True)
    got = words.values(name, distinct, "<u8").astype(np.int64)
    got[distinct == words.size] = tokens_as_start
    return got[back]


STATS = "place int, kind array<int>, keys array<binary>, counts array<binary>"


def count_pairs(rows: DataFrame, words: Words, tokens: int, docs: int) -> tuple[Pairs, DataFrame]:
    """The pairs, and per word range what pairs say about words (to be added up)."""
    spark = rows.sparkSession
    n, folder, narrow = common.shards(spark, 1), common.new_folder(spark, "lm-pairs"), NARROW
    if words.size >= MOST_WORDS:
        raise OverflowError(f"{words.size} different words do not fit the pair keys")
    pairs = Pairs(folder, n, words.size, tokens)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            first = (keys >> _U32).astype(np.int64)
            shard = pairs.shard(first, keys & _LOW, count_of(words, docs, first))
            order = np.argsort(shard, kind="stable")
            keys, counts, shard = keys[order], counts[order], shard[order]
            return sent([(s, keys[at], counts[at]) for s, at in cut(shard)])

        held, size = [], 0
        for batch in pieces(batches):
            lists = training(batch)
            if lists:
                first, second = bigrams(words, lists)
                held.append((first.astype(np.uint64) << _U32) | second.astype(np.uint64))
                size += len(held[-1])
            if size > PAIRS_HELD:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "shard"):
            shard = group.column("shard")[0].as_py()
            keys, counts = received(group)
            write_shard(folder, shard, keys=keys,
                        count=counts.astype("<u4" if counts.max(initial=0) < narrow else "<u8"))
            out = [(-1, shard, np.arange(1, 5, dtype=np.uint64),
                    np.array([(counts == k).sum() for k in range(1, 5)], np.uint64))]
            sides = [(0, np.unique(keys & _LOW, return_counts=True))]
            first = keys >> _U32
            for kind, some in ((1, counts == 1), (2, counts == 2), (3, counts > 2)):
                sides.append((kind, np.unique(first[some], return_counts=True)))
            for kind, (numbers, total) in sides:
                place = np.searchsorted(words.starts, numbers.astype(np.int64), "right") - 1
                out += [(kind, s, numbers[at], total[at]) for s, at in cut(place)]
            by_place: dict[int, list] = {}
            for kind, place, numbers, total in out:  # one row per word range, or one for the shard
                by_place.setdefault(-1 - place if kind < 0 else place, []).append(
                    (kind, pack(numbers), pack_counts(total)))
            columns = [[[o[i] for o in own] for own in by_place.values()] for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(by_place, pa.int32()), pa.array(columns[0], pa.list_(pa.int32())),
                 pa.array(columns[1], pa.list_(pa.binary())),
                 pa.array(columns[2], pa.list_(pa.binary()))], ["place", "kind", "keys", "counts"])

    built = by_key(rows.mapInArrow(send, SENT), n, "shard").mapInArrow(merge, STATS)
    return pairs, built


# --- model -----------------------------------------------------------------------------

def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    if min(n[:3]) > 0 and len(n) > 3 and n[3] > 0:
        y = n[0] / (n[0] + 2 * n[1])
        found = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
        if all(0 < d <= i + 1 for i, d in enumerate(found)):
            return [0.0, *found]
    return [0.0, 0.5, 1.0, 1.5]


@dataclass
class Model:
    words: Words
    pairs: Pairs
    tokens: int
    docs: int
    pair_discounts: list
    word_discounts: list
    kinds: int  # distinct pairs
    word_kinds: list  # words that are second in one, two, three or more kinds of pairs
    start_after: tuple = (0.0, 0.0, 0.0)  # words after the start, by count of the pair

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1.0) / (self.tokens + self.words.size + 1.0))

    def lower(self, second: np.ndarray) -> np.ndarray:
        """Probability by the number of different words that precede one."""
        uniform = 1.0 / (self.words.size + 1)
        if not self.kinds:
            return np.full(len(second), uniform)
        before = self.words.values("before", second, "<u8").astype(np.int64)
        d = np.array(self.word_discounts)[np.minimum(before, 3)]
        kept = sum(x * y for x, y in zip(self.word_discounts[1:], self.word_kinds)) / self.kinds
        return (before - d) / self.kinds + kept * uniform

    def probabilities(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Of each token after the one before it."""
        w, back_w = np.unique(second, return_inverse=True)
        u, back_u = np.unique(first, return_inverse=True)
        lower = self.lower(w)[back_w]
        total = self.words.values("count", u, "<u8").astype(np.int64)
        total[u == self.words.size] = self.docs
        d = self.pair_discounts
        after = [self.words.values(f"after{k}", u, "<u8").astype(np.float64) for k in (1, 2, 3)]
        for k in (1, 2, 3):
            after[k - 1][u == self.words.size] = self.start_after[k - 1]
        gamma = np.where(total > 0, sum(d[k] * after[k - 1] for k in (1, 2, 3)) / np.maximum(total, 1), 1.0)
        keys = (first.astype(np.uint64) << _U32) | second.astype(np.uint64)
        distinct, index, back = np.unique(keys, return_index=True, return_inverse=True)
        shard = self.pairs.shard(first[index], second[index], total[back_u[index]])
        order = np.argsort(shard, kind="stable")
        count = np.zeros(len(distinct), np.int64)
        count[order] = self.pairs.find(distinct[order], shard[order])
        count = count[back]
        seen = (count - np.array(d)[np.minimum(count, 3)]) / np.maximum(total[back_u], 1)
        return seen + gamma[back_u] * lower


def train(docs: DataFrame) -> Model:
    """Count the training texts of ``docs``; what comes to the driver is a few numbers per shard."""
    rows = texts(docs)
    words, tokens = count_words(rows)
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    n_docs = rows.filter(F.pmod(number, F.lit(FOLDS)) != HELD_OUT).count()
    pairs, stats = count_pairs(rows, words, tokens, n_docs)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "place"):
            place = group.column("place")[0].as_py()
            entries: dict[int, list] = {}
            for kinds, keys, counts in zip(*(group.column(c).to_pylist() for c in ("kind", "keys", "counts"))):
                for kind, k, c in zip(kinds, keys, counts):
                    entries.setdefault(kind, []).append((unpack(k), unpack_counts(c)))
            if place < 0:  # counts of counts, and the shard's presence
                yield _report(-1 - place, 0, entries[-1][0][1], True)
                continue
            inside = place < words.n
            base, size = (int(words.starts[place]), words.sizes[place]) if inside else (words.size, 1)
            columns = {}
            for kind, name in ((0, "before"), (1, "after1"), (2, "after2"), (3, "after3")):
                columns[name] = np.zeros(size, np.uint64)
                for numbers, total in entries.get(kind, ()):  # distinct numbers each
                    columns[name][numbers.astype(np.int64) - base] += total
            if not inside:  # the start is no word
                yield _report(place, 1, [0, *(int(columns[f"after{k}"][0]) for k in (1, 2, 3))], False)
                continue
            write_shard(words.folder, place, **{k: v.astype("<u8") for k, v in columns.items()})
            before = columns["before"]
            yield _report(place, 2, [int((before == k).sum()) for k in range(1, 5)]
                          + [int((before > 2).sum()), int(before.sum())], False)

    built = by_key(stats, words.n, "place").mapInArrow(
        add, "place int, kind int, counts array<bigint>, pairs boolean").collect()  # a row per shard
    _zeros(words, {r.place for r in built if r.kind == 2})
    pairs.present = frozenset(r.place for r in built if r.pairs)
    total = lambda kind, n: [sum(r.counts[i] for r in built if r.kind == kind) for i in range(n)]
    of_pairs, of_words = total(0, 4), total(2, 6)
    model = Model(words, pairs, tokens, n_docs, discounts(of_pairs), discounts(of_words[:4]),
                  of_words[5], [of_words[0], of_words[1], of_words[4]])
    starts = [r.counts for r in built if r.kind == 1]
    if starts:
        model.start_after = tuple(map(float, starts[0][1:]))
    return model


def _zeros(words: Words, have: set[int]) -> None:
    """Word ranges that no pair touches still need their (zero) columns."""
    for shard, size in enumerate(words.sizes):
        if size and shard not in have:
            write_shard(words.folder, shard, **{k: np.zeros(size, "<u8") for k in
                                                ("before", "after1", "after2", "after3")})


def _report(place: int, kind: int, counts, pairs: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([place], pa.int32()), pa.array([kind], pa.int32()),
         pa.array([[int(c) for c in counts]], pa.list_(pa.int64())), pa.array([pairs])],
        ["place", "kind", "counts", "pairs"])


SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Log10 probability of every whole text, next to that of smoothed word counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids = batch.column("doc_id")
            lists = [words_lower(t) + [END] for t in utf8(batch)]
            first, second = bigrams(model.words, lists)
            distinct, back = np.unique(second, return_inverse=True)
            count = model.words.values("count", distinct, "<u8").astype(np.float64)[back]
            starts = np.cumsum([0, *map(len, lists)])[:-1]
            logs = np.log10(model.probabilities(first, second))
            n = len(lists)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([fold(d) == HELD_OUT for d in ids.to_pylist()], pa.bool_()),
                 pa.array(list(map(len, lists)), pa.int64()),
                 pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                 pa.array([model.tokens] * n, pa.int64()),
                 pa.array(np.add.reduceat(model.base(count), starts)),
                 pa.array(np.add.reduceat(logs, starts))],
                [c.split()[0] for c in SCORES.split(", ")])

    return texts(docs).mapInArrow(run, SCORES)


def perplexity(scores: DataFrame) -> DataFrame:
    """Per fold: perplexity of the model and of the smoothed counts."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(per("score").alias("model"), per("base_score").alias("base"))
