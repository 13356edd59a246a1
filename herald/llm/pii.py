"""Personal data by fixed patterns, and by contexts learned from what those find.

Four kinds have base patterns, whose matches are seeds. A lexical pattern is the two words in
front of a match. Patterns and the identifiers they introduce are the two sides of a graph:
a pattern scores the share of its occurrences in the whole corpus that introduce known identifiers.
One with ``CONFIDENT`` behind which ``SUPPORT`` different known identifiers stand is trusted, and
what stands behind it is as good as a seed in the next round, so patterns grow from identifiers and
identifiers from patterns until no pattern is trusted that was not before, or for ``ROUNDS`` rounds.
Trusted patterns mark the identifier-like strings behind them, which no base pattern matches, as found:
numbers of 6 to 19 digits, spelled-out addresses, and IP addresses with bracketed or spelled dots.

Base spans are never dropped and found ones never overlap them. NULL and empty texts have no
spans. Every row is judged on its own, also where ids repeat or are NULL; repeated rows are counted
as often as they occur. Very long texts, words and runs of digits are read in one pass each. A candidate that could
be of several kinds is of the surest, a tie going to the later name. An empty table gives no rows. Other
columns than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.common import SPACES, mapped, new_folder, pieces, put, texts, utf8
from herald.scale import keyed_join, settle

KINDS = ("email", "ip", "card", "phone")
SUPPORT, CONFIDENT, ROUNDS = 3, 0.5, 8
#: Characters in front of a match that are read for its two words first.
REACH = 200

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# possessive: a run of digits that fails at its start fails at every later one too
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# like an identifier, but not matched by the base: plain numbers and spelled-out addresses
_NUMBER = re.compile(r"(?<![\w@.+-])\(?[0-9](?:[ ().-]{0,2}[0-9])++(?![\w@])")
_SPELLED = re.compile(r"(?<!\S)[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++"
                      r"(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]++)+")
LEAST_DIGITS, MOST_DIGITS = 6, 19
_DOT = r" ?(?:[\[({] ?(?:\.|dot|DOT) ?[\])}]| (?:dot|DOT) ) ?"
_SPELLED_IP = re.compile(rf"(?<![\w.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?!\w)")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def octet(digits: str) -> bool:
    """Whether the number is at most 255; it may have any length."""
    digits = digits.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their ``@``: the name is the run of its characters before."""
    done, at = 0, text.find("@")
    while at >= 0:
        if at > done:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            domain = _DOMAIN.match(text, at + 1)
            if start < at and domain:
                done = domain.end()
                yield start, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) by start, then kind."""
    found = [(s, "email", e) for s, e in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(map(octet, m.group().split("."))):
            found.append((m.start(), "ip", m.end()))
    for m in _CARD.finditer(text):
        digits = only_digits(m.group()) if m.end() - m.start() >= 14 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), "card", m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(only_digits(m.group())) <= 15:
                found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[1])))


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Identifier-like strings that overlap no base span, under every kind they could be."""
    found = [(m.start(), m.end(), ("card", "phone")) for m in _NUMBER.finditer(text)
             if LEAST_DIGITS <= len(only_digits(m.group())) <= MOST_DIGITS]
    if "at]" in text or "at)" in text or "AT]" in text or "AT)" in text:
        found += [(m.start(), m.end(), ("email",)) for m in _SPELLED.finditer(text)]
    if "[" in text or "(" in text or "{" in text or " dot " in text or " DOT " in text:
        found += [(m.start(), m.end(), ("ip",)) for m in _SPELLED_IP.finditer(text)
                  if all(map(octet, re.findall("[0-9]+", m.group())))]
    if not found:
        return []
    starts = [b for b, _, _ in base]  # in order
    reach = list(accumulate((e for _, _, e in base), max, initial=0))  # the furthest end of those before
    return [(s, kind, e) for s, e, kinds in found
            if reach[bisect_left(starts, e)] <= s for kind in kinds]


def left_words(text: str, start: int) -> str | None:
    """The two words in front, lower-cased; None where the match does not follow white space."""
    if not start or text[start - 1] not in SPACES:
        return None
    reach = REACH
    words = text[max(0, start - reach):start].lower().encode().split()[-3:]
    while len(words) < 3 and reach < start:  # the first one may be cut
        reach *= 2
        words = text[max(0, start - reach):start].lower().encode().split()[-3:]
    return b" ".join(words[-2:]).decode() if len(words) > 1 else None


def value(kind: str, text: str) -> str:
    """What makes two spans the same identifier, however they are written."""
    if kind == "ip":
        return ".".join(d.lstrip("0") or "0" for d in re.findall("[0-9]+", text))
    return text.lower() if kind == "email" else only_digits(text)


SPAN = "struct<kind:string,start:int,end:int,value:string,left:string,seed:boolean>"


def spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, spans): base and candidate spans of every document, with their contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("value", pa.string()), ("left", pa.string()), ("seed", pa.bool_())]))
        for batch in pieces(batches):
            out = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                both = [(*b, True) for b in base] + [(*c, False) for c in candidates(text, base)]
                out.append([{"kind": k, "start": s, "end": e, "value": value(k, text[s:e]),
                             "left": left_words(text, s), "seed": seed} for s, k, e, seed in both])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)],
                                             ["doc_id", "spans"])

    rows = texts(docs).mapInArrow(run, f"doc_id bigint, spans array<{SPAN}>")
    return settle(rows.withColumn("row", F.monotonically_increasing_id()), "pii-spans")


def occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(left, total): how often each pattern's words occur in the corpus. The patterns' hashes
    are one sorted array in the shared folder, mapped by the scan; counts are added up per task."""
    spark = docs.sparkSession
    folder = new_folder(spark, "pii-patterns")
    hashed = settle(patterns.select("left").distinct().withColumn("hash", F.xxhash64("left")), "pii-left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = [b.column("hash").to_numpy() for b in batches]
        keys = np.unique(np.concatenate([*own, np.empty(0, np.int64)]))
        part = TaskContext.get().partitionId()
        if len(keys):
            put(f"{folder}/keys-{part:06d}", keys.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32())], ["part"])

    parts = [r.part for r in hashed.select("hash").mapInArrow(write, "part int").collect()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [mapped(f"{folder}/keys-{p:06d}", "<i8") for p in parts]
        seen: Counter = Counter()
        for batch in pieces(batches):
            for text in utf8(batch):
                words = text.decode().lower().encode().split()
                for pair, times in Counter(zip(words, words[1:])).items():
                    seen[pair] += times
            if len(seen) > 300_000:
                yield from _matching(seen, wanted)
                seen.clear()
        yield from _matching(seen, wanted)

    totals = (texts(docs).select("text").mapInArrow(count, "hash bigint, times bigint")
              .groupBy("hash").agg(F.sum("times").alias("total")))
    return settle(keyed_join(hashed, settle(totals, "pii-totals"), ["hash"], "inner")
                  .select("left", "total"), "pii-occurrences")


def _matching(seen: Counter, wanted: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Counts of the pairs that are patterns. ``wanted``: sorted hashes, a part each."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(p), 42) for p in seen), np.uint64,
                         len(seen)).view(np.int64)  # as Spark's xxhash64 of the same text
    times = np.fromiter(seen.values(), np.int64, len(seen))
    hit = np.zeros(len(hashes), bool)
    for part in wanted:
        hit |= part[np.minimum(np.searchsorted(part, hashes), len(part) - 1)] == hashes
    yield pa.RecordBatch.from_arrays([pa.array(hashes[hit]), pa.array(times[hit])], ["hash", "times"])


def learn(docs: DataFrame, found: DataFrame, support: int = SUPPORT, confident: float = CONFIDENT,
          rounds: int = ROUNDS) -> DataFrame:
    """(left, kind, confidence) of the trusted patterns.

    Only words in front of ``support`` different identifiers, known or not, can ever be trusted; the corpus is
    counted once, for these. A round is a pass over the graph that is left.
    """
    edges = found.select(F.explode("spans").alias("s")).select("s.*").filter(F.col("left").isNotNull())
    edges = edges.groupBy("left", "kind", "value").agg(F.count(F.lit(1)).alias("times"),
                                                       F.max("seed").alias("seed"))
    edges = settle(edges, "pii-edges")
    possible = (edges.groupBy("left", "kind").agg(F.count(F.lit(1)).alias("values"))
                .filter(F.col("values") >= support).select("left", "kind"))
    possible = settle(possible, "pii-possible")
    if possible.isEmpty():
        return possible.withColumn("confidence", F.lit(1.0))
    # a value that the base finds anywhere is a seed everywhere
    known = settle(edges.filter("seed").select("kind", "value").distinct(), "pii-known")
    graph = settle(keyed_join(edges.drop("seed"), possible, ["left", "kind"], "inner"), "pii-graph")
    totals = occurrences(docs, possible)
    trusted = None
    for _ in range(rounds):
        hits = keyed_join(graph, known, ["kind", "value"], "left_semi").groupBy("left", "kind").agg(
            F.sum("times").alias("hits"), F.count(F.lit(1)).alias("support")).filter(F.col("support") >= support)
        patterns = keyed_join(hits, totals, ["left"], "inner").select(
            "left", "kind", (F.col("hits") / (F.col("total") + 1)).alias("confidence"))
        patterns = settle(patterns.filter(F.col("confidence") >= confident), "pii-trusted")
        before, trusted = trusted, patterns
        # what is trusted stays so, and as many are the same ones
        if patterns.isEmpty() or before is not None and patterns.count() == before.count():
            break
        behind = keyed_join(graph, patterns.select("left", "kind"), ["left", "kind"], "left_semi")
        known = settle(known.union(behind.select("kind", "value")).distinct(), "pii-known")
    return trusted


def find(docs: DataFrame, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """(row, doc_id, base, found): per row of ``docs`` its base spans and those that learned
    patterns add, as arrays of (kind, start, end)."""
    rows = spans(docs)
    trusted = settle(learn(docs, rows, support, confident), "pii-patterns")
    new = rows.select("row", F.explode("spans").alias("s")).filter(~F.col("s.seed")).select("row", "s.*")
    new = keyed_join(new, trusted, ["left", "kind"], "inner")
    # under its surest kind, if it could be several
    new = new.groupBy("row", "start", "end").agg(F.max(F.struct("confidence", "kind")).alias("best"))
    new = new.groupBy("row").agg(F.collect_list(F.struct(
        F.col("best.kind").alias("kind"), "start", "end")).alias("found"))
    base = F.transform(F.filter("spans", lambda s: s["seed"]),
                       lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return (rows.select("row", "doc_id", base.alias("base")).join(new, "row", "left")
            .withColumn("found", F.coalesce("found", none)))


def as_text(found):
    """Spans as kind:start:end, by start, then kind."""
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(found, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("at"),
                                                  s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.sort_array(keyed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, SHA-256 of the base spans, all spans, and how many were found."""
    rows = find(docs)

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return rows.select("doc_id", *map(number, KINDS), F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
                       as_text(F.concat("base", "found")).alias("spans"),
                       F.size("found").cast("bigint").alias("n_found"))


def masked(text: str, found: list) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    out, done = [], 0
    for span in sorted(found, key=lambda s: (s["start"], -s["end"])):
        if span["start"] >= done:
            out += [text[done:span["start"]], f"<{span['kind']}>"]
            done = span["end"]
    return "".join([*out, text[done:]])
