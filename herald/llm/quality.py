"""Quality rules as a ledger: every rule is evaluated once per document and leaves one bit and
its measurements; policies and ablations are then bitwise work on the ledger alone.

A policy is a mask of the rules that reject, so a new version needs no new pass over texts.
NULL and empty texts have no words and fail ``few_words``. Rows are never merged: a repeated
``doc_id`` has a ledger row per row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.common import pieces, texts

#: Rule by bit, lowest first. ``percent`` rules fail above so many hundredths of their base.
RULES = ("few_words", "repeated_words", "symbols", "shouting", "exclamations", "repeated_lines")
FEWEST_WORDS = 50
MOST_REPEATED_WORDS = 50  # percent of words
MOST_SYMBOLS = 10  # percent of words
MOST_CAPITALS = 30  # percent of letters
MOST_EXCLAMATIONS = 10  # percent of words
MOST_REPEATED_LINES = 50  # percent of lines with a word
#: Rules that the base verdict consists of, and versions of the policy: names of rejecting rules.
BASE = ("few_words", "repeated_words")
POLICIES = {"v1": BASE, "v2": RULES}

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letters", "n_capitals", "n_exclamations")
LEDGER = "doc_id bigint, failed bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
_SPACES = b" \t\n\x0b\x0c\r"


def mask(rules: Iterable[str]) -> int:
    return sum(1 << RULES.index(r) for r in rules)


def repeated_words(words: list) -> int:
    """Words inside a 3-word window that is found twice or more; the first time counts too."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered, until = 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered += i + 3 - max(i, until)
            until = i + 3
    return covered


def repeated_lines(lines: list[str]) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    full = [line for line in lines if line.strip(" \t\n\x0b\x0c\r")]
    return len(full), len(full) - len(set(full))


def measure(text: str) -> tuple[int, ...]:
    """The measurements in the order of ``MEASURES``."""
    raw = text.encode()
    words = raw.split()
    chars = len(text) - sum(raw.count(c) for c in _SPACES)
    lines, again = repeated_lines(text.split("\n"))
    capitals = sum(map(str.isupper, text)) if text != text.lower() else 0
    return (len(words), chars, sum(map(text.count, SYMBOLS)), lines, again,
            repeated_words(words), sum(map(str.isalpha, text)), capitals, text.count("!"))


def failures(m: tuple[int, ...]) -> int:
    n_words, _, symbols, lines, again, repeats, letters, capitals, exclamations = m
    failed = (n_words < FEWEST_WORDS, 100 * repeats > MOST_REPEATED_WORDS * n_words,
              100 * symbols > MOST_SYMBOLS * n_words, 100 * capitals > MOST_CAPITALS * letters,
              100 * exclamations > MOST_EXCLAMATIONS * n_words,
              100 * again > MOST_REPEATED_LINES * lines)
    return sum(1 << i for i, bad in enumerate(failed) if bad)


def _ledger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "failed", *MEASURES]
    for batch in pieces(batches):
        found = [measure(t) for t in batch.column("text").to_pylist()]
        columns = list(zip(*found))
        arrays = [batch.column("doc_id"), pa.array(map(failures, found), pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays + [pa.array(c, pa.int64()) for c in columns], names)


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: the bits of the rules it fails, and every measurement. Narrow:
    texts are read once and not shuffled."""
    return texts(docs).mapInArrow(_ledger, LEDGER)


def passes(failed, policy: str | Iterable[str]):
    """Whether no rule of the policy is among the failed ones."""
    rules = POLICIES[policy] if isinstance(policy, str) else policy
    return failed.bitwiseAND(F.lit(mask(rules)).cast("bigint")) == 0


def kept_documents(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The documents that pass, with all their columns. Each row is judged on its own, in one
    pass, so rows that share an id or lack one keep their own verdict."""
    schema = docs.select(F.struct(*docs.columns).alias("row"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    allowed = mask(POLICIES[policy])

    def judge(batches):
        for batch in pieces(batches):
            good = [not failures(measure(t)) & allowed for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return schema.mapInArrow(judge, schema.schema).select("row.*")


def ablation(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it rejects, which
    are the ones that come back without it. One row per distinct bit pattern is shuffled."""
    allowed = mask(POLICIES[policy])
    patterns = (rows.select(F.col("failed").bitwiseAND(F.lit(allowed).cast("bigint")).alias("failed"))
                .groupBy("failed").agg(F.count(F.lit(1)).alias("docs")))
    bits = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).cast("bigint").alias("bit"))
                     for r in POLICIES[policy]])
    each = patterns.select("failed", "docs", F.explode(bits).alias("b"))
    hit = F.col("failed").bitwiseAND(F.col("b.bit")) != 0
    return each.groupBy(F.col("b.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("failed") == F.col("b.bit"), F.col("docs")).otherwise(0))
        .alias("rejected_alone"))
