"""Token ids in grammar-compressed shards that can be read back from any position.

Documents are encoded word by word (the vocabulary drops white space, so words are
independent), sorted by ``doc_id`` over range partitions, and stored in blocks of about
``BLOCK_IDS`` ids, whole documents each. A block is compressed by Re-Pair: in each round the
most frequent pairs of neighbouring symbols become nonterminals, until no pair is frequent. A
pair never reaches over a document's end. The block keeps its rules and the expansion length of
every rule, so a span of ids is found by adding lengths and only its own symbols are expanded.

File format: one Parquet row per block, written and committed by Spark, with
``part, block`` (order of blocks), ``n_ids``, ``doc_ids``, ``doc_ids_count`` and
``doc_symbols`` (ids and symbols of each document), ``first_rule`` (symbols from here on are
rules), ``rules`` (pairs of little-endian unsigned 32-bit symbols), ``rounds`` (rules after each
round), ``lengths`` (expansion length of each rule) and ``symbols``.

NULL and empty texts are stored as the end id alone. A NULL ``doc_id`` comes first; rows that
share an id are ordered by the hash of their text and each keep their own entry.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from herald.llm.bpe import byte_letters
from herald.llm.common import pieces, texts
from herald.scale import keyed_join

END_ID = 2
BLOCK_IDS = 2_000_000
#: Pairs replaced per round at most, and how often a pair has to occur.
PAIRS, FREQUENT = 4096, 32
#: Words whose ids are kept from one piece of texts to the next, and what they may take.
REMEMBERED, REMEMBERED_BYTES = 400_000, 64 << 20
#: Texts are encoded in pieces of about so many bytes, each distinct word of one once.
ENCODED_BYTES = 16 << 20

BLOCKS = ("part int, block int, n_ids bigint, doc_ids array<bigint>, doc_ids_count array<int>, "
          "doc_symbols array<int>, first_rule int, rules binary, rounds array<int>, lengths binary, "
          "symbols binary")
_NAMES = [c.split()[0] for c in BLOCKS.split(", ")]


# --- encoding --------------------------------------------------------------------------

#: Words that need no Unicode rules: Latin letters up to U+012F, ASCII digits and signs.
PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+")
ALL_PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\n]*")
#: The parts of a lower-cased plain word (the tokenizer's fixed pattern on those characters).
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u012f]+|[0-9]|[!-/:-@\[-`{-~]+")


class PlainWords:
    """The merges of a vocabulary with word ends, on the tiktoken library: it merges short words
    several times faster. The end of a word is a mark whose bytes are joined to the last byte
    before any other merge, as the vocabulary's own symbols with ``</w>`` start out."""

    def __init__(self, spec: dict):
        import tiktoken

        model = spec["model"]
        letter, vocab = byte_letters(), model["vocab"]
        parts = {}  # bytes and whether a word ends here, in the order of the merges
        for merge in model["merges"]:
            token = "".join(merge if isinstance(merge, list) else merge.split(" "))
            word = token.removesuffix("</w>")
            parts.setdefault((bytes(map(letter.__getitem__, word)), word != token), vocab[token])
        # a private-use character for the end of a word, none of whose beginnings is a token
        self.mark = next(c for c in map(chr, range(0xE000, 0xF8FF))
                         if not any((c.encode()[:n], False) in parts for n in (2, 3)))
        mark = self.mark.encode()
        order = ([(bytes([b]) + mark, vocab[c + "</w>"]) for c, b in letter.items()]
                 + [(mark[:2], -1), (mark, -1)] + [(bytes([b]), vocab[c]) for c, b in letter.items()]
                 + [(raw + mark if end else raw, i) for (raw, end), i in parts.items()])
        self.ids = [i for _, i in order]
        self.tool = tiktoken.Encoding("words", pat_str=f"[^{self.mark}]*{self.mark}", special_tokens={},
                                      mergeable_ranks={raw: i for i, (raw, _) in enumerate(order)})

        self.table = np.array(self.ids, np.int64).astype("<u4")
        self.ends = np.array([raw.endswith(mark) for raw, _ in order])

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and how many each has. Every part gets its mark
        in one substitution over the words in lines; how many marks stand before a line's end tells the
        words apart again."""
        if not words:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        marked = PARTS.sub(rf"\g<0>{self.mark}", "\n".join(words).lower())
        points = np.frombuffer(marked.encode("utf-32-le"), "<u4")
        parts = np.cumsum(points == ord(self.mark))
        parts = np.append(parts[points == ord("\n")], parts[-1])
        ranks = np.array(self.tool.encode_ordinary(marked.replace("\n", "")), np.int64)
        ends = (np.flatnonzero(self.ends[ranks]) + 1)[parts - 1]
        return self.table[ranks], np.diff(ends, prepend=0)


class WordEncoder:
    """Encodes words, each distinct one once per batch: plain ones by their merges, all others,
    and those that could hold a special token, with the tokenizers library itself."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.plain = PlainWords(json.load(f))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        self.forget()

    def forget(self) -> None:
        """A word's code is its place among ``words`` and one: 0 closes a text."""
        self.words = pa.array([], pa.string())
        self.flat, self.ends = np.array([END_ID], "<u4"), np.array([0, 1])

    def learn(self, words: pa.Array) -> None:
        """Append new words and their ids."""
        self.words = pa.concat_arrays([self.words, words])
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py()
        names = text.split("\n")
        if ALL_PLAIN.fullmatch(text) and "<|" not in text:
            ids, counts = self.plain.encode(names)
        else:
            simple = np.array([bool(PLAIN.fullmatch(n)) and "<|" not in n for n in names])
            rest = [names[i] for i in np.flatnonzero(~simple)]
            own: list[list[int]] = []
            for start in range(0, len(rest), 4096):
                encoded = self.tokenizer.encode_batch_fast(rest[start:start + 4096], add_special_tokens=False)
                own += [e.ids for e in encoded]
            ids, plain_counts = self.plain.encode([names[i] for i in np.flatnonzero(simple)])
            ids = np.concatenate([ids, np.fromiter(chain.from_iterable(own), "<u4")])
            both = np.concatenate([plain_counts, np.fromiter(map(len, own), np.int64, len(own))])
            order = np.argsort(np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)]))
            starts = (np.cumsum(both) - both)[order]
            counts = both[order]
            ids = ids[_ranges(starts, counts)]
        self.flat = np.concatenate([self.flat, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])

    def encode(self, texts_: pa.Array | list[bytes]) -> list[np.ndarray]:
        """The ids of each text with the end id: a code per distinct word, then a gather of their ids."""
        if not len(texts_):
            return []
        if len(self.words) > REMEMBERED or self.words.nbytes > REMEMBERED_BYTES:
            self.forget()
        whole = pa.array(texts_, pa.binary()).view(pa.string()) if isinstance(texts_, list) else texts_
        words, counts = _words(whole)
        distinct = words.dictionary_encode()
        names = distinct.dictionary
        place = pc.index_in(names, value_set=self.words)
        if place.null_count:
            new = names.filter(pc.is_null(place))
            known = place.fill_null(-1).to_numpy().astype(np.int64)
            known[known < 0] = len(self.words) + np.arange(len(new))
            self.learn(new)
        else:
            known = place.to_numpy().astype(np.int64)
        until = np.cumsum(counts + 1)
        codes = np.zeros(until[-1], np.int64)
        inside = np.ones(len(codes), bool)
        inside[until - 1] = False
        if len(names):
            codes[inside] = known[distinct.indices.to_numpy()] + 1
        starts = self.ends[codes]
        sizes = self.ends[codes + 1] - starts
        return np.split(self.flat[_ranges(starts, sizes)], np.cumsum(sizes)[until - 1][:-1])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its size says."""
    until = np.cumsum(sizes)
    return np.repeat(starts - (until - sizes), sizes) + np.arange(until[-1] if len(until) else 0)


def _words(whole: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, and how many each text has. The vocabulary is lower case; the strings of special
    tokens are not, so texts that could hold one stay as they are."""
    special = pc.match_substring(whole, "<|")
    lower = pc.ascii_lower(whole)
    if pc.any(special).as_py():
        lower = pc.if_else(special, whole, lower)
    lists = pc.ascii_split_whitespace(lower)
    words = lists.flatten()
    there = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
    before = np.concatenate(([0], np.cumsum(there.to_numpy(zero_copy_only=False))))
    edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return words.filter(there), np.diff(before[edges])


TABLE_BITS = 20
_SPREAD, _TABLE_SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - TABLE_BITS)
_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# --- grammar ---------------------------------------------------------------------------

def compress(ids: np.ndarray, ends: np.ndarray, first_rule: int):
    """(symbols, symbols per document, rules, rules after each round, lengths of the rules).
    ``ends``: position behind each document's last id."""
    seq = ids.astype(np.uint64)
    last = np.zeros(len(seq), bool)
    last[ends - 1] = True
    rules, rounds = np.empty((0, 2), np.uint64), []
    whole, made = True, 0  # whether all pairs are counted, and the first symbol of the last round
    while True:  # each round shortens the block
        pairs = (seq[:-1] << np.uint64(32)) | seq[1:]
        # A pair of older symbols only gets rarer. Unless some that were frequent had to wait, what is
        # frequent now has a symbol of the last round.
        look = ~last[:-1]
        if not whole:
            new = seq >= np.uint64(made)
            look &= new[:-1] | new[1:]
        where = np.flatnonzero(look)
        some = pairs[where]
        ordered = np.sort(some)
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))[:len(ordered)])
        counts = np.diff(first, append=len(ordered))
        often = np.flatnonzero(counts >= FREQUENT)
        if not len(often):
            break
        frequent = len(often)
        often = often[np.argsort(-counts[often], kind="stable")[:PAIRS]]
        chosen = np.sort(ordered[first[often]])
        # a table by hash finds a pair's rule; of two pairs in one place, one waits for a later round
        place = ((chosen * _SPREAD) >> _TABLE_SHIFT).astype(np.int64)
        table = np.zeros(1 << TABLE_BITS, np.int32)
        table[place] = np.arange(len(chosen), dtype=np.int32)
        chosen = chosen[table[place] == np.arange(len(chosen))]
        table[(chosen * _SPREAD) >> _TABLE_SHIFT] = np.arange(len(chosen), dtype=np.int32)
        whole, made = frequent > len(chosen), first_rule + len(rules)
        at = table[(some * _SPREAD) >> _TABLE_SHIFT]
        hit = chosen[at] == some
        hits, at = where[hit], at[hit]
        start = np.concatenate(([True], np.diff(hits) > 1))
        run = np.maximum.accumulate(np.where(start, np.arange(len(hits)), 0))
        every_other = (np.arange(len(hits)) - run) % 2 == 0  # neighbours overlap
        hits, at = hits[every_other], at[every_other]
        seq[hits] = at.astype(np.uint64) + np.uint64(made)
        last[hits] = last[hits + 1]
        keep = np.ones(len(seq), bool)
        keep[hits + 1] = False
        seq, last = seq[keep], last[keep]
        rules = np.concatenate([rules, np.stack([chosen >> np.uint64(32),
                                                 chosen & np.uint64(0xFFFFFFFF)], 1)])
        rounds.append(len(rules))
    return (seq.astype("<u4"), np.diff(np.flatnonzero(last), prepend=-1), rules.astype("<u4"),
            rounds, rule_lengths(rules, rounds, first_rule))


def rule_lengths(rules: np.ndarray, rounds: list[int], first_rule: int) -> np.ndarray:
    out, done = np.empty(len(rules), np.int64), 0
    for upto in rounds:  # a round's rules use symbols of earlier rounds only
        out[done:upto] = lengths_of(rules[done:upto].astype(np.int64), out, first_rule).sum(1)
        done = upto
    return out.astype("<u4")


def lengths_of(symbols: np.ndarray, rule_len: np.ndarray, first_rule: int) -> np.ndarray:
    """Ids that each symbol stands for."""
    out = np.ones(symbols.shape, np.int64)
    nonterminal = symbols >= first_rule
    out[nonterminal] = rule_len[symbols[nonterminal].astype(np.int64) - first_rule]
    return out


def expansions(rules: np.ndarray, rounds: list[int], lengths: np.ndarray, first_rule: int):
    """(ids, where): the expansions of all rules one after the other, behind the ids that stand for
    themselves, and where each symbol's begins. A round's rules use symbols of earlier rounds only."""
    where = np.concatenate([np.arange(first_rule), first_rule + np.cumsum(lengths, dtype=np.int64) - lengths])
    ids = np.empty(first_rule + int(lengths.sum(dtype=np.int64)), "<u4")
    ids[:first_rule] = np.arange(first_rule)
    for start, stop in zip([0, *rounds], rounds):
        parts = rules[start:stop].astype(np.int64).reshape(-1)
        sizes = lengths_of(parts, lengths, first_rule)
        at = int(where[first_rule + start])
        ids[at:at + int(sizes.sum())] = ids[_ranges(where[parts], sizes)]
    return ids, where


def expand(symbols: np.ndarray, rules: np.ndarray, rounds: list[int], first_rule: int) -> np.ndarray:
    """Symbols back to ids."""
    lengths = rule_lengths(rules, rounds, first_rule)
    ids, where = expansions(rules, rounds, lengths, first_rule)
    return ids[_ranges(where[symbols], lengths_of(symbols, lengths, first_rule))]


class Block:
    """One row of the files."""

    def __init__(self, row: dict):
        self.row = row
        self.first_rule, self.rounds = row["first_rule"], row["rounds"]
        self.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
        self.lengths = np.frombuffer(row["lengths"], "<u4")
        self.symbols = np.frombuffer(row["symbols"], "<u4")

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The block's ids from ``start`` to ``stop``: only the symbols there are expanded."""
        sizes = lengths_of(self.symbols, self.lengths, self.first_rule)
        ends = np.cumsum(sizes)
        stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
        if start >= stop:
            return np.empty(0, "<u4")
        i, j = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        before = int(ends[i - 1]) if i else 0
        flat, where = expansions(self.rules, self.rounds, self.lengths, self.first_rule)
        some = flat[_ranges(where[self.symbols[i:j]], sizes[i:j])]
        return some[start - before:stop - before]


# --- files -----------------------------------------------------------------------------

def write_tokens(docs: DataFrame, path: str, folder: str) -> None:
    """Encode every document and write the blocks, in ascending order of ``doc_id``."""
    rows = texts(docs).withColumn("tie", F.xxhash64("text"))
    rows = (rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
            .select("doc_id", "text", F.spark_partition_id().alias("part")))

    def block(part, number, docs_, ids, first_rule):
        sizes = [len(x) for x in ids]
        flat = np.concatenate(ids)
        symbols, per_doc, rules, rounds, lengths = compress(flat, np.cumsum(sizes), first_rule)
        row = dict(part=part, block=number, n_ids=len(flat), doc_ids=docs_, doc_ids_count=sizes,
                   doc_symbols=per_doc.tolist(), first_rule=first_rule, rules=rules.tobytes(),
                   rounds=rounds, lengths=lengths.tobytes(), symbols=symbols.tobytes())
        return pa.RecordBatch.from_pylist([row], pa_schema)

    pa_schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()),
                           ("doc_ids", pa.list_(pa.int64())), ("doc_ids_count", pa.list_(pa.int32())),
                           ("doc_symbols", pa.list_(pa.int32())), ("first_rule", pa.int32()),
                           ("rules", pa.binary()), ("rounds", pa.list_(pa.int32())),
                           ("lengths", pa.binary()), ("symbols", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        docs_, ids, size, number, part = [], [], 0, 0, 0
        for batch in pieces(batches, limit=ENCODED_BYTES):
            part = batch.column("part")[0].as_py()
            for doc, own in zip(batch.column("doc_id").to_pylist(), tool.encode(batch.column("text"))):
                docs_.append(doc)
                ids.append(own)
                size += len(own)
                if size >= BLOCK_IDS:
                    yield block(part, number, docs_, ids, tool.size)
                    docs_, ids, size, number = [], [], 0, number + 1
        if docs_:
            yield block(part, number, docs_, ids, tool.size)

    rows.mapInArrow(run, BLOCKS).write.parquet(folder)


def block_starts(blocks: DataFrame) -> DataFrame:
    """(part, block, start): ids before each block. One narrow row per block of two million
    ids, so one task adds them up."""
    earlier = Window.orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("part", "block", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))
                         .cast("bigint").alias("start"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every stored document; ``ids`` is binary, little-endian
    unsigned 32-bit integers."""
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    rows = keyed_join(blocks, block_starts(blocks), ["part", "block"], "inner").select(*_NAMES, "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = Block(row).ids()
                ends = np.cumsum(row["doc_ids_count"])
                starts = ends - row["doc_ids_count"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"], pa.int64()),
                     pa.array(ends - starts, pa.int64()),
                     pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def read_span(spark: SparkSession, folder: str, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start`` of the whole store; ``count`` bounds what comes to
    the driver. Only the symbols of the span are expanded."""
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    rows = keyed_join(blocks, block_starts(blocks), ["part", "block"], "inner").filter(
        (F.col("start") < start + count) & (F.col("start") + F.col("n_ids") > start)).select(*_NAMES, "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = max(0, start - row["start"])
                ids = Block(row).ids(at, start + count - row["start"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["start"] + at], pa.int64()), pa.array([ids.tobytes()], pa.binary())],
                    ["start", "ids"])

    found = sorted(rows.mapInArrow(run, "start bigint, ids binary").collect(), key=lambda r: r.start)
    return np.frombuffer(b"".join(r.ids for r in found), "<u4")
