"""Byte-level BPE over a corpus by forced boundaries.

A pair of bytes that occurs inside no token of the vocabulary can never be joined by a merge,
so a text may be cut between them and the parts encoded on their own. The pair table is read
off the vocabulary. Of those cuts only the ones are used that the pre-tokenizer cannot notice:
in front of white space, or after an ASCII letter or digit. Words then repeat as fragments,
and each distinct fragment met in a batch is encoded once.

NULL and empty texts have no ids and decode to the empty text.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.common import pieces, texts, utf8

#: Fragments that a worker remembers, and the longest of them in bytes.
REMEMBERED, LONGEST = 250_000, 64
#: How byte-level BPE splits a text into pre-tokens (a fixed value).
PRE_TOKENS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
              r"|\s+(?!\S)|\s+")


def byte_letters() -> dict[str, int]:
    """The public byte alphabet: printable Latin-1 bytes stand for themselves, the others for
    the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Bytes of every token, and the byte pairs that mark certain cuts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.spec = spec
        letter = byte_letters()
        self.special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        by_id = {i: bytes(map(letter.__getitem__, t)) for t, i in spec["model"]["vocab"].items()
                 if i not in self.special} | self.special
        self.tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.never = np.ones((256, 256), bool)
        for token in self.tokens:
            pairs = np.frombuffer(token, np.uint8)
            self.never[pairs[:-1], pairs[1:]] = False

    def cuts(self) -> np.ndarray:
        """The pairs to cut at, as a table indexed by first byte * 256 + second byte.

        Before ASCII white space a cut leaves all pre-token boundaries where they are or adds
        itself, wherever in a run of white space it falls. After an ASCII letter or digit,
        before a printable ASCII byte, the scanner is between two pre-tokens or inside a run of
        one class, which both halves continue; contractions are tokens, so they hold no such pair.
        """
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        alnum = np.array([chr(b).isalnum() and b < 128 for b in range(256)])
        printable = np.array([33 <= b < 127 for b in range(256)])
        seen = space[None, :] | (alnum[:, None] & printable[None, :])
        return (self.never & seen).reshape(-1)


def fragments(text: bytes, table: np.ndarray) -> list[bytes]:
    """The text cut at every certain boundary."""
    raw = np.frombuffer(text, np.uint8)
    if len(raw) < 2:
        return [text] if text else []
    at = np.flatnonzero(table[(raw[:-1].astype(np.uint16) << 8) | raw[1:]]) + 1
    ends = [*at.tolist(), len(text)]
    return [text[i:j] for i, j in zip([0, *ends], ends)]


def ranked(vocabulary: Vocabulary):
    """The same vocabulary for the tiktoken library, which merges short fragments several times
    faster; None if the file asks for more than plain byte-level BPE whose merges are in the
    order of their ids."""
    spec, model = vocabulary.spec, vocabulary.spec["model"]
    split = spec["pre_tokenizer"] or {}
    merges = [m if isinstance(m, str) else "".join(m) for m in model["merges"]]
    ids = [model["vocab"][m.replace(" ", "")] for m in merges]
    plain = (spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex")
             and not split.get("add_prefix_space") and not model.get("dropout")
             and not model.get("end_of_word_suffix") and not model.get("ignore_merges"))
    if not plain or any(b <= a for a, b in zip(ids, ids[1:])):
        return None
    import tiktoken

    ranks = {t: i for i, t in enumerate(vocabulary.tokens) if t and i not in vocabulary.special}
    return tiktoken.Encoding("fragments", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


class FragmentEncoder:
    """Encodes fragments, each distinct one once per batch. Fragments with a special token, and
    vocabularies that need it, go through the tokenizers library itself."""

    def __init__(self, path: str, vocabulary: Vocabulary):
        self.fast = ranked(vocabulary)
        self.special = list(vocabulary.special.values())
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}

    def encode(self, parts: list[list[bytes]]) -> list[np.ndarray]:
        """The ids of each text, given as its fragments."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list(set().union(*parts).difference(known.keys()))
        rest = new
        if self.fast:
            rest = [f for f in new if any(s in f for s in self.special)]
            fast = self.fast.encode_ordinary
            for fragment in set(new).difference(rest) if rest else new:
                known[fragment] = pack(fast(fragment.decode()))
        for start in range(0, len(rest), 4096):
            some = rest[start:start + 4096]
            found = self.tokenizer.encode_batch_fast([b.decode() for b in some],
                                                     add_special_tokens=False)
            for fragment, encoding in zip(some, found):
                known[fragment] = pack(encoding.ids)
        ids = [np.frombuffer(b"".join(map(known.__getitem__, p)), "<i4") for p in parts]
        for fragment in new:
            if len(fragment) > LONGEST:
                del known[fragment]
        return ids


def pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


_encoders: dict[str, tuple] = {}


def _tools(path: str) -> tuple[Vocabulary, np.ndarray, FragmentEncoder]:
    if path not in _encoders:
        vocabulary = Vocabulary(path)
        _encoders[path] = (vocabulary, vocabulary.cuts(), FragmentEncoder(path, vocabulary))
    return _encoders[path]


def list_array(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
    flat = np.concatenate([*ids, np.empty(0, "<i4")]).astype(np.int32, copy=False)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) per document, as the library's encode without special tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table, encoder = _tools(path)
        for batch in pieces(batches):
            ids = encoder.encode([fragments(t, table) for t in utf8(batch)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), list_array(ids)],
                                             ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): ids back to text, special tokens included, as the library's decode.
    Ids outside the vocabulary and NULL ids give nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tools(path)[0].tokens
        nothing = [b""]

        def one(ids) -> str:
            try:
                raw = b"".join(map(tokens.__getitem__, ids))
            except (IndexError, TypeError):
                raw = b"".join((tokens[i:i + 1] or nothing)[0] for i in ids
                               if i is not None and i >= 0)
            return raw.decode("utf-8", "replace")

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                column = part.column("ids")
                flat, ends = column.flatten().to_pylist(), np.cumsum(
                    [0, *(len(x) if x.is_valid else 0 for x in column)]).tolist()
                out = [one(flat[i:j]) for i, j in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), column, pa.array(out, pa.string())],
                    ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, ids array<int>, text string")


def ids_digest(ids):
    """Lowercase hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode(encode(docs, path), path)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       ids_digest(F.col("ids")).alias("ids_sha256"),
                       F.sha2(F.col("text"), 256).alias("decoded_sha256"))


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every row: its ids, and whether decoding them gives
    the text again. Encoded and decoded in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, table, encoder = _tools(path)
        for batch in pieces(batches):
            raw = utf8(batch)
            ids = encoder.encode([fragments(t, table) for t in raw])
            same = [b"".join(map(vocabulary.tokens.__getitem__, i.tolist())) == t
                    for i, t in zip(ids, raw)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(map(len, ids)), pa.int64()), list_array(ids),
                 pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])

    return texts(docs).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids array<int>, round_trip boolean")
