"""Small tables with everything that may go wrong, and brute-force versions of the operators."""

import collections
import hashlib
import math
import re
import struct
import zlib

import xxhash

TEXT = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"word{i % 977} Ünïcode{i % 311},\n" for i in range(12_000))
DOCS = [
    (1, TEXT, "en", "a", len(TEXT)),
    (2, TEXT + " tail", "en", "a", 5),
    (3, None, "en", None, None),
    (4, "", None, "b", 0),
    (5, " \t\n\x0b\x0c\r ", "en", "b", 7),
    (6, "one", "en", "b", 3),
    (6, "one", "en", "b", 3),  # a repeated row
    (8, LONG, "en", "a", len(LONG)),
    (9, "A LINE OF SOME LENGTH\n a line of some length \nshort\nshort", "en", "c", 1),
    (10, "a line of some length\nother <|endoftext|> things's", "en", "c", 1),
    (None, "a line of some length\nno id", "en", "c", 1),
    (12, "a@b.co 10.0.0.1 4111 1111 1111 1111 +1 (555) 010-9999 é漢🙂", "en", "c", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df):
    """Extra columns under names that operators use inside or for their results."""
    from pyspark.sql import functions as F

    names = ["size", "row", "key", "tie", "class", "place", "kept", "n_words", "ids", "copies", "u",
             "src", "p", "q", "slice", "print", "id", "none", "words", "copy", "drop", "failed",
             "sketch", "count", "target", "digest", "first", "shard"]
    return df.withColumns({n: F.lit("x") for n in names})


def words(text):
    return (text or "").encode().lower().split()


def shingle_sets(rows, width):
    out = {}
    for i, t in rows:
        w = words(t)
        out[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    return out


def classes(rows, width=4, percent=85):
    """doc_id to (set size, smallest id reachable over links), by all pairs that share a shingle."""
    sets = shingle_sets(rows, width)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        shared = collections.Counter(j for g in s for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    smallest = {}
    for i in sets:
        smallest[find(i)] = min(i, smallest.get(find(i), i))
    return {i: (len(s), smallest[find(i)]) for i, s in sets.items()}


def language_model(rows):
    """doc_id to (base score, score) by the formulas, with dictionaries."""
    tokens = [(i, words(t) + [b" end"]) for i, t in rows]
    train = [w for i, w in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    count = collections.Counter(x for w in train for x in w)
    n, v = sum(count.values()), len(count)
    pair = collections.Counter(p for w in train for p in zip([None, *w], w))

    def discount(counts):
        c = [0, *(sum(x == k for x in counts) for k in (1, 2, 3, 4))]
        y = c[1] / (c[1] + 2 * c[2])
        return [0, *(k - (k + 1) * y * c[k + 1] / c[k] for k in (1, 2, 3))]

    before = collections.Counter(w for _, w in pair)
    d2, d1 = discount(pair.values()), discount(before.values())
    total = collections.Counter()
    kinds = collections.defaultdict(lambda: [0] * 4)
    for (u, _), c in pair.items():
        total[u] += c
        kinds[u][min(c, 3)] += 1
    rest = sum(d1[min(c, 3)] for c in before.values()) / len(pair) / (v + 1)

    def probability(u, w):
        low = (before[w] - d1[min(before[w], 3)]) / len(pair) + rest
        if not total[u]:
            return low
        c = pair[u, w]
        return (c - d2[min(c, 3)] + sum(d2[k] * kinds[u][k] for k in (1, 2, 3)) * low) / total[u]

    return {i: (sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w),
                sum(math.log10(probability(u, x)) for u, x in zip([None, *w], w))) for i, w in tokens}


def sketch(text, width=5, k=128):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", text.lower())]
    found = set()
    for i in range(max(1, len(h) - width + 1) if h else 0):
        seed = 42
        for x in h[i:i + width]:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", x), seed)
        found.add(seed - (1 << 64) if seed >> 63 else seed)
    return sorted(found)[:k]


def near(a, b, k=128):
    union = sorted({*a, *b})[:k]
    return len({*a} & {*b} & {*union}) / len(union) if union else 1.0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def personal_data(rows, support=3, confident=0.5, rounds=8):
    """Per row: base spans, and those that learned patterns add, by dictionaries over whole texts."""
    from herald.llm import pii

    spans, edges, seeds = [], collections.Counter(), set()
    pairs = collections.Counter()
    for text in rows:
        text = text or ""
        words_ = words(text)
        pairs.update(zip(words_, words_[1:]))
        base = pii.base_spans(text)
        own = [(s, k, e, True) for s, k, e in base] + [(s, k, e, False) for s, k, e in pii.candidates(text, base)]
        spans.append([])
        for s, k, e, seed in own:
            left = None
            if s and text[s - 1] in " \t\n\x0b\x0c\r":
                two = text[:s].lower().split()[-2:] if text[:s].isascii() else words(text[:s])[-2:]
                left = tuple(w.encode() if isinstance(w, str) else w for w in two)
                left = left if len(left) == 2 else None
            v = (k, pii.value(k, text[s:e]))
            spans[-1].append((s, k, e, seed, left, v))
            if left:
                edges[left, v] += 1
                if seed:
                    seeds.add(v)
    score = collections.defaultdict(float, dict.fromkeys(seeds, 1.0))
    trusted = {}
    for _ in range(rounds):
        hits, known = collections.Counter(), collections.Counter()
        for (left, v), n in edges.items():
            hits[left, v[0]] += n * score[v]
            known[left, v[0]] += score[v] > 0
        new = {p: hits[p] / (pairs[p[0]] + 1) for p in hits if known[p] >= support}
        new = {p: c for p, c in new.items() if c >= confident}
        stop = not new or (trusted and len(new) == len(trusted))
        trusted = new
        if stop:
            break
        for left, v in edges:
            if (left, v[0]) in trusted:
                score[v] = 1.0
    out = []
    for own in spans:
        base = [(s, k, e) for s, k, e, seed, _, _ in own if seed]
        best = {}
        for s, k, e, seed, left, _ in own:
            if not seed and (left, k) in trusted:
                best[s, e] = max(best.get((s, e), (0.0, "")), (trusted[left, k], k))
        out.append((base, [(s, k, e) for (s, e), (_, k) in best.items()]))
    return out


def spans_text(spans):
    from herald.llm import pii

    return ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(spans, key=lambda x: (x[0], pii.KINDS.index(x[1]), x[2])))
