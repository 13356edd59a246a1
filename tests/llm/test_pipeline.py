"""Each stage of the pipeline against a brute-force version of it, on its own input."""

import collections

import cases
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from herald.llm import quality
from herald.scale import settle

SMALL = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def runs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(settle(stage(spark, found[-1], SMALL), "test-stage"))
    return found


def test_columns(runs):
    for out in runs[1:-1]:
        assert out.columns == runs[0].columns


def test_quality(runs):
    keep = {r.doc_id for r in runs[0].collect()
            if not quality.failures(quality.measure(r.text or ""))}
    assert sorted(r.doc_id for r in runs[1].collect()) == sorted(keep)
    assert 0 < len(keep) < runs[0].count()


def test_lines(runs):
    rows = sorted((r.doc_id, r.text or "") for r in runs[1].collect())
    seen, want = {}, {}
    for doc, text in rows:
        kept = []
        for line in text.split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r")
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in key)
            if len(key) < 10 or seen.setdefault(key, doc) == doc:
                kept.append(line)
        want[doc] = "\n".join(kept)
    got = {r.doc_id: r for r in runs[2].collect()}
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_near_duplicates(runs):
    found = cases.classes([(r.doc_id, r.text) for r in runs[2].collect()], width=5, percent=80)
    assert sorted(r.doc_id for r in runs[3].collect()) == sorted(i for i, (_, c) in found.items() if i == c)


def test_mix(runs):
    sizes = {r.doc_id: len((r.text or "").encode().split()) for r in runs[3].collect()}
    taken = collections.Counter(r.doc_id for r in runs[4].collect())
    assert set(taken) <= set(sizes) and max(taken.values()) <= 3
    assert sum(n * sizes[d] for d, n in taken.items()) == pytest.approx(sum(sizes.values()), rel=0.25)


def test_tokens(runs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r.doc_id: r.text for r in runs[4].collect()}
    got = runs[5].collect()
    assert len(got) == runs[4].count()
    assert all(r.ids == tool.encode(text[r.doc_id], add_special_tokens=False).ids and r.round_trip for r in got)


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_edges(spark, name):
    df = cases.clashing(cases.docs(spark))
    out = STAGES[name](spark, df, SMALL)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == df.columns
    out.collect()
    assert STAGES[name](spark, df.limit(0), SMALL).count() == 0


def test_repeated_rows_are_one_document(spark):
    df = cases.docs(spark)
    out = STAGES["n-gram Jaccard join"](spark, df, SMALL)
    assert out.filter("doc_id = 6").count() == 1
    assert out.filter("doc_id in (3, 4, 5)").count() == 3
    assert out.filter(F.col("doc_id").isin(1, 2)).count() == 1


def test_near_copies_that_four_words_tell_apart(spark):
    words = [f"w{i}" for i in range(200)]
    copy = list(words)
    for i in (20, 70, 120, 170):
        copy[i] = "other"
    longer = [f"v{i}" for i in range(200)]
    rows = [(1, words), (2, copy), (3, longer), (4, longer + [f"u{i}" for i in range(45)]), (5, longer + words)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    out = STAGES["n-gram Jaccard join"](spark, df, SMALL)
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 5]
