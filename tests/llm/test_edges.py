"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import cases
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from herald.llm import bpe, fingerprints, jaccard, line_dedup, mixing, ngram_lm, pii, quality, token_store


def store(df):
    from herald.llm.common import new_folder

    folder = new_folder(df.sparkSession, "test-store")
    token_store.write_tokens(df, public_tokenizers.path("word_bpe_49k.json"), folder)
    return token_store.read_documents(df.sparkSession, folder)


OPERATORS = {
    "bpe": lambda d: bpe.round_trip(d, public_tokenizers.path("byte_bpe_50k.json")),
    "lm": lambda d: ngram_lm.score(d, ngram_lm.train(d)),
    "store": store,
    "lines": lambda d: line_dedup.dedup_lines(d).select("row.doc_id", "n_lines", "n_dropped", "kept"),
    "pii": pii.report,
    "mixing": mixing.taken,
    "quality": quality.ledger,
    "jaccard": jaccard.near_duplicates,
    "fingerprints": fingerprints.fingerprints,
}


def ordered(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(columns).collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(spark, name):
    df = cases.docs(spark)
    got = OPERATORS[name](df)
    assert got.count() == len(cases.DOCS)
    assert ordered(OPERATORS[name](cases.clashing(df))) == ordered(got)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](cases.docs(spark, [])).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_only_nulls(spark, name):
    rows = [(None, None, None, None, None)] * 3
    assert OPERATORS[name](cases.docs(spark, rows)).count() == 3


def test_lines_by_hand(spark):
    got = {(r.doc_id, r.kept) for r in OPERATORS["lines"](cases.docs(spark)).collect()}
    assert (9, "A LINE OF SOME LENGTH\n a line of some length \nshort\nshort") in got
    assert (10, "other <|endoftext|> things's") in got
    assert (None, "no id") in got  # no id: after all others
    assert (3, "") in got and (6, "one") in got


def test_lines_of_rows_without_id(spark):
    """Hot rows without an id, and the largest id there is."""
    last = (1 << 63) - 1
    rows = [(None, "a line of some length\nown line of the others", "en", "a", 1)] * 300 + [
        (last, "a line of some length\nlast id's own line", "en", "a", 1), (5, "A line of some length ", "en", "a", 1),
        (None, "last id's own line", "en", "a", 1)]
    got = {(r.doc_id, r.n_dropped, r.kept) for r in OPERATORS["lines"](cases.docs(spark, rows)).collect()}
    assert got == {(None, 1, "own line of the others"), (None, 1, ""), (last, 1, "last id's own line"),
                   (5, 0, "A line of some length ")}


def test_store_by_hand(spark):
    got = store(cases.docs(spark)).orderBy("start").collect()
    assert got[0].doc_id is None and [r.doc_id for r in got[1:]] == sorted(d[0] for d in cases.DOCS if d[0])
    empty = next(r for r in got if r.doc_id == 3)
    assert bytes(empty.ids) == (2).to_bytes(4, "little")


def test_mixing_by_hand(spark):
    df = cases.docs(spark)
    got = mixing.taken(df).collect()
    by_source = {}
    for r in got:
        assert r.taken <= 3 * r.size
        by_source.setdefault((r.target, r.source_size), []).append(r.taken)
    assert sum(t for t, _ in by_source) == pytest.approx(sum(r.size for r in got))
    assert all(t <= 3 * s + 1e-9 for t, s in by_source)
    assert ordered(mixing.taken(df.repartition(5))) == ordered(mixing.taken(df))


def test_mixing_reaches_targets(spark):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 37 as int))").alias("text"),
        F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    rows = mixing.taken(df).groupBy("target", "source_size").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r.t - r.target) <= 3 * 37 for r in rows)
    mix = mixing.mix(cases.clashing(df))
    assert mix.columns == cases.clashing(df).columns
    assert mix.agg(F.sum(F.size(F.split("text", " ")) - 1)).first()[0] == sum(r.t for r in rows)


def test_mixing_prefers_by_odds(spark):
    """Among documents of one source the larger inclusion odds are drawn more often."""
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"),
                                   F.expr("repeat('w ', if(id % 2 = 0, 2, 200))").alias("text"))
    df = df.union(spark.range(20000, 20100).selectExpr("id", "'b'", "repeat('w ', 50)"))
    got = {r["size"]: r.share for r in mixing.copies(df).filter(F.col("size") != 50).groupBy("size").agg(
        F.avg("copies").alias("share")).collect()}
    assert got[200] > got[2]


_SAME, _OTHER = "repeat('w ', 20)", "concat('t', id % 50, repeat(' w', 1 + cast(id % 23 as int)))"


@pytest.mark.parametrize("ids,text", [("NULL", _SAME), ("NULL", _OTHER), ("id % 3", _OTHER)])
def test_mixing_of_tied_rows(spark, ids, text):
    """Repeated ids, no ids, equal texts: the words taken are within a document of the target."""
    df = spark.range(6000).selectExpr(f"cast({ids} as bigint) doc_id", f"{text} text", "if(id % 5 < 4, 'big', 'small') source")
    rows = mixing.taken(df.repartition(7)).groupBy("target", "source_size").agg(F.sum("taken").alias("t")).collect()
    assert len(rows) == 2 and all(abs(r.t - r.target) <= 3 * 24 for r in rows)
    got = mixing.mix(df).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("t")).collect()
    targets = sorted(r.target for r in rows)
    assert all(abs(t - r) <= 3 * 24 for t, r in zip(targets, sorted(r.t for r in got)))
