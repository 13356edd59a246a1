"""The registered queries of the corpus operators, and SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald.llm import (bpe, chat, fingerprints, jaccard, line_dedup, mixing, ngram_lm, pii, quality,
                        token_store, vector_queries)
from herald.llm.common import new_folder, ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Query) -> Query:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngram_lm.score(docs, ngram_lm.train(docs))


@query
def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-store")
    token_store.write_tokens(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("word_bpe_49k.json"), folder)
    rows = token_store.read_documents(spark, folder)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.render_maximal(table(spark, sf_dir, "conversations"))
    return rows.select("conv_id", "n_turns", "position", "start", "rendered")


ORACLES["op4_chat"] = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role) AS position
           FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered FROM t),
p AS (SELECT *, sha256(string_agg(md5(role || chr(0) || text), ',') OVER (
                PARTITION BY conv_id ORDER BY position ROWS UNBOUNDED PRECEDING)) AS h,
             count(*) OVER (PARTITION BY conv_id) AS n_turns,
             sum(length(rendered)) OVER (PARTITION BY conv_id ORDER BY position
                                         ROWS UNBOUNDED PRECEDING) - length(rendered) AS start FROM r),
w AS (SELECT conv_id, n_turns, h FROM p WHERE position = n_turns),
kept AS (SELECT min(conv_id) AS conv_id FROM w GROUP BY n_turns, h
         HAVING NOT EXISTS (SELECT 1 FROM p WHERE p.position < p.n_turns
                            AND p.position = w.n_turns AND p.h = w.h))
SELECT p.conv_id, n_turns, position, start::BIGINT AS start, rendered FROM p JOIN kept USING (conv_id)
"""


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op5_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM d),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
again AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
          GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.doc_id, i, line, coalesce(k.doc_id > first, false) AS gone
           FROM keyed k LEFT JOIN again a ON k.key = a.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


ORACLES["op7_mixing"] = r"""
WITH d AS (SELECT doc_id, coalesce('a' || source, 'b') AS src,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  (('0x' || substr(md5(doc_id || ':mix-1'), 1, 13))::BIGINT::DOUBLE + 0.5)
                  / 4503599627370496.0::DOUBLE AS u
           FROM documents),
c AS (SELECT *, length(bin(size))::INT AS class FROM d),
s AS (SELECT src, sum(size)::BIGINT AS source_size, (3 * sum(size))::DOUBLE AS lim,
             [5, 2, 1][((row_number() OVER (ORDER BY src COLLATE "C") - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM c GROUP BY src),
f AS (SELECT *, (sum(source_size) OVER ())::DOUBLE AS total,
             sum(lim) OVER (o ROWS UNBOUNDED PRECEDING) - lim AS full_,
             sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
      FROM s WINDOW o AS (ORDER BY lim / w, src COLLATE "C")),
sh AS (SELECT (total - full_) / rest AS share FROM f WHERE (total - full_) / rest * w <= lim
       ORDER BY lim / w, src COLLATE "C" LIMIT 1),
t AS (SELECT src, source_size, least(lim, coalesce(share * w, lim)) AS target FROM f LEFT JOIN sh ON true),
k AS (SELECT src, class, sum(size)::BIGINT AS words, (class + 4)::DOUBLE AS w FROM c GROUP BY ALL),
r AS (SELECT k.*, source_size, target,
             (target - 3 * (sum(words) OVER (v ROWS UNBOUNDED PRECEDING) - words))
             / nullif(sum(words * w) OVER (v ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS rate
      FROM k JOIN t USING (src) WINDOW v AS (PARTITION BY src ORDER BY w DESC)),
r2 AS (SELECT *, max_by(rate, w) FILTER (WHERE rate * w <= 3) OVER (PARTITION BY src) AS chosen FROM r),
r3 AS (SELECT *, least(3.0::DOUBLE, coalesce(chosen * w, 3.0::DOUBLE)) AS raw FROM r2),
r4 AS (SELECT *, CASE WHEN abs(raw - round(raw)) < 1e-9 THEN round(raw) ELSE raw END AS n FROM r3),
r5 AS (SELECT *, floor(n) AS certain, n - floor(n) AS p,
              target - sum(words * floor(n)) OVER (PARTITION BY src) AS left_ FROM r4),
q AS (SELECT c.*, source_size, target, certain, p, left_,
             CASE WHEN p > 0 THEN (u / (1 - u)) * ((1 - p) / p) END AS q
      FROM c JOIN r5 USING (src, class)),
z AS (SELECT *, CASE WHEN p > 0 THEN sum(size) OVER (PARTITION BY src, p > 0 ORDER BY q, doc_id, size
                                                     ROWS UNBOUNDED PRECEDING) - size / 2 <= left_
                ELSE false END AS extra FROM q)
SELECT doc_id, size, source_size, target, (size * (certain + extra::INT))::BIGINT AS taken FROM z
"""


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    failed = F.col("failed")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(failed, quality.BASE)).alias("base_failed"),
        quality.passes(failed, "v2").alias("kept"), failed.alias("failed_rules"))


ORACLES["op8_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
tokens AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
windows AS (SELECT doc_id, i, a, lead(a, 1) OVER s AS b, lead(a, 2) OVER s AS c
            FROM tokens WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
                                 FROM windows WHERE c IS NOT NULL) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n
            FROM again, (VALUES (0), (1), (2)) AS offsets(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
line_counts AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
                FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines,
             coalesce(r.n, 0) AS n_repeat_words,
             length(regexp_replace(t, '\P{L}', '', 'g')) AS letters,
             length(regexp_replace(t, '\P{Lu}', '', 'g')) AS capitals,
             length(t) - length(replace(t, '!', '')) AS exclamations
      FROM d LEFT JOIN repeats r ON d.doc_id = r.doc_id LEFT JOIN line_counts l ON d.doc_id = l.doc_id),
f AS (SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
                + 4 * (100 * n_symbols > 10 * n_words)::INT + 8 * (100 * capitals > 30 * letters)::INT
                + 16 * (100 * exclamations > 10 * n_words)::INT
                + 32 * (100 * n_dup_lines > 50 * n_lines)::INT AS failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept,
       failed::BIGINT AS failed_rules FROM f
"""


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


for _f in vector_queries.QUERIES.values():
    query(_f)
ORACLES |= vector_queries.ORACLES
