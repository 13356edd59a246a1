"""From raw documents to token ids: rules, line dedup, near duplicates, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows
to the shared folder and reads them back as the next one's ``docs``. All stages but the last
return the columns of ``documents``. What each does with NULL or empty texts, repeated rows,
empty tables and extra columns is said in its operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from herald.llm import bpe, jaccard, line_dedup, mixing, quality
from herald.llm.common import ship
from herald.scale import settle

POLICY = "v2"
#: Words per shingle and percent of similarity from which documents are near duplicates. The query
#: ``op9_ngram_jaccard`` has values of its own.
WIDTH, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the policy."""
    return quality.kept_documents(docs, POLICY)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds."""
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of near duplicates."""
    return jaccard.without_near_duplicates(docs, WIDTH, PERCENT)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: each document as often as it is taken, which may be never."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): ids of every row's text, and whether they decode to
    it. A document taken twice has two rows."""
    return bpe.tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup_stage),
          ("n-gram Jaccard join", near_duplicates), ("mixing to target weights", mixing_stage),
          ("BPE encoding and decoding", bpe_stage)]

#: The near-duplicate and tokenizer stages are no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
