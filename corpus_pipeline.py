"""Corpus pipeline over ``documents``, built from the operators in tidewater.llm.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the
columns of ``documents``; the last returns the packed pieces. Stages are
written as Parquet and read again in between, so each works on all its
predecessor kept and a lost executor costs no more than its stage.

1. toxicity: documents predicted toxic go (learnt from ``labels`` outside the held-out fold).
2. exact dedup: of equal texts (A-Z lower-cased) the row with the largest doc_id stays.
3. n-gram Jaccard join: of each group of near-duplicates the row with the smallest doc_id stays.
4. benchmark decontamination: documents that contain a benchmark item go.
5. packing: the rest as sequences of 2,048 tokens along a Hilbert curve.

Defined cases: the stages judge rows by id and text, so rows with a null doc_id
are judged like others (a null id sorts below every id among equal texts, behind
every id among near ones), and an id on two texts is judged by each of them; of
rows that repeat an id and its text one stays; null texts count as empty; an
empty table gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import saved, ship, table
from tidewater.llm.contamination import drop_contaminated
from tidewater.llm.exact_dedup import drop_exact_duplicates
from tidewater.llm.ngram_join import drop_near_duplicates
from tidewater.llm.packing import pack
from tidewater.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_exact_duplicates(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: Neither the classifier nor the tokenizer can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return docs
