"""Corpus preparation: toxicity, quality rules, line deduplication, near-duplicates, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.llm import line_dedup, packing, repetition, simhash, toxicity
from viewpulse.llm.queries import toxicity_model
from viewpulse.sources.tables import settle


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the tables in `sf_dir`, does not hold toxic. Null and empty texts are scored as
    texts without words; all columns of what stays pass through."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, sf_dir))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules. Null and empty texts have too few words, so they go."""
    return repetition.keep_by_rules(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; `n_chars`, where there is one, is that of the new text.

    A null text becomes ""; columns of any other name, `n_lines` and `n_dropped` too, are as they were."""
    kept = line_dedup.dedup_lines(docs, counts=False)
    return kept.select(*[F.char_length("text").cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes])


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Groups are the components of SimHash fingerprints at most two bits apart, joined where texts are similar beyond that."""
    return simhash.drop_near_duplicates(docs, linked=simhash.near_duplicates(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in token windows; a null or empty text is a piece of its end id alone."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("near dedup", near_deduplication),
    ("packing", pack),
]

#: The stages train, hash and tokenize in ways SQL has no words for; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
