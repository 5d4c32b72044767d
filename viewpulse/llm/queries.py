"""Registered queries of the operators: each applies one, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.llm import alignment, ann, bpe, html_extract, licenses, line_dedup, merkle, packing, repetition, simhash, token_files, toxicity, transducer
from viewpulse.sources.tables import scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    labels = _table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    return toxicity.train(_table(spark, sf_dir, "documents"), labels)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(_table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(written, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch(spark)
    token_files.write_tokens(_table(spark, sf_dir, "documents"), target, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.checksums(token_files.read_tokens(spark, target))


def op7_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.measure_repetition(_table(spark, sf_dir, "documents"))


def op8_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("keeper.doc_id").alias("component_id"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(_table(spark, sf_dir, "documents"), *files, carry={"groups_sha256": digest})


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_style_tree, op3_bpe, op4_packing, op5_license_scan, op6_token_files, op7_repetition_rules,
        op8_hilbert_ann, op9_simhash, op10_line_dedup, op11_token_counts, op12_alignment, op13_merkle,
    )
}
