"""One query per operator, over its whole table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from quillset.llm import ann, bpe, dedup, htmltext, jaccard, langid, licenses, mixing, negatives, quality, runs, tokencount, warc

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, sf_dir), WORD_BPE)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", mixing.label_domain().alias("domain"))
    return mixing.mixed(documents(spark, sf_dir), labels)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(documents(spark, sf_dir), dedup.new_index(spark))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.sized(documents(spark, sf_dir), PIECE_BPE)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, k=20)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(documents(spark, sf_dir))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(runs.find_runs(runs.with_planted_tails(documents(spark, sf_dir))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_token_counts": op6_token_counts,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_license_scan": op8_license_scan,
    "op9_warc": op9_warc,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality_rules": op12_quality_rules,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {"op4_exact_dedup": dedup.DEDUP_SQL, "op9_warc": warc.WARC_SQL, "op11_hard_negatives": negatives.NEGATIVES_SQL}
