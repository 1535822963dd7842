"""A corpus from raw documents: language, exact and near copies, mix, tokens. Every stage reads what the last one wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillset.llm import bpe, dedup, jaccard, langid, mixing
from quillset.llm.queries import WORD_BPE
from quillset.session import materialise


#: Shares of tokens in the mix: less of poor and toxic text than the corpus has, so that good documents are the scarce ones.
MIX = {"good": 0.88, "poor": 0.08, "toxic": 0.04}


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language go."""
    return langid.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the smallest doc_id stays."""
    return dedup.keep_first(docs, dedup.new_index(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component the smallest doc_id stays; documents without words stay."""
    return jaccard.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: the largest mix without repeats in which poor and toxic documents have little weight."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", mixing.label_domain().alias("domain"))
    return mixing.keep_mixed(docs, labels, MIX)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding."""
    return bpe.round_trip_digests(docs, WORD_BPE)


STAGES = [
    ("language ID", identify),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix),
    ("BPE encoding and decoding", tokens),
]

#: The language, mixing and token stages are beyond SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
