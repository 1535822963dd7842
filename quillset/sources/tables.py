"""Readers: split tables, named datasets, review CSV files, document corpora."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.contracts import REVIEWS, require_columns
from quillset.functions.fixed_values import NULL_TOKENS
from quillset.operators.projections import class_dimension
from quillset.session import broadcast_if_small, spread
from quillset.sources.csv_splits import read_split_csv


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Parquet table partitioned by ``split``; with a split name only its folder is read."""
    df = require_columns(spark.read.parquet(path), "split")
    return df if split is None else df.filter(F.col("split") == split)


def load_dataset(spark: SparkSession, name: str, split: str | None = None) -> DataFrame:
    """A table or view of the catalog, all splits or one."""
    df = spark.table(name)
    return df if split is None else require_columns(df, "split").filter(F.col("split") == split)


def null_token_as_null(cell: Column, null_tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~cell.isin(list(null_tokens)), cell)


def read_reviews_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REVIEWS,
    null_tokens: Sequence[str] = NULL_TOKENS,
    cut_files: bool = False,
) -> DataFrame:
    """CSV with header and quoted cells; null tokens become null before the cells are cast.

    Spark's own reader takes each file in one task, as line breaks may lie inside cells. With ``cut_files`` large files
    are read in many tasks; quotes must then stand around cells only.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    if cut_files:
        raw = read_split_csv(spark, path, as_text)
    else:
        raw = (
            spark.read.schema(as_text)
            .option("header", True)
            .option("multiLine", True)
            .option("escape", '"')
            .option("enforceSchema", False)
            .csv(path)
        )
    return raw.select(
        *[null_token_as_null(F.col(f.name), null_tokens).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_corpus(
    spark: SparkSession, path: str, key: str = "doc_id", text: str = "text", class_column: str = "source"
) -> tuple[DataFrame, DataFrame]:
    """Documents (key, text, target) and the class names (target, target_name)."""
    stored = require_columns(spark.read.parquet(path), key, text, class_column)
    classes = class_dimension(stored, class_column)
    raw = spread(stored, key)
    documents = (
        raw.select(key, text, F.col(class_column).alias("target_name"))
        .join(broadcast_if_small(classes), "target_name", "left")
        .select(key, text, "target")
    )
    return documents, classes
