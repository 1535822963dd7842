"""Writers and their readers: result CSV, metrics JSON, vector index, models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillset.operators.forest import build_index, open_index


def write_results_csv(df: DataFrame, path: str) -> str:
    """CSV files with a header, quotes doubled inside quoted cells."""
    writer = df.write.option("header", True).option("escape", '"').option("quoteAll", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def read_results_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what ``write_results_csv`` wrote; empty cells come back as null."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    return reader.csv(path)


def write_metrics(metrics: DataFrame, path: str) -> str:
    """One-row metrics table as JSON, nulls included."""
    metrics.write.option("ignoreNullFields", False).json(path)
    return path


def read_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_index(items: DataFrame, path: str, **options) -> str:
    """Build the vector index of (item_id, vector) at ``path``; its tables are written once, the manifest last."""
    build_index(items, path=path, **options)
    return path


def load_index(spark: SparkSession, path: str) -> dict:
    """An index that was written to its end."""
    return open_index(spark, path)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
