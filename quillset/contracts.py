"""Column contracts of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

QUESTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField("opa", T.StringType()),
        T.StructField("opb", T.StringType()),
        T.StructField("opc", T.StringType()),
        T.StructField("opd", T.StringType()),
        T.StructField("cop", T.IntegerType()),
        T.StructField("choice_type", T.StringType()),
    ]
)

REVIEWS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("clean_text", T.StringType()),
        T.StructField("category", T.DoubleType()),
    ]
)

TAGGED_SENTENCES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.StringType())),
        T.StructField("ner_tags", T.ArrayType(T.IntegerType())),
    ]
)

TRAINING_LOG = T.StructType(
    [
        T.StructField("epoch", T.DoubleType()),
        T.StructField("step", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("eval_loss", T.DoubleType()),
    ]
)

CHAT_MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` itself, or an error naming the columns it lacks."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df
