"""Text to vectors with a pluggable encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.functions.text import STOPWORDS, preprocess_text


def clean_for_embedding(df: DataFrame, text: str, stopwords: Iterable[str] = STOPWORDS) -> DataFrame:
    """``df`` with the cleaned text; a null text is cleaned to the empty one."""
    return df.withColumn("_clean", F.coalesce(preprocess_text(F.col(text), stopwords), F.lit("")))


def fit_tfidf_encoder(
    corpus: DataFrame, text: str = "text", dim: int = 256, stopwords: Iterable[str] = STOPWORDS
) -> PipelineModel:
    """Hashed TF-IDF of unit length, fitted on the corpus: the default encoder."""
    stages = [
        Tokenizer(inputCol="_clean", outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(clean_for_embedding(corpus.select(text), text, stopwords))


def embed_text(
    df: DataFrame, encoder: PipelineModel, text: str = "text", out: str = "vector", stopwords: Iterable[str] = STOPWORDS
) -> DataFrame:
    """Add the encoder's vector of the cleaned text. A text without words gets a vector of zeros, a null text none."""
    encoded = encoder.transform(clean_for_embedding(df, text, stopwords))
    vector = vector_to_array("_unit", "float32")
    zeros = F.transform(vector, lambda x: F.lit(0.0).cast("float"))
    known = F.when(F.col("_clean") == "", zeros).otherwise(vector)
    return encoded.withColumn(out, F.when(F.col(text).isNotNull(), known)).select(*df.columns, out)


def embed_text_with_model(
    df: DataFrame,
    make_encode_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    text: str = "text",
    out: str = "vector",
    batch_size: int = 64,
    stopwords: Iterable[str] = STOPWORDS,
) -> DataFrame:
    """Add the vector a user model gives for the cleaned text; the model is built once per Python worker."""
    encode = predict_batch_udf(make_encode_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    return clean_for_embedding(df, text, stopwords).withColumn(out, encode(F.col("_clean"))).drop("_clean")
