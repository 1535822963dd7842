"""Document retrieval: encode, index, search, look up."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillset.operators.embedding import embed_text
from quillset.operators.joins import lookup_neighbours
from quillset.operators.forest import build_index, search


def index_documents(
    documents: DataFrame, encoder: PipelineModel, key: str = "doc_id", text: str = "text", **index_options
) -> dict:
    """Vector index over the cleaned texts; those without words have no direction and are left out."""
    vectors = embed_text(documents.select(key, text), encoder, text).filter(F.exists("vector", lambda x: x != 0))
    return build_index(vectors.select(F.col(key).alias("item_id"), "vector"), **index_options)


def retrieve_documents(
    index: dict,
    encoder: PipelineModel,
    questions: DataFrame,
    documents: DataFrame,
    classes: DataFrame,
    k: int = 10,
    key: str = "query_id",
    text: str = "text",
    candidates: int | None = None,
) -> DataFrame:
    """The ``k`` documents nearest to each question, with raw text and class name."""
    queries = embed_text(questions.select(key, text), encoder, text)
    found = search(index, queries.select(F.col(key).alias("query_id"), "vector"), k, candidates)
    return lookup_neighbours(found, documents, classes)
