"""Input tables in the shapes the operators expect, derived from the given Parquet tables.

Every table is built from whole rows and whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillset.functions.fixed_values import MASKED_LABEL
from quillset.functions.prompts import correct_option
from quillset.functions.text import words
from quillset.operators.rows import posexplode_rows
from quillset.session import spread

OPTION_WORDS = 3  # words per answer option, taken from the end of the text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, "doc_id") if name == "documents" else df


def _joined(word_array: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(word_array, start, length), " ")


def mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions: the last twelve words of a document are its four options, all words before them the question.

    A text too short for that has null parts.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", words(F.col("text")).alias("w"))
    kinds = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    rest = F.size("w") - 4 * OPTION_WORDS
    parts = {"question": _joined(F.col("w"), F.lit(1), F.greatest(rest, F.lit(0)))}
    for i, name in enumerate(["opa", "opb", "opc", "opd"]):
        parts[name] = _joined(F.col("w"), F.greatest(rest + i * OPTION_WORDS + 1, F.lit(1)), F.lit(OPTION_WORDS))
    return documents.join(kinds, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        *[F.when(rest > 0, text).alias(name) for name, text in parts.items()],
        F.pmod(F.col("doc_id"), F.lit(4)).cast("int").alias("cop"),
        F.when(F.col("toxic") == 1, F.lit("multi")).when(F.col("toxic") == 0, F.lit("single")).alias("choice_type"),
    )


def mcq_answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with an ``answer`` as a model might give it: right, wrong, misspelt or off the format."""
    shape = F.pmod(F.col("id"), F.lit(7))
    cop = F.col("cop")
    answer = (
        F.when(shape == 0, F.concat(cop.cast("string"), F.lit(".")))
        .when(shape == 1, F.concat(F.lit("Answer: "), correct_option()))
        .when(shape == 2, F.concat(F.lit("The answer is "), F.pmod(cop + 1, F.lit(4)).cast("string")))
        .when(shape == 3, F.lit("10"))
        .when(shape == 4, F.lit("none of these"))
        .when(shape == 5, F.substring(correct_option(), 2, 2**31 - 1))
        .otherwise(F.concat(F.lit("Option "), cop.cast("string"), F.lit(" because")))
    )
    return mcq(spark, sf_dir).withColumn("answer", answer)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with a category of -1, 0, 1, or null where a document has no label."""
    quality, toxic = F.col("quality"), F.col("toxic")
    category = (
        F.when(quality.isNull(), F.lit(None).cast("double"))
        .when((quality == 1) & (toxic == 0), F.lit(1.0))
        .when(quality == 1, F.lit(0.0))
        .otherwise(F.lit(-1.0))
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        F.col("doc_id").alias("id"), F.col("text").alias("clean_text"), category.alias("category")
    )


def ner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged sentences: one row per document with token, tag, prediction and masked-label arrays."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("sent_id"), words(F.col("text")).alias("tokens")
    )
    cycle = F.pmod
    tag = F.transform(
        "tokens", lambda w, pos: cycle(F.col("sent_id") * 7 + pos * 5, F.lit(18)).cast("int")
    )
    tagged = documents.withColumn("tags", F.transform(tag, lambda t: F.when(t < 9, t).otherwise(F.lit(0))))
    wrong = lambda pos: cycle(F.col("sent_id") + pos, F.lit(9)) == 0
    return tagged.select(
        "sent_id",
        "tokens",
        "tags",
        F.transform("tags", lambda t, pos: F.when(wrong(pos), cycle(t + 1, F.lit(9))).otherwise(t)).alias("pred"),
        F.transform("tags", lambda t, pos: F.when(cycle(pos, F.lit(10)) == 9, F.lit(MASKED_LABEL)).otherwise(t))
        .alias("label"),
    )


def ner_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tagged sentences with one token per row."""
    cells = F.arrays_zip("tokens", "tags", "pred", "label")
    return posexplode_rows(ner(spark, sf_dir), cells, "pos", "c", "sent_id").select(
        "sent_id", "pos", F.col("c.tokens").alias("token"), F.col("c.tags").alias("tag"),
        F.col("c.pred").alias("pred"), F.col("c.label").alias("label"),
    )


def named_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged sentences whose tags can be learned from the words.

    A capitalised word opens a person, the next capitalised ones go on with it; a word with a digit is a place.
    """
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("sent_id"), words(F.col("text")).alias("tokens")
    )
    shape = F.transform(
        "tokens", lambda w: F.when(w.rlike(r"^\p{Lu}"), F.lit(1)).when(w.rlike(r"\d"), F.lit(5)).otherwise(F.lit(0))
    )
    shaped = documents.withColumn("shape", shape)
    before = F.concat(F.array(F.lit(0)), F.slice("shape", 1, F.greatest(F.size("shape") - 1, F.lit(0))))
    tags = F.zip_with("shape", before, lambda own, last: F.when((own == 1) & (last == 1), F.lit(2)).otherwise(own))
    return shaped.select("sent_id", "tokens", tags.alias("tags"))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole vectors taken as class scores."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("logits"), "label"
    )


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training log: five rows per step, a loss or an evaluation loss or neither."""
    kind = F.col("event_type")
    step = F.floor(F.col("event_id") / F.lit(5)).cast("bigint")
    return table(spark, sf_dir, "events").select(
        "event_id",
        step.alias("step"),
        (step / F.lit(500.0)).alias("epoch"),
        F.when(kind == "view", F.col("value")).alias("loss"),
        F.when(kind == "purchase", F.col("value")).alias("eval_loss"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"), "label"
    )
