"""Joins: log merge, neighbour lookup, answer write-back, pairing of predictions with truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillset.session import broadcast_if_small


def split_log(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training rows (those with a loss) and validation rows (no loss, but an evaluation loss)."""
    train = log.filter(F.col("loss").isNotNull())
    valid = log.filter(F.col("loss").isNull() & F.col("eval_loss").isNotNull())
    return train, valid


def merge_logs(log: DataFrame, on: Sequence[str] = ("epoch", "step")) -> DataFrame:
    """Training rows beside validation rows of the same epoch and step, all combinations of equal keys.

    Every metric column survives. Columns that only one kind of row fills keep their name; a column that both kinds fill
    comes twice, with the suffixes ``_train`` and ``_valid``. The losses belong to their side.
    """
    train, valid = split_log(log)
    metrics = [c for c in log.columns if c not in (*on, "loss", "eval_loss")]
    filled = lambda side: [F.count(F.col(f"`{c}`")).alias(f"{side}_{i}") for i, c in enumerate(metrics)]
    used = train.agg(*filled("t")).join(valid.agg(*filled("v"))).first() if metrics else {}  # one row each
    of_train, of_valid = [F.col("loss")], [F.col("eval_loss")]
    for i, name in enumerate(metrics):
        both = used[f"t_{i}"] and used[f"v_{i}"]
        if used[f"t_{i}"] or not used[f"v_{i}"]:
            of_train.append(F.col(f"`{name}`").alias(f"{name}_train" if both else name))
        if used[f"v_{i}"]:
            of_valid.append(F.col(f"`{name}`").alias(f"{name}_valid" if both else name))
    return train.select(*on, *of_train).join(valid.select(*on, *of_valid), list(on), "inner")


def lookup_neighbours(
    neighbours: DataFrame, documents: DataFrame, classes: DataFrame, doc_key: str = "doc_id"
) -> DataFrame:
    """Raw text, class id and class name for (query_id, item_id, distance) rows.

    ``documents`` has ``text`` and ``target``, ``classes`` the name of each target. The neighbour list is joined as
    it is: when it is small Spark broadcasts it, when a document is the neighbour of very many queries the skew
    join splits it. A neighbour whose document or class is unknown stays, with nulls in its place.
    """
    found = neighbours.join(documents.select(F.col(doc_key).alias("item_id"), "text", "target"), "item_id", "left")
    named = found.join(broadcast_if_small(classes), "target", "left")
    return named.select(*neighbours.columns, "text", "target", "target_name")


def write_back(df: DataFrame, answers: DataFrame, key: str = "id") -> DataFrame:
    """Rows with the answers of the same key; rows without an answer get null."""
    return df.join(answers, key, "left")


def pair_predictions(pred: DataFrame, truth: DataFrame, on: Sequence[str] = ("sent_id", "pos")) -> DataFrame:
    """Prediction beside truth for the same sentence and position."""
    return truth.join(pred, list(on), "inner")
