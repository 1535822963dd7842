"""Counts, accuracy, classification reports and token accuracy.

Every report starts with one aggregation that combines on the map side; what follows works on a table of at most
classes x classes rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.functions.answers import mask_filter
from quillset.functions.fixed_values import INVALID_CHOICE


def share(condition: Column) -> Column:
    """Share of rows that meet the condition; an unknown counts as not met."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per class, largest class first, ties by class."""
    return order_by_count(df.groupBy(column).agg(F.count(F.lit(1)).alias("count")), column)


def order_by_count(counts: DataFrame, column: str, count: str = "count") -> DataFrame:
    return counts.orderBy(F.desc(count), F.asc(column))


def split_sizes(df: DataFrame, column: str = "split") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def choice_scores(df: DataFrame, truth: str = "cop", prediction: str = "prediction") -> DataFrame:
    """``accuracy``, ``error_rate`` (invalid answers included) and ``invalid_rate`` in one pass."""
    right = F.col(truth) == F.col(prediction)
    return df.agg(
        share(right).alias("accuracy"),
        share(~F.coalesce(right, F.lit(False))).alias("error_rate"),
        share(F.col(prediction) == INVALID_CHOICE).alias("invalid_rate"),
    )


def match_scores(df: DataFrame, correct: str = "is_correct") -> DataFrame:
    """Correct answers, all answers, and the percentage with two decimals."""
    hits = F.count_if(F.col(correct))
    total = F.count(F.lit(1))
    percent = F.round(F.try_divide(F.lit(100.0) * hits, total), 2)
    return df.agg(hits.alias("correct"), total.alias("total"), percent.alias("percent"))


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Rows per (label, pred) pair."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: Sequence[int]) -> DataFrame:
    """One row per label, one ``pred_<class>`` column per class, and ``pred_other`` for predictions outside ``classes``
    (nulls too), so that a row's columns add up to its label's rows."""
    cells = [
        F.count_if(F.col(pred) == F.lit(c)).alias(f"pred_{c}".replace("-", "minus_")) for c in classes
    ]
    known = F.coalesce(F.col(pred).isin(*classes), F.lit(False))
    return df.groupBy(F.col(label).alias("label")).agg(*cells, F.count_if(~known).alias("pred_other"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(F.lit(2.0) * precision * recall, precision + recall)


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then the rows accuracy, macro avg and weighted avg.

    Classes are those that occur as label or as prediction. A zero denominator gives 0. In the accuracy row the
    four measures hold the accuracy and the number of rows.
    """
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("pred").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    per_class = (
        confusion_counts(df, label, pred)
        .select(F.explode(sides).alias("s"))
        .select("s.*")
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
        .withColumn("precision", _ratio(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )
    # All summary rows come from one pass over the per-class rows.
    measures = ["precision", "recall", "f1"]
    total = F.sum("support")
    accuracy = _ratio(F.sum("hits"), total)
    line = F.struct(
        F.col("class").cast("string").alias("class"), *[F.col(m) for m in measures], F.col("support")
    )
    summary = F.array(
        F.struct(F.lit("accuracy").alias("class"), *[accuracy.alias(m) for m in measures], total.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], total.alias("support")),
        F.struct(
            F.lit("weighted avg").alias("class"),
            *[_ratio(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in measures],
            total.alias("support"),
        ),
    )
    lines = per_class.agg(F.concat(F.array_sort(F.collect_list(line)), summary).alias("lines"))
    return lines.select(F.explode("lines").alias("l")).select("l.*")


def token_accuracy(df: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """Share of right labels over all unmasked positions of array columns; rows are counted in place."""
    pairs = mask_filter(F.col(pred), F.col(label))
    counted = df.select(pairs.alias("pairs")).select(
        F.size("pairs").cast("bigint").alias("tokens"),
        F.size(F.filter("pairs", lambda p: p["pred"] == p["label"])).cast("bigint").alias("hits"),
    )
    return counted.agg(
        F.sum("tokens").alias("tokens"),
        F.sum("hits").alias("hits"),
        _ratio(F.sum("hits"), F.sum("tokens")).alias("accuracy"),
    )


def throughput(log: DataFrame, group: str, ts: str, workers: int = 1) -> DataFrame:
    """Rows, seconds between first and last row, rows per second and per worker, for each group of a run log."""
    seconds = F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts)) / F.lit(1_000_000.0)
    return (
        log.groupBy(group)
        .agg(F.count(F.lit(1)).alias("samples"), seconds.alias("seconds"))
        .withColumn("per_second", F.try_divide(F.col("samples").cast("double"), F.col("seconds")))
        .withColumn("per_second_per_worker", F.col("per_second") / F.lit(float(workers)))
    )
