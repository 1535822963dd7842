"""Choices over training logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_epoch(log: DataFrame) -> DataFrame:
    """Epoch and step with the lowest evaluation loss; the lowest step of equals."""
    rated = log.filter(F.col("eval_loss").isNotNull())
    best = F.min(F.struct("eval_loss", "step", "epoch")).alias("b")
    return rated.agg(best).select("b.epoch", "b.step", "b.eval_loss")
