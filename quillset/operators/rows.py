"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The outer forms keep Spark from inferring a filter on the size of the array. That filter moves below other
# operators and computes the array a second time, which costs more than the explode when the array is an expression.


def explode_rows(df: DataFrame, array: Column | str, out: str, *keep: str) -> DataFrame:
    """One row per non-null element."""
    return df.select(*keep, F.explode_outer(array).alias(out)).filter(F.col(out).isNotNull())


def posexplode_rows(df: DataFrame, array: Column | str, pos: str, out: str, *keep: str) -> DataFrame:
    """One row per element with its position from 0."""
    return df.select(*keep, F.posexplode_outer(array).alias(pos, out)).filter(F.col(pos).isNotNull())
