"""Dense-vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(u: Column, v: Column) -> Column:
    return F.aggregate(F.zip_with(u, v, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x))


def unit_vector(v: Column) -> Column:
    """The vector at length 1; a zero vector stays as it is."""
    # The length travels as an array element so that it is computed once, not once per coordinate.
    return F.flatten(
        F.transform(
            F.array(norm(v)),
            lambda length: F.transform(v, lambda x: F.when(length == 0.0, x).otherwise(x / length)),
        )
    )


def angular_distance(u: Column, v: Column) -> Column:
    """Euclidean distance between the two directions: sqrt(2 * (1 - cos)); a zero vector counts as orthogonal."""
    cosine = F.coalesce(F.try_divide(dot(u, v), norm(u) * norm(v)), F.lit(0.0))
    return F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) * (F.lit(1.0) - cosine)))
