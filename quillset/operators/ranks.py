"""Exact global order without a single-task sort: ranks, running totals, seeded samples and splits.

Two building blocks:

* ``key_cutoffs`` finds the row key at given positions of the seeded order. Rows are counted per hash prefix
  and only the one prefix a cutoff falls into is sorted, so drawing a sample or a split moves no rows: it ends
  in a filter or a CASE against a scalar.
* ``global_rank`` and ``prefix_offsets`` need a value per row. Rows are cut into buckets that follow the order,
  bucket totals are added up (a table with at most one row per bucket) and a window runs inside each bucket.

Keys must be unique; that is what makes the order total.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX_DIGITS = 4  # 65,536 hash prefixes: the bound on every counts table below
SMALL_SAMPLE = 256  # up to here a top-n per task is cheaper than counting prefixes
MAX_BUCKETS = 65_536
SAMPLES_PER_BUCKET = 16  # of keys that are no numbers


def seeded_hash(key: Column, seed: int) -> Column:
    """Hex digest that orders rows by seed and key only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _order_key(key: str, seed: int) -> Column:
    return F.struct(seeded_hash(F.col(key), seed).alias("hash"), F.col(key).alias("key"))


def key_cutoffs(df: DataFrame, key: str, seed: int, targets) -> DataFrame:
    """One row with one struct column ``cut`` holding, per target, the order key of the row at that position.

    ``targets`` maps the total row count (a column) to a list of 1-based positions (bigint columns). A position
    of 0 or past the end gives null.
    """
    keys = df.select(_order_key(key, seed).alias("k")).withColumn("prefix", F.substring("k.hash", 1, PREFIX_DIGITS))
    counts = keys.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = counts.select(
        "prefix", "n", F.sum("n").over(upto).alias("end"), F.sum("n").over(Window.partitionBy()).alias("total")
    )
    positions = targets(F.col("total"))
    wanted = F.array(*[F.struct(F.lit(i).alias("target"), p.alias("position")) for i, p in enumerate(positions)])
    cuts = (
        totals.select("prefix", "n", "end", F.explode(wanted).alias("w"))
        .filter((F.col("w.position") > F.col("end") - F.col("n")) & (F.col("w.position") <= F.col("end")))
        .select("prefix", "w.target", (F.col("w.position") - F.col("end") + F.col("n")).alias("offset"))
    )
    # at most one row per target, so the broadcast is bounded by the length of the target list
    ranked = keys.join(F.broadcast(cuts), "prefix").withColumn(
        "rank", F.row_number().over(Window.partitionBy("target").orderBy("k.hash", "k.key"))
    )
    picked = ranked.filter(F.col("rank") == F.col("offset"))
    return picked.agg(
        F.struct(*[F.max(F.when(F.col("target") == i, F.col("k"))).alias(f"t{i}") for i in range(len(positions))])
        .alias("cut")
    )


def sample_n(df: DataFrame, n: int, key: str, seed: int, allow_fewer: bool = False) -> DataFrame:
    """Exactly ``n`` rows without replacement, the same ones for the same seed.

    Asking for more rows than there are is an error unless ``allow_fewer``.
    """
    if n <= 0:
        return df.limit(0)
    total = df.agg(F.count(F.lit(1)).alias("n"))
    if not allow_fewer:
        message = F.lit(f"sample of {n} rows is larger than the table")
        enough = total.select(
            F.when(F.col("n") < n, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)).alias("ok")
        )
        df = df.filter(enough.scalar())
    if n <= SMALL_SAMPLE:
        return df.orderBy(seeded_hash(F.col(key), seed), F.col(key)).limit(n)
    cutoff = key_cutoffs(df, key, seed, lambda rows: [F.least(F.lit(n).cast("bigint"), rows)])
    return df.filter(_order_key(key, seed) <= cutoff.select("cut.t0").scalar())


def preview(df: DataFrame, key: str, n: int = 3, seed: int = 0) -> DataFrame:
    """A few seeded rows to look at."""
    return sample_n(df, n, key, seed, allow_fewer=True)


def split_exact(
    df: DataFrame,
    key: str,
    test: float,
    validation: float = 0.0,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Label rows train, test and (if asked for) validation with exact sizes.

    ``ceil(test * n)`` rows are test; ``ceil(validation * rest)`` of the others are validation.
    """
    if not 0 < test < 1 or not 0 <= validation < 1:
        raise ValueError("fractions must lie between 0 and 1")

    def positions(rows: Column) -> list[Column]:
        n_test = F.ceil(F.lit(float(test)) * rows).cast("bigint")
        n_validation = F.ceil(F.lit(float(validation)) * (rows - n_test)).cast("bigint")
        return [n_test, n_test + n_validation] if validation else [n_test]

    cut = key_cutoffs(df, key, seed, positions)
    order = _order_key(key, seed)
    label = F.when(order <= cut.select("cut.t0").scalar(), F.lit("test"))
    if validation:
        label = label.when(order <= cut.select("cut.t1").scalar(), F.lit("validation"))
    return df.withColumn(out, label.otherwise(F.lit("train")))


def train_test_split(df: DataFrame, key: str, test: float = 0.3, seed: int = 42) -> DataFrame:
    """Two-way split with a test share."""
    return split_exact(df, key, test=test, seed=seed)


def _buckets(df: DataFrame, key: str, seed: int | None) -> tuple[DataFrame, list[Column]]:
    """``df`` with a ``_bucket`` column that grows with the order, and the order inside a bucket.

    Seeded order: bucket by hash prefix. Natural order: bucket by quantiles of the key, so gaps or clusters in the keys
    do not make a bucket large. Keys that are no numbers are cut at sampled values of their own type.
    """
    if seed is not None:
        order = seeded_hash(F.col(key), seed)
        return df.withColumn("_bucket", F.substring(order, 1, 3)), [order, F.col(key)]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MAX_BUCKETS, 4 * partitions)
    if not isinstance(df.schema[key].dataType, (T.NumericType, T.TimestampType)):
        return df.withColumn("_bucket", _between_samples(df, key, buckets)), [F.col(key)]
    as_double = df.withColumn("_key_as_double", F.col(key).cast("double"))
    probabilities = [i / buckets for i in range(1, buckets)]
    edges = as_double.approxQuantile("_key_as_double", probabilities, 1 / (8 * buckets))
    if not edges:
        return df.withColumn("_bucket", F.lit(0.0)), [F.col(key)]
    splits = [-math.inf, *sorted(set(edges)), math.inf]
    bucketed = Bucketizer(splits=splits, inputCol="_key_as_double", outputCol="_bucket").transform(as_double)
    return bucketed.drop("_key_as_double"), [F.col(key)]


def _between_samples(df: DataFrame, key: str, buckets: int) -> Column:
    """Number of the sampled keys up to the key, which grows with it; a null key comes first.

    About SAMPLES_PER_BUCKET keys for each bucket are drawn by hash and sorted by Spark, so their order is its own.
    """
    total = df.count()
    share = min(1.0, buckets * SAMPLES_PER_BUCKET / max(1, total))
    drawn = df.filter(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))))
    ordered = [r[0] for r in drawn.select(key).orderBy(key).collect()]  # bounded by MAX_BUCKETS * SAMPLES_PER_BUCKET
    edges = sorted(set(ordered[:: max(1, len(ordered) // buckets)]))

    @F.arrow_udf("double")
    def place(keys: pa.Array) -> pa.Array:
        return pa.array([-1.0 if k is None else float(bisect_right(edges, k)) for k in keys.to_pylist()], pa.float64())

    return place(key)


def _with_bucket_start(bucketed: DataFrame, amount: Column) -> DataFrame:
    """Add ``_bucket_start``: the sum of ``amount`` over all earlier buckets."""
    sums = bucketed.groupBy("_bucket").agg(F.sum(amount).alias("_sum"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0).cast("bigint")).alias("_bucket_start"))
    return bucketed.join(F.broadcast(starts), "_bucket")  # at most MAX_BUCKETS rows


def global_rank(df: DataFrame, key: str, seed: int | None = None, out: str = "rank") -> DataFrame:
    """1-based position of every row in the natural order of ``key``, or in the seeded order."""
    bucketed, order = _buckets(df, key, seed)
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    ranked = _with_bucket_start(bucketed, F.lit(1).cast("bigint")).withColumn(out, F.col("_bucket_start") + within)
    return ranked.drop("_bucket", "_bucket_start")


def prefix_offsets(df: DataFrame, key: str, length: str, out: str = "offset") -> DataFrame:
    """Exclusive running sum of ``length`` in the natural order of ``key``."""
    bucketed, order = _buckets(df, key, None)
    before = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    amount = F.col(length).cast("bigint")
    summed = _with_bucket_start(bucketed, amount).withColumn(
        out, F.col("_bucket_start") + F.coalesce(F.sum(amount).over(before), F.lit(0).cast("bigint"))
    )
    return summed.drop("_bucket", "_bucket_start")


def batch_index(df: DataFrame, key: str, batch_size: int, seed: int | None = None, out: str = "batch") -> DataFrame:
    """Number of the contiguous batch of ``batch_size`` rows a row belongs to."""
    ranked = global_rank(df, key, seed, "_rank")
    return ranked.withColumn(out, F.expr(f"(_rank - 1) div {int(batch_size)}")).drop("_rank")


def item_ids(df: DataFrame, key: str, out: str = "item") -> DataFrame:
    """0-based position in the natural order of ``key``."""
    return global_rank(df, key, None, "_rank").withColumn(out, F.col("_rank") - 1).drop("_rank")


def top_k_per_query(
    df: DataFrame, k: int = 10, query: Sequence[str] = ("query_id",), distance: str = "distance", item: str = "item_id"
) -> DataFrame:
    """The ``k`` nearest items of each query with their ``rank``; equal distances go by item id.

    The rank filter reaches the map side, so a query with very many candidates is cut down before the shuffle.
    """
    order = Window.partitionBy(*query).orderBy(F.col(distance), F.col(item))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
