"""Batch scoring with a model that is loaded once per Python worker."""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def score_batches(
    df: DataFrame,
    column: str,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    batch_size: int = 64,
    return_type: T.DataType = T.StringType(),
    out: str = "answer",
) -> DataFrame:
    """Add the model's output for ``column``.

    ``make_predict_fn`` builds the model in the worker; the function it returns gets arrays of at most
    ``batch_size`` inputs without nulls. Null input gives null output.
    """
    scorer = predict_batch_udf(_null_safe(make_predict_fn, return_type), return_type=return_type, batch_size=batch_size)
    return df.withColumn(out, scorer(F.col(column)))


def score_batches_with_errors(
    df: DataFrame,
    column: str,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    batch_size: int = 64,
    out: str = "answer",
    error: str = "error",
) -> DataFrame:
    """As ``score_batches`` for text output, but a row the model fails on gets null and the message in ``error``.

    A failing batch is scored again row by row, so only the bad rows are lost.
    """
    result = T.StructType([T.StructField(out, T.StringType()), T.StructField(error, T.StringType())])

    def make() -> Callable:
        predict = make_predict_fn()

        def one_by_one(inputs: np.ndarray) -> tuple[list, list]:
            answers, errors = [], []
            for i in range(len(inputs)):
                try:
                    answers.append(predict(inputs[i : i + 1])[0])
                    errors.append(None)
                except Exception as failure:  # noqa: BLE001 - the row carries the message
                    answers.append(None)
                    errors.append(f"{type(failure).__name__}: {failure}")
            return answers, errors

        def run(inputs: np.ndarray) -> dict[str, np.ndarray]:
            known = np.array([value is not None for value in inputs], dtype=bool)
            answers = np.full(len(inputs), None, dtype=object)
            errors = np.full(len(inputs), None, dtype=object)
            if known.any():
                try:
                    answers[known] = predict(inputs[known])
                except Exception:  # noqa: BLE001
                    answers[known], errors[known] = one_by_one(inputs[known])
            return {out: answers, error: errors}

        return run

    scorer = predict_batch_udf(make, return_type=result, batch_size=batch_size)
    scored = df.withColumn("_scored", scorer(F.col(column)))
    return scored.select(*df.columns, F.col(f"_scored.{out}"), F.col(f"_scored.{error}"))


def score_to_table(
    df: DataFrame,
    column: str,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    path: str,
    batch_size: int = 64,
    return_type: T.DataType = T.StringType(),
    out: str = "answer",
) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` with the model's output to ``path`` (Parquet), and the log of that run: (written table, log).

    The log is one row, observed while the run writes: ``samples``, ``seconds`` from the first batch's start to the last
    one's end, ``batch_seconds`` spent in the model over all workers, ``per_second`` and ``per_second_per_worker``.
    An empty table has 0 samples and null rates. Clocks are those of the workers.
    """
    timed = T.StructType([T.StructField(out, return_type), *[T.StructField(n, T.DoubleType()) for n in ("started", "ended", "own")]])

    def make() -> Callable[[np.ndarray], dict[str, np.ndarray]]:
        predict = _null_safe(make_predict_fn, return_type)()

        def run(inputs: np.ndarray) -> dict[str, np.ndarray]:
            started = time.time()
            answers = predict(inputs)
            ended, n = time.time(), len(inputs)
            return {out: answers, "started": np.full(n, started), "ended": np.full(n, ended), "own": np.full(n, (ended - started) / n)}

        return run

    scorer = predict_batch_udf(make, return_type=timed, batch_size=batch_size)
    run = Observation()
    scored = df.withColumn("_scored", scorer(F.col(column))).observe(
        run,
        F.count(F.lit(1)).alias("samples"),
        F.min("_scored.started").alias("started"),
        F.max("_scored.ended").alias("ended"),
        F.sum("_scored.own").alias("batch_seconds"),
    )
    scored.select(*df.columns, F.col(f"_scored.{out}")).write.parquet(path)
    seen = run.get
    log = df.sparkSession.createDataFrame(
        [(seen["samples"], seen["started"], seen["ended"], seen["batch_seconds"])],
        "samples long, started double, ended double, batch_seconds double",
    )
    log = log.select("samples", (F.col("ended") - F.col("started")).alias("seconds"), "batch_seconds").withColumns(
        {
            "per_second": F.try_divide("samples", "seconds"),
            "per_second_per_worker": F.try_divide("samples", "batch_seconds"),
        }
    )
    return df.sparkSession.read.parquet(path), log


def _null_safe(make_predict_fn: Callable, return_type: T.DataType) -> Callable:
    def make() -> Callable[[np.ndarray], np.ndarray]:
        predict = make_predict_fn()

        def run(inputs: np.ndarray) -> np.ndarray:
            if inputs.dtype != object:
                return predict(inputs)
            known = np.array([value is not None for value in inputs], dtype=bool)
            if known.all():
                return predict(inputs)
            results = np.full(len(inputs), None, dtype=object)
            if known.any():
                results[known] = list(predict(inputs[known]))
            return results

        return run

    return make
