"""Metrics of the user's own, computed in two phases: a state per task and group, then states merged into one."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.functions.fixed_values import INVALID_CHOICE

MOST_GROUPS = 10_000  # states a task holds; beyond that it hands them on and starts anew


class Metric(Protocol):
    """``merge`` gives the same state in whatever order states are merged; ``update`` and ``merge`` may change and return
    their first argument. States are plain picklable values of bounded size."""

    columns: Sequence[str]  #: what it reads
    schema: str  #: what ``finish`` returns, as DDL

    def start(self) -> Any: ...

    def update(self, state: Any, rows: pd.DataFrame) -> Any: ...

    def merge(self, state: Any, other: Any) -> Any: ...

    def finish(self, state: Any) -> list[tuple]: ...


class ChoiceTally:
    """Accuracy, error rate and share of invalid answers, as ``metrics.choice_scores`` has them."""

    schema = "accuracy double, error_rate double, invalid_rate double"

    def __init__(self, truth: str = "cop", prediction: str = "prediction"):
        self.columns = [truth, prediction]

    def start(self) -> list[int]:
        return [0, 0, 0]

    def update(self, state: list[int], rows: pd.DataFrame) -> list[int]:
        truth, prediction = rows[self.columns[0]], rows[self.columns[1]]
        right = (truth == prediction) & truth.notna() & prediction.notna()
        return self.merge(state, [len(rows), int(right.sum()), int((prediction == INVALID_CHOICE).sum())])

    def merge(self, state: list[int], other: list[int]) -> list[int]:
        return [a + b for a, b in zip(state, other)]

    def finish(self, state: list[int]) -> list[tuple]:
        n, right, invalid = state
        return [(right / n, (n - right) / n, invalid / n) if n else (None, None, None)]


def custom_metric(df: DataFrame, metric: Metric, by: Sequence[str] = (), fan_in: int = 64) -> DataFrame:
    """Rows of ``metric.finish`` per group: (by..., metric's columns). Null keys make a group of their own.

    Rows never leave their tasks, only states do, and those are merged in two steps, so that no task gets the states of
    all others. Without ``by`` an empty table gives what ``finish`` makes of ``start``.
    """
    # pandas knows neither null among numbers nor null beside NaN, so a number travels with a flag: 1 null, 2 NaN
    named, restored, key_fields = [], [], []
    for i, name in enumerate(by):
        kind, key = df.schema[name].dataType, f"_k{i}"
        key_fields.append(T.StructField(key, kind))
        if isinstance(kind, T.NumericType):
            real = isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType)
            flag = F.when(F.isnull(name), 1).when(F.isnan(name) if real else F.lit(False), 2).otherwise(0)
            named += [F.when(flag == 0, F.col(name)).otherwise(F.lit(0).cast(kind)).alias(key), flag.alias(f"_n{i}")]
            key_fields.append(T.StructField(f"_n{i}", T.IntegerType()))
            nan = F.when(F.col(f"_n{i}") == 2, F.lit("NaN").cast(kind)) if real else F.lit(None).cast(kind)
            restored.append(F.when(F.col(f"_n{i}") == 0, F.col(key)).otherwise(nan).alias(name))
        else:
            named.append(F.col(name).alias(key))
            restored.append(F.col(key).alias(name))
    keys = [field.name for field in key_fields]
    numbers = [isinstance(field.dataType, T.NumericType) for field in key_fields]
    inputs = df.select(*named, *[F.col(c) for c in metric.columns])
    state_schema = T.StructType([*key_fields, T.StructField("_state", T.BinaryType())])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[tuple, Any] = {}

        def out() -> pd.DataFrame:
            return pd.DataFrame([(*key, pickle.dumps(state)) for key, state in states.items()], columns=[*keys, "_state"])

        for batch in batches:
            groups = batch.groupby(keys, dropna=False, sort=False) if keys else [((), batch)]
            for key, rows in groups:
                key = tuple(k if number or not pd.isna(k) else None for k, number in zip(key, numbers))
                state = states.get(key)
                state = metric.start() if state is None else state
                states[key] = metric.update(state, rows[list(metric.columns)].reset_index(drop=True))
            if len(states) > MOST_GROUPS:
                yield out()
                states.clear()
        if states:
            yield out()

    def merged(pickles: Sequence[bytes]) -> Any:
        state = pickle.loads(pickles[0])
        for other in pickles[1:]:
            state = metric.merge(state, pickle.loads(other))
        return state

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows[keys].iloc[:1].reset_index(drop=True)
        return head.assign(_state=[pickle.dumps(merged(rows["_state"].tolist()))])

    values = T.StructType.fromDDL(metric.schema)
    names = [f.name for f in values.fields]

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame(metric.finish(merged(rows["_state"].tolist())), columns=names, dtype=object)
        for at, key in enumerate(keys):
            found.insert(at, key, [rows[key].iloc[0]] * len(found))
        return found

    states = inputs.mapInPandas(partial, state_schema)
    if not by:
        blank = df.sparkSession.createDataFrame([(pickle.dumps(metric.start()),)], state_schema)
        states = states.unionByName(blank)
    bucket = (F.spark_partition_id() % fan_in).alias("_bucket")
    first = states.withColumn("_bucket", bucket).groupBy(*keys, "_bucket").applyInPandas(combine, state_schema)
    result = first.groupBy(*keys).applyInPandas(finish, T.StructType([*key_fields, *values.fields]))
    return result.select(*restored, *names)
