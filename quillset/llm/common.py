"""What the operators share: state kept by a worker process, and Arrow batches of a few columns."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Functions travel to the workers by value, so a module's own globals would be new in every task.
_STATE = "_quillset_worker_state"


def worker_state(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` returned for ``key`` in this worker process; made once, reused by its later tasks.

    One state is held at a time: workers outlive the stages they serve, so what an earlier operator left goes first.
    """
    held = sys.modules.setdefault(_STATE, ModuleType(_STATE)).__dict__
    if held.get("key") != key:
        release_worker_state()
        held["key"], held["value"] = key, make()
    return held["value"]


def release_worker_state() -> None:
    """Let go of what this worker process holds, as operators do that need none."""
    held = sys.modules.setdefault(_STATE, ModuleType(_STATE)).__dict__
    held.pop("key", None)
    held.pop("value", None)


class Cache(dict):
    """key -> what ``compute`` gives for it, in two generations of about ``limit`` bytes each.

    When the younger one is full it becomes the older one, whose entries come back when they are asked for. Keys of more
    than 64 characters are computed each time.
    """

    def __init__(self, compute: Callable[[str], object], limit: int = 48 << 20):
        super().__init__()
        self.compute, self.limit, self.held, self.older = compute, limit, 0, {}

    def __missing__(self, key: str) -> object:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= 64:
            if self.held >= self.limit:
                self.older, self.held = dict(self), 0
                self.clear()
            # both strings with their headers, and the slot in the table
            self.held += 4 * len(key) + (len(value) if isinstance(value, bytes) else 0) + 190
            self[key] = value
        return value


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add; names are compared without case."""
    new = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new])


def rows_with_keys(df: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``kept``, null as any other, whatever the columns of ``df`` are called."""
    taken = {c.lower() for c in df.columns}
    name = next(n for i in range(len(taken) + 1) if (n := f"kept_{i}") not in taken)
    return df.join(kept.select(F.col(key).alias(name)), F.col(key).eqNullSafe(F.col(name)), "left_semi")


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def in_pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of ``column`` and at most ``rows`` rows, one row at least."""
    for batch in batches:
        if batch.num_rows <= min(rows, 1) or batch.num_rows <= rows and batch.column(column).nbytes <= limit:
            if batch.num_rows:
                yield batch
            continue
        begin, held = 0, 0
        for row, size in enumerate(pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()):
            if row - begin == rows or held and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        yield batch.slice(begin)
