"""Tag sequences decoded as wholes: transition weights from training tags, and the best path through each sentence."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.functions.answers import mask_filter
from quillset.operators.rows import explode_rows

NEVER = -1e30  # weight of a step no path may take
CELLS = 1 << 22  # cells of scores and of back pointers held at once; a longer sentence is decoded alone


@dataclass(frozen=True)
class Transitions:
    """Log weights: of a first tag, of a tag after another (row: the earlier one), and of the tags by themselves."""

    first: tuple[float, ...]
    after: tuple[tuple[float, ...], ...]
    prior: tuple[float, ...]


def may_follow(before: str | None, tag: str) -> bool:
    """Whether the tag may stand after ``before`` (None: at the start): I-X only inside a span of X."""
    return not tag.startswith("I-") or (before is not None and before != "O" and before[2:] == tag[2:])


def count_transitions(sentences: DataFrame, tags: str) -> DataFrame:
    """Neighbouring label ids and their number, masked positions taken out: (before, after, n). ``before`` is null for
    a sentence's first label. Null and empty arrays count nothing."""
    kept = sentences.select(F.col(tags).alias("_tags"))
    kept = kept.select(mask_filter(F.col("_tags"), F.col("_tags"))["label"].alias("t")).filter(F.size("t") > 0)
    before = F.concat(F.array(F.lit(None).cast("int")), F.slice("t", 1, F.size("t") - 1).cast("array<int>"))
    pairs = explode_rows(kept, F.arrays_zip(before.alias("before"), F.col("t").cast("array<int>").alias("after")), "p")
    return pairs.groupBy("p.before", "p.after").agg(F.count(F.lit(1)).alias("n"))


def transition_weights(counts: DataFrame, names: Sequence[str], smoothing: float = 1.0) -> Transitions:
    """Smoothed log weights over the steps that BIO tagging allows. There are at most (labels + 1)^2 counts to fetch.

    Steps that the training tags take against the rules, and labels without a name, count for nothing but the prior.
    """
    size = len(names)
    steps = np.full((size + 1, size), float(smoothing))
    prior = np.full(size, float(smoothing))
    for before, after, n in counts.collect():
        if 0 <= after < size:
            prior[after] += n
            if before is None or 0 <= before < size:
                steps[size if before is None else before, after] += n
    allowed = np.array([[may_follow(b, a) for a in names] for b in [*names, None]])
    steps = np.where(allowed, steps, 0.0)
    share = steps / np.maximum(steps.sum(axis=1, keepdims=True), 1e-300)
    weights = np.where(allowed & (share > 0), np.log(np.maximum(share, 1e-300)), NEVER)
    return Transitions(
        tuple(weights[size].tolist()), tuple(map(tuple, weights[:size].tolist())), tuple(np.log(prior / prior.sum()).tolist())
    )


def best_paths(chances: list[np.ndarray], weights: Transitions) -> list[np.ndarray]:
    """The path of the largest sum of log(chance / prior) and step weights, per sentence (tokens x labels). Of equal
    paths, the one with the smaller label at the last place where they differ."""
    first, after = np.array(weights.first), np.array(weights.after)
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(chances)
    order = sorted((i for i in range(len(chances)) if len(chances[i])), key=lambda i: len(chances[i]), reverse=True)
    at = 0
    while at < len(order):
        longest = len(chances[order[at]])
        block = order[at : at + max(1, CELLS // (longest * len(first)))]
        at += len(block)
        lengths = np.array([len(chances[i]) for i in block])
        scores = np.full((longest, len(block), len(first)), 0.0)
        for j, i in enumerate(block):
            scores[: lengths[j], j] = np.log(np.maximum(chances[i], math.exp(-700))) - np.array(weights.prior)
        back = np.zeros(scores.shape, np.int16)
        total = scores[0] + first
        ended = total.copy()
        for t in range(1, longest):
            live = int((lengths > t).sum())  # longest first, so the live ones lead
            steps = total[:live, :, None] + after
            back[t, :live] = steps.argmax(axis=1)
            total[:live] = steps.max(axis=1) + scores[t, :live]
            ended[:live] = total[:live]
        for j, i in enumerate(block):
            path = np.zeros(lengths[j], np.int64)
            path[-1] = ended[j].argmax()
            for t in range(lengths[j] - 1, 0, -1):
                path[t - 1] = back[t, j, path[t]]
            found[i] = path
    return found


def decode(sentences: DataFrame, chances: str, weights: Transitions, out: str = "path", score: str = "scores") -> DataFrame:
    """Add the label ids of the best path and the chance of each label on it.

    ``chances`` holds a sentence's chances token after token in one array. A null array gives null, an empty one empty
    arrays. A task holds one batch of sentences at a time; a sentence is as long as its own row.
    """
    size = len(weights.first)
    schema = T.StructType(
        [*sentences.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType())), T.StructField(score, T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = [len(row.values) if row.is_valid else 0 for row in batch.column(chances)]
            start = 0
            while start < len(lengths):
                stop, cells = start + 1, lengths[start]
                while stop < len(lengths) and cells + lengths[stop] <= CELLS:
                    cells += lengths[stop]
                    stop += 1
                piece, start = batch.slice(start, stop - start), stop
                rows = list(piece.column(chances))
                grids = [np.asarray(row.values if row.is_valid else [], np.float64).reshape(-1, size) for row in rows]
                paths = best_paths(grids, weights)
                ids = [path.tolist() if row.is_valid else None for path, row in zip(paths, rows)]
                own = [grid[np.arange(len(path)), path].tolist() if row.is_valid else None for grid, path, row in zip(grids, paths, rows)]
                columns = [*piece.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(own, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*piece.schema.names, out, score])

    return sentences.mapInArrow(run, schema)
