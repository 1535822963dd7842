"""Multinomial regression over hashed token features, trained in steps over blocks of encoded tokens.

A token's features are hashed as ``FeatureHasher`` hashes them, once per distinct word of a block. What a word says by
itself (the word, affixes, shape) is one entry of the block's table; a cell is an entry, its two neighbours and its label.
A step adds the rows of the coefficients that a cell names, so a token costs a few look-ups instead of a vector. What the
labels add to loss and slope is linear in the coefficients, so it is summed once, and cells are told apart without labels.
The loss, the standardisation and the steps are those of Spark ML's regression (L-BFGS with a strong Wolfe search).
"""

from __future__ import annotations

import math
import unicodedata
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.wrapper import JavaParams
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.functions.fixed_values import MASKED_LABEL
from quillset.session import materialise

BLOCK = 1 << 21  # cells of one block; a longer sentence is a block of its own
CHUNK = 1 << 16  # cells whose scores are held at once
HASH_SEED = 42  # of FeatureHasher
MEMORY = 10  # steps that L-BFGS looks back on
WATCHED = 20  # values among which the search looks for progress

_CELLS = ["entry", "previous", "next", "weight", "table"]
_BLOCKS = ", ".join(f"{c} binary" for c in [*_CELLS, "known"])


# ---------------------------------------------------------------- features


def hashed(name: str, values: Sequence[str], dim: int) -> np.ndarray:
    """The place of ``name=value`` among ``dim`` features: Murmur3 of its UTF-8 bytes, as ``FeatureHasher`` takes it."""
    coded, begin = [v.encode() for v in values], f"{name}=".encode()
    lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) + len(begin)
    data = np.frombuffer(begin + begin.join(coded) + bytes(4), dtype=np.uint8).astype(np.uint32)
    starts = np.cumsum(lengths) - lengths
    found = np.full(len(coded), HASH_SEED, dtype=np.uint32)

    def mixed(k: np.ndarray) -> np.ndarray:
        k = k * np.uint32(0xCC9E2D51)
        return ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(0x1B873593)

    order = np.argsort(-lengths, kind="stable")
    whole = lengths[order] // 4
    for i in range(int(whole[0]) if len(order) else 0):
        live = order[: np.searchsorted(-whole, -i, side="left")]  # longest first, so the live ones lead
        at = starts[live] + 4 * i
        k = data[at] | (data[at + 1] << np.uint32(8)) | (data[at + 2] << np.uint32(16)) | (data[at + 3] << np.uint32(24))
        h = found[live] ^ mixed(k)
        found[live] = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64)
    rest, tail = lengths % 4, np.zeros(len(coded), dtype=np.uint32)
    for i in range(3):
        some = np.flatnonzero(rest > i)
        tail[some] |= data[starts[some] + lengths[some] - rest[some] + i] << np.uint32(8 * i)
    found ^= mixed(tail)
    found ^= lengths.astype(np.uint32)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        found = (found ^ (found >> np.uint32(shift))) * np.uint32(factor)
    found ^= found >> np.uint32(16)
    return found.view(np.int32).astype(np.int64) % dim


def shapes_of(tokens: pa.StringArray) -> np.ndarray:
    """Number of each token's shape flag: capital, digit and hyphen as bits."""
    first = pc.utf8_slice_codeunits(tokens, 0, 1).dictionary_encode()
    capital = np.array([unicodedata.category(c) == "Lu" if c else False for c in first.dictionary.to_pylist()], dtype=np.int64)
    digit, hyphen = pc.match_substring_regex(tokens, "[0-9]"), pc.match_substring(tokens, "-")
    bits = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (digit, hyphen)]
    return 4 * capital[first.indices.to_numpy()] + 2 * bits[0] + bits[1]


@dataclass
class Cells:
    """The tokens of some sentences. Places are those of features; ``dim`` stands for a feature that is missing."""

    counts: np.ndarray  # cells of each sentence
    entry: np.ndarray
    previous: np.ndarray
    next: np.ndarray
    table: np.ndarray  # per entry the places of word, prefix, suffix and shape


def cells_of(tokens: pa.ListArray, dim: int, at_least: np.ndarray) -> Cells:
    """Cells of sentences as ``token_features`` has them: one at least, and where labels go on after the last token
    (``at_least``), cells without token and neighbours."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = tokens.flatten().dictionary_encode()
    known = coded.dictionary.to_pylist()
    flat = pc.fill_null(coded.indices, len(known)).to_numpy(zero_copy_only=False).astype(np.int64)

    lowers = [t.lower() for t in known]
    lowered, words = pa.array(lowers, pa.string()).dictionary_encode(), list(dict.fromkeys(lowers))  # both in order of appearance
    nothing, edge = len(words), len(words) + 1
    word_of = np.append(lowered.indices.to_numpy().astype(np.int64), nothing)
    kinds = np.append(shapes_of(coded.dictionary), 0)

    def affixes(name: str, values: pa.StringArray) -> np.ndarray:
        distinct = values.dictionary_encode()  # there are few
        return hashed(name, distinct.dictionary.to_pylist(), dim)[distinct.indices.to_numpy()]

    word = np.append(hashed("word", words, dim), dim)
    prefix = np.append(affixes("prefix", pc.utf8_slice_codeunits(lowered.dictionary, 0, 3)), dim)
    suffix = np.append(affixes("suffix", pc.utf8_slice_codeunits(lowered.dictionary, -3)), dim)
    before, after = (np.concatenate([hashed(n, words, dim), [dim], hashed(n, [""], dim)]) for n in ("previous", "next"))
    shapes = hashed("shape", [c + d + h for c in "cC" for d in "dD" for h in "hH"], dim)

    pairs, entry_of = np.unique(word_of * 8 + kinds, return_inverse=True)
    own = pairs // 8
    table = np.stack([word[own], prefix[own], suffix[own], shapes[pairs % 8]])

    spans = np.maximum(sizes, 1)
    counts = np.maximum(spans, at_least)
    total = int(counts.sum())
    begins = np.cumsum(counts) - counts
    pos = np.arange(total) - np.repeat(begins, counts)
    span = np.repeat(spans, counts)
    cell = np.full(total, len(known), dtype=np.int64)
    cell[pos < np.repeat(sizes, counts)] = flat
    context = word_of[cell]
    left, right = np.full(total, nothing), np.full(total, nothing)
    left[1:], right[:-1] = context[:-1], context[1:]
    left[pos == 0] = edge
    right[pos == span - 1] = edge
    outside = pos >= span
    left[outside] = right[outside] = nothing
    return Cells(counts, entry_of[cell].astype(np.int32), before[left].astype(np.int32), after[right].astype(np.int32), table.astype(np.int32))


def pieces(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows with ``BLOCK`` cells at most, or one row."""
    start = 0
    while start < len(lengths):
        stop, cells = start + 1, lengths[start]
        while stop < len(lengths) and cells + lengths[stop] <= BLOCK:
            cells += lengths[stop]
            stop += 1
        yield start, stop
        start = stop


def blocks(sentences: DataFrame, tokens: str, labels: str, dim: int) -> DataFrame:
    """Encoded cells that have a label, equal ones of a block as one with their number, and what is known of them before the
    first step (``known_sums``). Cells whose label is masked or null go."""
    known = sentences.select(F.col(tokens).alias("tokens"), F.col(labels).cast("array<int>").alias("labels"))
    known = known.filter(F.col("tokens").isNotNull() & F.col("labels").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [pc.list_value_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            for start, stop in pieces(np.maximum(*sizes)):
                texts, marks = (c.slice(start, stop - start) for c in batch.columns)
                given = sizes[1][start:stop]
                cells = cells_of(texts, dim, given)
                label = np.full(len(cells.entry), MASKED_LABEL, dtype=np.int64)
                pos = np.arange(len(label)) - np.repeat(np.cumsum(cells.counts) - cells.counts, cells.counts)
                label[pos < np.repeat(given, cells.counts)] = pc.fill_null(marks.flatten(), MASKED_LABEL).to_numpy(zero_copy_only=False)
                kept = label != MASKED_LABEL
                if not kept.any():
                    continue
                if label[kept].min() < 0:
                    raise ValueError(f"labels are numbers from 0, but there is {label[kept].min()}")
                columns = [c[kept] for c in (cells.entry, cells.previous, cells.next)]
                learned = known_sums(columns, label[kept], cells.table, dim)
                columns, weight = merged(columns, [cells.table.shape[1], dim + 1, dim + 1])
                values = [*stored_block(columns, weight, cells.table, dim), learned.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=[*_CELLS, "known"])

    return known.mapInArrow(run, _BLOCKS)


def place_type(dim: int) -> type:
    return np.uint16 if dim < 1 << 16 else np.int32


def stored_block(columns: list[np.ndarray], weight: np.ndarray, table: np.ndarray, dim: int) -> list[bytes]:
    """A block as it is written: the cells of each entry instead of their entries, and the weights that are not 1."""
    counts = np.bincount(columns[0], minlength=table.shape[1]).astype(np.int32)
    more = np.flatnonzero(weight > 1).astype(np.int32)
    kind = place_type(dim)
    return [counts.tobytes(), *(c.astype(kind).tobytes() for c in columns[1:]), np.stack([more, weight[more]]).tobytes(), table.astype(kind).tobytes()]


def opened_block(dim: int, *stored: pa.Buffer) -> list[np.ndarray]:
    """entry, previous, next, weight and table of a written block."""
    kind = place_type(dim)
    counts, more = np.frombuffer(stored[0], dtype=np.int32), np.frombuffer(stored[3], dtype=np.int32).reshape(2, -1)
    previous, after, table = (np.frombuffer(stored[i], dtype=kind) for i in (1, 2, 4))
    weight = np.ones(len(previous))
    weight[more[0]] = more[1]
    return [np.repeat(np.arange(len(counts), dtype=np.int32), counts), previous, after, weight, table.reshape(4, -1)]


def merged(columns: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order, and how often each comes. Rows that do not fit one number are sorted as they are."""
    if math.prod(sizes) >= 1 << 63:
        order = np.argsort(columns[0], kind="stable")
        return [c[order] for c in columns], np.ones(len(order), dtype=np.int32)
    keys = np.zeros(len(columns[0]), dtype=np.int64)
    for column, size in zip(columns, sizes):
        keys = keys * size + column
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    weight = np.diff(np.append(first, len(keys))).astype(np.int32)
    keys, out = keys[first], []
    for size in reversed(sizes):
        keys, part = np.divmod(keys, size)
        out.append(part.astype(np.int32))
    return out[::-1], weight


# ---------------------------------------------------------------- sums over blocks


def known_sums(columns: list[np.ndarray], label: np.ndarray, table: np.ndarray, dim: int) -> np.ndarray:
    """Per place the pairs of features that a row has there, then for each label the sums of its features and its rows."""
    entry, previous, after = columns
    pairs, width = np.zeros(dim + 1), dim + 1
    own = np.bincount(entry, minlength=table.shape[1])
    for f in range(4):
        for g in range(f):
            pairs += np.bincount(table[f], own * (table[f] == table[g]), width)
        for side in (previous, after):
            pairs += np.bincount(side[table[f][entry] == side], minlength=width)
    pairs += np.bincount(previous[previous == after], minlength=width)
    classes = int(label.max()) + 1
    sums = np.zeros(classes * width)
    begins = label * width
    for place in (*(table[f][entry] for f in range(4)), previous, after):
        sums += np.bincount(begins + place, minlength=classes * width)
    sums = sums.reshape(classes, width)
    sums[:, dim] = np.bincount(label, minlength=classes)
    return np.concatenate([pairs[:dim], sums.ravel()])


def summed(stored: DataFrame, tasks: int, of_block: Callable[..., np.ndarray]) -> np.ndarray:
    """Sum of a vector per row, made of its binary columns: within a task, then in about the root of the number of tasks,
    then here."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in range(batch.num_rows):
                own = of_block(*[column[row].as_buffer() for column in batch.columns])
                total = own if total is None else _added(total, own)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column("total"):
                own = np.frombuffer(value.as_buffer(), dtype=np.float64)
                total = own if total is None else _added(total, own)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    sums = stored.mapInArrow(first, "total binary")
    if tasks > 16:
        sums = sums.repartition(math.ceil(math.sqrt(tasks))).mapInArrow(second, "total binary")
    total = np.zeros(0)
    for row in sums.collect():
        total = _added(total, np.frombuffer(row["total"], dtype=np.float64))
    return total


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of vectors of which one may go on."""
    if len(a) < len(b):
        a, b = b, a
    out = a.copy()
    out[: len(b)] += b
    return out


def loss_and_slope(block: list[np.ndarray], coefficients: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """Of a block, for scores against a column whose score is 0: the sum of the logarithms of the columns' exponentials, the
    columns' chances, and their sums over the features (columns x places). The column of zeros itself is left out."""
    entry, previous, after, weight, table = block
    (size, width), entries = coefficients.shape, table.shape[1]
    by_entry = np.zeros((size, entries))
    for k in range(size):
        for f in range(4):
            by_entry[k] += coefficients[k].take(table[f])
        by_entry[k] += intercepts[k]
    entry_slope, slope, loss = np.zeros((size, entries)), np.zeros((size, width)), 0.0
    for start in range(0, len(entry), CHUNK):
        e, p, a, w = (c[start : start + CHUNK] for c in (entry, previous, after, weight))
        p, a = p.astype(np.intp), a.astype(np.intp)
        begins = np.flatnonzero(np.append(True, e[1:] != e[:-1]))  # entries are in order
        held = e[begins]
        times = np.diff(np.append(begins, len(e)))
        scores = np.empty((size, len(e)))
        for k in range(size):
            row = np.repeat(by_entry[k].take(held), times)
            row += coefficients[k].take(p)
            row += coefficients[k].take(a)
            scores[k] = row
        top = scores.max() if size else 0.0
        shift = np.maximum(scores.max(axis=0), 0.0) if top > 600 else None  # else no exponential is too large
        if shift is not None:
            scores -= shift
        np.exp(scores, out=scores)
        whole = scores.sum(axis=0)
        whole += 1.0 if shift is None else np.exp(-shift)
        loss += float(w @ (np.log(whole) if shift is None else np.log(whole) + shift))
        scores *= w / whole
        for k in range(size):
            entry_slope[k, held] += np.add.reduceat(scores[k], begins)
            slope[k] += np.bincount(p, scores[k], width)
            slope[k] += np.bincount(a, scores[k], width)
    for k in range(size):
        for f in range(4):
            slope[k] += np.bincount(table[f], entry_slope[k], width)
    return np.concatenate([[loss], entry_slope.sum(axis=1), slope.ravel()])


# ---------------------------------------------------------------- training


class SearchFailed(ArithmeticError):
    """A line search found no step."""


def wolfe_step(phi: Callable[[float], tuple[float, float]], value: float, slope: float, first: float) -> float:
    """A step with a sufficient decrease and a flat enough slope, among ten tried and ten between two of them."""
    if slope > 0:
        raise SearchFailed("no descent")

    def between(left: tuple, right: tuple) -> float:
        d1 = left[2] + right[2] - 3 * (left[1] - right[1]) / (left[0] - right[0])
        inside = d1 * d1 - left[2] * right[2]
        d2 = math.sqrt(inside) if inside >= 0 else math.nan
        width, under = right[0] - left[0], right[2] - left[2] + 2 * d2
        t = right[0] - width * (right[2] + d2 - d1) / under if under else math.nan
        low, high = left[0] + 0.1 * width, left[0] + 0.9 * width
        return (left[0] + right[0]) / 2 if math.isnan(t) else min(max(t, low), high)

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(10):
            t = between(high, low) if low[0] > high[0] else between(low, high)
            now = (t, *phi(t))
            if now[1] > value + 1e-4 * t * slope or now[1] >= low[1]:
                high = now
            else:
                if abs(now[2]) <= 0.9 * abs(slope):
                    return t
                if now[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = now
        raise SearchFailed("no step between two")

    t, low = first, (0.0, value, slope)
    for i in range(10):
        now = (t, *phi(t))
        if not math.isfinite(now[1]):
            t /= 2
            continue
        if now[1] > value + 1e-4 * t * slope or (now[1] >= low[1] and i > 0):
            return zoom(low, now)
        if abs(now[2]) <= 0.9 * abs(slope):
            return t
        if now[2] >= 0:
            return zoom(now, low)
        low, t = now, t * 1.5
    raise SearchFailed("no step")


def minimised(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int, tolerance: float = 1e-6) -> np.ndarray:
    """L-BFGS from ``start``: the last point before the steps, the progress or the slope end."""
    x, (value, slope) = start, objective(start)
    first_value, seen, steps, failed, done = value, [math.inf], [], False, 0
    while True:
        if done >= max_iter or np.linalg.norm(slope) <= max(tolerance * value, 1e-8):
            return x
        if len(seen) >= 2 and abs(value - max(seen)) <= tolerance * first_value:
            return x
        try:
            direction, found = slope.copy(), []
            for s, y in steps:
                share = (s @ direction) / (s @ y)
                if math.isnan(share):
                    raise SearchFailed("no number in the steps")
                found.append(share)
                direction -= share * y
            if steps:
                s, y = steps[0]
                if not s @ y >= 0:
                    raise SearchFailed("no curvature")
                direction *= (s @ y) / (y @ y)
            for (s, y), share in zip(reversed(steps), reversed(found)):
                direction += (share - (y @ direction) / (s @ y)) * s
            direction = -direction
            tried: dict[float, tuple[float, np.ndarray]] = {}

            def phi(t: float) -> tuple[float, float]:
                tried.clear()
                tried[t] = objective(x + t * direction)
                return tried[t][0], float(tried[t][1] @ direction)

            t = wolfe_step(phi, value, float(slope @ direction), 1.0 if done else 1.0 / np.linalg.norm(direction))
            if t * np.linalg.norm(slope) < 1e-10:
                raise SearchFailed("step too small")
            after = x + t * direction
            new_value, new_slope = tried[t]
        except SearchFailed:
            if failed:
                return x
            steps, failed = [], True
            continue
        steps = [(after - x, new_slope - slope), *steps][:MEMORY]
        x, value, slope, failed, done = after, new_value, new_slope, False, done + 1
        seen = [*seen, value][-WATCHED:]


def fit_token_regression(
    sentences: DataFrame, tokens: str, labels: str, dim: int, reg_param: float, max_iter: int
) -> LogisticRegressionModel:
    """The regression over the hashed features of all labelled tokens, as a model of Spark ML."""
    spark = sentences.sparkSession
    stored = materialise(blocks(sentences, tokens, labels, dim), "token-cells")
    tasks = stored.rdd.getNumPartitions()
    found = summed(stored.select("known"), tasks, lambda known: np.frombuffer(known, dtype=np.float64))
    if not len(found):
        raise ValueError("no labelled tokens to train on")
    by_label = found[dim:].reshape(-1, dim + 1)
    by_label, histogram = by_label[:, :dim], by_label[:, dim]
    sums = by_label.sum(axis=0)
    squares = sums + 2 * found[:dim]  # a place that two features of a row share counts 2, squared 4: 2 more for each pair
    total, classes = histogram.sum(), len(histogram)
    if (histogram > 0).sum() == 1:  # nothing to learn
        only = np.full(classes, 0.0)
        only[int(histogram.argmax())] = math.inf
        return regression_model(np.zeros((classes, dim)), only)
    mean = sums / total
    spread = np.sqrt(np.maximum((squares - total * mean * mean) / max(total - 1, 1), 0.0))
    scale = np.divide(1.0, spread, out=np.zeros(dim), where=spread > 0)

    # labels that no token has are alike: one column stands for all of them
    absent = np.flatnonzero(histogram == 0)
    columns = [*np.flatnonzero(histogram).tolist(), *absent[:1].tolist()]
    shares = np.where(np.isin(columns, absent), max(len(absent), 1), 1).astype(np.float64)
    column_of = np.full(classes, len(columns) - 1)
    column_of[columns] = np.arange(len(columns))
    cells = stored.select(*_CELLS)

    def plain(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients and intercepts of the features as they are."""
        coefficients = x[: classes * dim].reshape(classes, dim) * scale
        return coefficients, x[classes * dim :] - coefficients @ mean

    def objective(x: np.ndarray) -> tuple[float, np.ndarray]:
        coefficients, intercepts = plain(x)
        # scores are taken against the first column, whose label some token has
        wide = np.pad(coefficients[columns[1:]] - coefficients[columns[0]], ((0, 0), (0, 1)))
        against = intercepts[columns[1:]] + np.log(shares[1:]) - intercepts[columns[0]]
        shipped = spark.sparkContext.broadcast((wide, against))
        out = summed(cells, tasks, lambda *stored: loss_and_slope(opened_block(dim, *stored), *shipped.value))
        shipped.destroy()
        chances, features = out[1 : len(columns)], out[len(columns) :].reshape(len(columns) - 1, dim + 1)[:, :dim]
        chances = np.append(total - chances.sum(), chances) / shares
        features = np.concatenate([[sums - features.sum(axis=0)], features]) / shares[:, None]
        of_labels = histogram @ intercepts + (by_label * coefficients).sum()
        loss = out[0] + total * intercepts[columns[0]] + sums @ coefficients[columns[0]] - of_labels
        by_intercept = (chances[column_of] - histogram) / total
        by_feature = (features[column_of] - by_label) / total
        own = x[: classes * dim]
        slope = ((by_feature - np.outer(by_intercept, mean)) * scale).ravel() + reg_param * own
        return float(loss / total + 0.5 * reg_param * (own @ own)), np.concatenate([slope, by_intercept])

    begin = np.log1p(histogram)
    start = np.concatenate([np.zeros(classes * dim), begin - begin.mean()])
    coefficients, intercepts = plain(minimised(objective, start, max_iter))
    return regression_model(coefficients, intercepts - intercepts.mean())


def regression_model(coefficients: np.ndarray, intercepts: np.ndarray) -> LogisticRegressionModel:
    """A model of Spark ML with these coefficients (classes x features)."""
    classes, dim = coefficients.shape
    matrix = DenseMatrix(classes, dim, coefficients.ravel(), isTransposed=True)
    uid = f"LogisticRegression_{uuid.uuid4().hex[:12]}"
    java = JavaParams._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", uid, matrix, DenseVector(intercepts), classes, True
    )
    return LogisticRegressionModel(java)


# ---------------------------------------------------------------- scoring


def token_chances(
    model: LogisticRegressionModel, sentences: DataFrame, key: str, tokens: str, labels: str | None, out: str
) -> DataFrame:
    """(key, tokens, [labels,] out): per key the cells of its sentences, and one after another the chance of each label.

    Null arrays have no cells. The cells of a key that comes more than once are ordered by position, token and label.
    """
    columns = [tokens, *([labels] if labels else [])]
    known = sentences.select(key, *columns)
    for column in columns:
        known = known.filter(F.col(column).isNotNull())
    parts = known.groupBy(key).agg(F.collect_list(F.struct(*columns)).alias("_parts"))
    dim = model.numFeatures
    lists = [T.StructField(c, T.ArrayType(known.schema[c].dataType.elementType)) for c in columns]  # cells may be null
    schema = T.StructType([known.schema[key], *lists, T.StructField(out, T.ArrayType(T.DoubleType()))])
    shipped = sentences.sparkSession.sparkContext.broadcast((np.pad(model.coefficientMatrix.toArray(), ((0, 0), (0, 1))), model.interceptVector.toArray()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coefficients, intercepts = shipped.value
        for batch in batches:
            lists = batch.column("_parts")
            every = lists.flatten()
            bounds = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
            fields = [every.field(i) for i in range(len(columns))]
            sizes = np.max([pc.list_value_length(f).to_numpy(zero_copy_only=False) for f in fields] + [np.ones(len(every))], axis=0)
            held = np.append(0, np.cumsum(sizes))
            for start, stop in pieces(np.diff(held[bounds])):
                low, high = int(bounds[start]), int(bounds[stop])
                texts = [f.slice(low, high - low) for f in fields]
                given = pc.list_value_length(texts[-1]).to_numpy(zero_copy_only=False).astype(np.int64)
                cells = cells_of(texts[0], dim, given)
                chances = chances_of(cells, coefficients, intercepts)
                ends = np.cumsum(cells.counts)
                cut = np.append(0, ends)[bounds[start : stop + 1] - low]
                values = [filled(t, cells.counts) for t in texts]
                if high - low > stop - start:
                    order = in_order(cells.counts, cut, values, chances)
                    values, chances = [v.take(pa.array(order)) for v in values], chances[order]
                offsets = pa.array(cut, pa.int32())
                arrays = [pa.ListArray.from_arrays(offsets, v) for v in values]
                arrays.append(pa.ListArray.from_arrays(pa.array(cut * len(intercepts), pa.int32()), pa.array(chances.ravel())))
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(start, stop - start), *arrays], names=schema.names)

    return parts.mapInArrow(run, schema)


def chances_of(cells: Cells, coefficients: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """Cells x labels. A label of infinite intercept is certain."""
    if np.isinf(intercepts).any():
        return np.tile(np.isposinf(intercepts).astype(np.float64), (len(cells.entry), 1))
    scores = sum(coefficients[:, cells.table[f]] for f in range(4)).take(cells.entry, axis=1)
    scores += coefficients.take(cells.previous, axis=1)
    scores += coefficients.take(cells.next, axis=1)
    scores += intercepts[:, None]
    scores -= scores.max(axis=0)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=0)
    return np.ascontiguousarray(scores.T)


def filled(lists: pa.ListArray, counts: np.ndarray) -> pa.Array:
    """The values of all lists, each filled up with nulls to its number of cells."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    if (sizes == counts).all():
        return flat
    pos = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    known = pos < np.repeat(sizes, counts)
    return flat.take(pa.array(np.cumsum(known) - 1, mask=~known))


def in_order(counts: np.ndarray, cut: np.ndarray, values: list[pa.Array], chances: np.ndarray) -> np.ndarray:
    """The cells of each stretch between cuts by position, values and chances, nulls first."""
    pos = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    order = np.arange(len(pos))
    begins = np.append(0, np.cumsum(counts))
    for low, high in zip(cut[:-1], cut[1:]):
        if high - low in (0, counts[np.searchsorted(begins, low, side="right") - 1]):
            continue  # one sentence
        rows = [v.slice(low, high - low).to_pylist() for v in values]
        ranked = [[(x is not None, x.encode() if isinstance(x, str) else x or 0) for x in row] for row in rows]
        own = zip(pos[low:high].tolist(), *ranked, chances[low:high].tolist(), range(low, high))
        order[low:high] = [cell[-1] for cell in sorted(own)]
    return order
