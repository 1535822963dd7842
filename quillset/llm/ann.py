"""Nearest neighbours by inner product: inverted lists, scanned in blocks of dimensions with early abandoning.

Vectors get one more coordinate that brings them to a common length; the largest inner product is then the smallest
distance. A random rotation spreads the length of a difference evenly over the coordinates, so the distance over the first
d of D coordinates, times D / d, estimates the whole. A candidate whose estimate exceeds the distance of the k-th best so
far by more than the tested margin is abandoned; the rest read the next block. What is left is scored on the original
vectors in double precision.

The index is scanned in slices drawn by a hash of the id, each RATIO times as large as all before it. The k-th best of the
slices before bounds the next, so about RATIO * k candidates a query leave a slice, however many vectors there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quillset.session import materialise

#: Vectors that the lists' centres are fitted on, drawn by a hash of the id, and rounds of fitting.
SAMPLE, ROUNDS, SEED = 20_000, 10, 7
#: Vectors of a list in the mean, the most lists; share of the lists that a query probes, and the least number.
LIST_ROWS, MOST_LISTS, PROBED, LEAST_PROBED = 1024, 4096, 0.75, 24
#: Dimensions of a block, and the margin of the test: an estimate may exceed the bound by MARGIN / sqrt(d) of itself.
DIMENSIONS, MARGIN = 16, 2.1
#: Rows of the sample that give every query its first bound, and the growth of what is scanned from slice to slice.
PILOT, RATIO = 2000, 4
#: Rows of a list that are scanned in one task.
BLOCK = 4096


def usable(vector: str) -> Column:
    """Not null, not zero, and no component null or not finite; as doubles."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def centres_of(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centres by k-means from rows spread over the sample."""
    lists = max(1, min(lists, len(sample)))
    centres = sample[np.linspace(0, len(sample) - 1, lists).astype(int)].copy()
    for _ in range(ROUNDS):
        near = nearest(sample, centres)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=lists)
        np.add.at(sums, near, sample)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1)[None, :] - 2 * rows @ centres.T, axis=1)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def exact(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of rows side by side, each summed in one order whatever the rows around it."""
    return np.ascontiguousarray(rows * queries).sum(axis=1)


def first_of_each(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each group: largest score, then smallest id."""
    order = np.lexsort((ids, -scores, groups))
    sorted_groups = groups[order]
    begins = np.searchsorted(sorted_groups, sorted_groups, side="left")
    return order[np.arange(len(order)) - begins < k]


def scanned(queries: np.ndarray, own: np.ndarray, bounds: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position of query, position of row) of one list that are not abandoned.

    ``queries`` and ``rows`` are rotated, ``bounds`` are squared distances to beat. A first few rows are known in full and
    may lower a bound; the others are read block of dimensions by block and dropped by the test.
    """
    size = queries.shape[1]
    if len(rows) > 4 * k:
        first = rows[: 4 * k]
        whole = (queries**2).sum(1)[:, None] + (first**2).sum(1)[None, :] - 2 * queries @ first.T
        bounds = np.minimum(bounds, np.partition(whole, k, axis=1)[:, k])  # one more than k: the query itself may be among them
    block = slice(0, min(DIMENSIONS, size))
    partial = (queries[:, block] ** 2).sum(1)[:, None] + (rows[:, block] ** 2).sum(1)[None, :] - 2 * queries[:, block] @ rows[:, block].T
    q, r = np.nonzero((own[:, None] != ids[None, :]) & (partial * (size / block.stop) <= allowed(bounds, block.stop, size)[:, None]))
    partial = partial[q, r]
    for begin in range(block.stop, size, DIMENSIONS):
        end = min(size, begin + DIMENSIONS)
        partial = partial + ((queries[q, begin:end] - rows[r, begin:end]) ** 2).sum(axis=1)
        keep = partial * (size / end) <= allowed(bounds, end, size)[q]
        q, r, partial = q[keep], r[keep], partial[keep]
    return q, r


def allowed(bounds: np.ndarray, read: int, size: int) -> np.ndarray:
    """What an estimate from ``read`` of ``size`` dimensions may be for a candidate to stay."""
    return bounds * ((1 + MARGIN / np.sqrt(read)) ** 2 if read < size else 1 + 1e-9) + 1e-12


def search(
    vectors: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", lists: int | None = None, probed: float = PROBED
) -> DataFrame:
    """For the rows that ``queries`` holds for: query_id, rank, vec_id, score of the k nearest others that are found.

    Every usable vector is in the index; its length is that of most vectors. Vectors that are null, zero, of another length
    or have a null or infinite component take no part. Equal scores go to the smaller key. With fewer than k candidates a
    query gets all of them: lists are probed nearest first until they hold k others, at least a share ``probed`` of them.
    Keys are unique integers. Lists longer than BLOCK are scanned in several tasks.
    """
    spark = vectors.sparkSession
    fine = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), usable(vector).alias("ok"), queries.alias("asks")).filter("ok AND id IS NOT NULL")
    sizes = fine.groupBy(F.size("v").alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm")
    ).orderBy(F.desc("n"), "size").first()
    out = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], out)
    size, total, norm = sizes["size"], sizes["n"], float(sizes["norm"])
    fine = fine.filter(F.size("v") == size)
    drawn = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < min(1.0, SAMPLE / total) * (1 << 30)
    drawn_rows = fine.filter(drawn).select("v", "id").collect() or fine.select("v", "id").head(1)
    sample = np.array([r[0] for r in drawn_rows], dtype=np.float64)
    some = slice(None, None, max(1, len(sample) // PILOT))
    first_ids, first_rows = np.array([r[1] for r in drawn_rows], dtype=np.int64)[some][:PILOT], sample[some][:PILOT]
    turn = rotation(size + 1)

    def lifted(rows: np.ndarray, is_query: bool) -> np.ndarray:
        last = np.zeros(len(rows)) if is_query else np.sqrt(np.maximum(0, norm - (rows**2).sum(axis=1)))
        return np.column_stack((rows, last)) @ turn

    count = lists or min(-(-total // LIST_ROWS), MOST_LISTS)
    sent = spark.sparkContext.broadcast(centres_of(lifted(sample, False), count))  # at most 4096 centres
    count = len(sent.value)
    pilot = spark.sparkContext.broadcast((first_ids, first_rows, lifted(first_rows, False)))  # at most PILOT rows

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("v"))
            near = nearest(lifted(rows, False), sent.value) if len(rows) else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], names=["id", "v", "asks", "list"])

    index = materialise(fine.select("id", "v", "asks").mapInArrow(assign, "id long, v array<double>, asks boolean, list int"), "ann-index")
    held = {r[0]: r[1] for r in index.groupBy("list").count().collect()}  # as many rows as lists
    filled = np.array([held.get(i, 0) for i in range(count)])
    least = max(1, min(count, max(LEAST_PROBED, int(np.ceil(probed * count)))))
    asking = index.filter("asks").select("id", "v")
    place = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30))

    def level(low: float, high: float, found: DataFrame) -> DataFrame:
        """Candidates from the slice of the index between two shares; ``found`` bounds them."""
        # lists that hold few rows of a small slice are read together
        width = max(1, int(count * LIST_ROWS / max(1.0, (high - low) * total)))
        units = np.bincount(np.arange(count) // width, weights=filled * (high - low))
        blocks = np.maximum(1, np.ceil(units / BLOCK)).astype(np.int64)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = matrix(batch.column("v"))
                if not len(rows):
                    continue
                far = (sent.value**2).sum(1)[None, :] - 2 * lifted(rows, True) @ sent.value.T
                worst = batch.column("worst").to_numpy(zero_copy_only=False)
                bounds = np.where(np.isnan(worst), np.inf, (rows**2).sum(axis=1) + norm - 2 * worst)
                asked, places, parts = [], [], []
                for at, order in enumerate(np.argsort(far, axis=1)):
                    enough = int(np.searchsorted(np.cumsum(filled[order]), k + 1)) + 1
                    chosen = order[: max(least, enough)]
                    chosen = np.unique(chosen[filled[chosen] > 0] // width)
                    parts += [np.arange(n) for n in blocks[chosen]]
                    chosen = np.repeat(chosen, blocks[chosen])
                    asked.append(np.full(len(chosen), at))
                    places.append(chosen)
                asked = np.concatenate(asked)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(parts).astype(np.int32)), batch.column("id").take(pa.array(asked)),
                        batch.column("v").take(pa.array(asked)), pa.array(np.ones(len(asked), dtype=bool)), pa.array(bounds[asked]),
                    ],
                    names=["unit", "part", "id", "v", "asks", "bound"],
                )

        worst = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("worst"))
        asked = asking.join(worst, F.col("id") == F.col("query_id"), "left").select("id", "v", "worst")
        asked = asked.mapInArrow(probe, "unit int, part int, id long, v array<double>, asks boolean, bound double")
        unit = F.floor(F.col("list") / width).cast("int")
        parts_of = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), unit + 1)
        part = F.pmod(F.xxhash64("id"), parts_of).cast("int")
        rows = index.filter((place >= int(low * (1 << 30))) & (place < int(high * (1 << 30))))
        rows = rows.select(unit.alias("unit"), part.alias("part"), "id", "v", F.lit(False).alias("asks"), F.lit(0.0).alias("bound"))
        dealt = rows.unionByName(asked).repartition("unit", "part").sortWithinPartitions("unit", "part", "asks")
        return dealt.mapInArrow(scan, shape)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(ids: list[int], vs: list[np.ndarray], asked: list[tuple[int, np.ndarray, float]]) -> pa.RecordBatch:
            keys, originals = np.array(ids, dtype=np.int64), np.array(vs)
            own, queries, bounds = np.array([a[0] for a in asked], dtype=np.int64), np.array([a[1] for a in asked]), np.array([a[2] for a in asked])
            q, r = scanned(lifted(queries, True), own, bounds, lifted(originals, False), keys, k)
            scores = exact(originals[r], queries[q])
            top = first_of_each(q, scores, keys[r], k)
            return pa.RecordBatch.from_arrays([pa.array(own[q[top]]), pa.array(keys[r[top]]), pa.array(scores[top])], names=["query_id", "vec_id", "score"])

        def stream() -> Iterator[tuple]:
            for batch in batches:
                if batch.num_rows:
                    yield from zip(*(batch.column(c).to_pylist() for c in ("unit", "part", "asks", "bound", "id")), matrix(batch.column("v")))

        for _, group in groupby(stream(), key=lambda r: r[:2]):
            ids, vs, asked = [], [], []
            for _, _, asks, bound, key_, v in group:
                if not asks:
                    ids.append(key_)
                    vs.append(v)
                else:
                    asked.append((key_, v, bound))
                    if len(asked) >= 256 and ids:
                        yield results(ids, vs, asked)
                        asked = []
            if ids and asked:
                yield results(ids, vs, asked)

    def of_pilot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, originals, known = pilot.value
        for batch in batches:
            rows = matrix(batch.column("v"))
            own = batch.column("id").to_numpy()
            far = (known**2).sum(1)[None, :] - 2 * lifted(rows, True) @ known.T if len(rows) else np.zeros((0, len(keys)))
            most = min(k + 1, len(keys))
            q, r = np.repeat(np.arange(len(rows)), most), np.argpartition(far, most - 1, axis=1)[:, :most].ravel()
            other = own[q] != keys[r]
            q, r = q[other], r[other]
            scores = exact(originals[r], rows[q]) if len(q) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(keys[r]), pa.array(scores)], names=["query_id", "vec_id", "score"])

    def best(found: DataFrame) -> DataFrame:
        """The k best of each query; a pair found twice has one score, hence one rank."""
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k).dropDuplicates(["query_id", "vec_id"])

    shape = "query_id long, vec_id long, score double"
    shares = [1.0]
    while total * shares[0] / RATIO > PILOT:
        shares.insert(0, shares[0] / RATIO)
    # the rows behind the first bounds are results too, so that a bound never leaves a query with fewer than k
    found = best(asking.mapInArrow(of_pilot, shape))
    for low, high in zip([0.0, *shares], shares):
        found = materialise(found.drop("rank"), "ann-found")
        found = best(level(low, high, found).unionByName(found))
    return found.select("query_id", "rank", "vec_id", "score")
