"""Exact and approximate nearest neighbours over dense vectors by angular distance.

All searches share one kernel: inside a task a block of queries meets a block of items as a matrix product and only
the best ``k`` items per query leave the task. Pairs are never written out.

* ``knn_exact`` with few queries ships them to the tasks that scan the items: no shuffle of vectors. With many
  queries both sides are cut into blocks of bounded size, and a task holds a block of each (``in_cells``).

Approximate search over a written index is in ``forest``; it uses the same kernel.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.operators.ranks import top_k_per_query
from quillset.session import broadcast_if_small, fits_broadcast, materialise

QUERY_BLOCK = 1024
ITEM_BLOCK = 8192
DISTANCE_DIGITS = 6  # equal vectors must tie whatever the order of additions, so distances are rounded

#: Queries and items of one cell. Items beyond four blocks make the blocks larger, up to the second number; so do queries
#: beyond the third number of blocks, up to eight times the first, where they come without bits and get few answers.
CELL_QUERIES, CELL_ITEMS, CELL_ROWS, FEW_ANSWERS = 4096, (32_768, 131_072), 24, 64
#: Queries and items that meet as one matrix inside a cell.
STEP_QUERIES, STEP_ITEMS = 256, 4096
#: Similarities this close may be equal as rounded distances.
NEAR = 4e-6

_HITS = "query_id bigint, item_id bigint, distance double"


# ---------------------------------------------------------------- kernel


def _matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows scaled to length 1 as a float64 matrix; zero rows stay zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = len(vectors)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if rows == 0:
        return flat.reshape(0, 0)
    matrix = flat.reshape(rows, -1)
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(lengths == 0, 1.0, lengths)


def _distances(queries: np.ndarray, items: np.ndarray) -> np.ndarray:
    return np.round(np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (queries @ items.T))), DISTANCE_DIGITS)


def _best(distances: np.ndarray, item_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item id, distance) of the k nearest per row, ties by item id."""
    rows, cols = [], []
    width = distances.shape[1]
    if width > k:
        bound = np.partition(distances, k - 1, axis=1)[:, k - 1]
    else:
        bound = np.full(len(distances), np.inf)
    for row in range(len(distances)):
        near = np.flatnonzero(distances[row] <= bound[row])
        order = np.lexsort((item_ids[near], distances[row][near]))[:k]
        rows.append(np.full(len(order), row))
        cols.append(near[order])
    if not rows:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, np.empty(0)
    row, col = np.concatenate(rows), np.concatenate(cols)
    return row, item_ids[col], distances[row, col]


def _hits(query_ids: np.ndarray, row: np.ndarray, items: np.ndarray, distances: np.ndarray) -> dict:
    return {
        "query_id": pa.array(query_ids[row], pa.int64()),
        "item_id": pa.array(items, pa.int64()),
        "distance": pa.array(distances, pa.float64()),
    }


# ---------------------------------------------------------------- exact


def knn_exact(queries: DataFrame, items: DataFrame, k: int = 10, max_queries: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` nearest items of every query: (query_id, item_id, distance, rank).

    ``queries`` is (query_id, vector), ``items`` (item_id, vector).
    """
    if fits_broadcast(queries, max_queries):
        local = _scan_with_queries(queries, items, k)
    else:
        local = in_cells(queries.select("query_id", "vector"), items.select("item_id", "vector"), cell_top_k(k), _HITS, k > FEW_ANSWERS)
    return top_k_per_query(local, k)


def _scan_with_queries(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    rows = queries.select("query_id", "vector").collect()  # at most one query block
    query_ids = np.array([r["query_id"] for r in rows], dtype=np.int64)
    query_matrix = _matrix(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())))
    shipped = items.sparkSession.sparkContext.broadcast((query_ids, query_matrix))

    def scan(batches):
        ids, matrix = shipped.value
        best_items = best_distances = None
        for batch in batches:
            if batch.num_rows == 0 or len(ids) == 0:
                continue
            item_ids = batch.column("item_id").to_numpy(zero_copy_only=False)
            for start in range(0, len(item_ids), ITEM_BLOCK):
                part = batch.slice(start, ITEM_BLOCK)
                distances = _distances(matrix, _matrix(part.column("vector")))
                row, found, near = _best(distances, item_ids[start : start + ITEM_BLOCK], k)
                width = len(row) // len(ids)
                found, near = found.reshape(len(ids), width), near.reshape(len(ids), width)
                if best_items is not None:
                    found, near = np.hstack([best_items, found]), np.hstack([best_distances, near])
                keep = np.lexsort((found, near), axis=1)[:, :k]
                best_items = np.take_along_axis(found, keep, axis=1)
                best_distances = np.take_along_axis(near, keep, axis=1)
        if best_items is not None:
            row = np.repeat(np.arange(len(ids)), best_items.shape[1])
            yield pa.RecordBatch.from_pydict(_hits(ids, row, best_items.ravel(), best_distances.ravel()))

    return items.select("item_id", "vector").mapInArrow(scan, _HITS)


def in_cells(
    queries: DataFrame, items: DataFrame, meet: Callable[[pa.Table, pa.Table], pa.Table], schema: str, wide: bool = False
) -> DataFrame:
    """``meet`` of every block of ``queries`` with every block of ``items``; rows are dealt to their blocks by the hash of
    ``query_id`` and ``item_id``. Rows without an id take no part. Blocks of ``wide`` queries stay small.

    Both sides are counted, and each row is sent once per block of the other side, so hand in written tables.
    """
    queries, items = queries.filter("query_id is not null"), items.filter("item_id is not null")
    n_queries, n_items = queries.count(), items.count()
    q_size = CELL_QUERIES if wide else min(max(CELL_QUERIES, math.ceil(n_queries / CELL_ROWS)), 8 * CELL_QUERIES)
    i_blocks = max(1, math.ceil(n_items / min(max(CELL_ITEMS[0], n_items // 4), CELL_ITEMS[1])))
    at_once = 4 * queries.sparkSession.sparkContext.defaultParallelism
    q_blocks = max(1, math.ceil(n_queries / q_size), min(math.ceil(at_once / i_blocks), math.ceil(n_queries / STEP_QUERIES)))

    def dealt(side: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        placed = side.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    left = dealt(queries, "query_id", "_q", q_blocks, "_i", i_blocks)
    right = dealt(items, "item_id", "_i", i_blocks, "_q", q_blocks)
    return left.groupBy("_q", "_i").cogroup(right.groupBy("_q", "_i")).applyInArrow(meet, schema)


def cell_top_k(k: int, held_of: Callable | None = None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For ``in_cells``: the ``k`` nearest items of the block per query, ties by item id.

    ``held_of(query_rows, item_rows)`` yields (queries, held), held(items) telling which of these each of those may find.
    """

    def meet(query_rows: pa.Table, item_rows: pa.Table) -> pa.Table:
        none = np.empty(0, dtype=np.int64)
        if not query_rows.num_rows or not item_rows.num_rows:
            return pa.table(_hits(none, none, none, np.empty(0)))
        query_ids, item_ids = query_rows.column("query_id").to_numpy(), item_rows.column("item_id").to_numpy()
        queries, items = _matrix(query_rows.column("vector")), _matrix(item_rows.column("vector"))
        rough = items.astype(np.float32)
        if held_of is None:
            steps = ((slice(a, a + STEP_QUERIES), None) for a in range(0, len(queries), STEP_QUERIES))
        else:
            steps = held_of(query_rows, item_rows)
        found = [(none, none, np.empty(0))]
        for some, held in steps:
            row, col, near = _best_of_steps(queries[some], items, rough, item_ids, k, held)
            found.append((row + some.start, col, near))
        row, col, near = (np.concatenate(parts) for parts in zip(*found))
        return pa.table(_hits(query_ids, row, item_ids[col], near))

    return meet


def _best_of_steps(
    queries: np.ndarray, items: np.ndarray, rough: np.ndarray, item_ids: np.ndarray, k: int, held: Callable | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of the k nearest per query. Items pass by in steps; what cannot be among the k nearest so far
    is left out by its similarity in single precision (``rough`` holds the items so), the rest is measured in double.
    """
    # what rounding of the coordinates and of each product and sum can make of a similarity of vectors of length 1
    off = 1.1 * (queries.shape[1] + 8) * 2.0**-24
    asked = queries.astype(np.float32)
    bound, least = np.full(len(queries), -1.5), np.full((len(queries), 1), -2.0, dtype=np.float32)
    best = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))
    waiting, n_waiting = [best], 0
    for start in range(0, len(items), STEP_ITEMS):
        part = slice(start, min(start + STEP_ITEMS, len(items)))
        may = None if held is None else held(part)
        if may is not None and not may.any():
            continue
        like = asked @ rough[part].T
        if may is not None:
            np.copyto(like, -3.0, where=~may)
        near = like >= least
        if like.shape[1] > k and np.count_nonzero(near) > 8 * k * len(queries):
            bound = np.maximum(bound, np.partition(like, -k, axis=1)[:, -k].astype(np.float64) - off - NEAR)
            least = _below(bound - off)
            near = like >= least
        flat = np.flatnonzero(near)
        if not len(flat):
            continue
        row, col = np.divmod(flat, like.shape[1])
        waiting.append((row, col + start, _similarities(queries, items[part], row, col)))
        n_waiting += len(flat)
        if 2 * n_waiting >= k * len(queries):
            best = _k_best(waiting, item_ids, k)
            waiting, n_waiting = [best], 0
            first = np.searchsorted(best[0], np.arange(len(queries) + 1))
            full = np.diff(first) >= k
            bound[full] = np.maximum(bound[full], best[2][first[:-1][full] + k - 1] - NEAR)
            least = _below(bound - off)
    rows, cols, sims = _k_best(waiting, item_ids, k)
    return rows, cols, _as_distances(sims)


def _below(bound: np.ndarray) -> np.ndarray:
    return np.nextafter(bound.astype(np.float32), np.float32(-4.0))[:, None]


def _as_distances(sims: np.ndarray) -> np.ndarray:
    return np.round(np.sqrt(np.maximum(0.0, 2.0 - 2.0 * sims)), DISTANCE_DIGITS)


def _similarities(queries: np.ndarray, items: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Of the pairs (row, col): all pairs at once where they are many, else pair by pair, some millions of numbers at a time."""
    if 16 * len(row) > len(queries) * len(items):
        return (queries @ items.T)[row, col]
    step = max(1, (1 << 22) // max(1, queries.shape[1]))
    parts = [np.einsum("ij,ij->i", queries[row[i : i + step]], items[col[i : i + step]]) for i in range(0, len(row), step)]
    return np.concatenate(parts)


def _k_best(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], item_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, similarity): the ``k`` of each row that come first by rounded distance and item id, in that order."""
    rows, cols, sims = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((item_ids[cols], _as_distances(sims), rows))
    rows, cols, sims = rows[order], cols[order], sims[order]
    kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[kept], cols[kept], sims[kept]


def block_top_k(
    queries: DataFrame,
    items: DataFrame,
    groups: list[str],
    query_vectors: DataFrame,
    item_vectors: DataFrame,
    k: int,
    query_block: int = QUERY_BLOCK,
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """Nearest items of each query among the items of the same group, at most ``k`` rows per query and block.

    Groups larger than a block are cut by id hash on both sides, and every query block meets every item block of its
    group, so a task holds two blocks at most, however large the group. ``queries`` is (*groups, query_id), ``items``
    (*groups, item_id); the vectors join in by id once the blocks are known.
    """

    def blocks(side: DataFrame, size: int, name: str) -> DataFrame:
        count = F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int")
        return side.groupBy(*groups).agg(count.alias(name))

    sizes = blocks(queries, query_block, "_nq").join(blocks(items, item_block, "_ni"), groups)
    # one row per group; shipped when few, so that a crowded group is not gathered by its key before it is cut
    sizes = broadcast_if_small(materialise(sizes, "block-sizes"))

    def spread(side: DataFrame, vectors: DataFrame, key: str, own: str, own_count: str, other: str, other_count: str):
        place = F.pmod(F.xxhash64(key), F.col(own_count)).cast("int").alias(own)
        copies = F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)).alias(other)
        placed = side.join(sizes, groups).select(*groups, key, place, copies)
        return placed.join(vectors.select(key, "vector"), key)

    cells = [*groups, "_q", "_i"]
    left = spread(queries, query_vectors, "query_id", "_q", "_nq", "_i", "_ni")
    right = spread(items, item_vectors, "item_id", "_i", "_ni", "_q", "_nq")

    def nearest(query_rows: pa.Table, item_rows: pa.Table) -> pa.Table:
        if query_rows.num_rows == 0 or item_rows.num_rows == 0:
            empty = np.empty(0, dtype=np.int64)
            return pa.table(_hits(empty, empty, empty, np.empty(0)))
        query_ids = query_rows.column("query_id").to_numpy()
        item_ids = item_rows.column("item_id").to_numpy()
        distances = _distances(_matrix(query_rows.column("vector")), _matrix(item_rows.column("vector")))
        row, found, near = _best(distances, item_ids, k)
        return pa.table(_hits(query_ids, row, found, near))

    return left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(nearest, _HITS)


# ---------------------------------------------------------------- centroids


def class_centroids(df: DataFrame, label: str, vector: str = "vector") -> DataFrame:
    """Mean vector per class: (label, vector). Each task sends one partial mean per class."""
    dense = df.select(F.col(label).alias("label"), array_to_vector(F.col(vector).cast(T.ArrayType(T.DoubleType()))).alias("v"))
    return dense.groupBy("label").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("vector"))
