"""The exact search of many queries: blocks of queries meet blocks of items."""

import numpy as np
import pyarrow as pa

from quillset.operators import nearest


def frame(spark, matrix, key):
    vectors = pa.array(list(np.asarray(matrix, dtype=np.float32)), pa.list_(pa.float32()))
    return spark.createDataFrame(pa.table({key: pa.array(range(len(matrix)), pa.int64()), "vector": vectors})).repartition(4)


def test_items_are_sent_to_a_bounded_number_of_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL_QUERIES", 4)
    points = frame(spark, np.random.default_rng(5).standard_normal((600, 4)), "item_id")

    def sent(query_rows, item_rows):
        return pa.table({"query_rows": [query_rows.num_rows], "item_rows": [item_rows.num_rows]})

    queries = points.withColumnRenamed("item_id", "query_id")
    cells = nearest.in_cells(queries, points, sent, "query_rows bigint, item_rows bigint").collect()
    assert sum(c["query_rows"] * c["item_rows"] for c in cells) == 600 * 600
    assert sum(c["item_rows"] for c in cells) <= 600 * nearest.CELL_ROWS


def test_equal_similarities_take_no_more_room_than_the_best(spark, monkeypatch):
    monkeypatch.setattr(nearest, "STEP_ITEMS", 64)
    one = np.random.default_rng(6).standard_normal(16)
    items = nearest._matrix(pa.array([one * s for s in range(1, 1001)]))
    most, k_best = [], nearest._k_best
    monkeypatch.setattr(nearest, "_k_best", lambda parts, ids, k: most.append(sum(len(p[0]) for p in parts)) or k_best(parts, ids, k))
    ids = np.arange(1000)[::-1].copy()
    row, col, near = nearest._best_of_steps(items[:20], items, items.astype(np.float32), ids, 5, None)
    assert ids[col].tolist() == [0, 1, 2, 3, 4] * 20 and not near.any()
    assert max(most) <= 20 * (64 + 5)


def test_what_single_precision_cannot_tell_apart_is_told_in_double(spark):
    draw = np.random.default_rng(7)
    centre = draw.standard_normal((30, 1, 48))
    points = (centre + 10.0 ** draw.uniform(-7, -2, (30, 60, 1)) * draw.standard_normal((30, 60, 48))).reshape(-1, 48).astype(np.float32)
    unit = nearest._matrix(pa.array(list(points)))
    row, col, near = nearest._best_of_steps(unit[:200], unit, unit.astype(np.float32), np.arange(len(unit)), 10, None)
    whole = np.round(np.sqrt(np.maximum(0, 2 - 2 * np.einsum("qd,id->qi", unit[:200], unit))), nearest.DISTANCE_DIGITS)
    order = np.stack([np.lexsort((np.arange(len(unit)), d))[:10] for d in whole])
    assert np.allclose(near.reshape(200, 10), np.take_along_axis(whole, order, axis=1), atol=2e-6)
    assert np.mean(col.reshape(200, 10) == order) > 0.99
