"""Searches whose queries meet a good part of all items."""

import numpy as np
import pyarrow as pa
import pytest

from quillset.operators import forest, nearest


def frame(spark, matrix, key):
    vectors = pa.array(list(np.asarray(matrix, dtype=np.float32)), pa.list_(pa.float32()))
    return spark.createDataFrame(pa.table({key: pa.array(range(len(matrix)), pa.int64()), "vector": vectors})).repartition(4)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("sample", [16_384, 300])  # without and with subtrees
def test_only_queries_that_find_too_few_ship_their_leaves_as_bits(spark, monkeypatch, sample):
    monkeypatch.setattr(forest, "SAMPLE", sample)
    monkeypatch.setattr(forest, "PAIRS", 0)
    items = np.random.default_rng(1).standard_normal((1000, 12)).astype(np.float32)
    items[50:60] = items[3]
    df = frame(spark, items, "item_id")
    index = forest.build_index(df, n_trees=3, leaf_size=64)
    queries = df.withColumnRenamed("item_id", "query_id")
    wanted = forest.search(index, queries, 10)
    asked, as_bits = [], forest.probed_bits
    monkeypatch.setattr(forest, "probed_bits", lambda i, q, w, f: asked.append(q.count()) or as_bits(i, q, w, f))
    monkeypatch.setattr(forest, "AHEAD", 1)  # a miss among the ten nearest, and all leaves are gone through
    assert rows(forest.search(index, queries, 10)) == rows(wanted) and 0 < asked.pop() < 991
    monkeypatch.setattr(forest, "AHEAD", 100)  # a list then holds all items
    monkeypatch.setattr(forest, "probed_bits", None)
    assert rows(forest.search(index, queries, 10)) == rows(wanted)


def test_few_candidates_and_ids_that_come_twice(spark, monkeypatch):
    draw = np.random.default_rng(2)
    index = forest.build_index(frame(spark, draw.standard_normal((900, 8)), "item_id"), n_trees=2, leaf_size=32)
    asked = [(i % 40, [float(x) for x in draw.standard_normal(8)]) for i in range(60)]
    asked += [(None, asked[0][1]), (70, None), (71, []), (72, [0.0] * 8), (73, asked[1][1])]
    queries = spark.createDataFrame(asked, "query_id long, vector array<float>")
    monkeypatch.setattr(forest, "PAIRS", 0)
    assert forest.crowded(index, 60, 60)
    found = rows(forest.search(index, queries, 5, candidates=60))

    def through_all_leaves(index, queries, wanted, k):
        whole = forest.whole_forest(index)
        items = forest.leaves_of_items(index, whole).join(index["items"].select("item_id", "vector"), "item_id")
        return nearest.in_cells(forest.probed_bits(index, queries, wanted, whole), items, nearest.cell_top_k(k, forest.held_by_bits), nearest._HITS)

    monkeypatch.setattr(forest, "_crowded_top_k", through_all_leaves)
    assert found == rows(forest.search(index, queries, 5, candidates=60))
    assert {r[0] for r in found} == {None, *range(40), 72, 73}


def test_copies_do_not_hide_that_a_search_is_crowded(spark, monkeypatch):
    monkeypatch.setattr(forest, "PAIRS", 0)
    items = np.tile(np.random.default_rng(3).standard_normal((40, 6)), (20, 1))
    index = forest.build_index(frame(spark, items, "item_id"), n_trees=2, leaf_size=8)
    assert forest.crowded(index, 40, 20) and not forest.crowded(index, 40, 2)


@pytest.mark.parametrize("kind", ["plain", "ties", "one priority"])
def test_the_last_leaf_is_that_of_the_whole_order(kind):
    draw = np.random.default_rng(4)
    for n in (1, 7, 3000, 40_000):
        sizes = draw.integers(1, 129, n)
        own = {"plain": draw.standard_normal(n), "ties": np.round(draw.standard_normal(n), 1), "one priority": np.zeros(n)}[kind]
        order = np.argsort(-own, kind="stable")
        upto = np.cumsum(sizes[order])
        for wanted in (1, int(upto[0]), int(0.001 * upto[-1]) + 1, int(0.4 * upto[-1]) + 1, int(upto[-1]), 2 * int(upto[-1])):
            last = order[min(np.searchsorted(upto, wanted), n - 1)]
            assert forest.last_leaf(own, sizes, wanted) == last
