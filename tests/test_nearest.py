"""Exact and approximate search against brute force."""

import shutil

import numpy as np
import pyarrow as pa
import pytest

from quillset.operators import embedding, forest, nearest
from quillset.sources import sinks


def brute(queries, items, k):
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    d = np.round(np.sqrt(np.maximum(0, 2 - 2 * unit(queries) @ unit(items).T)), 6)
    return {(q, i, float(d[q, i]), r + 1) for q in range(len(queries)) for r, i in enumerate(np.lexsort((np.arange(len(items)), d[q]))[:k])}


def frame(spark, matrix, key):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], f"{key} long, vector array<float>")


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(3)
    items = draw.standard_normal((300, 16)).astype(np.float32)
    items[100:140] = items[7]  # forty exact copies
    return draw.standard_normal((25, 16)).astype(np.float32), items


def found(df):
    return {tuple(r) for r in df.select("query_id", "item_id", "distance", "rank").collect()}


def test_exact_with_few_and_with_many_queries(spark, data, monkeypatch):
    queries, items = data
    wanted = brute(queries.astype(np.float64), items.astype(np.float64), 10)
    q, i = frame(spark, queries, "query_id"), frame(spark, items, "item_id").repartition(5)
    assert found(nearest.knn_exact(q, i, 10)) == wanted
    assert found(nearest.knn_exact(q, i, 10, max_queries=5)) == wanted


def test_blocks_of_one_group_meet_each_other(spark, data):
    from pyspark.sql import functions as F

    queries, items = data
    q, i = frame(spark, queries, "query_id"), frame(spark, items, "item_id")
    group = F.lit(0).alias("g")
    near = nearest.block_top_k(q.select(group, "query_id"), i.select(group, "item_id"), ["g"], q, i, 10, query_block=4, item_block=32)
    wanted = brute(queries.astype(np.float64), items.astype(np.float64), 10)
    assert found(nearest.top_k_per_query(near, 10)) == wanted


def test_more_neighbours_than_items(spark):
    items = frame(spark, np.eye(3), "item_id")
    assert nearest.knn_exact(items.withColumnRenamed("item_id", "query_id"), items, 10).count() == 9


def test_a_search_through_all_leaves_is_exact_and_copies_come_back(spark, data):
    queries, items = data
    queries = np.vstack([queries, items[7:8], items[7:8]])  # the copied vector, asked for twice
    index = forest.build_index(frame(spark, items, "item_id"), n_trees=2, leaf_size=16)
    got = found(forest.search(index, frame(spark, queries, "query_id"), 10, candidates=10_000))
    assert got == brute(queries.astype(np.float64), items.astype(np.float64), 10)
    assert {g[1] for g in got if g[0] == 25} == {7, *range(100, 109)}


def arrow_frame(spark, matrix, key):
    vectors = pa.array(list(matrix.astype(np.float32)), pa.list_(pa.float32()))
    return spark.createDataFrame(pa.table({key: pa.array(range(len(matrix)), pa.int64()), "vector": vectors})).repartition(8)


def clustered(n_clusters=40, per=25, dim=32, spread=0.05):
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((n_clusters, dim))
    return (centres[:, None, :] + spread * draw.standard_normal((n_clusters, per, dim))).reshape(-1, dim).astype(np.float32)


@pytest.mark.parametrize(
    "kind,most_work", [("random", 0.7), ("clustered", 0.05), ("non-negative", 0.7), ("large", 0.6)]
)
def test_recall_rows_and_bounded_leaves(spark, kind, most_work):
    draw = np.random.default_rng(4)
    items = {
        "random": lambda: draw.standard_normal((4000, 64)),
        "clustered": lambda: clustered(200, 40, 64, 0.3),
        "non-negative": lambda: np.abs(draw.standard_normal((4000, 32))),
        "large": lambda: draw.standard_normal((60_000, 64)),
    }[kind]().astype(np.float32)
    queries = (items[:100] + 0.1 * draw.standard_normal((100, items.shape[1]))).astype(np.float32)
    index = forest.build_index(arrow_frame(spark, items, "item_id"))
    sizes = index["leaves"].groupBy("tree").agg({"n": "sum"}).collect()
    assert index["leaves"].agg({"n": "max"}).first()[0] <= 128 and {r[1] for r in sizes} == {len(items)}
    q = arrow_frame(spark, queries, "query_id")
    got = [tuple(r) for r in forest.search(index, q, 10).select("query_id", "item_id").collect()]
    wanted = brute(queries.astype(np.float64), items.astype(np.float64), 10)
    pairs = {(r[0], r[1]) for r in wanted}
    assert len(got) == len(set(got)) == 1000 and len(pairs & set(got)) / len(pairs) >= 0.9
    work = forest.knn_candidates(index, q).agg({"candidates": "avg", "query_id": "count"}).first()
    assert min(work) / len(items) <= most_work


def test_every_query_gets_its_rows(spark):
    items = np.random.default_rng(2).standard_normal((700, 8)).astype(np.float32)
    items[200:] = items[0]  # one vector and its many copies
    df = frame(spark, items, "item_id").union(spark.createDataFrame([(9000, None), (9001, [])], "item_id long, vector array<float>"))
    index = forest.build_index(df, n_trees=3, leaf_size=8)
    queries = frame(spark, items[:30], "query_id").union(spark.createDataFrame([(500, None), (501, [0.0] * 8)], "query_id long, vector array<float>"))
    counts = {r[0]: r[1] for r in forest.search(index, queries, 10, candidates=1).groupBy("query_id").count().collect()}
    assert counts == {**dict.fromkeys(range(30), 10), 501: 10}
    few = forest.build_index(frame(spark, items[:4], "item_id"), n_trees=2)
    assert forest.search(few, frame(spark, items[:2], "query_id"), 10).count() == 8
    with pytest.raises(ValueError):
        forest.build_index(df.limit(0))


def test_scaled_copies_cannot_be_split_and_are_searched_in_blocks(spark):
    one = np.random.default_rng(6).standard_normal(8)
    items = np.vstack([one * s for s in range(1, 301)]).astype(np.float32)
    index = forest.build_index(frame(spark, items, "item_id"), n_trees=2, leaf_size=32)
    top = forest.search(index, frame(spark, items[:3], "query_id"), 5).collect()
    assert len(top) == 15 and all(r["distance"] < 0.001 for r in top)


def test_subtrees_below_the_first_tier(spark, monkeypatch):
    monkeypatch.setattr(forest, "SAMPLE", 200)
    items = np.random.default_rng(8).standard_normal((1500, 16)).astype(np.float32)
    index = forest.build_index(frame(spark, items, "item_id"), n_trees=4, leaf_size=8)
    assert index["manifest"]["tiers"] >= 2 and index["leaves"].agg({"n": "max"}).first()[0] <= 8
    assert index["postings"].count() == 4 * 1500
    got = found(forest.search(index, frame(spark, items[:60], "query_id"), 10))
    wanted = brute(items[:60].astype(np.float64), items.astype(np.float64), 10)
    assert len({g[:2] for g in got} & {w[:2] for w in wanted}) / len(wanted) >= 0.9


def test_best_first_visits_leaves_by_falling_margin():
    draw = np.random.default_rng(0)
    rows = draw.standard_normal((500, 6))
    trees = [(t, forest.Subtree.of(*forest.grow(rows, 20, t)), None) for t in range(3)]
    visited = list(forest.best_first(trees, rows[0], np.inf, np.inf, 0))
    assert sorted((w, leaf) for w, leaf, _ in visited) == sorted((w, i) for w, (_, tree, _) in enumerate(trees) for i in range(len(tree.paths)))
    margins = [p for _, _, p in visited]
    assert margins == sorted(margins, reverse=True)
    own = {(w, int(tree.leaves_of(rows[:1])[0])) for w, (_, tree, _) in enumerate(trees)}
    assert own == {(w, leaf) for w, leaf, p in visited if p > 0}
    for _, tree, _ in trees:
        assert np.bincount(tree.leaves_of(rows)).max() <= 20


def test_recall_on_the_given_vectors(spark):
    from quillset.plans import fixtures

    items = fixtures.vectors(spark, "/root/testdata/sf0.01").select("item_id", "vector")
    queries = items.withColumnRenamed("item_id", "query_id")
    exact = {(r[0], r[1]) for r in found(nearest.knn_exact(queries, items, 10))}
    near = {(r[0], r[1]) for r in found(forest.search(forest.build_index(items), queries, 10))}
    assert len(exact & near) / len(exact) >= 0.9


def test_stored_index(spark, data, tmp_path):
    queries, items = data
    path = sinks.save_index(frame(spark, items, "item_id"), str(tmp_path / "index"), n_trees=2, leaf_size=16)
    loaded = sinks.load_index(spark, path)
    q = frame(spark, queries, "query_id")
    assert found(forest.search(loaded, q, 5, candidates=10_000)) == brute(queries.astype(np.float64), items.astype(np.float64), 5)
    probes = forest.probe_leaves(loaded, q.limit(1), 1)
    plan = forest.postings_of(loaded, probes)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    with pytest.raises(Exception, match="already exists"):
        sinks.save_index(frame(spark, items, "item_id"), path)
    shutil.rmtree(tmp_path / "index" / "manifest")  # as if the writer had been stopped
    with pytest.raises(FileNotFoundError):
        sinks.load_index(spark, path)


def make_counting_encoder():
    return lambda texts: np.array([[len(t), t.count(" ") + 1] for t in texts], dtype=np.float32)


def test_encoders(spark):
    df = spark.createDataFrame([(1, "the red fox"), (2, "blue whale song"), (3, "red fox")], "id long, text string")
    model = embedding.fit_tfidf_encoder(df, dim=64)
    vectors = {r["id"]: np.array(r["vector"]) for r in embedding.embed_text(df, model).collect()}
    assert np.linalg.norm(vectors[2]) == pytest.approx(1.0) and vectors[1] == pytest.approx(vectors[3])
    own = {r["id"]: r["vector"] for r in embedding.embed_text_with_model(df, make_counting_encoder).collect()}
    assert own == {1: [7.0, 2.0], 2: [15.0, 3.0], 3: [7.0, 2.0]}


def test_texts_without_words_have_no_direction(spark):
    from quillset.plans import retrieval

    df = spark.createDataFrame([(1, "red fox"), (2, ""), (3, None), (4, "the")], "doc_id long, text string")
    model = embedding.fit_tfidf_encoder(df, dim=16)
    vectors = {r["doc_id"]: r["vector"] for r in embedding.embed_text(df, model).collect()}
    assert vectors[3] is None and vectors[2] == vectors[4] == [0.0] * 16 and max(vectors[1]) > 0
    assert [r["item_id"] for r in retrieval.index_documents(df, model, n_trees=1)["items"].collect()] == [1]


@pytest.mark.parametrize("sample", [16_384, 300])  # without and with subtrees
def test_crowded_searches_meet_in_cells_and_write_no_row_per_leaf(spark, monkeypatch, sample):
    monkeypatch.setattr(forest, "SAMPLE", sample)
    items = np.random.default_rng(9).standard_normal((1200, 12)).astype(np.float32)
    items[50:55] = items[3]
    df = frame(spark, items, "item_id")
    index = forest.build_index(df, n_trees=3, leaf_size=64)
    assert (index["manifest"]["tiers"] > 1) == (sample == 300)
    queries = df.withColumnRenamed("item_id", "query_id")
    targets = index["copies"].selectExpr("item_id as query_id", "rep as target")

    def answers():
        near = found(forest.search(index, queries, 10))
        candidates = {tuple(r) for r in forest.knn_candidates(index, queries).collect()}
        own = {tuple(r) for r in forest.candidates_with(index, queries, targets).collect()}
        return near, candidates, own

    by_leaf = answers()
    monkeypatch.setattr(forest, "PAIRS", 0)
    monkeypatch.setattr(forest, "probe_leaves", None)
    monkeypatch.setattr(forest, "block_top_k", None)
    assert answers() == by_leaf
    assert by_leaf[2] == {(i, 1) for i in range(1200)}


def test_exact_search_of_many_queries_in_several_cells(spark, data, monkeypatch):
    queries, items = data
    monkeypatch.setattr(nearest, "CELL_QUERIES", 8)
    monkeypatch.setattr(nearest, "CELL_ITEMS", (64, 64))
    monkeypatch.setattr(nearest, "STEP_QUERIES", 4)
    wanted = brute(queries.astype(np.float64), items.astype(np.float64), 10)
    got = nearest.knn_exact(frame(spark, queries, "query_id"), frame(spark, items, "item_id"), 10, max_queries=5)
    assert found(got) == wanted
