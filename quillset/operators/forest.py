"""Approximate nearest neighbours: a forest of split trees that follow the data, searched best-first.

A node is split by the plane halfway between two centres of its vectors, or, if that leaves one side with little, at the
median along the line through the centres; so depth follows the data and leaves are bounded, wherever the vectors lie.
Trees grow in tiers. The first tier is grown from a bounded sample and shipped to every task; a node that is still too
large gets a subtree of its own, grown in one task per node from all its vectors or a bounded sample of them, until no
node that can be split is larger than a leaf. What stays large holds vectors of one direction and is searched in blocks.

A query keeps a queue of nodes over all trees, ordered by the least distance to a plane on the wrong side of which the
path lies. It goes on until the leaves met hold the wanted number of items. The number is found when the index is built,
by measuring on some of its own vectors how far the queue has to go for the wanted recall.

Where many queries each meet a good part of all items, rows for what they meet would grow with the square of the input. Blocks
of queries and of items then meet as vectors first, and the nearest pairs are kept that lie in a leaf the query meets; for
queries that this leaves with too few, and for counts, the leaves met are a string of bits, and bits and vectors meet in cells.

The tables under the index's folder are written once; a manifest goes last, and a folder without it cannot be opened.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.operators.nearest import _HITS, FEW_ANSWERS, STEP_ITEMS, STEP_QUERIES, _matrix, block_top_k, cell_top_k, in_cells, knn_exact
from quillset.operators.ranks import top_k_per_query
from quillset.session import broadcast_if_small, materialise, scratch_path

#: Vectors that the first tier, and each subtree of a large node, is grown from.
SAMPLE, SAMPLE_BYTES = 16_384, 64 << 20
#: Vectors of a node that the two centres are found with, and rounds of moving them.
CENTRE_SAMPLE, CENTRE_ROUNDS = 256, 4
#: Of a node, the smaller side of a split holds this share at least; else it is split at the median.
LEAST_SIDE = 0.2
#: Leaves of the first tier, at most; with SAMPLE it bounds what is shipped.
FIRST_LEAVES = 512
#: Folders of the postings, by leaf.
PARTS = 64
#: Vectors that the number of candidates is measured with, and the leaves of a tree that their queues go through at most.
TUNING_QUERIES, TUNING_LEAVES = 64, 4096

#: Candidates of all queries that may become rows, and the share of the items that a query's candidates are then at least,
#: for queries and items to meet in cells. The planes of the whole forest are then shipped, these bytes at most.
PAIRS, CROWDED, FOREST_BYTES = 20_000_000, 1 / 16, 256 << 20
#: Of a crowded search for k, the nearest pairs of a query that are looked up in its leaves first, in multiples of k.
AHEAD = 2
#: Leaves that are put in order to find where a query's leaves end; more are narrowed down first.
ORDERED = 2048

_TIER = "tree int, node string, planes array<array<float>>, offsets array<float>, children array<int>"


# ---------------------------------------------------------------- growing


@dataclass
class Subtree:
    """Planes of the inner nodes, the root first, and their two children: the number of a node, or -1 - number of a leaf."""

    planes: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    paths: list[str]

    @classmethod
    def of(cls, planes: list, offsets: list, children: list) -> Subtree:
        kids = np.asarray(children, dtype=np.int64).reshape(-1, 2)
        paths: dict[int, str] = {}
        ways = {0: ""}
        for node, pair in enumerate(kids):
            for bit, child in enumerate(pair):
                if child >= 0:
                    ways[int(child)] = ways[node] + str(bit)
                else:
                    paths[-1 - int(child)] = ways[node] + str(bit)
        return cls(np.asarray(planes, dtype=np.float64), np.asarray(offsets, dtype=np.float64), kids, [paths[i] for i in range(len(paths))] or [""])

    def plain(self) -> tuple:
        return self.planes, self.offsets, self.children, self.paths

    def leaves_of(self, rows: np.ndarray) -> np.ndarray:
        """The number of each row's leaf."""
        if not len(self.children):
            return np.zeros(len(rows), dtype=np.int64)
        at = np.zeros(len(rows), dtype=np.int64)
        inner = np.arange(len(rows))
        while len(inner):
            node = at[inner]
            side = np.einsum("ij,ij->i", rows[inner], self.planes[node]) > self.offsets[node]
            at[inner] = self.children[node, side.astype(np.int64)]
            inner = inner[at[inner] >= 0]
        return -1 - at


def plane_between(rows: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, float] | None:
    """A unit normal and an offset that split the rows, or None if they all lie in one place."""
    few = rows[draw.choice(len(rows), min(len(rows), CENTRE_SAMPLE), replace=False)]
    first = few[draw.integers(len(few))]
    away = ((few - first) ** 2).sum(axis=1)
    if away.max() <= 1e-12:
        away = ((rows - first) ** 2).sum(axis=1)
        if away.max() <= 1e-12:
            return None
        centres = np.stack([first, rows[away.argmax()]])
    else:
        centres = np.stack([first, few[draw.choice(len(few), p=away / away.sum())]])
        for _ in range(CENTRE_ROUNDS):
            second = ((few[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1).astype(bool)
            if second.all() or not second.any():
                break
            centres = np.stack([few[~second].mean(axis=0), few[second].mean(axis=0)])
    normal = centres[1] - centres[0]
    length = np.linalg.norm(normal)
    if length <= 1e-9:
        return None
    normal = (normal / length).astype(np.float32).astype(np.float64)
    along = rows @ normal
    offset = float(np.float32(normal @ (centres[0] + centres[1]) / 2))
    upper = int((along > offset).sum())
    if min(upper, len(rows) - upper) < max(1, LEAST_SIDE * len(rows)):
        ordered = np.sort(along)
        # at the widest step near the middle, so that equal values stay together
        low, high = max(0, int(0.4 * len(rows)) - 1), min(len(rows) - 1, int(0.6 * len(rows)) + 1)
        steps = np.diff(ordered[low : high + 1])
        best = low + int(steps.argmax()) if len(steps) and steps.max() > 1e-9 else int(np.diff(ordered).argmax())
        if ordered[best + 1] - ordered[best] <= 1e-9:
            return None
        offset = float(np.float32((ordered[best] + ordered[best + 1]) / 2))
        upper = int((along > offset).sum())
        if upper == 0 or upper == len(rows):
            return None
    return normal, offset


def grow(rows: np.ndarray, most: int, seed: int) -> tuple[list, list, list]:
    """Planes, offsets and children of a tree over ``rows`` whose leaves hold ``most`` rows at most where they can be split."""
    draw = np.random.default_rng(seed)
    planes, offsets, children, leaves = [], [], [], 0
    todo = [(np.arange(len(rows)), -1, 0)]
    for members, parent, side in todo:  # grows while it is gone through
        split = plane_between(rows[members], draw) if len(members) > most else None
        if split is None:
            if parent >= 0:
                children[2 * parent + side] = -1 - leaves
                leaves += 1
            continue
        node = len(offsets)
        if parent >= 0:
            children[2 * parent + side] = node
        planes.append(split[0].astype(np.float32))
        offsets.append(split[1])
        children += [0, 0]
        upper = rows[members] @ split[0] > split[1]
        todo += [(members[~upper], node, 0), (members[upper], node, 1)]
    return planes, offsets, children


# ---------------------------------------------------------------- building


def build_index(
    items: DataFrame,
    n_trees: int = 10,
    leaf_size: int = 128,
    seed: int = 42,
    path: str | None = None,
    recall: float = 0.95,
    k: int = 10,
) -> dict:
    """Index over (item_id, vector), written under ``path`` or the shared folder.

    Tables: ``items`` (item_id, vector, h1, h2), ``copies`` (rep, item_id) with the smallest id of equal vectors as their
    rep, ``tiers`` (tier, tree, node, planes, offsets, children), ``first`` (tree, node, n: vectors below the leaves of the
    first tier), ``leaves`` (tree, leaf, part, n), ``postings`` (tree, leaf, item_id of reps) in one folder per part, and
    the manifest. Ids are unique; null and empty vectors are left out.
    ``recall`` is the share of the ``k`` nearest that a search finds on average unless it is told how far to look.
    """
    spark = items.sparkSession
    path = path or scratch_path(spark, "index")
    items = items.filter(F.size("vector") > 0).select("item_id", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    items.write.parquet(f"{path}/items")
    stored = spark.read.parquet(f"{path}/items")
    total, dim = stored.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not total:
        raise ValueError("no items to index")

    # drawn by the hash of the vector, so that copies count once; about SAMPLE rows, and never more than twice that
    room = min(SAMPLE, max(1024, SAMPLE_BYTES // (4 * dim)))
    few = stored if total <= room else stored.filter(F.pmod("h2", F.lit(1 << 30)) < int((1 << 30) * room / total))
    drawn = few.dropDuplicates(["h1", "h2"]).orderBy("h2", "h1").limit(2 * room).select("vector").toArrow()
    sample = _matrix(drawn.column("vector")) if drawn.num_rows else np.zeros((0, 1))
    most = max(leaf_size, 1) if total <= room else max(16, math.ceil(len(sample) / FIRST_LEAVES))
    first = [(t, "", *_plain(grow(sample, most, seed + t))) for t in range(n_trees)]
    trees = [Subtree.of(*row[2:]) for row in first]

    shipped = spark.sparkContext.broadcast([tree.plain() for tree in trees])  # plain values: workers need no package

    @F.arrow_udf("array<string>")
    def nodes_of(vectors: pa.Array) -> pa.Array:
        rows = _matrix(vectors)
        names = [np.array(tree.paths, dtype=object)[tree.leaves_of(rows)] for tree in (Subtree(*parts) for parts in shipped.value)]
        return pa.array(np.stack(names, axis=1).tolist() if len(rows) else [], pa.list_(pa.string()))

    placed_items = materialise(stored.select("item_id", "h1", "h2", nodes_of("vector").alias("nodes")), "placed-items")
    reps = materialise(placed_items.groupBy("h1", "h2").agg(F.min("item_id").alias("rep"), F.min("nodes").alias("nodes")), "reps")
    placed_items.select("item_id", "h1", "h2").join(reps.select("h1", "h2", "rep"), ["h1", "h2"]).select("rep", "item_id").write.parquet(f"{path}/copies")

    tiers = spark.createDataFrame([(0, *row) for row in first], f"tier int, {_TIER}")
    tiers.coalesce(1).write.parquet(f"{path}/tiers/part=0")
    placed = reps.select(F.posexplode("nodes").alias("tree", "leaf"), F.col("rep").alias("item_id"))
    whole = spark.createDataFrame([], "tree int, leaf string")  # nodes of one direction stay as they are
    tier = 0
    while True:
        placed = materialise(placed, "placed") if tier else placed
        sizes = materialise(placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")), "sizes")
        if tier == 0:
            sizes.withColumnRenamed("leaf", "node").write.parquet(f"{path}/first")
        large = sizes.filter(F.col("n") > leaf_size).join(whole, ["tree", "leaf"], "left_anti")
        if large.isEmpty():
            break
        tier += 1
        members = placed.join(broadcast_if_small(large), ["tree", "leaf"]).join(stored.select("item_id", "vector"), "item_id")
        members = materialise(members, "members")
        grown = materialise(_grown(members, leaf_size, seed + tier), f"tier-{tier}")
        grown.filter(F.size("offsets") > 0).withColumn("tier", F.lit(tier)).select("tier", *[c.split()[0] for c in _TIER.split(", ")]).write.parquet(f"{path}/tiers/part={tier}")
        whole = whole.union(grown.filter(F.size("offsets") == 0).select("tree", F.col("node").alias("leaf")))
        moved = _routed(members, grown.filter(F.size("offsets") > 0))
        split = grown.filter(F.size("offsets") > 0).select("tree", F.col("node").alias("leaf"))
        placed = placed.join(broadcast_if_small(split), ["tree", "leaf"], "left_anti").union(moved)

    part = F.pmod(F.xxhash64("tree", "leaf"), F.lit(PARTS)).cast("int").alias("part")
    sizes.select("tree", "leaf", part, "n").write.parquet(f"{path}/leaves")
    placed.select("tree", "leaf", "item_id", part).repartition("part").write.partitionBy("part").parquet(f"{path}/postings")
    manifest = {"n_trees": n_trees, "leaf_size": leaf_size, "tiers": tier + 1, "items": total}
    index = _tables(spark, path, manifest)
    manifest["candidates"] = tuned_candidates(index, recall, k)
    _write_manifest(spark, path, manifest)
    return open_index(spark, path)


def _plain(parts: tuple[list, list, list]) -> tuple[list, list, list]:
    return [[float(x) for x in p] for p in parts[0]], [float(x) for x in parts[1]], [int(x) for x in parts[2]]


def _grown(members: DataFrame, leaf_size: int, seed: int) -> DataFrame:
    """A subtree for every node; a node that cannot be split has one without planes."""
    share = F.lit(float(1 << 30)) * SAMPLE / F.col("n")
    sampled = members.filter((F.col("n") <= SAMPLE) | (F.pmod(F.xxhash64("item_id", F.lit(seed)), F.lit(1 << 30)) < share))

    def one(rows: pa.Table) -> pa.Table:
        matrix, n = _matrix(rows.column("vector")), rows.column("n")[0].as_py()
        tree, node = rows.column("tree")[0].as_py(), rows.column("leaf")[0].as_py()
        most = leaf_size if n <= SAMPLE else max(16, math.ceil(len(matrix) / FIRST_LEAVES))
        own = np.frombuffer(f"{tree}:{node}".encode(), dtype=np.uint8).astype(np.int64)
        planes, offsets, children = _plain(grow(matrix, most, [seed, tree, *own.tolist()]))
        types = [pa.int32(), pa.string(), pa.list_(pa.list_(pa.float32())), pa.list_(pa.float32()), pa.list_(pa.int32())]
        values = [[tree], [node], [planes], [offsets], [children]]
        return pa.table([pa.array(v, t) for v, t in zip(values, types)], names=["tree", "node", "planes", "offsets", "children"])

    return sampled.groupBy("tree", "leaf").applyInArrow(one, _TIER)


def _routed(members: DataFrame, grown: DataFrame) -> DataFrame:
    """(tree, leaf, item_id) of the members of the nodes in ``grown``, down their subtree; large nodes in several tasks."""
    cells = F.ceil(F.col("n") / SAMPLE).cast("int")
    left = members.withColumn("cell", F.pmod(F.xxhash64("item_id"), cells).cast("int"))
    sizes = members.select("tree", "leaf", cells.alias("cells")).distinct()
    right = grown.join(sizes, (grown["tree"] == sizes["tree"]) & (grown["node"] == sizes["leaf"])).select(
        grown["*"], F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell")
    )

    def down(rows: pa.Table, tiers: pa.Table) -> pa.Table:
        if not rows.num_rows or not tiers.num_rows:
            return pa.table({"tree": pa.array([], pa.int32()), "leaf": pa.array([], pa.string()), "item_id": pa.array([], pa.int64())})
        subtree = _subtree(tiers, 0)
        node = tiers.column("node")[0].as_py()
        paths = np.array([node + p for p in subtree.paths], dtype=object)[subtree.leaves_of(_matrix(rows.column("vector")))]
        return pa.table({"tree": rows.column("tree"), "leaf": pa.array(paths.tolist(), pa.string()), "item_id": rows.column("item_id")})

    placed = left.select("tree", F.col("leaf").alias("node"), "cell", "item_id", "vector")
    return placed.groupBy("tree", "node", "cell").cogroup(right.groupBy("tree", "node", "cell")).applyInArrow(down, "tree int, leaf string, item_id bigint")


def _subtree(table: pa.Table, row: int) -> Subtree:
    return Subtree.of(*[table.column(c)[row].as_py() for c in ("planes", "offsets", "children")])


# ---------------------------------------------------------------- files


INDEX_TABLES = {
    "items": "item_id bigint, vector array<float>, h1 bigint, h2 bigint",
    "copies": "rep bigint, item_id bigint",
    "tiers": f"tier int, {_TIER}, part int",
    "first": "tree int, node string, n bigint",
    "leaves": "tree int, leaf string, part int, n bigint",
    "postings": "tree int, leaf string, item_id bigint, part int",
}


def _tables(spark: SparkSession, path: str, manifest: dict) -> dict:
    tables = {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in INDEX_TABLES.items()}
    return {**tables, "manifest": manifest}


def _write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}/manifest")


def open_index(spark: SparkSession, path: str) -> dict:
    """The tables of an index that was written to its end, and its manifest."""
    try:
        lines = spark.read.text(f"{path}/manifest").collect()  # one line
    except AnalysisException:
        lines = []
    if not lines:
        raise FileNotFoundError(f"{path} holds no complete index: the manifest is missing")
    return _tables(spark, path, json.loads(lines[0]["value"]))


# ---------------------------------------------------------------- searching


def best_first(trees: list[tuple[int, Subtree, np.ndarray | None]], query: np.ndarray, begin: float, wanted: float, least: int) -> Iterator[tuple[int, int, float]]:
    """(which tree, leaf, priority) in falling priority, until the leaves given hold ``wanted`` items and are ``least`` many.

    ``trees`` come with the items of each leaf, or None to count leaves only.
    """
    queue = [(-begin, which, 0) if len(tree.children) else (-begin, which, -1) for which, (_, tree, _) in enumerate(trees)]
    heapq.heapify(queue)
    held = given = 0
    while queue and (held < wanted or given < least):
        minus, which, node = heapq.heappop(queue)
        _, tree, sizes = trees[which]
        if node < 0:
            yield which, -1 - node, -minus
            held += 1 if sizes is None else sizes[-1 - node]
            given += 1
            continue
        margin = float(tree.planes[node] @ query - tree.offsets[node])
        lower, upper = tree.children[node]
        heapq.heappush(queue, (max(minus, margin), which, int(lower)))
        heapq.heappush(queue, (max(minus, -margin), which, int(upper)))


def _first_tier(index: dict) -> list[tuple[int, Subtree, np.ndarray]]:
    """The first tier of each tree with the items below its leaves. Bounded by n_trees, SAMPLE and FIRST_LEAVES."""
    rows = index["tiers"].filter("part = 0").orderBy("tree").toArrow()
    trees = [(rows.column("tree")[i].as_py(), _subtree(rows, i)) for i in range(rows.num_rows)]
    below = {(r["tree"], r["node"]): r["n"] for r in index["first"].collect()}  # a row per leaf of the first tier
    return [(t, tree, np.array([below.get((t, path), 0) for path in tree.paths], dtype=np.int64)) for t, tree in trees]


def probe_leaves(index: dict, queries: DataFrame, candidates: int | None = None, most_leaves: int | None = None) -> DataFrame:
    """(query_id, tree, leaf, part, n, priority): the leaves met best-first until they hold ``candidates`` items.

    ``queries`` is (query_id, vector). The queue runs through the first tier in the task that reads the query; nodes with
    a subtree are then gone into, one task per node and block of queries, and the leaves of all trees meet in one order.
    """
    manifest = index["manifest"]
    wanted = candidates or manifest["candidates"]
    trees = _first_tier(index)
    spark = queries.sparkSession
    shipped = spark.sparkContext.broadcast([(t, tree.plain(), sizes) for t, tree, sizes in trees])
    n_trees, deeper = len(trees), manifest["tiers"] > 1
    leaves_each = most_leaves or max(4, math.ceil(2 * wanted / (n_trees * manifest["leaf_size"])) + 2)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [(t, Subtree(*parts), sizes) for t, parts, sizes in shipped.value]
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            # where subtrees follow, more nodes than needed go on: their leaves are ordered again below
            reach, least = (4.0 * wanted, 4 * n_trees) if deeper else (float(wanted), 1)
            if most_leaves:
                reach = math.inf
            for query, row in zip(batch.column("query_id").to_pylist(), _matrix(batch.column("vector"))):
                for which, leaf, priority in best_first(trees, row, math.inf, reach, least):
                    for column, value in zip(out, (query, trees[which][0], trees[which][1].paths[leaf], min(priority, 1e9))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.string(), pa.float64()))], names=["query_id", "tree", "node", "priority"])

    queries = queries.filter(F.size("vector") > 0).select("query_id", "vector")
    met = materialise(queries.mapInArrow(first, "query_id bigint, tree int, node string, priority double"), "met")
    ended = []
    for tier in range(1, manifest["tiers"]):
        subtrees = index["tiers"].filter(F.col("part") == tier).select("tree", "node", "planes", "offsets", "children")
        inner = subtrees.select("tree", "node")
        ended.append(met.join(broadcast_if_small(inner), ["tree", "node"], "left_anti"))
        met = materialise(_gone_into(met.join(broadcast_if_small(inner), ["tree", "node"], "left_semi"), queries, subtrees, leaves_each), f"met-{tier}")
    ended.append(met)
    every = ended[0]
    for more in ended[1:]:
        every = every.unionByName(more)
    sized = every.withColumnRenamed("node", "leaf").join(broadcast_if_small(index["leaves"]), ["tree", "leaf"])
    order = Window.partitionBy("query_id").orderBy(F.col("priority").desc(), "tree", "leaf").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0))
    return sized.withColumn("before", before).filter(F.col("before") < wanted).select("query_id", "tree", "leaf", "part", "n", "priority")


def _gone_into(met: DataFrame, queries: DataFrame, subtrees: DataFrame, leaves_each: int) -> DataFrame:
    """The leaves of their subtree that queries meet first, for each node that they met."""
    cells = F.ceil(F.count(F.lit(1)) / 4096).cast("int").alias("cells")
    sizes = met.groupBy("tree", "node").agg(cells)
    left = met.join(broadcast_if_small(sizes), ["tree", "node"]).withColumn("cell", F.pmod(F.xxhash64("query_id"), F.col("cells")).cast("int"))
    left = left.select("tree", "node", "cell", "query_id", "priority").join(queries, "query_id")
    right = subtrees.join(broadcast_if_small(sizes), ["tree", "node"]).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).drop("cells")

    def down(rows: pa.Table, tiers: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if rows.num_rows and tiers.num_rows:
            tree, node, subtree = tiers.column("tree")[0].as_py(), tiers.column("node")[0].as_py(), _subtree(tiers, 0)
            for query, priority, row in zip(rows.column("query_id").to_pylist(), rows.column("priority").to_pylist(), _matrix(rows.column("vector"))):
                for _, leaf, at in best_first([(tree, subtree, None)], row, priority, leaves_each, 1):
                    for column, value in zip(out, (query, tree, node + subtree.paths[leaf], at)):
                        column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.string(), pa.float64()))], names=["query_id", "tree", "node", "priority"])

    return left.groupBy("tree", "node", "cell").cogroup(right.groupBy("tree", "node", "cell")).applyInArrow(down, "query_id bigint, tree int, node string, priority double")


# ---------------------------------------------------------------- crowded searches


def crowded(index: dict, n_queries: int, wanted: int) -> bool:
    """Whether queries have so many candidates that they meet the items in cells and not leaf by leaf."""
    items = index["first"].agg(F.sum("n")).first()[0] / index["manifest"]["n_trees"]  # copies lie in leaves once
    if n_queries * min(wanted, items) <= PAIRS or wanted < CROWDED * items:
        return False
    dim = F.max(F.coalesce(F.size(F.get("planes", F.lit(0))), F.lit(0)))
    planes, dim = index["tiers"].agg(F.sum(F.size("offsets")), dim).first()
    return planes * dim * 4 <= FOREST_BYTES


@dataclass
class Forest:
    """All tiers of all trees. Node 0 stands above the roots; parents come before their children, and the nodes of a level
    lie together. Leaves are numbered by tree and path; those without items are left out."""

    planes: np.ndarray
    offsets: np.ndarray
    levels: list[tuple[int, int]]
    above: np.ndarray
    sides: np.ndarray
    leaf_above: np.ndarray
    leaf_sides: np.ndarray
    names: list[tuple[int, str]]
    sizes: np.ndarray

    def plain(self) -> tuple:
        return self.planes, self.offsets, self.levels, self.above, self.sides, self.leaf_above, self.leaf_sides, self.sizes


def whole_forest(index: dict) -> Forest:
    """The tiers put together: FOREST_BYTES at most where ``crowded`` was asked before."""
    subtrees: dict[tuple[int, str], Subtree] = {}
    table = index["tiers"].select("tree", "node", "planes", "offsets", "children").toArrow()
    for i in range(table.num_rows):
        planes, offsets = table.column("planes")[i].values, table.column("offsets")[i].values.to_numpy(zero_copy_only=False)
        flat = planes.flatten().to_numpy(zero_copy_only=False) if len(planes) else np.zeros(0, np.float32)
        subtree = Subtree.of(flat.reshape(len(offsets), -1) if len(offsets) else [], offsets, table.column("children")[i].as_py())
        subtrees[table.column("tree")[i].as_py(), table.column("node")[i].as_py()] = subtree
    below = {(r["tree"], r["leaf"]): r["n"] for r in index["leaves"].select("tree", "leaf", "n").toArrow().to_pylist()}

    planes, offsets, above, sides, levels = [None], [-math.inf], [0], [1.0], []
    leaves: list[tuple[tuple[int, str], int, float]] = []
    # (subtree, its node or -1 - its leaf, the path to the subtree, tree, parent, side)
    todo = [(subtrees[key], 0 if len(subtrees[key].children) else -1, "", key[0], 0, 1.0) for key in sorted(subtrees) if key[1] == ""]
    while todo:
        level, begin = [], len(offsets)
        for subtree, node, path, tree, parent, side in todo:  # grows while it is gone through
            if node < 0:
                whole = path + subtree.paths[-1 - node]
                deeper = subtrees.get((tree, whole)) if whole else None
                if deeper is not None and len(deeper.children):
                    todo.append((deeper, 0, whole, tree, parent, side))
                else:
                    leaves.append(((tree, whole), parent, side))
                continue
            own = len(offsets)
            planes.append(subtree.planes[node])
            offsets.append(subtree.offsets[node])
            above.append(parent)
            sides.append(side)
            lower, upper = subtree.children[node]
            level += [(subtree, int(lower), path, tree, own, -1.0), (subtree, int(upper), path, tree, own, 1.0)]
        if len(offsets) > begin:
            levels.append((begin, len(offsets)))
        todo = level
    leaves = sorted(leaf for leaf in leaves if below.get(leaf[0]))
    dim = len(planes[1]) if len(planes) > 1 else index["items"].select(F.size("vector")).first()[0]
    planes[0] = np.zeros(dim)
    return Forest(
        np.asarray(planes, dtype=np.float32), np.asarray(offsets), levels, np.asarray(above), np.asarray(sides),
        np.asarray([leaf[1] for leaf in leaves]), np.asarray([leaf[2] for leaf in leaves]),
        [leaf[0] for leaf in leaves], np.asarray([below[leaf[0]] for leaf in leaves], dtype=np.int64),
    )


def leaf_priorities(forest: tuple, rows: np.ndarray) -> np.ndarray:
    """Of each leaf (rows of the result) the priority at which ``best_first`` meets it, for each query (columns)."""
    planes, offsets, levels, above, sides, leaf_above, leaf_sides, _ = forest
    margins = planes.astype(np.float64, copy=False) @ rows.T
    margins -= offsets[:, None]
    at = np.full(margins.shape, math.inf)
    for begin, end in levels:
        over = above[begin:end]
        np.minimum(at[over], sides[begin:end, None] * margins[over], out=at[begin:end])
    leaves = margins[leaf_above]
    leaves *= leaf_sides[:, None]
    np.minimum(leaves, at[leaf_above], out=leaves)
    return np.minimum(leaves, 1e9, out=leaves)


def last_leaf(priorities: np.ndarray, sizes: np.ndarray, wanted: int) -> int:
    """The number of the leaf with which leaves, by falling priority and then by number, come to hold ``wanted`` items."""
    among, held = np.arange(len(sizes)), 0
    while len(among) > ORDERED:
        own, n = priorities[among], sizes[among]
        few = np.argsort(-own[:: len(among) // 1024])
        share = np.cumsum(n[:: len(among) // 1024][few]) / n[:: len(among) // 1024].sum()
        guess = int(np.searchsorted(share, (wanted - held) / n.sum()))
        upper = own > own[:: len(among) // 1024][few[max(0, guess - 64)]]
        lower = own < own[:: len(among) // 1024][few[min(len(few) - 1, guess + 64)]]
        before, last = int(n[upper].sum()), len(among)
        if held + before >= wanted:
            among = among[upper]
        elif held + (upto := int(n[~lower].sum())) >= wanted or upto == n.sum():
            among, held = among[~(upper | lower)], held + before
        else:
            among, held = among[lower], held + upto
        if len(among) == last:  # of one priority
            break
    order = np.argsort(-priorities[among], kind="stable")
    upto = held + np.cumsum(sizes[among][order])
    return int(among[order[min(np.searchsorted(upto, wanted), len(order) - 1)]])


def _chooser(index: dict, wanted: int, forest: Forest) -> Callable[[], Callable[[np.ndarray], Iterator[tuple[slice, np.ndarray]]]]:
    """What a task calls once for a function of vectors that yields some of them and the leaves of ``probe_leaves`` they meet
    (vectors x leaves, by their number in ``forest``)."""
    # in a single tier, which of equal priorities come first is the queue's choice
    first = None
    if index["manifest"]["tiers"] == 1:
        number = {name: i for i, name in enumerate(forest.names)}
        first = [(tree.plain(), sizes, np.array([number.get((t, path), -1) for path in tree.paths])) for t, tree, sizes in _first_tier(index)]
    shipped = index["tiers"].sparkSession.sparkContext.broadcast((forest.plain(), first))

    def of_task() -> Callable[[np.ndarray], Iterator[tuple[slice, np.ndarray]]]:
        plain, first = shipped.value
        plain, sizes = (plain[0].astype(np.float64), *plain[1:]), plain[-1]
        trees = [(t, Subtree(*parts), n) for t, (parts, n, _) in enumerate(first)] if first else []
        step = max(1, (1 << 22) // max(1, len(plain[1])))

        def met(rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
            for start in range(0, len(rows), step):
                some = slice(start, min(start + step, len(rows)))
                chosen = np.zeros((some.stop - start, len(sizes)), dtype=bool)
                if first:
                    for own, row in zip(chosen, rows[some]):
                        leaves = [(-min(p, 1e9), int(first[t][2][leaf])) for t, leaf, p in best_first(trees, row, math.inf, float(wanted), 1)]
                        leaves = sorted(pair for pair in leaves if pair[1] >= 0)
                        order = np.array([leaf for _, leaf in leaves], dtype=np.int64)
                        own[order[np.cumsum(sizes[order]) - sizes[order] < wanted]] = True
                else:
                    for own, priorities in zip(chosen, np.ascontiguousarray(leaf_priorities(plain, rows[some]).T)):
                        last = last_leaf(priorities, sizes, wanted)
                        np.greater(priorities, priorities[last], out=own)
                        own[: last + 1] |= priorities[: last + 1] == priorities[last]
                yield some, chosen

        return met

    return of_task


def probed_bits(index: dict, queries: DataFrame, wanted: int, forest: Forest) -> DataFrame:
    """``queries`` with the leaves of ``probe_leaves`` as bits by their number in ``forest``, and how many they are: (*, bits,
    leaves)."""
    chooser = _chooser(index, wanted, forest)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = chooser()
        for batch in batches:
            for some, chosen in met(_matrix(batch.column("vector"))):
                bits = pa.array([bits.tobytes() for bits in np.packbits(chosen, axis=1)], pa.binary())
                columns = [*batch.slice(some.start, len(chosen)).columns, bits, pa.array(chosen.sum(axis=1), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "bits", "leaves"])

    schema = T.StructType([*queries.schema.fields, T.StructField("bits", T.BinaryType()), T.StructField("leaves", T.LongType())])
    return queries.mapInArrow(choose, schema)


def leaves_of_items(index: dict, forest: Forest) -> DataFrame:
    """(item_id, places): the numbers of the leaves that hold an item, one per tree."""
    spark = index["postings"].sparkSession
    numbers = pa.table({
        "tree": pa.array([t for t, _ in forest.names], pa.int32()),
        "leaf": pa.array([leaf for _, leaf in forest.names], pa.string()),
        "place": pa.array(range(len(forest.names)), pa.int32()),
    })
    # a row per leaf, fewer than there are planes and trees together
    numbered = index["postings"].join(F.broadcast(spark.createDataFrame(numbers)), ["tree", "leaf"])
    return numbered.groupBy("item_id").agg(F.collect_set("place").alias("places"))


def held_by_bits(query_rows: pa.Table, item_rows: pa.Table) -> Iterator[tuple[slice, object]]:
    """Blocks of queries and, for each, which of some items lie in one of a query's leaves (queries x items)."""
    places = item_rows.column("places").to_pylist()
    width = max(len(p) for p in places)
    places = np.array([p + [p[0]] * (width - len(p)) for p in places], dtype=np.int64)
    bits = [np.frombuffer(b, dtype=np.uint8) for b in query_rows.column("bits").to_pylist()]
    for start in range(0, len(bits), STEP_QUERIES):
        some = slice(start, min(start + STEP_QUERIES, len(bits)))
        chosen = np.unpackbits(np.stack(bits[some]), axis=1)
        if len(chosen) < STEP_QUERIES:
            chosen = np.vstack([chosen, np.zeros((STEP_QUERIES - len(chosen), chosen.shape[1]), dtype=np.uint8)])
        askers = np.ascontiguousarray(np.packbits(chosen, axis=0).T).view(np.uint64)  # of each leaf, the queries as bits

        def held(part: slice, askers: np.ndarray = askers, n: int = some.stop - some.start) -> np.ndarray:
            own = places[part]
            either = askers[own[:, 0]]
            for tree in range(1, own.shape[1]):
                either |= askers[own[:, tree]]
            return np.ascontiguousarray(np.unpackbits(either.view(np.uint8), axis=1)[:, :n].T).view(bool)

        yield some, held


def candidate_counts(index: dict, queries: DataFrame, wanted: int) -> DataFrame:
    """Per query the leaves met, the distinct items in them, and whether ``target`` is one: (query_id, leaves, candidates, own).

    ``queries`` is (query_id, vector, target). The candidates are formed in cells and only counted, never written out.
    """
    forest = whole_forest(index)
    queries = queries.filter(F.size("vector") > 0).dropDuplicates(["query_id", "vector"])
    chosen = materialise(probed_bits(index, queries, wanted, forest).select("query_id", "target", "leaves", "bits"), "chosen")
    items = materialise(leaves_of_items(index, forest), "places")

    def meet(query_rows: pa.Table, item_rows: pa.Table) -> pa.Table:
        n = query_rows.num_rows
        counts, own = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        if n and item_rows.num_rows:
            ids = item_rows.column("item_id").to_numpy()
            targets = query_rows.column("target").to_pylist()
            for some, held in held_by_bits(query_rows, item_rows):
                asked: dict[int, list[int]] = {}
                for row, target in enumerate(targets[some]):
                    asked.setdefault(target, []).append(row)
                for start in range(0, len(ids), STEP_ITEMS):
                    part = slice(start, min(start + STEP_ITEMS, len(ids)))
                    found = held(part)
                    counts[some] += np.count_nonzero(found, axis=1)
                    for col, item in enumerate(ids[part].tolist()):
                        for row in asked.get(item, ()):
                            own[some.start + row] += found[row, col]
        columns = [query_rows.column("query_id"), query_rows.column("leaves"), pa.array(counts), pa.array(own)]
        return pa.table(columns, names=["query_id", "leaves", "candidates", "own"])

    counted = in_cells(chosen, items, meet, "query_id bigint, leaves bigint, candidates bigint, own bigint", wide=True)
    return counted.groupBy("query_id", "leaves").agg(F.sum("candidates").alias("candidates"), F.sum("own").alias("own"))


def _held_first(index: dict, asked: DataFrame, wanted: int, forest: Forest, k: int, most: int) -> DataFrame:
    """(asker, query_id, item_id, distance): of the pairs in ``near`` the first ``k`` per query that lie in a leaf it meets.

    ``asked`` is (asker, query_id, vector, near), ``near`` the ``most`` nearest items in order as (distance, item_id, places). A
    query that could find more beyond them has a row without an item instead.
    """
    chooser = _chooser(index, wanted, forest)

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = chooser()
        for batch in batches:
            for some, chosen in met(_matrix(batch.column("vector"))):
                part = batch.slice(some.start, len(chosen))
                near = part.column("near")
                lengths, pairs = np.diff(near.offsets.to_numpy()), near.flatten()
                places = pairs.field("places")
                row = np.repeat(np.arange(len(chosen)), lengths)
                pair = np.repeat(np.arange(len(row)), np.diff(places.offsets.to_numpy()))
                held = np.bincount(pair, chosen[row[pair], places.flatten().to_numpy()], len(row)) > 0
                found = np.bincount(row, held, len(chosen))
                whole = (found >= k) | (lengths < most)
                upto = np.cumsum(held)
                before = np.append(0, upto)[near.offsets.to_numpy()[:-1] - near.offsets[0].as_py()]
                kept = np.flatnonzero(held & (upto - before[row] <= k) & whole[row])
                short = np.flatnonzero(~whole)
                askers = pa.array(np.append(row[kept], short))
                columns = [part.column(name).take(askers) for name in ("asker", "query_id")]
                for name in ("item_id", "distance"):
                    own = pairs.field(name).take(pa.array(kept))
                    columns.append(pa.concat_arrays([own, pa.nulls(len(short), own.type)]))
                yield pa.RecordBatch.from_arrays(columns, names=["asker", "query_id", "item_id", "distance"])

    return asked.mapInArrow(hold, "asker bigint, query_id bigint, item_id bigint, distance double")


def _crowded_top_k(index: dict, queries: DataFrame, wanted: int, k: int) -> DataFrame:
    """(query_id, item_id, distance): the nearest of the items in the leaves that a query meets, ``k`` at least where it meets
    as many.

    The ``AHEAD * k`` nearest of all items are found first, and a query's leaves looked up for these alone. Queries that find
    fewer than ``k`` among them go through all items of their leaves.
    """
    forest = whole_forest(index)
    most = AHEAD * k
    vectors = index["items"].dropDuplicates(["item_id", "h1", "h2"]).select("item_id", "vector")
    places = materialise(leaves_of_items(index, forest), "places")
    items = materialise(places.join(vectors, "item_id"), "placed-vectors")
    asked = materialise(queries.filter("query_id is not null").withColumn("asker", F.monotonically_increasing_id()), "asked")
    near = in_cells(asked.select(F.col("asker").alias("query_id"), "vector"), items.select("item_id", "vector"), cell_top_k(most), _HITS, most > FEW_ANSWERS)
    near = top_k_per_query(near, most).join(places, "item_id")
    lists = near.groupBy(F.col("query_id").alias("asker")).agg(F.array_sort(F.collect_list(F.struct("distance", "item_id", "places"))).alias("near"))
    held = materialise(_held_first(index, asked.join(lists, "asker"), wanted, forest, k, most), "held")
    best = held.filter("item_id is not null").drop("asker")
    short = materialise(asked.join(held.filter("item_id is null").select("asker"), "asker", "left_semi"), "unheld")
    if short.isEmpty():
        return best
    chosen = materialise(probed_bits(index, short.drop("asker"), wanted, forest).drop("leaves"), "chosen")
    return best.unionByName(in_cells(chosen, items, cell_top_k(k, held_by_bits), _HITS, wide=True))


def postings_of(index: dict, probes: DataFrame) -> DataFrame:
    """The postings of the probed leaves; only the folders that hold some of them are read."""
    parts = sorted(r[0] for r in probes.select("part").distinct().collect())  # PARTS at most
    wanted = broadcast_if_small(probes.select("tree", "leaf").distinct())
    return index["postings"].filter(F.col("part").isin(parts)).join(wanted, ["tree", "leaf"], "left_semi").select("tree", "leaf", "item_id")


def knn_candidates(index: dict, queries: DataFrame, candidates: int | None = None) -> DataFrame:
    """Per query the leaves a search will probe and the distinct items in them: (query_id, leaves, candidates).

    An item that several trees propose counts once, and stands for its exact copies.
    """
    wanted = candidates or index["manifest"]["candidates"]
    if crowded(index, queries.count(), wanted):
        return candidate_counts(index, queries.withColumn("target", F.lit(None).cast("bigint")), wanted).drop("own")
    probes = materialise(probe_leaves(index, queries, candidates), "probes")
    pairs = probes.select("query_id", "tree", "leaf").join(postings_of(index, probes), ["tree", "leaf"]).select("query_id", "item_id").distinct()
    items = pairs.groupBy("query_id").agg(F.count(F.lit(1)).alias("candidates"))
    return probes.groupBy("query_id").agg(F.count(F.lit(1)).alias("leaves")).join(items, "query_id")


def candidates_with(index: dict, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """(query_id, own): how often the item ``target`` of a query, from (query_id, target), is among its distinct candidates."""
    wanted = index["manifest"]["candidates"]
    if crowded(index, queries.count(), wanted):
        return candidate_counts(index, queries.join(targets, "query_id"), wanted).select("query_id", "own")
    probes = materialise(probe_leaves(index, queries), "probes")
    pairs = probes.join(postings_of(index, probes), ["tree", "leaf"]).select("query_id", "item_id").distinct()
    return pairs.join(targets, "query_id").groupBy("query_id").agg(F.count_if(F.col("item_id") == F.col("target")).alias("own"))


def search(index: dict, queries: DataFrame, k: int = 10, candidates: int | None = None, include_distances: bool = True) -> DataFrame:
    """Approximately nearest ``k`` items per query: (query_id, item_id[, distance], rank).

    Every query gets min(k, items) rows. ``candidates`` is how many items the probed leaves hold, counted once per tree;
    by default what the index was tuned to, and never so few that k different items could be missed. Equal query vectors
    are searched once. A vector that has copies stands for them until the end; of its copies the first ``k`` ids can make
    the result, so only those are put back. Items and queries meet leaf by leaf, so a vector moves once per leaf and block,
    or in cells where the searches are ``crowded``; pairs are never written; what several trees find is made distinct by id. Null and empty queries get no rows.
    """
    manifest = index["manifest"]
    wanted = max(candidates or manifest["candidates"], k * manifest["n_trees"])
    hashed = queries.filter(F.size("vector") > 0).select("query_id", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    hashed = materialise(hashed, "queries")
    first = hashed.groupBy("h1", "h2").agg(F.min("query_id").alias("rep"))
    askers = hashed.select("query_id", "h1", "h2").join(first, ["h1", "h2"]).select("rep", "query_id")
    distinct = materialise(hashed.join(first.select(F.col("rep").alias("query_id")), "query_id", "left_semi").select("query_id", "vector"), "distinct")
    if crowded(index, distinct.count(), wanted):
        near = _crowded_top_k(index, distinct, wanted, k)
    else:
        probes = materialise(probe_leaves(index, distinct, wanted), "probes")
        near = block_top_k(probes.select("tree", "leaf", "query_id"), postings_of(index, probes), ["tree", "leaf"], distinct, index["items"], k)
    best = materialise(top_k_per_query(near.distinct(), k).drop("rank"), "best")
    # the leaves of a subtree may be few: a query that met fewer than k different items scans them all
    reps = index["copies"].select("rep").distinct()
    enough = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(k, reps.count()))
    short = materialise(distinct.join(enough, "query_id", "left_anti"), "short")
    if not short.isEmpty():
        exact = knn_exact(short, index["items"].join(reps, F.col("item_id") == F.col("rep"), "left_semi").select("item_id", "vector"), k).drop("rank")
        best = best.join(short.select("query_id"), "query_id", "left_anti").unionByName(exact)

    first_copies = top_k_per_query(index["copies"], k, ("rep",), "item_id").drop("rank")
    spread = best.withColumnRenamed("item_id", "rep").join(first_copies, "rep").drop("rep")
    ranked = top_k_per_query(spread, k)
    answered = ranked.withColumnRenamed("query_id", "rep").join(askers, "rep")
    columns = ["query_id", "item_id", "distance", "rank"] if include_distances else ["query_id", "item_id", "rank"]
    return answered.select(*columns)


def tuned_candidates(index: dict, recall: float, k: int) -> int:
    """How many items the probed leaves have to hold so that some of the index's own vectors find the share ``recall`` of
    their ``k`` nearest others (the vectors themselves are too easy to find and do not count).

    The vectors are drawn by the hash of their value. An item counts as found where the first leaf that holds it is met.
    """
    spark = index["items"].sparkSession
    reps = index["copies"].select(F.col("rep").alias("item_id")).distinct()
    singles = index["items"].select("item_id", "vector", "h2").join(reps, "item_id", "left_semi")
    asked = singles.orderBy("h2", "item_id").limit(TUNING_QUERIES).select(F.col("item_id").alias("query_id"), "vector").toArrow()
    queries = spark.createDataFrame(asked)
    nearest = knn_exact(queries, singles.select("item_id", "vector"), k + 1).filter("query_id <> item_id").select("query_id", "item_id")
    wanted = spark.createDataFrame(nearest.collect(), nearest.schema)  # TUNING_QUERIES * (k + 1) rows, at most
    held = index["postings"].join(F.broadcast(wanted), "item_id").select("query_id", "tree", "leaf", "item_id")
    every = 1 << 60
    if index["manifest"]["tiers"] == 1:  # the first tier is all there is, and it is here
        trees = _first_tier(index)
        upto_of: dict[tuple, int] = {}
        for query, row in zip(asked.column("query_id").to_pylist(), _matrix(asked.column("vector"))):
            seen = 0
            for which, leaf, _ in best_first(trees, row, math.inf, math.inf, 0):
                seen += int(trees[which][2][leaf])
                upto_of[query, trees[which][0], trees[which][1].paths[leaf]] = seen
        reached: dict[tuple, int] = {}
        for r in held.collect():  # a row per wanted item and tree
            pair = (r["query_id"], r["item_id"])
            reached[pair] = min(reached.get(pair, every), upto_of[r["query_id"], r["tree"], r["leaf"]])
        upto = sorted(reached.values())
    else:
        probes = probe_leaves(index, queries, every, TUNING_LEAVES)
        order = Window.partitionBy("query_id").orderBy(F.col("priority").desc(), "tree", "leaf")
        met = probes.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        first = held.join(met, ["query_id", "tree", "leaf"]).groupBy("query_id", "item_id").agg(F.min("upto").alias("upto"))
        found = wanted.join(first, ["query_id", "item_id"], "left").select(F.coalesce("upto", F.lit(every)).alias("upto"))
        upto = sorted(r["upto"] for r in found.collect())
    least = k * index["manifest"]["n_trees"]
    if not upto:
        return least
    need = upto[min(len(upto) - 1, math.ceil(recall * len(upto)) - 1)]
    total = index["leaves"].agg(F.sum("n")).first()[0]
    return int(max(least, min(need, total)))
