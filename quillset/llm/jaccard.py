"""Join of documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more, and its components.

Equal sets form a class, which its smallest document stands for. Two linked sets share a shingle among the first
``n - ceil(0.8 n) + 1`` of each under any common order; frequent shingles come last in the order used, so that they seldom
gather many classes. The classes that hold a shingle there form its bucket, and buckets are searched in two rounds:

1. each class is checked against one leader, the fullest class of most of its buckets; linked classes get a common label;
2. in each bucket that still holds several labels, a signature tree is built. A node holds the OR of its members' token
   bitmaps, the range of their sizes and their common label, if they have one. The tree is traversed against itself, and a
   pair of nodes is left out when its sizes, its labels or its largest possible overlap rule every link out. What reaches
   the leaves is a candidate.

Candidates of both rounds are checked on the whole sets. Pairs inside a label are never formed, so a group of copies costs
about as many checks as it has members. Shingles
and classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import in_pieces, rows_with_keys
from quillset.llm.shingles import shingle_sets
from quillset.session import broadcast_if_small, materialise

#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: A shingle is frequent if a share of 1 / FREQUENT of the documents has it, counted over runs of CHUNK shingles. At most
#: 2 * FREQUENT * (mean size of a set) are, whatever the number of documents; their list is broadcast.
FREQUENT, CHUNK = 1000, 4_000_000
#: Members of a tree node.
FANOUT = 8
#: Rows of a bucket that are searched in one task; a larger bucket is searched block by block.
BLOCK = 4096
#: Buckets of a class that are known in each of its buckets, so that a pair is seldom given twice.
FIRSTS = 8
#: Texts that meet the text of one class in one run.
MEETING = 256


def bitmap(hashes: np.ndarray) -> bytes:
    """One bit per shingle, by the low bits of its hash, in a map of a power of two bits: at least four times the set's
    size for small sets, down to its size for large ones. Linked sets have widths that differ by one doubling at most."""
    n = len(hashes)
    width = max(64, min(1 << (4 * n - 1).bit_length(), 2048 if n <= 1024 else 4096), 1 << (n - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def class_of(hashes: np.ndarray) -> int | None:
    """The class of a set: 64 bits of the digest of its sorted shingles; none for the empty set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True) if len(hashes) else None


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Two kinds of rows of one pass over the texts: id, n, class and bits for each document; shingle and n for the
    shingles that many documents of a run share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def often(sets: list[np.ndarray]) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(sets), return_counts=True)
            many = counts >= max(4, len(sets) // FREQUENT)
            size = int(many.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(size, pa.int64()), pa.array(counts[many]), pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary()), pa.array(values[many].view(np.int64))],
                names=["id", "n", "class", "bits", "shingle"],
            )

        held: list[np.ndarray] = []
        size = 0
        for batch in in_pieces(batches, text):
            sets = shingle_sets(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) for s in sets], pa.int64()),
                    pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()), pa.nulls(len(sets), pa.int64()),
                ],
                names=["id", "n", "class", "bits", "shingle"],
            )
            held, size = held + [s for s in sets if len(s)], size + sum(map(len, sets))
            if size >= CHUNK:
                yield often(held)
                held, size = [], 0
        if held:
            yield often(held)

    rows = docs.select(F.col(key).alias("id"), F.col(text)).mapInArrow(run, "id long, n long, class long, bits binary, shingle long")
    return materialise(rows, "signatures")


def frequent_shingles(signed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the frequent shingles and the level of each: the higher, the more frequent."""
    least = max(8, signed.filter("shingle IS NULL").count() // (2 * FREQUENT))
    counts = signed.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    found = counts.select("shingle", F.log2("n").cast("int").alias("level")).toPandas()
    hashes = found["shingle"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found["level"].to_numpy(dtype=np.int64)[order]


def first_shingles(docs: DataFrame, text: str, hot: np.ndarray, level: np.ndarray) -> DataFrame:
    """Rows (token, id): 48 bits of each of the first shingles of a class in the common order. Copies read by one task
    give them once."""
    sent = docs.sparkSession.sparkContext.broadcast((hot, level))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, level = sent.value
        seen: set[int] = set()
        for batch in in_pieces(batches, text, 1 << 20):
            tokens, ids = [], []
            for hashes in shingle_sets(batch.column(text)):
                n, own = len(hashes), class_of(hashes)
                if not n or own in seen:
                    continue
                seen.add(own)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
                    hashes = hashes[np.argsort(np.where(hot[at] == hashes, level[at], 0), kind="stable")]
                tokens.append(hashes[: n - -(-PERCENT * n // 100) + 1])
                ids.append(np.full(len(tokens[-1]), own, dtype=np.int64))
            if tokens:
                token = (np.concatenate(tokens) >> np.uint64(16)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(np.concatenate(ids))], names=["token", "id"])

    return docs.select(text).mapInArrow(run, "token long, id long")


class Leaf:
    """One class of documents as the lowest node of a signature tree."""

    __slots__ = ("bits", "children", "high", "id", "label", "low", "slack", "width")

    def __init__(self, key: int, n: int, label: int, bits: bytes):
        self.id, self.low, self.high, self.label, self.children = key, n, n, label, None
        self.width, self.bits = 8 * len(bits), int.from_bytes(bits, "little")
        self.slack = n - self.bits.bit_count()  # shingles that share a bit with another


class Node:
    """Members with maps of one width: OR of the maps, range of sizes, most collisions, and their label if they share it."""

    __slots__ = ("bits", "children", "high", "label", "low", "slack", "width")

    def __init__(self, children: list):
        self.children, self.width, self.bits = children, children[0].width, 0
        for c in children:
            self.bits |= c.bits
        self.low, self.high = min(c.low for c in children), max(c.high for c in children)
        self.slack = max(c.slack for c in children)
        labels = {c.label for c in children}
        self.label = labels.pop() if len(labels) == 1 else None


def folded(bits: int, width: int, to: int) -> int:
    """The map of the same set in ``to`` bits."""
    while width > to:
        width >>= 1
        bits = (bits | bits >> width) & ((1 << width) - 1)
    return bits


def overlap_allows(n: int, x: int, m: int, y: int) -> bool:
    """Whether sets of ``n`` and ``m`` shingles with the maps ``x`` and ``y`` can be linked."""
    return min(n - (x & ~y).bit_count(), m - (y & ~x).bit_count()) * (100 + PERCENT) >= PERCENT * (n + m)


def may_link(a: Leaf | Node, b: Leaf | Node) -> bool:
    """False only if no member of ``a`` can be linked to one of ``b`` with another label."""
    if a.high * 100 < PERCENT * b.low or b.high * 100 < PERCENT * a.low:
        return False
    if a.label is not None and a.label == b.label:
        return False
    if a.children is None and b.children is None:
        width = min(a.width, b.width)
        return overlap_allows(a.low, folded(a.bits, a.width, width), b.low, folded(b.bits, b.width, width))
    if a.width != b.width:
        return True  # collisions are counted at one width only
    most = (a.bits & b.bits).bit_count() + min(a.slack, b.slack)
    return most * (100 + PERCENT) >= PERCENT * (a.low + b.low)


def signature_trees(leaves: list[Leaf]) -> dict[int, Leaf | Node]:
    """A tree for each width of map; similar sizes side by side, crowded labels apart."""
    crowds: dict[int, int] = {}
    for leaf in leaves:
        crowds[leaf.label] = crowds.get(leaf.label, 0) + 1
    trees = {}
    leaves = sorted(leaves, key=lambda m: (m.width, m.label if crowds[m.label] > FANOUT else -1, m.low, m.id))
    for width, members in groupby(leaves, key=lambda m: m.width):
        level = [*members]
        while len(level) > 1:
            level = [Node(level[at : at + FANOUT]) for at in range(0, len(level), FANOUT)]
        trees[width] = level[0]
    return trees


def traverse(a: Leaf | Node, b: Leaf | Node) -> Iterator[tuple[int, int]]:
    """Pairs of ids, the smaller first, that the traversal of two trees, or of one with itself, leaves."""
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        if a is b:
            if a.children is not None and a.label is None:
                stack += [(x, y) for i, x in enumerate(a.children) for y in a.children[i:]]
        elif may_link(a, b):
            if a.children is None and b.children is None:
                if a.id != b.id:
                    yield (a.id, b.id) if a.id < b.id else (b.id, a.id)
            elif b.children is None or (a.children is not None and a.high - a.low >= b.high - b.low):
                stack += [(x, b) for x in a.children]
            else:
                stack += [(a, y) for y in b.children]


def tree_pairs(left: list[Leaf], right: list[Leaf] | None = None) -> Iterator[tuple[int, int]]:
    """Candidates within ``left``, or between ``left`` and ``right``. Maps of linked sets differ by one doubling at most."""
    trees = signature_trees(left)
    others = trees if right is None else signature_trees(right)
    for width, tree in trees.items():
        for other in (width, 2 * width) if right is None else (width // 2, width, 2 * width):
            if other in others:
                yield from traverse(tree, others[other])


def bucket_candidates(rows: DataFrame) -> DataFrame:
    """Distinct pairs a < b of classes that the trees of the buckets leave.

    ``rows``: token, left and right block, side, id, n, label, bits, firsts; one row per class, bucket and pair of blocks.
    ``firsts`` are the first few buckets of the class: a pair with a common one of them is given in that bucket only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(token: int, bucket: list[tuple]) -> Iterator[tuple[int, int]]:
            sides: tuple[dict, dict] = ({}, {})
            firsts = {}
            for _, _, _, side, key, n, label, bits, own in bucket:
                if key not in sides[side]:
                    sides[side][key] = Leaf(key, n, label, bits)
                    firsts[key] = frozenset(own)
            left, right = ([*s.values()] for s in sides)
            for a, b in tree_pairs(left, right or None):
                common = firsts[a] & firsts[b]
                if not common or min(common) == token:
                    yield a, b

        def flushed() -> pa.RecordBatch:
            a, b = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        pairs: set[tuple[int, int]] = set()
        stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for (token, _, _), bucket in groupby(stream, key=lambda r: r[:3]):
            for pair in found(token, [*bucket]):
                pairs.add(pair)
                if len(pairs) >= 200_000:
                    yield flushed()
                    pairs = set()
        yield flushed()

    dealt = rows.repartition("token", "left", "right").sortWithinPartitions("token", "left", "right")
    dealt = dealt.select("token", "left", "right", "side", "id", "n", "label", "bits", "firsts")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def in_blocks(rows: DataFrame) -> DataFrame:
    """Buckets of more than BLOCK rows (column ``rows``) cut into blocks by a hash of the id; every two blocks meet once."""
    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    cut = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    meets = F.when(
        F.col("blocks") > 1,
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda other: F.struct(
                F.least("block", other).alias("left"), F.greatest("block", other).alias("right"), (F.col("block") > other).cast("int").alias("side")
            ),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).alias("left"), F.lit(0).alias("right"), F.lit(0).alias("side"))))
    cut = cut.select("token", "id", "n", "label", "bits", "firsts", F.explode(meets).alias("meet"))
    return cut.select("token", "meet.left", "meet.right", "meet.side", "id", "n", "label", "bits", "firsts")


def with_bits(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose bitmaps allow a link."""
    side = lambda s: classes.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, x, m, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b"))):
                width = 8 * min(len(x), len(y))
                maps = (folded(int.from_bytes(z, "little"), 8 * len(z), width) for z in (x, y))
                keep.append(overlap_allows(n, next(maps), m, next(maps)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(run, "a long, b long")


def checked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs (a, b) of classes that are linked, by the whole texts of the documents that stand for them.

    The texts of the members ``b`` of each ``a`` meet the text of ``a`` in runs of MEETING, so a class with many partners is
    spread over many tasks. ``pairs`` is read several times: write it first.
    """
    crowd = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEETING).cast("int").alias("runs"))
    whole = crowd.select("a", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), F.col("a").alias("id"))
    members = pairs.join(crowd, "a").select("a", F.pmod(F.xxhash64("b"), "runs").cast("int").alias("run"), F.col("b").alias("id"))
    parts = whole.unionByName(members).join(classes.select("id", "doc"), "id")
    parts = materialise(parts, "parts")
    wanted = parts.select("doc").distinct()
    texts = docs.select(F.col(key).alias("doc"), text).join(broadcast_if_small(wanted), "doc", "left_semi").dropDuplicates(["doc"])
    small = parts.select("a", "run", "id", "doc")
    meeting = texts.join(broadcast_if_small(small), "doc").select("a", "run", "id", text)
    meeting = meeting.repartition("a", "run").sortWithinPartitions("a", "run", F.col("id") != F.col("a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, whole = None, None
        for batch in in_pieces(batches, text):
            a, b = [], []
            for left, part, right, hashes in zip(*(batch.column(c).to_pylist() for c in ("a", "run", "id")), shingle_sets(batch.column(text))):
                if right == left:
                    met, whole = (left, part), hashes
                elif met == (left, part):
                    common = len(whole) + len(hashes) - len(np.union1d(whole, hashes))
                    if common * (100 + PERCENT) >= PERCENT * (len(whole) + len(hashes)):
                        a.append(left)
                        b.append(right)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return meeting.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Id and smallest reachable id for every id of ``links`` (a, b). Each round takes the least label of the neighbours
    and then that label's own label; every round is written, so a lost executor costs one round."""
    edges = materialise(links.select("a", "b").union(links.select("b", "a")), "edges")
    labels = materialise(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        stepped = labels.join(near, labels["id"] == near["a"]).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        new = stepped.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        new = materialise(new, "labels")
        labels = new.select("id", "label")
        if not new.filter("old <> label").limit(1).count():
            return labels


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_shingles, component_id, the smallest key reachable by links.

    Null and empty texts, and texts of white space, have no shingles and are linked with nothing; a text of fewer than five
    words is one shingle. Equal texts, and repeated rows, share their component. Other columns are not read. Keys are
    integers; a row with a null key is compared like any other and its component is the smallest key there is in it.
    """
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    signed = signatures(docs, key, text)
    hot, level = frequent_shingles(signed)
    signed = signed.filter("shingle IS NULL").drop("shingle")
    classes = signed.filter("class IS NOT NULL").groupBy(F.col("class").alias("id")).agg(F.min("id").alias("doc"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = materialise(classes, "classes")

    held = first_shingles(docs, text, hot, level).repartition("token").distinct()
    sizes = held.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    shared = materialise(held.join(sizes.hint("shuffle_hash"), "token"), "shared-shingles")

    # round 1: one leader for each class, a class that fills its buckets
    scores = shared.groupBy("id").agg(F.sum("rows").alias("mates")).join(classes.select("id", "n"), "id")
    scores = scores.select("id", (F.col("mates") / F.col("n")).alias("score"))
    leads = shared.join(scores, "id").groupBy("token").agg(F.max_by("id", F.struct("score", "id")).alias("lead"))
    votes = shared.join(leads, "token").filter("id <> lead").groupBy("id", "lead").agg(F.count(F.lit(1)).alias("votes"))
    leaders = votes.groupBy(F.col("id").alias("b")).agg(F.max_by("lead", F.struct("votes", "lead")).alias("a")).select("a", "b")
    leaders = materialise(with_bits(leaders, classes), "leader-pairs")
    first = materialise(checked(leaders, classes, docs, key, text), "leader-links")

    # round 2: buckets that hold several labels, one of those that hold the same classes
    labelled = components(first)
    rows = shared.select("token", "id").join(labelled, "id", "left").withColumn("label", F.coalesce("label", "id"))
    rows = materialise(rows, "labelled-shingles")
    buckets = rows.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("id")).alias("held")
    )
    buckets = buckets.filter("low < high").groupBy("low", "high", "rows", "held").agg(F.min("token").alias("token"))
    rows = materialise(rows.join(buckets.select("token", "rows"), "token"), "open-buckets")
    tokens = rows.groupBy("id").agg(F.slice(F.array_sort(F.collect_list("token")), 1, FIRSTS).alias("firsts"))
    rows = rows.join(classes.select("id", "n", "bits").join(tokens, "id"), "id")
    pairs = materialise(bucket_candidates(in_blocks(rows)), "tree-pairs")
    second = checked(pairs, classes, docs, key, text)

    found = components(first.unionByName(second))
    # a component's key is the smallest one of its classes' documents
    named = found.join(classes.select("id", "doc"), "id").groupBy("label").agg(F.min("doc").alias("component_id"))
    named = found.join(named, "label").select(F.col("id").alias("class"), "component_id")
    known = signed.select("id", "n", "class").join(classes.select(F.col("id").alias("class"), "doc"), "class", "left").join(named, "class", "left")
    return known.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc", "id").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose document has the smallest key of its component; keys are unique."""
    kept = jaccard_components(docs, key, text).filter(F.col(key) == F.col("component_id"))
    return rows_with_keys(docs, kept, key)
