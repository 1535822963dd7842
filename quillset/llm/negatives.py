"""Hard negatives by exact integer scores, several candidates at a time in one wide integer.

Components become whole numbers. Both sides are raised by their smallest component, so that all numbers are 0 or more and a
sum over the dimensions stays below a known bound; that bound gives the width of a field. Candidates lie side by side in
the fields of one wide integer, each anchor component is multiplied with it once, and the fields of the sum are the
candidates' raised scores, from which the raise is taken off again. Words of 53 bits, which doubles hold without rounding,
hold the fields when two fit; else the words are Python integers of any width.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.session import broadcast_if_small, materialise

SCALE = 256.0
#: Bits that a double holds exactly, and bits of a word of Python integers.
EXACT_BITS, WIDE_BITS = 53, 4096
#: Rows that meet in a task: anchors and candidates; fewer when vectors are long.
ANCHOR_BLOCK, ROW_BLOCK, BLOCK_BYTES = 1024, 4096, 16 << 20
ANCHORS_AT_ONCE = 128

_SCORED = "anchor_id {key}, other_id {key}, score bigint"
_NEGATIVE = "anchor_id {key}, place int, positive_id {key}, negative_id {key}, positive_score bigint, negative_score bigint"


def whole_numbers(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of floor(256 * component): 64-bit integers, or Python integers when components are larger than 2 ** 62."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    with np.errstate(over="ignore"):
        values = np.floor(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(len(flat), dim)
    if not values.size or np.abs(values).max() < 2.0**62:
        return values.astype(np.int64)
    if not np.isfinite(values).all():
        raise OverflowError("a component is too large to become a whole number")
    return np.array([[int(x) for x in row] for row in values], dtype=object).reshape(values.shape)


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of every anchor (rows of whole numbers) with every row, exact; an error if one exceeds 64 bits."""
    (m, dim), n = anchors.shape, len(rows)
    if not m or not n or not dim:
        return np.zeros((m, n), dtype=np.int64)
    low_a, low_r = int(anchors.min()), int(rows.min())
    if max(abs(low_a), abs(low_r), int(anchors.max()), int(rows.max())) >= 1 << 61:
        anchors, rows = anchors.astype(object), rows.astype(object)
    a, r = anchors - low_a, rows - low_r
    width = max(1, (dim * int(a.max()) * int(r.max())).bit_length())
    exact = EXACT_BITS // width >= 2
    fields = EXACT_BITS // width if exact else max(1, WIDE_BITS // width)
    groups = -(-n // fields)
    kind = np.int64 if exact else object
    raised = np.zeros((groups * fields, dim), dtype=kind)
    raised[:n] = r
    shifts = np.array([width * f for f in range(fields)], dtype=kind)
    words = (raised.reshape(groups, fields, dim) << shifts[None, :, None]).sum(axis=1)
    if exact:
        sums = (a.astype(np.float64) @ words.astype(np.float64).T).astype(np.int64)
    else:
        sums = a.astype(object) @ words.T
    unpacked = ((sums[:, :, None] >> shifts) & ((1 << width) - 1)).reshape(m, groups * fields)[:, :n]
    if not exact:
        a, r = a.astype(object), r.astype(object)
    scores = unpacked + low_r * a.sum(axis=1)[:, None] + low_a * r.sum(axis=1)[None, :] + dim * low_a * low_r
    if scores.dtype == object:
        if max(abs(int(scores.min())), abs(int(scores.max()))) >= 1 << 63:
            raise OverflowError("a score does not fit in 64 bits")
        scores = scores.astype(np.int64)
    return scores


def usable(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, v, dim) of the rows that take part."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    kept = df.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    return kept.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"), F.size(vector).alias("dim"))


def _meeting(anchors: DataFrame, rows: DataFrame, groups: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides cut into blocks of bounded size; every block of anchors meets every block of rows of its group once."""
    room = lambda most: F.greatest(F.lit(64), F.least(F.lit(most), F.floor(F.lit(BLOCK_BYTES) / (8 * F.greatest("dim", F.lit(1))))))
    count = lambda side, most, name: side.groupBy(*groups).agg(F.ceil(F.count(F.lit(1)) / F.max(room(most))).cast("int").alias(name))
    sizes = count(anchors, ANCHOR_BLOCK, "na").join(count(rows, ROW_BLOCK, "nr"), groups)
    sizes = broadcast_if_small(materialise(sizes, "block-sizes"))

    def dealt(side: DataFrame, own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        place = F.pmod(F.xxhash64("id"), F.col(n_own)).cast("int").alias(own)
        return side.join(sizes, groups).select(*[F.col(c) for c in side.columns], place, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1)).alias(other))

    cells = [*groups, "cell_a", "cell_r"]
    return dealt(anchors, "cell_a", "na", "cell_r", "nr"), dealt(rows, "cell_r", "nr", "cell_a", "na"), cells


def _parts(anchors: pa.Table, rows: pa.Table):
    """(index of the first anchor of the part, scores) for some anchors at a time."""
    if anchors.num_rows and rows.num_rows:
        dim = anchors.column("dim")[0].as_py()
        a, r = whole_numbers(anchors.column("v"), dim), whole_numbers(rows.column("v"), dim)
        for begin in range(0, len(a), ANCHORS_AT_ONCE):
            yield begin, packed_scores(a[begin : begin + ANCHORS_AT_ONCE], r)


def best_of_label(anchors: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(anchor_id, positives: array of id and score) of each anchor's ``k`` best other rows of its label."""
    kind = anchors.schema["id"].dataType.simpleString()

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, own = right.column("id").to_numpy(zero_copy_only=False), left.column("id").to_numpy(zero_copy_only=False)
        found: list[tuple] = []
        for begin, scores in _parts(left, right):
            for row, line in enumerate(scores):
                others = np.flatnonzero(ids != own[begin + row])
                if len(others) > k:
                    others = others[line[others] >= np.partition(line[others], len(others) - k)[len(others) - k]]
                order = others[np.lexsort((ids[others], -line[others]))[:k]]
                found += [(own[begin + row], ids[i], line[i]) for i in order]
        columns = list(zip(*found)) or [(), (), ()]
        types = [left.schema.field("id").type, right.schema.field("id").type, pa.int64()]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], names=["anchor_id", "other_id", "score"])

    left, right, cells = _meeting(anchors, rows, ["dim", "label"])
    scored = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(best, _SCORED.format(key=kind))
    top = _first(scored, ["anchor_id"], "score", "other_id", k, "place")
    listed = F.sort_array(F.collect_list(F.struct("place", F.col("other_id").alias("id"), "score")))  # k at most
    return top.groupBy("anchor_id").agg(listed.alias("positives"))


def _first(df: DataFrame, by: list[str], score: str, tie: str, k: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(256 * component), exact. An anchor (a row that ``anchors`` holds for) has as
    positives its ``n_positives`` best other rows of the same label. For each of them the first ``n_negatives`` rows of
    other labels are returned whose score is at least ``low`` and at most ``high`` hundredths of the positive's; all, if
    there are fewer. Higher scores come first, ties by smaller key. Rows take part that have a key, a label and a vector of
    finite components; they meet rows of equal dimension. Other rows of an anchor are those with another key; rows that
    repeat a key each count as a candidate and as a positive, and of those that repeat an anchor's key the smallest label and vector is the
    anchor. Other columns are not read. All anchors meet all rows, in blocks of bounded size; no label is gathered.
    """
    rows = materialise(usable(df, key, vector, label), "negatives-rows")
    chosen = usable(df.filter(anchors), key, vector, label).groupBy("id").agg(F.min(F.struct("label", "v", "dim")).alias("r"))
    chosen = materialise(chosen.select("id", "r.*"), "negatives-anchors")
    kind = chosen.schema["id"].dataType.simpleString()
    positives = best_of_label(chosen, rows, n_positives)
    asking = materialise(chosen.join(positives, chosen["id"] == positives["anchor_id"]).drop("anchor_id"), "negatives-asking")

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, labels = right.column("id").to_numpy(zero_copy_only=False), right.column("label").to_numpy(zero_copy_only=False)
        own, own_label, wanted = left.column("id").to_pylist(), left.column("label").to_pylist(), left.column("positives").to_pylist()
        out: list[list] = [[], [], [], [], [], []]
        for begin, scores in _parts(left, right):
            for row, line in enumerate(scores):
                at = begin + row
                # of whole scores: 100 * n >= low * p, and 100 * n <= high * p
                bounds = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in wanted[at]]
                least, most = min(b for b, _ in bounds), max(b for _, b in bounds)
                near = np.flatnonzero((line >= least) & (line <= most) & (labels != own_label[at]))
                near = near[np.lexsort((ids[near], -line[near]))]
                falling = -line[near]
                for p, (bottom, top) in zip(wanted[at], bounds):
                    begins = int(np.searchsorted(falling, -top))
                    ends = min(begins + n_negatives, int(np.searchsorted(falling, -bottom, side="right")))
                    for i in near[begins:ends]:
                        for column, value in zip(out, (own[at], p["place"], p["id"], ids[i], p["score"], line[i])):
                            column.append(value)
        key_type = left.schema.field("id").type
        types = [key_type, pa.int32(), key_type, key_type, pa.int64(), pa.int64()]
        names = ["anchor_id", "place", "positive_id", "negative_id", "positive_score", "negative_score"]
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=names)

    left, right, cells = _meeting(asking, rows, ["dim"])
    found = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(negatives, _NEGATIVE.format(key=kind))
    ranked = _first(found, ["anchor_id", "place"], "negative_score", "negative_id", n_negatives, "rank")
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast(T.IntegerType()), "negative_id", "positive_score", "negative_score")


NEGATIVES_SQL = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
        cast(list_dot_product(a.v, r.v) as bigint) as score
    from rows a join rows r on a.vec_id <> r.vec_id
    where a.vec_id % 100 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), met as (
    select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
        cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as int) as rank
    from positives join scored using (anchor_id)
    where not same and 100 * score between 30 * positive_score and 90 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from met where rank <= 10
"""
