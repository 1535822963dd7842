"""Entity spans from B-/I-/O tags, and span-level scores.

A span starts at a B- tag, or at an I- tag that follows O or another type. It ends before O, a B- tag, another
type, or the end of the sentence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillset.functions.answers import ids_to_labels, mask_filter
from quillset.functions.fixed_values import ENTITY_LABELS
from quillset.operators.rows import explode_rows

CHUNK = 65_536  # positions of one sentence handled by one window


def _kind(tag: Column) -> Column:
    return F.substring(tag, 3, 2**31 - 1)


def _starts(tag: Column, before: Column) -> Column:
    return (tag != "O") & (F.startswith(tag, F.lit("B-")) | (before == "O") | (_kind(before) != _kind(tag)))


def _ends(tag: Column, after: Column) -> Column:
    return (tag != "O") & ((after == "O") | F.startswith(after, F.lit("B-")) | (_kind(after) != _kind(tag)))


def span_array(tags: Column) -> Column:
    """Array of (start, end, type) for an array of tag names, positions from 0. Needs no shuffle.

    Spans do not overlap, so the i-th start belongs to the i-th end.
    """
    size = F.size(tags)
    outside = F.array(F.lit("O"))
    cells = F.arrays_zip(
        F.sequence(F.lit(0), size - 1).alias("pos"),
        tags.alias("tag"),
        F.concat(outside, F.slice(tags, 1, F.greatest(size - 1, F.lit(0)))).alias("before"),
        F.concat(F.slice(tags, 2, size), outside).alias("after"),
    )
    starts = F.transform(
        F.filter(cells, lambda c: _starts(c["tag"], c["before"])),
        lambda c: F.struct(c["pos"].alias("start"), _kind(c["tag"]).alias("type")),
    )
    ends = F.transform(F.filter(cells, lambda c: _ends(c["tag"], c["after"])), lambda c: c["pos"])
    spans = F.zip_with(
        starts,
        ends,
        lambda s, e: F.struct(s["start"].alias("start"), e.alias("end"), s["type"].alias("type")),
    )
    # sequence(0, -1) counts down, so an empty sentence is kept apart
    return F.when(size > 0, spans).otherwise(F.filter(spans, lambda s: F.lit(False)))


def bio_spans(df: DataFrame, sent: str, tags: str) -> DataFrame:
    """Spans of tag arrays, one sentence per row: (sent, start, end, type)."""
    found = explode_rows(df.withColumnRenamed(sent, "sent"), span_array(F.col(tags)), "s", "sent")
    return found.select("sent", "s.*")


def with_neighbours(
    df: DataFrame, group: Sequence[str], pos: str, value: str, chunk: int | None = CHUNK
) -> DataFrame:
    """Add ``before`` and ``after``: the value one row earlier and later in the group, by ``pos``.

    The window runs per group and stretch of ``chunk`` positions, so a group of any length is spread over many
    tasks; the values at the seams come from a table with one row per stretch. Values must not be null. Without a
    ``chunk`` the window runs over whole groups: for callers that know them to be short.
    """
    if chunk is None:
        whole = Window.partitionBy(*group).orderBy(pos)
        return df.withColumn("before", F.lag(value).over(whole)).withColumn("after", F.lead(value).over(whole))
    cut = df.withColumn("_chunk", F.floor(F.col(pos) / F.lit(chunk)).cast("bigint"))
    inside = Window.partitionBy(*group, "_chunk").orderBy(pos)
    near = cut.withColumn("before", F.lag(value).over(inside)).withColumn("after", F.lead(value).over(inside))
    seams = cut.groupBy(*group, "_chunk").agg(
        F.min_by(value, pos).alias("_first"), F.max_by(value, pos).alias("_last")
    )
    along = Window.partitionBy(*group).orderBy("_chunk")
    seams = seams.select(
        *group, "_chunk", F.lag("_last").over(along).alias("_before"), F.lead("_first").over(along).alias("_after")
    ).filter(F.col("_before").isNotNull() | F.col("_after").isNotNull())
    return (
        near.join(seams, [*group, "_chunk"], "left")
        .withColumn("before", F.coalesce("before", "_before"))
        .withColumn("after", F.coalesce("after", "_after"))
        .drop("_chunk", "_before", "_after")
    )


def bio_spans_rows(df: DataFrame, sent: str, pos: str, tag: str, chunk: int = CHUNK) -> DataFrame:
    """Spans of a table with one token per row: (sent, start, end, type).

    Positions may have gaps (masked tokens taken out beforehand); a gap does not break a span.
    """
    tokens = df.select(F.col(sent).alias("sent"), F.col(pos).alias("pos"), F.col(tag).alias("tag"))
    # Positions are distinct within a sentence, so the largest one bounds the longest sentence.
    longest = tokens.agg(F.max("pos")).first()[0]
    stretch = chunk if longest is not None and longest >= chunk else None
    near = with_neighbours(tokens, ["sent"], "pos", "tag", stretch)
    outside = F.lit("O")
    marked = near.select(
        "sent",
        "pos",
        _kind(F.col("tag")).alias("type"),
        _starts(F.col("tag"), F.coalesce("before", outside)).alias("starts"),
        _ends(F.col("tag"), F.coalesce("after", outside)).alias("ends"),
    ).filter("starts or ends")
    # Starts and ends alternate: a start that is not an end itself is closed by the next marked token.
    closed = with_neighbours(marked, ["sent"], "pos", "pos", stretch).filter("starts")
    return closed.select("sent", F.col("pos").alias("start"), F.when(F.col("ends"), F.col("pos"))
                         .otherwise(F.col("after")).alias("end"), "type")


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def entity_scores(
    df: DataFrame, pred: str = "pred", label: str = "label", names: Sequence[str] = ENTITY_LABELS
) -> DataFrame:
    """Precision, recall and F1 of exact spans, per type and over all (``type`` = ``micro``).

    ``pred`` and ``label`` are arrays of label ids per sentence; masked positions are taken out of both first.
    Spans are compared inside the row, so only counts per type are shuffled. Without any span there is the row ``micro``
    with zeros. Types may hold any character.
    """
    pairs = df.select(mask_filter(F.col(pred), F.col(label)).alias("pairs"))
    tags = pairs.select(
        ids_to_labels(F.col("pairs.label"), names).alias("truth"), ids_to_labels(F.col("pairs.pred"), names).alias("guess")
    )
    spans = tags.select(span_array(F.col("truth")).alias("truth"), span_array(F.col("guess")).alias("guess"))

    def named(column: str) -> Column:
        # a plain string per span keeps array_intersect on its hash path
        return F.transform(column, lambda s: F.concat_ws(":", s["type"], s["start"], s["end"]))

    keys = spans.select(named("truth").alias("truth"), named("guess").alias("guess"))
    matched = F.array_intersect("truth", "guess")

    def type_of(key: Column) -> Column:  # all but the two positions at the end
        return F.substring(key, F.lit(1), F.length(key) - F.length(F.substring_index(key, ":", -2)) - 1)

    def kinds(column: Column, side: str) -> Column:
        return F.transform(column, lambda k: F.struct(type_of(k).alias("type"), F.lit(side).alias("side")))

    sides = F.concat(kinds(F.col("truth"), "t"), kinds(F.col("guess"), "g"), kinds(matched, "m"))
    found = explode_rows(keys, sides, "k").select("k.type", "k.side")
    # one row without a type, so that there is something to count when there are no spans
    found = found.unionByName(df.sparkSession.range(1).select(*[F.lit(None).cast("string").alias(c) for c in found.columns]))
    counts = found.rollup("type").agg(
        F.grouping("type").alias("all_types"),
        F.count_if(F.col("side") == "t").alias("true_spans"),
        F.count_if(F.col("side") == "g").alias("predicted_spans"),
        F.count_if(F.col("side") == "m").alias("matched_spans"),
    )
    precision = _ratio(F.col("matched_spans"), F.col("predicted_spans"))
    recall = _ratio(F.col("matched_spans"), F.col("true_spans"))
    f1 = _ratio(F.lit(2.0) * F.col("matched_spans"), F.col("predicted_spans") + F.col("true_spans"))
    return counts.filter("all_types = 1 or type is not null").select(
        F.coalesce("type", F.lit("micro")).alias("type"),
        "true_spans", "predicted_spans", "matched_spans",
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
    )
