"""Vocabulary, encoding, truncation, padding and packing of token sequences."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.functions.fixed_values import MASKED_LABEL, SPECIAL_TOKENS
from quillset.functions.text import basic_tokens
from quillset.functions.tokens import align_labels, piece_tokens, piece_word_ids
from quillset.operators.ranks import prefix_offsets
from quillset.operators.rows import explode_rows, posexplode_rows
from quillset.session import BROADCAST_ROW_LIMIT, materialise

ASSEMBLE_CHUNK = 65_536


def special_id(token: str, specials: Sequence[str] = SPECIAL_TOKENS) -> int:
    return list(specials).index(token)


def build_vocab(tokens: DataFrame, column: str, size: int, specials: Sequence[str] = SPECIAL_TOKENS) -> DataFrame:
    """The ``size`` most frequent tokens of an array column, ties in token order: (id, token, n).

    Special tokens come first with n = 0. Counts combine on the map side, so a very frequent token is one row per
    task. Only tokens at least as frequent as the one at position ``size`` reach the final sort: that frequency is
    read off the table of frequencies.
    """
    exploded = explode_rows(tokens, column, "token")
    # written once: the texts are read a single time, the cutoff and the selection work on the counts
    counts = materialise(exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token_counts")
    counts = counts.filter(~F.col("token").isin(list(specials)))
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    frequencies = counts.groupBy("n").agg(F.count(F.lit(1)).alias("tokens"))  # distinct frequencies: few
    cutoff = (
        frequencies.select("n", F.sum("tokens").over(above).alias("upto"))
        .agg(F.coalesce(F.max(F.when(F.col("upto") >= size, F.col("n"))), F.lit(0)).alias("n"))
    )
    kept = counts.filter(F.col("n") >= cutoff.scalar()).orderBy(F.desc("n"), "token").limit(size)
    position = F.row_number().over(Window.orderBy(F.desc("n"), "token"))  # at most ``size`` rows
    ranked = kept.select((position + len(specials) - 1).alias("id"), "token", "n")
    head = tokens.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(s) for s in specials])).alias("id", "token"), F.lit(0).cast("bigint").alias("n")
    )
    return head.unionByName(ranked)


def encode_tokens(
    df: DataFrame, column: str, vocab: DataFrame, key: str, out: str = "input_ids", unknown: int | None = None
) -> DataFrame:
    """Vocabulary ids of a token array; tokens outside the vocabulary get the unknown id.

    A vocabulary under the broadcast limit is looked up inside the rows, without moving them. A larger one is joined
    token by token, and the sequences are put together again by ``key``, which must be unique.
    """
    unknown = special_id("[UNK]") if unknown is None else unknown
    entries = vocab.select("token", "id").limit(BROADCAST_ROW_LIMIT + 1).collect()
    if len(entries) > BROADCAST_ROW_LIMIT:
        return _encode_by_join(df, column, vocab, key, out, unknown)
    table = df.sparkSession.sparkContext.broadcast(([e["token"] for e in entries], [e["id"] for e in entries]))

    @F.arrow_udf("array<int>")
    def lookup(tokens: pa.Array) -> pa.Array:
        names, ids = table.value
        flat = tokens.flatten()
        found = pc.index_in(flat, value_set=pa.array(names, flat.type))
        codes = pc.fill_null(pa.array(ids, pa.int32()).take(found), pa.scalar(unknown, pa.int32()))
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).cast(pa.int32())
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes)])
        return pa.ListArray.from_arrays(offsets, codes, mask=tokens.is_null())

    return df.withColumn(out, lookup(F.col(column)))


def _encode_by_join(df: DataFrame, column: str, vocab: DataFrame, key: str, out: str, unknown: int) -> DataFrame:
    rows = posexplode_rows(df, column, "pos", "token", key)
    codes = vocab.select("token", F.col("id").alias("_code"))
    coded = rows.join(codes, "token", "left").select(
        key, "pos", F.coalesce("_code", F.lit(unknown)).cast("int").alias("code")
    )
    sequences = assemble_sequence(coded, [key], "pos", "code", out)
    joined = df.join(sequences, key, "left")
    # a row without tokens has no sequence to join with
    empty = F.when(F.col(column).isNotNull(), F.array().cast("array<int>"))
    return joined.withColumn(out, F.coalesce(out, empty))


def assemble_sequence(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str, chunk: int = ASSEMBLE_CHUNK
) -> DataFrame:
    """One array per key with the values in the order of ``pos``.

    Rows that already follow one another by position travel as one stretch, at most to the next multiple of ``chunk``, and
    are sent once: by key, not row by row and again stretch by stretch. Only stretches that overlap are sorted value by value.
    """
    cut = _stretches(df.select(*keys, F.col(pos).alias("_pos"), F.col(value).alias("_value")), list(keys), chunk)
    parts = cut.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_pos", "_values"))).alias("_parts"))
    ends = F.transform("_parts", lambda p: p["_pos"].cast("bigint") + F.size(p["_values"]))
    apart = F.zip_with(F.slice(ends, 1, F.size("_parts") - 1), F.slice("_parts", 2, F.size("_parts")), lambda end, p: p["_pos"] >= end)
    cells = F.flatten(
        F.transform("_parts", lambda p: F.transform(p["_values"], lambda v, i: F.struct((p["_pos"].cast("bigint") + i).alias("p"), v.alias("v"))))
    )
    ordered = F.transform(F.sort_array(cells), lambda c: c["v"])
    return parts.select(
        *keys, F.when(F.forall(apart, lambda x: F.coalesce(x, F.lit(False))), F.flatten("_parts._values")).otherwise(ordered).alias(out)
    )


def _stretches(df: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """(*keys, _pos, _values): neighbouring rows of equal keys whose positions count up by one, as one row; no shuffle."""
    kind = df.schema["_pos"].dataType
    if not isinstance(kind, T.IntegralType):
        return df.select(*keys, "_pos", F.array("_value").alias("_values"))
    schema = T.StructType([*[df.schema[k] for k in keys], df.schema["_pos"], T.StructField("_values", T.ArrayType(df.schema["_value"].dataType))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            at = batch.column("_pos")
            known = np.asarray(pc.is_valid(at))
            place = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            goes_on = known[1:] & known[:-1] & (np.diff(place) == 1) & (place[1:] % chunk != 0)
            for name in keys:
                column = batch.column(name)
                same = pc.equal(column.slice(1), column.slice(0, n - 1))  # a null key begins a stretch of its own
                goes_on &= np.asarray(pc.fill_null(same, False))
            begins = np.flatnonzero(np.append(True, ~goes_on))
            offsets = pa.array(np.append(begins, n), pa.int32())
            heads = [batch.column(name).take(pa.array(begins)) for name in (*keys, "_pos")]
            yield pa.RecordBatch.from_arrays([*heads, pa.ListArray.from_arrays(offsets, batch.column("_value"))], names=[*keys, "_pos", "_values"])

    return df.mapInArrow(run, schema)


def truncate_sequences(df: DataFrame, max_len: int, *columns: str) -> DataFrame:
    """Array columns cut to the model's maximum length."""
    for name in columns:
        df = df.withColumn(name, F.slice(name, 1, max_len))
    return df


def tokenize(df: DataFrame, text: str, vocab: DataFrame, key: str, max_len: int | None = None) -> DataFrame:
    """Ids and attention mask of a text column, truncated when ``max_len`` is given."""
    split = df.withColumn("_tokens", basic_tokens(F.col(text)))
    coded = encode_tokens(split, "_tokens", vocab, key).drop("_tokens")
    if max_len is not None:
        coded = truncate_sequences(coded, max_len, "input_ids")
    return coded.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))


def tokenize_presplit(
    df: DataFrame,
    tokens: str,
    tags: str,
    width: int = 4,
    max_len: int | None = None,
    label_all_word_parts: bool = False,
) -> DataFrame:
    """Split words into pieces, with the word of each piece and the labels aligned to the pieces.

    Adds ``pieces``, ``word_ids``, ``labels`` and ``attention_mask``. Truncation keeps the closing token.
    """
    lowered = F.transform(tokens, F.lower)
    split = df.withColumn("_lower", lowered)
    split = split.withColumn("pieces", piece_tokens(F.col("_lower"), width, "[CLS]", "[SEP]")).withColumn(
        "word_ids", piece_word_ids(F.col("_lower"), width)
    )
    if max_len is not None:
        for name, closing in (("pieces", F.lit("[SEP]")), ("word_ids", F.lit(None).cast("int"))):
            cut = F.concat(F.slice(name, 1, max_len - 1), F.array(closing))
            split = split.withColumn(name, F.when(F.size(name) > max_len, cut).otherwise(F.col(name)))
    aligned = split.withColumn("labels", align_labels(F.col("word_ids"), F.col(tags), label_all_word_parts))
    return aligned.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("pieces"))).drop("_lower")


def _padded(values: Column, fill: Column, missing: Column, side: str) -> Column:
    filler = F.array_repeat(fill, missing)
    return F.concat(values, filler) if side == "right" else F.concat(filler, values)


def pad_batch(
    df: DataFrame,
    batch: str = "batch",
    ids: str = "input_ids",
    labels: str | None = None,
    pad_id: int = 0,
    side: str = "right",
    length: str | None = None,
) -> DataFrame:
    """Pad ids (and labels, with the mask) to the longest sequence of the batch; adds the attention mask.

    Batch lengths are a small aggregate joined back, so a batch of any size is never one task's work. The input is
    read twice, so hand in a written table; ``length`` names a stored column with the sequence lengths.
    """
    lengths = df.groupBy(batch).agg(F.max(F.col(length) if length else F.size(ids)).alias("_longest"))
    joined = df.join(lengths, batch)
    missing = F.col("_longest") - F.size(ids)
    size = F.size(ids)
    out = joined.withColumn("_missing", missing).withColumn(
        "attention_mask", _padded(F.array_repeat(F.lit(1), size), F.lit(0), F.col("_missing"), side)
    )
    if labels:
        out = out.withColumn(labels, _padded(F.col(labels), F.lit(MASKED_LABEL), F.col("_missing"), side))
    return out.withColumn(ids, _padded(F.col(ids), F.lit(pad_id), F.col("_missing"), side)).drop("_longest", "_missing")


def pack_sequences(
    df: DataFrame,
    key: str,
    ids: str = "input_ids",
    block: int = 2048,
    end_id: int = 3,
    drop_last: bool = True,
    length: str | None = None,
) -> DataFrame:
    """Concatenate the sequences in key order, each closed by ``end_id``, and cut the stream into equal blocks.

    Every row finds its place in the stream by its offset and is cut into the parts that fall into each block; a
    block gathers at most ``block`` parts. The short last block is dropped unless ``drop_last`` is off. The input is
    read more than once, so hand in a written table; ``length`` names a stored column with the sequence lengths.
    """
    sized = df.select(
        F.col(key).alias("_key"),
        F.concat(F.col(ids), F.array(F.lit(end_id))).alias("_ids"),
        ((F.col(length) if length else F.size(ids)) + 1).alias("_n"),
    )
    placed = prefix_offsets(sized, "_key", "_n", "_start")
    first = F.expr(f"_start div {block}")
    last = F.expr(f"(_start + _n - 1) div {block}")
    spread = placed.select("_ids", "_n", "_start", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("block") * block - F.col("_start"), F.lit(0).cast("bigint"))
    stop = F.least((F.col("block") + 1) * block - F.col("_start"), F.col("_n").cast("bigint"))
    parts = spread.select(
        "block", "_start", F.slice("_ids", (begin + 1).cast("int"), (stop - begin).cast("int")).alias("_part")
    )
    gathered = F.sort_array(F.collect_list(F.struct("_start", "_part")))
    blocks = parts.groupBy("block").agg(F.flatten(F.transform(gathered, lambda c: c["_part"])).alias(ids))
    return blocks.filter(F.size(ids) == block) if drop_last else blocks
