"""Large CSV files with line breaks inside quoted cells, read in many tasks.

Spark cuts a text file into splits at line ends, but such an end may lie inside a cell. Whether a split begins inside
one follows from the number of quotes before it: quotes are counted per split, and the parities summed up along the file
say where each split's first record begins. Records inside a split are put together in its task; the at most two pieces
per split that belong to records of neighbouring splits are joined afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.session import fits_broadcast, materialise

_PIECES = "file string, block long, seq long, begins boolean, ends boolean, record string"


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Records as text: (header, record); ``header`` marks the first record of a file. Empty records are left out.

    Quotes stand around cells and, doubled, inside quoted ones only. A last record whose quote never closes goes to the
    end of its file. A task holds one batch of lines and one record at a time.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    parities = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = parities.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("open"))
    opened = materialise(opened, "csv-splits")  # one row per split
    pieces = _in_file_order(lines, opened).mapInArrow(_pieces, _PIECES)

    alone = pieces.filter("begins and ends").select((F.expr("block = 0 and seq = 0")).alias("header"), "record")
    parts = materialise(pieces.filter("not (begins and ends)"), "csv-pieces")
    along = Window.partitionBy("file").orderBy("block", "seq")
    owners = parts.select("file", "block", "seq", F.sum(F.col("begins").cast("int")).over(along).alias("number"))
    joined = parts.join(owners, ["file", "block", "seq"]).groupBy("file", "number").agg(
        F.bool_or(F.expr("block = 0 and seq = 0")).alias("header"),
        F.array_sort(F.collect_list(F.struct("block", "seq", "record"))).alias("parts"),
    )
    records = alone.unionByName(joined.select("header", F.array_join("parts.record", "\n").alias("record")))
    record = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return records.select("header", record.alias("record")).filter("record != ''")


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header that names the columns of ``schema`` in its order; cells are cast as Spark's reader does."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    options = {"escape": '"', "multiLine": "true"}
    names = [f.name.lower() for f in schema.fields]
    records = csv_records(spark, path)
    titles = F.from_csv(F.regexp_replace("record", "^\ufeff", ""), ", ".join(f"`{f.name}` string" for f in as_text.fields), options)
    right = F.concat_ws("\n", *[F.lower(titles[f.name]) for f in schema.fields]) == F.lit("\n".join(names))
    wrong = F.raise_error(F.concat(F.lit("unexpected CSV header: "), F.col("record"))).cast("boolean")
    body = records.filter(F.when(F.col("header"), F.when(right, F.lit(False)).otherwise(wrong)).otherwise(F.lit(True)))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return body.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")


def _in_file_order(lines: DataFrame, opened: DataFrame) -> DataFrame:
    """Lines with their split's ``open``, those of a split together and in the order of the file."""
    missing = F.raise_error(F.lit("the files were split in another way on the second reading")).cast("int")
    known = F.coalesce("open", missing).alias("open")
    if fits_broadcast(opened):  # a broadcast join leaves rows where they were read
        return lines.join(F.broadcast(opened), ["file", "block"], "left").select("value", "file", "block", known)
    numbered = lines.withColumn("at", F.monotonically_increasing_id()).join(opened, ["file", "block"], "left")
    ordered = numbered.repartition("file", "block").sortWithinPartitions("file", "block", "at")
    return ordered.select("value", "file", "block", known)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records of each split, numbered from 0."""
    split, is_open, seq, starts_inside, rest = None, 0, 0, False, []

    def rows(records: list[str] | pa.Array, ended: bool) -> pa.RecordBatch:
        nonlocal seq, starts_inside
        n = len(records)
        begins = np.ones(n, bool)
        begins[0] = not starts_inside
        numbers = np.arange(seq, seq + n)
        seq, starts_inside = seq + n, False
        columns = [pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n, pa.int64()), pa.array(numbers), pa.array(begins), pa.array([ended] * n)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(records, pa.string())], names=["file", "block", "seq", "begins", "ends", "record"])

    for batch in batches:
        files, blocks, opens = batch.column("file"), batch.column("block").to_numpy(), batch.column("open")
        changed = np.flatnonzero((blocks[1:] != blocks[:-1]) | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)) + 1
        for start, stop in zip([0, *changed.tolist()], [*changed.tolist(), len(blocks)]):
            if start == stop:
                continue
            here = (files[start].as_py(), int(blocks[start]))
            if here != split:
                if rest:
                    yield rows(["\n".join(rest)], False)
                split, is_open, seq, rest = here, opens[start].as_py(), 0, []
                starts_inside = bool(is_open)
            values = batch.column("value").slice(start, stop - start)
            inside = (is_open + np.cumsum(pc.count_substring(values, '"').to_numpy())) % 2
            is_open = int(inside[-1])
            ends = np.flatnonzero(inside == 0) + 1
            if not len(ends):
                rest += values.to_pylist()
                continue
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            records = pc.binary_join(pa.ListArray.from_arrays(offsets, pa.concat_arrays([values]).cast(pa.string())), "\n")
            if rest:
                records = pa.concat_arrays([pa.array(["\n".join([*rest, records[0].as_py()])], pa.string()), records[1:]])
            rest = values[int(ends[-1]) :].to_pylist()
            yield rows(records, True)
    if rest:
        yield rows(["\n".join(rest)], False)
