"""WARC archives written from and read back into tables of chunks.

A payload travels as rows (record, chunk number, data) with the running SHA-1 and length up to that chunk, so no step holds
more than a chunk of a record besides what a row of the input brings. Archives are gzip members, one per record, written
by tasks under names of their own and listed in a manifest when complete: of a task that ran twice, one file counts.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import text_of
from quillset.session import materialise, scratch_path

#: Bytes of a chunk; bytes of payload from which equal records refer to one.
CHUNK, LEAST = 64 << 10, 1000
#: The date in the headers; a parameter of ``write``, so that the same pages give the same archives.
DATE = "1970-01-01T00:00:00Z"


def open_files(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def chunks(pages: DataFrame, key: str = "page_id", html: str = "html", size: int = CHUNK) -> DataFrame:
    """Rows record, chunk, data, sha1 and length so far, last, and the whole payload's sha1. A null or empty payload is one
    empty chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for record, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                view = memoryview(payload.as_buffer() or b"")
                running, whole = hashlib.sha1(usedforsecurity=False), hashlib.sha1(view, usedforsecurity=False).hexdigest()
                for number in range(max(1, -(-len(view) // size))):
                    data = view[number * size : (number + 1) * size]
                    running.update(data)
                    rows.append((record, number, bytes(data), running.copy().hexdigest(), min(len(view), (number + 1) * size), (number + 1) * size >= len(view), whole))
                    held += len(data)
                    if held > 4 << 20:
                        yield batched(rows)
                        rows, held = [], 0
            if rows:
                yield batched(rows)

    def batched(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["record", "chunk", "data", "sha1", "length", "last", "payload_sha1"])

    rows = pages.select(F.col(key).cast("long").alias("record"), text_of(html).cast("binary").alias("payload"))
    return rows.mapInArrow(run, "record long, chunk int, data binary, sha1 string, length long, last boolean, payload_sha1 string")


def record_types(parts: DataFrame, least: int = LEAST) -> DataFrame:
    """Per record: length, sha1, refers_to (the largest record of an equal payload of ``least`` bytes or more, else null)."""
    records = parts.filter("last").select("record", "length", "sha1")
    groups = records.filter(F.col("length") >= least).groupBy("sha1", "length").agg(F.max("record").alias("of"))
    both = records.join(groups, ["sha1", "length"], "left")
    return both.select("record", "length", "sha1", F.when(F.col("of") != F.col("record"), F.col("of")).alias("refers_to"))


def header(record: int, length: int, sha1: str, refers_to: int | None, uri: str | None, date: str) -> bytes:
    """The head of a record. Digests are of the whole payload, of revisits too, which carry no payload."""
    target = "".join(c for c in (uri or "") if c >= " " and c != "\x7f")
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{record}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{sha1}", f"X-Payload-Length: {length}", "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {0 if refers_to is not None else length}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, date: str = DATE) -> DataFrame:
    """Write a record per page to archives under ``path``, which all executors reach, and return their manifest (file,
    records). Payloads are shuffled once, in chunks; of rows that repeat a key the one of the least digest is written."""
    types = materialise(record_types(chunks(pages, key, html), least), "warc-records")
    uris = pages.select(F.col(key).cast("long").alias("record"), F.col(url).cast("string").alias("uri")).groupBy("record").agg(F.min("uri").alias("uri"))
    heads = types.groupBy("record").agg(F.min(F.struct("sha1", "length", "refers_to")).alias("of")).select("record", "of.*")
    heads = heads.join(uris, "record").withColumn("chunk", F.lit(-1)).withColumn("data", F.lit(None).cast("binary"))
    bodies = chunks(pages, key, html).select("record", "chunk", "data", F.col("payload_sha1").alias("sha1"))
    parts = heads.unionByName(bodies, allowMissingColumns=True)
    parts = parts.repartition("record").sortWithinPartitions("record", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_files(path)
        name = f"{base}/{uuid.uuid4().hex}.warc.gz"
        out, member, records, head, due = None, None, 0, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] < 0:
                    if out is None:
                        files.create_dir(base, recursive=True)
                        out = files.open_output_stream(name, compression=None)
                    if member is not None:
                        out.write(member.compress(b"\r\n\r\n") + member.flush())
                    member, records = zlib.compressobj(4, zlib.DEFLATED, 31), records + 1
                    out.write(member.compress(header(row["record"], row["length"], row["sha1"], row["refers_to"], row["uri"], date)))
                    head, due = row, 0
                elif head["refers_to"] is None and row["sha1"] == head["sha1"] and row["chunk"] == due:
                    out.write(member.compress(row["data"]))
                    due += 1
        if out is not None:
            out.write(member.compress(b"\r\n\r\n") + member.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["file", "records"])

    kept = parts.select("record", "chunk", "data", "length", "sha1", "refers_to", "uri")
    return materialise(kept.mapInArrow(run, "file string, records long"), "warc-manifest")


def read_chunks(manifest: DataFrame, path: str, size: int = CHUNK) -> DataFrame:
    """The records of the archives in ``manifest`` as rows of chunks: record, record_type, uri, refers_to, stated_digest,
    stated_length, chunk, data, sha1 and length so far, last. A revisit is one chunk without data."""
    shape = (
        "record long, record_type string, uri string, refers_to long, stated_digest string, stated_length long, chunk int, data binary, "
        "sha1 string, length long, last boolean"
    )
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.bool_()]
    names = [part.split()[0] for part in shape.split(", ")]

    def unpacked(files: pyarrow.fs.FileSystem, name: str) -> Iterator[bytes]:
        """The archive's bytes in pieces of bounded size."""
        with files.open_input_stream(name, compression=None) as stream:
            member = zlib.decompressobj(31)
            while packed := stream.read(size):
                while packed:
                    yield member.decompress(packed, size)
                    packed = member.unconsumed_tail or (member.unused_data if member.eof else b"")
                    if member.eof:
                        member = zlib.decompressobj(31)

    def records(pieces: Iterator[bytes]) -> Iterator[tuple]:
        held = b""
        while True:
            while b"\r\n\r\n" not in held:
                piece = next(pieces, None)
                if piece is None:
                    if held.strip():
                        raise ValueError("an archive ends within a record")
                    return
                held = (held + piece).lstrip(b"\r\n") if not held else held + piece
            head, held = held.split(b"\r\n\r\n", 1)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            number = lambda name: int(fields[name].rsplit(":", 1)[-1].rstrip(">")) if name in fields else None
            known = (
                number("WARC-Record-ID"), fields["WARC-Type"], fields["WARC-Target-URI"], number("WARC-Refers-To"),
                fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"]),
            )
            left, at, running = int(fields["Content-Length"]), 0, hashlib.sha1(usedforsecurity=False)
            length = left
            while True:
                while len(held) < min(left, size):
                    piece = next(pieces, None)
                    if piece is None:
                        raise ValueError("an archive ends within a record")
                    held += piece
                data, held = held[: min(left, size)], held[min(left, size) :]
                left -= len(data)
                running.update(data)
                yield (*known, at, data, running.copy().hexdigest(), length - left, left == 0)
                at += 1
                if not left:
                    break
            while len(held) < 4:
                piece = next(pieces, None)
                if piece is None:
                    break
                held += piece
            held = held[4:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_files(path)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows: list[tuple] = []
                for row in records(unpacked(files, name)):
                    rows.append(row)
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return manifest.select("file").repartition("file").mapInArrow(run, shape)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page, as read back from archives: key, payload_bytes, payload_digest, record_type, refers_to.

    Digest and length of a response are those of the payload read; those of a revisit are stated in its head. Keys are
    unique integers; of rows that repeat a key one record is written. Null pages are empty payloads. A response whose
    payload does not fit its head's digest fails the job.
    """
    path = scratch_path(pages.sparkSession, "warc")
    manifest = write(pages, path, key, url, html)
    rows = read_chunks(manifest, path).filter("last")
    fits = (F.col("sha1") == F.col("stated_digest")) & (F.col("length") == F.col("stated_length"))
    sound = F.when((F.col("record_type") == "revisit") | fits, F.col("stated_digest")).otherwise(F.raise_error(F.lit("a payload differs from its digest")))
    return rows.select(F.col("record").alias(key), F.col("stated_length").alias("payload_bytes"), sound.alias("payload_digest"), "record_type", "refers_to")


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
     g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS main FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN main = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN main <> page_id THEN main END AS refers_to
FROM g
"""
