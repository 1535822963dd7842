"""Exact deduplication against a persistent index of text digests.

The index is a table of (digest, keep_id), bucketed and sorted by digest. A batch of documents is grouped by digest,
joined against the index by a sort-merge anti-join that reads the index in its buckets without a shuffle, and what is new
is appended. Only digests and ids are shuffled, never texts.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillset.llm.common import rows_with_keys, text_of
from quillset.session import materialise, scratch_path

SPACES = "[\\x20\\x09-\\x0D]+"


def digest(text: str = "text") -> Column:
    """SHA-256 in lower-case hex of the text with each run of ASCII white space as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(text_of(text), SPACES, " "), 256)


class DigestIndex:
    """A bucketed table of digests under a folder, known to the session's catalog under a name of its own.

    ``open`` on a folder that holds an index takes it up again, in a new session too. The number of buckets is fixed when
    the index is made and kept beside it, whatever a later ``open`` asks for; choose it for the size the index will reach (a
    bucket of some hundred MB).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (text_sha256 STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int) -> DigestIndex:
        path = path.rstrip("/")
        noted = f"{path}-buckets"
        try:
            buckets = spark.read.schema("buckets int").json(noted).first()[0]
        except AnalysisException:  # no such folder: a new index
            spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.json(noted)
        return cls(spark, path, buckets)

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def add(self, first: DataFrame) -> None:
        """Append the rows of ``first`` (text_sha256, keep_id, one row per digest) that the index lacks."""
        new = first.join(self.table().hint("merge"), "text_sha256", "left_anti")
        # one writing task per bucket, so that each append adds one sorted file to a bucket
        (
            new.select("text_sha256", "keep_id")
            .repartition(self.buckets, "text_sha256")
            .write.bucketBy(self.buckets, "text_sha256")
            .sortBy("text_sha256")
            .format("parquet")
            .option("path", self.path)
            .mode("append")
            .saveAsTable(self.name)
        )

    def close(self) -> None:
        """Take the name out of the catalog; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def exact_dedup(
    docs: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text", keep_new_only: bool = False
) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256; the index afterwards holds all digests.

    Of equal texts in the batch the smallest key stays, unless the index already has the text: then the document kept
    earlier is keep_id and none of the batch stays. Null and empty texts are one group. A key that occurs in several rows
    gives as many rows. group_size counts the batch. ``keep_new_only`` leaves out the rows that go.
    """
    spark = docs.sparkSession
    digests = materialise(docs.select(F.col(key).alias(key), digest(text).alias("text_sha256")), "digests")
    groups = materialise(
        digests.groupBy("text_sha256").agg(F.min(key).alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "digest-groups"
    )
    index.add(groups)
    kept = groups.drop("keep_id").join(index.table(), "text_sha256")
    rows = digests.join(kept, "text_sha256").select(
        key, "keep_id", "group_size", F.col(key).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
    return rows.filter("kept") if keep_new_only else rows


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index in the shared folder, with as many buckets as the session has shuffle partitions."""
    return DigestIndex.open(spark, scratch_path(spark, "digest-index"), buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))


def keep_first(docs: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept; keys are unique."""
    return rows_with_keys(docs, exact_dedup(docs, index, key, text, keep_new_only=True), key)


DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
