"""Exact dedup (7): a persistent digest index, bucketed and sorted by hash.

The index is a Parquet table of one row per distinct text (digest, the row
that stays, copies), bucketed and sorted by digest.  New data is reduced to
one row per digest first (partial aggregation, so a text with very many copies
is one row per task), then anti-joined with the index and appended.  Because
both sides of that join hold a digest once and the index is already bucketed,
it is a sort-merge join that moves the new digests only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import read_table, with_row_key
from tickforge.session import scratch_path

DIGEST_COLUMNS = "digest BINARY, batch STRING, keep_rid BIGINT, keep_id BIGINT, group_size BIGINT"


def digests(docs: DataFrame) -> DataFrame:
    """``(rid, doc_id, digest)``: SHA-256 of each whole text; null is empty."""
    return docs.select("rid", "doc_id", F.unhex(F.sha2(F.col("text"), 256)).alias("digest"))


class DigestIndex:
    """A digest index kept as a bucketed table at ``path``.

    ``buckets`` fixes the layout for the life of the index; choose it for the
    size the index will reach (about 128 MB a bucket file).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, table: str | None = None):
        self.spark = spark
        self.path = path
        self.buckets = buckets
        self.table = table or f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({DIGEST_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def new_only(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest the index lacks (sort-merge anti-join)."""
        return groups.join(self.rows().hint("merge"), "digest", "left_anti")

    def append(self, found: DataFrame, batch: str) -> None:
        """Reduce the rows of a batch to groups, anti-join them, append what is new.

        Of equal texts within ``found`` the one with the largest row key (so the
        largest doc_id) stays; a text that the index already has stays
        represented by the row it was first kept with.
        """
        groups = found.groupBy("digest").agg(
            F.max(F.struct("rid", "doc_id")).alias("keep"), F.count(F.lit(1)).alias("group_size")
        ).select("digest", F.lit(batch).alias("batch"), F.col("keep.rid").alias("keep_rid"),
                 F.col("keep.doc_id").alias("keep_id"), "group_size")
        rows = self.new_only(groups).repartition(self.buckets, "digest").sortWithinPartitions("digest")
        (rows.write.format("parquet").mode("append").option("path", self.path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))


def dedup(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Add ``docs`` to the index and return one row per document:
    ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null texts count as empty; empty texts equal each other.  Rows that repeat
    a doc_id are rows of their own and exactly one row of equal texts is kept, over
    all batches that the index has seen: a text it already has keeps no row of this
    batch, also if the very row it was first kept with is sent again.  Null ids sort
    below every id.  ``keep_id`` is the row that stays, ``group_size`` the number of equal
    rows in the batch that brought the text.  An empty table gives no rows.

    The decisions are joined on from a plain read of the index, not by bucket:
    both sides are then exchanged, and the adaptive skew join can split the
    rows of a digest that very many documents share.
    """
    found, batch = digests(with_row_key(docs)), uuid.uuid4().hex
    index.append(found, batch)
    groups = index.spark.read.schema(DIGEST_COLUMNS).parquet(index.path)
    return found.join(groups.hint("merge"), "digest").select(
        "doc_id", "keep_id", "group_size",
        # row keys are those of one batch
        ((F.col("batch") == batch) & (F.col("rid") == F.col("keep_rid"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query 7: documents against a new, empty index."""
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    index = DigestIndex(spark, scratch_path(spark, "digest-index"), buckets)
    return dedup(read_table(spark, sf_dir, "documents"), index)


OP7_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text) AS keep_id,
       count(*) OVER (PARTITION BY text) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text) AS kept,
       sha256(text) AS text_sha256
FROM d
"""
