"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.session import scratch_path

# Arrow batches handed to Python hold at most this many rows and bytes, so a
# run of very long texts cannot fill a worker.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS, nbytes: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of this session by rows and by bytes, and let its
    Python workers find this package where the driver found it."""
    env = spark.sparkContext.environment
    paths = [str(Path(__file__).resolve().parents[2]), *env.get("PYTHONPATH", "").split(os.pathsep)]
    env["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(p for p in paths if p))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(nbytes))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint root and read
    it back: computed once, lineage cut, safe against lost executors.  The
    shuffle files of the write go once it has committed: nothing reads them again."""
    return cut_to(df, scratch_path(df.sparkSession, name))


def cut_to(df: DataFrame, path: str) -> DataFrame:
    """``cut`` to a folder of the caller's, who may remove it with ``drop_folder``."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that no later job reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def text_of(column: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def with_row_key(df: DataFrame, carry: bool = False) -> DataFrame:
    """``doc_id, text`` of ``df`` with ``rid``, a unique long that sorts like the
    id; with ``carry`` also ``row``, a struct of all its columns.

    Where the ids are unique and not null, ``rid`` is the id and nothing is
    moved but the ids of the check.  Otherwise the rows are numbered in the
    order (id, nulls first; text hash) and written once, so rows that repeat
    an id, or have none, stay rows of their own.
    """
    whole = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []
    df = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *whole)
    twice = df.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    if twice.isEmpty():
        return df.withColumn("rid", F.col("doc_id"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(ranged.withColumn("rid", F.monotonically_increasing_id()), "row-key")


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Python tuples of the named columns of an Arrow batch."""
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))
