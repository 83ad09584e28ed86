"""Ordered scans over groups that may be far larger than a task: rows are cut into
ranges of about equal row count, each range is summed up, and a prefix over the few
ranges gives what each inherits from those before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.session import scratch_path

LOWEST = -(2**63) + 1  # orders in front of every key


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_ranges(df: DataFrame, order: list[str], ranges: int, name: str, column: str = "_range") -> DataFrame:
    """``df`` in ``ranges`` contiguous ranges of ``order`` (column ``column``, ascending with
    the order), written once.  Rows equal in ``order`` share a range, so it should tell
    rows apart where one value may be frequent; Spark's own sampling balances the ranges."""
    ranged = df.repartitionByRange(max(1, ranges), *order).sortWithinPartitions(*order)
    return written(ranged.withColumn(column, F.spark_partition_id()), name)


def numbered(df: DataFrame, group: list[str], order: list[str], rows_per_range: int = 1_000_000) -> DataFrame:
    """``df`` with ``_row``: 1, 2, ... within each group in ``order``, exact whatever the
    size of a group.

    Only the count of each (group, range) is brought together; a group that spans
    many ranges is numbered by many tasks.
    """
    total = df.count()
    rows = cut_ranges(df, [*group, *order], -(-total // rows_per_range), "numbered")
    counts = rows.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_range").alias("_r"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    here = Window.partitionBy(*group, "_range").orderBy(*order)
    out = rows.withColumn("_row", F.row_number().over(here))
    same: Column = F.col("_range") == F.col("_r")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return out.join(start, same).withColumn("_row", F.col("_row") + F.col("_before")).select(*df.columns, "_row")
