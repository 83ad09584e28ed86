"""Readers for landed Parquet (S1-S3), commits of landing runs, derived bars.

Landed bars are text (the landing step writes every value as text), with
Hive-style partition folders ``fsym_char1=…/year=…/month=…/day=…`` under one
``run=<run_id>`` folder per landing run.  The schema is declared, so no file
footers are sampled for inference and the partition values keep their
declared types.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from tickforge.operators.derive import Grain, grain_of, output_columns

# Landed bar columns (all text) and the partition columns.
LANDED_TEXT_COLUMNS = (
    "time", "open", "high", "low", "close", "volumefrom", "volumeto",
    "fsym", "tsym", "date", "request_timestamp",
)
LANDING_PARTITIONS = ("fsym_char1", "year", "month", "day")

LANDED_SCHEMA = StructType(
    [StructField(c, StringType()) for c in LANDED_TEXT_COLUMNS]
    + [StructField("fsym_char1", StringType())]
    + [StructField(c, IntegerType()) for c in ("year", "month", "day")]
)


def run_path(root: str, run_id: str) -> str:
    """Folder of one landing run."""
    return f"{root.rstrip('/')}/run={run_id}"


RUN_COMMIT = "run_id string, attempt string, rows long, version long"


def new_attempt(root: str, run_id: str) -> str:
    """A folder for one attempt to land a run."""
    return f"{run_path(root, run_id)}/attempt={uuid.uuid4().hex}"


def _commits(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/_committed/run={run_id}"


def run_commits(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The commits of a run (``RUN_COMMIT``); empty if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(_commits(root, run_id))
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], RUN_COMMIT)
    return spark.read.schema(RUN_COMMIT).parquet(_commits(root, run_id))


def commit_run(spark: SparkSession, root: str, run_id: str, attempt: str, rows: int) -> None:
    """Make a written attempt the run's content: one row, appended last.  An attempt that
    failed half way was never committed and is not seen by ``committed_run``."""
    version = (run_commits(spark, root, run_id).agg(F.max("version")).first()[0] or 0) + 1
    row = spark.createDataFrame([(run_id, attempt, rows, version)], RUN_COMMIT)
    row.coalesce(1).write.mode("append").parquet(_commits(root, run_id))


def committed_run(spark: SparkSession, root: str, run_id: str) -> str:
    """Folder of the newest committed attempt of a run; fails if there is none."""
    newest = run_commits(spark, root, run_id).orderBy(F.desc("version"), F.desc("attempt")).limit(1).collect()
    if not newest:
        raise ValueError(f"run {run_id!r} has not been landed under {root}")
    return newest[0]["attempt"]


def scan_bars(spark: SparkSession, run: str) -> DataFrame:
    """Every landed bar of one run (one folder, partition folders below)."""
    return spark.read.schema(LANDED_SCHEMA).option("basePath", run).parquet(run)


def scan_bars_prefix(spark: SparkSession, run: str, prefix: str) -> DataFrame:
    """One bucket of one run; the filter prunes partition folders
    (``PartitionFilters`` in the plan), other buckets are never listed
    into the scan's files."""
    return scan_bars(spark, run).filter(F.col("fsym_char1") == prefix)


def scan_coins(spark: SparkSession, path: str) -> DataFrame:
    """S3: the landed coin list (flat Parquet dataset)."""
    return spark.read.parquet(path)


def derived_schema(grain: Grain | str) -> StructType:
    """Declared schema of the derived bars of a grain, partition columns included."""
    g = grain_of(grain)
    kinds = {"date": TimestampType() if g.date_is_timestamp else DateType(), "hour": IntegerType(), "minute": IntegerType(),
             "fsym": StringType(), "tsym": StringType(), "fsym_char1": StringType()}
    return StructType([StructField(c, kinds.get(c, DoubleType())) for c in output_columns(g)])


def scan_derived(spark: SparkSession, path: str, grain: Grain | str) -> DataFrame:
    """Derived bars as ``sink_derived`` writes them, in the grain's column order.  The schema is
    declared: a bucket ``1`` or a quote ``1e5`` stays text, and no file footer is sampled."""
    return spark.read.schema(derived_schema(grain)).parquet(path).select(*output_columns(grain))
