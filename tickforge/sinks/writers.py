"""Writers (K1-K5) and output layouts.

All writers are Spark's own (partitioned Parquet / text); the output
committer makes a failed or retried task invisible, so lost executors do
not leave partial files behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.operators.quality import guard
from tickforge.sources.landed import LANDING_PARTITIONS

# Layouts of the derived-bar output.
DERIVED_PARTITIONS = ("fsym_char1", "tsym")
LAYOUTS = ("chunk", "range", "counts", "pair", "bucket")


def sink_landing(
    df: DataFrame,
    path: str,
    partition_cols: tuple[str, ...] | list[str] = LANDING_PARTITIONS,
    mode: str = "append",
    cluster: bool = True,
) -> None:
    """K1: partitioned Parquet dataset; partition columns are required.

    ``cluster`` groups rows by partition folder first (a ``rebalance`` on
    the partition columns: AQE sizes the tasks and splits a hot folder over
    several), so each folder gets a few well-sized files instead of one
    small file per task.  ``append`` adds files: write each run to its own
    ``run=<id>`` folder (``sources.landed.run_path``) so a rerun does not
    double rows.
    """
    if not partition_cols:
        raise ValueError("sink_landing needs at least one partition column")
    if cluster:
        df = df.hint("rebalance", *partition_cols)
    df.write.mode(mode).partitionBy(*partition_cols).parquet(path)


def sink_flat(df: DataFrame, folder: str, name: str, mode: str = "append") -> str:
    """K2: one unpartitioned Parquet dataset ``<folder>/<name>.parquet``."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    df.write.mode(mode).parquet(path)
    return path


def cluster_output(df: DataFrame) -> DataFrame:
    """Rows of one output folder (``fsym_char1``, ``tsym``) together.

    A ``rebalance`` rather than a plain repartition: AQE splits a hot
    folder over several tasks (and merges small ones), so no task holds a
    whole large folder, while each task still writes to one folder.
    """
    return df.hint("rebalance", *DERIVED_PARTITIONS)


def sort_derived(df: DataFrame) -> DataFrame:
    """O2: files sorted by symbol and bar time (date, hour, minute) inside
    each output folder.

    A global sort in front of a repartition is lost; sorting inside the
    partitions after it is what gives sorted files.
    """
    calendar = [c for c in ("date", "hour", "minute") if c in df.columns]
    return cluster_output(df).sortWithinPartitions(*DERIVED_PARTITIONS, "fsym", *calendar)


def sink_derived(
    df: DataFrame,
    path: str,
    layout: str = "range",
    mode: str = "errorifexists",
    max_records_per_file: int = 5_000_000,
) -> None:
    """K3: derived bars partitioned by (``fsym_char1``, ``tsym``); fails if
    the path exists.

    * ``chunk``: write the window's own (hash) partitioning.  Rows arrive
      sorted by (``fsym_char1``, ``tsym``, ``fsym``, time), so the writer
      adds neither a shuffle nor a sort, and no task holds more than a few
      pair-chunks.  A task writes one file per folder it holds rows of.
    * ``range`` (default), ``counts``: the windows' one shuffle is a partitioning by ranges of
      (``fsym_char1``, ``tsym``, ``fsym``, chunk) (see ``plans.jobs``), so a
      task writes to one or two folders: few files, one shuffle.
    * ``pair``: folder-clustered output (O2 + O4): a second full shuffle,
      rebalanced so a hot folder is split over several tasks, each file
      holding one folder's rows sorted by symbol and date.  Fewer, larger
      files than ``chunk``.
    * ``bucket``: the input was clustered by (``fsym_char1``, ``tsym``)
      before the windows (see ``plans.jobs.derive_job``); written as is.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "pair":
        df = sort_derived(df)
    (
        df.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*DERIVED_PARTITIONS)
        .parquet(path)
    )


def sink_json(docs: DataFrame, path: str) -> None:
    """K4: write JSON documents, each to its own ``folder=…/name=…`` place.

    Every body is parsed first (``parse_json`` fails the job on malformed
    text, as the reference's load-then-dump did) and written back in
    compact form.  Columns: ``folder``, ``name``, ``body``.
    """
    checked = docs.select(
        "folder", "name", F.to_json(F.parse_json("body")).alias("value")
    )
    checked.write.mode("errorifexists").partitionBy("folder", "name").text(path)


# Bytes of documents in one packed file.
PACK_BYTES = 32 << 20


def sink_json_packed(docs: DataFrame, path: str, pack_bytes: int = PACK_BYTES) -> None:
    """K4 for many documents: files of about ``pack_bytes`` with a document a line
    (``<path>/packs/pack=N``), and an index of where each begins (``<path>/index``: ``folder,
    name, pack, offset, length``, in bytes, ordered by name).

    Columns: ``folder``, ``name``, ``body``.  Bodies are checked and written in compact form
    as in ``sink_json``; equal rows are one document, two bodies of one name fail the job.
    Documents go to packs by a hash of their name, so packs are of like size and no
    folder is one task; a document larger than a pack makes its own larger.
    """
    for part in ("folder", "name"):
        docs = guard(docs, {f"document without {part}": F.col(part).isNull()})
    text = F.to_json(F.parse_json("body"))
    one = docs.groupBy("folder", "name").agg(F.min("body").alias("body"), F.max("body").alias("_other"))
    one = guard(one, {"two documents of one name": F.col("body") != F.col("_other")}).drop("_other")
    one = one.withColumn("value", text).withColumn("length", F.octet_length("value").cast("long")).drop("body")
    # the size is all that is read here; the compact texts are not kept
    total = docs.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    packs = max(1, -(-total // pack_bytes))
    one = one.withColumn("pack", F.pmod(F.xxhash64("folder", "name"), F.lit(packs)).cast("int"))
    before = Window.partitionBy("pack").orderBy("folder", "name").rowsBetween(Window.unboundedPreceding, -1)
    placed = one.withColumn("offset", F.coalesce(F.sum(F.col("length") + 1).over(before), F.lit(0)))
    # rows of a pack are in one task, in the order of their offsets: one file, no line moves
    (placed.sortWithinPartitions("pack", "offset").select("value", "pack")
     .write.mode("errorifexists").option("lineSep", "\n").partitionBy("pack").text(f"{path}/packs"))
    index = placed.select("folder", "name", "pack", "offset", "length").sort("folder", "name")
    index.write.mode("errorifexists").parquet(f"{path}/index")


def sink_charts(points: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K5: chart rows, one folder per chart, in one job.  Rows are clustered by chart first
    (a ``rebalance``: a large chart is split over several tasks), so a chart is a few files."""
    points = points.hint("rebalance", "chart")
    points.write.mode(mode).partitionBy("chart").parquet(path)
