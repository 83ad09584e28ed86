"""Session set-up (E1) and the shared scratch folder for written intermediates.

Object-store credentials are not handled here: on a cluster they come from
the Hadoop credential provider chain, never from code.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  The time zone matters for correctness:
# hour(), minute() and cast(ts as date) follow the session zone, and all
# bar instants are UTC.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files (join_small) once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    app_name: str = "tickforge",
    master: str | None = None,
    driver_memory: str | None = None,
    executor_memory: str | None = None,
    extra_class_path: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    ``driver_memory`` only takes effect when this call starts the JVM; on a
    cluster pass it to spark-submit instead.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if driver_memory:
        settings["spark.driver.memory"] = driver_memory
    if executor_memory:
        settings["spark.executor.memory"] = executor_memory
    if extra_class_path:
        settings["spark.driver.extraClassPath"] = extra_class_path
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (a runtime setting, safe to repeat)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever runs the job (a folder every
    executor can reach).  Only a local-mode session without one gets a fresh
    folder of its own, as in tests.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(e.g. an object-store prefix) before running this job"
        )
    root = tempfile.mkdtemp(prefix="tickforge-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def sizing_conf(input_bytes: int, partition_bytes: int = 512 << 20) -> dict[str, str]:
    """Settings sized to the input: shuffle partitions of about
    ``partition_bytes`` each, scan splits and AQE's target of the same size.

    For 100 TB at 512 MiB that is ~200k shuffle partitions; AQE merges the
    small ones at run time and ``rebalance`` writes aim at the same size,
    so files stay large.  Pass the result as ``conf`` to ``get_session`` (or
    to spark-submit).
    """
    partitions = max(1, -(-int(input_bytes) // int(partition_bytes)))
    size = str(int(partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
    }
