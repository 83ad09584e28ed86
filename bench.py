"""Benchmark the headline jobs; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--all]

Each headline query runs once to warm up, then three times; the median is
reported.  DataFrame queries are forced with the ``noop`` writer (full
computation, nothing collected to the driver); sink queries time the whole
write job into a fresh folder.  ``--all`` also times every registered query
once (``all_queries`` in the output).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickforge import fixtures as fx  # noqa: E402
from tickforge import registry  # noqa: E402
from tickforge.operators.derive import HOUR, MINUTE, derive_bars  # noqa: E402
from tickforge.plans import jobs  # noqa: E402
from tickforge.session import get_session, scratch_path  # noqa: E402
from tickforge.sinks import writers  # noqa: E402
from tickforge.sources import landed as src  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
SHUFFLE_PARTITIONS = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * CPUS)))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _sf_of(path: str):
    text = os.path.basename(path.rstrip("/")).replace("sf", "")
    try:
        return float(text)
    except ValueError:
        return text


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def median_of(fn) -> float:
    fn()  # warm-up
    return round(statistics.median(timed(fn) for _ in range(RUNS)), 3)


def main() -> None:
    spark = get_session(
        app_name="tickforge-bench",
        master=f"local[{CPUS}]",
        conf={
            "spark.sql.shuffle.partitions": str(SHUFFLE_PARTITIONS),
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    # landed runs for the derive jobs (set-up, not timed)
    minute_run = src.run_path(scratch_path(spark, "bench-landed-minute"), "bench")
    writers.sink_landing(fx.landed_bars(spark, SF_DIR, "minute"), minute_run)
    hour_run = src.run_path(scratch_path(spark, "bench-landed-hour"), "bench")
    writers.sink_landing(fx.landed_bars(spark, SF_DIR, "hour"), hour_run)

    def derive(run, grain, layout):
        return lambda: jobs.derive_job(spark, run, scratch_path(spark, "bench-out"), grain, layout=layout)

    def reference_shape(run, grain):
        """For comparison: the reference job's plan shape on built-ins - one
        plain window per pair, then one task per output folder."""
        def job():
            bars = derive_bars(src.scan_bars(spark, run), grain, chunked=False)
            out = scratch_path(spark, "bench-out")
            bars.repartition("fsym_char1", "tsym").write.partitionBy("fsym_char1", "tsym").parquet(out)
        return job

    headline = {
        "change_daily_ath": lambda: force(registry.change_daily(spark, SF_DIR)),
        "change_minute": lambda: force(registry.change_minute(spark, SF_DIR)),
        "backfill_cut": lambda: force(registry.concat_pages(spark, SF_DIR)),
        "derive_minute_from_landed": lambda: force(
            derive_bars(src.scan_bars(spark, minute_run), MINUTE)
        ),
        "sink_derived_chunk": derive(minute_run, MINUTE, "chunk"),
        "sink_derived_range": derive(minute_run, MINUTE, "range"),
        "sink_derived_pair": derive(minute_run, MINUTE, "pair"),
        "sink_derived_bucket": derive(minute_run, MINUTE, "bucket"),
        "sink_derived_hour_chunk": derive(hour_run, HOUR, "chunk"),
    }
    results = {name: median_of(fn) for name, fn in headline.items()}
    # not part of the total: the same minute write in the reference's plan shape
    comparison = {"reference_shape_minute": median_of(reference_shape(minute_run, MINUTE))}
    out = {
        "metric": "headline_total_median",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "comparison": comparison,
        "sf": _sf_of(SF_DIR),
        "cpus": CPUS,
        "shuffle_partitions": SHUFFLE_PARTITIONS,
        "runs": RUNS,
    }
    if "--all" in sys.argv:
        every = {}
        for key, q in registry.queries().items():
            every[key] = round(timed(lambda q=q: force(q(spark, SF_DIR))), 3)
        out["all_queries"] = every
        out["all_queries_total"] = round(sum(every.values()), 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
