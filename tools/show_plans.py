"""Print the executed physical plans of the key jobs (after AQE), trimmed to
operator names, exchanges and scan schemas.

    python tools/show_plans.py [--sf-dir DIR] > PLANS.md
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickforge import fixtures as fx  # noqa: E402
from tickforge import registry  # noqa: E402
from tickforge.operators.derive import MINUTE, derive_bars  # noqa: E402
from tickforge.session import get_session, scratch_path  # noqa: E402
from tickforge.sinks import writers  # noqa: E402
from tickforge.sources import landed as src  # noqa: E402

KEEP = re.compile(
    r"(Exchange|ReusedExchange|Union|Window|WindowGroupLimit|Sort|HashAggregate|SortAggregate|"
    r"ObjectHashAggregate|BroadcastHashJoin|SortMergeJoin|BroadcastExchange|Generate|Filter|Scan|"
    r"FileScan|AQEShuffleRead|Expand|Scan ExistingRDD|LocalTableScan|Project)"
)


def trim(plan: str, width: int = 150) -> str:
    out = []
    for line in plan.splitlines():
        body = line.lstrip(" :+-*()0123456789")
        if KEEP.match(body):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: [^,]+, ", "", line)
            out.append(line[:width])
    return "\n".join(out)


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = get_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    spark.sparkContext.setLogLevel("ERROR")

    run = src.run_path(scratch_path(spark, "plans-landed"), "plans")
    writers.sink_landing(fx.landed_bars(spark, args.sf_dir, "minute"), run)
    landed = src.scan_bars(spark, run)

    cases = [
        ("derive minute bars from a landed run, hash chunks (DataFrame default)",
         derive_bars(landed, MINUTE)),
        ("derive minute bars from a landed run, range layout (derive-job default)",
         derive_bars(landed, MINUTE, partitioning="range")),
        ("derive minute bars, copy split forced (split_copies_over=5: every chunk over 5 rows is hot)",
         derive_bars(landed, MINUTE, split_copies_over=5)),
        ("back-fill cut + flatten (concat_pages)", registry.concat_pages(spark, args.sf_dir)),
        ("holiday flags (is_holiday_usa)", registry.is_holiday_usa(spark, args.sf_dir)),
        ("24 newest bars per pair (recent_bars)", registry.recent_bars(spark, args.sf_dir)),
        ("one bucket of a landed run (scan_bars_prefix)", src.scan_bars_prefix(spark, run, "C")),
    ]
    print("# Executed plans (after AQE)\n")
    print(f"Generated by `tools/show_plans.py` on `{args.sf_dir}`, local[8], 16 shuffle partitions.")
    print("Operator lines only; expression ids removed.\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{trim(executed(df))}\n```\n")


if __name__ == "__main__":
    main()
