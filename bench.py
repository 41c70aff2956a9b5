"""Wall time of the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (3); its time is the
median. A run ends in a no-op write, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from factorfall.session import build_session  # noqa: E402
from verification.queries import queries  # noqa: E402

HEADLINE = [
    "control_summary",
    "quarterly_sum",
    "markets_null_rwf",
    "waterfall_join",
    "stage1_outlook",
    "stage1_addon",
    "stage2_frm",
    "upload_template",
    "rwa_long",
    "diff_verdict",
    "sql_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="staging-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, times = queries(), {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:]), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline query wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
