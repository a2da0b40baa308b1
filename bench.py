"""Time every registered query on one machine; prints one JSON line.

BENCH_SF_DIR  folder of the sample tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores (default: all)

Each query is planned and run in full (results go to Spark's no-op sink) up to three times,
after a warm-up that starts the JVM and reads the tables; the median counts. A query that has taken
``ENOUGH`` seconds is not run again. ``plan`` has the part of it that passes before Spark runs the query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cdcmart.session import build_session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

ENOUGH = 6.0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> tuple[float, float]:
        start = time.perf_counter()
        frame = QUERIES[name](spark, folder)
        planned = time.perf_counter() - start
        frame.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start, planned

    for name in ("report_delivered_order_aov", "typed_bronze"):
        run(name)
    def median(name: str) -> tuple[float, float]:
        runs = [run(name)]
        while len(runs) < 3 and sum(whole for whole, _ in runs) < ENOUGH:
            runs.append(run(name))
        return sorted(runs)[(len(runs) - 1) // 2]

    runs = {name: median(name) for name in QUERIES}
    seconds = {name: round(whole, 3) for name, (whole, _) in runs.items()}
    spark.stop()
    scale = Path(folder).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "plan": {name: round(planned, 3) for name, (_, planned) in runs.items()},
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
