"""Time the registered queries at $BENCH_SF_DIR and print one JSON line.

Each query runs once to warm up and once on the clock; results go to the noop
sink, so every row is computed and none reaches the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidegauge.queries import QUERIES  # noqa: E402
from tidegauge.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    keys = sys.argv[1:] or list(QUERIES)
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    seconds: dict[str, float] = {}
    for key in keys:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[key] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
