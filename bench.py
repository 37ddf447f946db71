"""Times the headline queries: prints one JSON line.  BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores."""

import json
import os
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.plans.queries import QUERIES  # noqa: E402

NAMES = ["price_resolution", "touch_snapshots", "asof_strict", "forward_cagr", "max_drawdown", "technical_features", "full_rank", "tie_audit", "uniqueness_weights", "role_tags"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = {}
    for name in NAMES:
        times = []
        for _ in range(1 + int(os.environ.get("BENCH_RUNS", "2"))):  # the first run compiles code
            t = time.time()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.time() - t)
        out[name] = round(median(times[1:]), 3)
    print(json.dumps({"metric": "total seconds of the headline queries, median of warm runs", "value": round(sum(out.values()), 3), "unit": "sec", "queries": out, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
