"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from orbitframe.plans import catalogue
from orbitframe.session import session

QUERIES = (
    "season_dedup", "season_filter", "yearly_windows", "dedup_last", "state_upsert", "predominant", "fully_cached", "missing_assets", "lookup_last",
    "group_records", "storage_running", "skip_product", "footprint_coverage", "masked_band", "catalog_search", "union_windows",
)


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in QUERIES:
        run = catalogue.QUERIES[name]
        times = []
        for _ in range(3):
            began = time.perf_counter()
            run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(statistics.median(times), 3)
    print(json.dumps({"metric": "sum of medians of 3 warm runs", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
