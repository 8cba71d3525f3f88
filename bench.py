"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` is the folder of parquet tables, ``BENCH_CPUS`` the number of
local cores, ``BENCH_REPEAT`` the number of runs of each question after one that is
not counted. The model builds and the jobs are timed once, apart from the questions,
which run over the stored layers; each time covers the whole result. ``queries`` holds means
and ``stdev`` the sample standard deviations.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from starfold.session import build_session

QUESTIONS = [f"{q}_{layout}" for q in ("a1", "a2", "a3", "a4", "a5") for layout in ("oltp", "star", "snow")]
OTHERS = ["a6_quarterly_aggregate", "a6_incremental_refresh", "a7_family_kpi", "a8_reconcile", "d14_increment", "d19_kpi_report",
          "d16_weather_clean", "d18_customers_clean", "g8_dedup_keep_first", "w1_top1_per_group", "w2_surrogate_keys",
          "j8_lookup_default", "j12_unpivot", "u1_upsert", "t7_pricing", "q6_date_order"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, repeat = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session("starfold-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    from starfold.catalog import QUERIES
    from starfold.plans.retail import warehouse

    times: dict[str, float] = {}
    spread: dict[str, float] = {}

    def timed(name: str, work, repeat: int = 0) -> None:
        runs = []
        for _ in range(1 + repeat):
            started = time.perf_counter()
            work()
            runs.append(time.perf_counter() - started)
        counted = runs[1:] or runs
        times[name] = round(statistics.mean(counted), 3)
        if len(counted) > 1:
            spread[name] = round(statistics.stdev(counted), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    run(spark.read.parquet(f"{folder}/lineitem.parquet"))  # starts the JVM's threads and caches the file
    w = warehouse(spark, folder)
    timed("build_star", lambda: w.star["fact_exportaciones"])
    timed("build_snow", lambda: w.snow["fact_exportaciones"])
    for name in QUESTIONS + OTHERS:
        timed(name, lambda: run(QUERIES[name](spark, folder)), repeat if name in QUESTIONS else 0)
    print(json.dumps({
        "metric": "total seconds of model builds, questions and jobs", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "stdev": spread, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
