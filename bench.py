"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``),
``BENCH_CPUS`` the cores.  Every query computes all its rows and columns
(``noop`` sink); the time is the best of ``BENCH_RUNS`` runs after a warm-up.
``naive`` holds the times of the same results computed the plain way
(``benchmarks/naive.py``) in the same session.  With ``BENCH_FILES`` the tables are first
written as that many files each, ``BENCH_TIMES`` over; keys differ between the copies.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from benchmarks.naive import NAIVE
from fleetlens import adapters as A
from fleetlens.plans.catalog import QUERIES
from fleetlens.session import local_session, scratch_path

HEADLINE = [
    "stationarity",
    "hourly_fact",
    "group_record_count",
    "min_sample_gate",
    "station_score",
    "data_consumption",
    "consumption_rank",
    "top_rest_weighted",
    "speed_score",
    "coverage_score",
    "reliability_score",
    "composite_score",
    "missing_days_inclusive",
    "freshness_report",
    "rows_per_day",
    "latest_file",
    "dedup_rows",
    "wide_daily_features",
    "correlation_matrix",
    "export_filtered",
    "message_encode",
    "message_decode",
]


def best_time(query, spark, sf_dir: str, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def spread(spark, sf_dir: str, files: int, times: int) -> str:
    """The tables as ``files`` files each, ``times`` over, with keys that are shifted in every copy."""
    folder = scratch_path(spark, "bench")
    for name in A.SCHEMAS:
        table = A.table(spark, sf_dir, name)
        keys = [f.name for f in table.schema.fields if f.dataType.typeName() == "long" and f.name != "event_id"]
        copies = table.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
        copies = copies.withColumns({k: F.col(k) + F.col("copy") * 1_000_000 for k in keys}).drop("copy")
        copies.repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("fleetlens-bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    scale = sf_dir.rsplit("/sf", 1)[-1]
    if "BENCH_FILES" in os.environ:
        sf_dir = spread(spark, sf_dir, int(os.environ["BENCH_FILES"]), int(os.environ.get("BENCH_TIMES", "1")))
    times = {name: best_time(QUERIES[name], spark, sf_dir, runs) for name in HEADLINE}
    naive = {name: best_time(query, spark, sf_dir, runs) for name, query in NAIVE.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total best time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "naive": naive,
                "sf": scale,
            }
        )
    )


if __name__ == "__main__":
    main()
