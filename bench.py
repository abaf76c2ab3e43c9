"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 5; the median is reported after a
warm-up pass over all queries and one more warm-up run of the query; jobs get one
warm-up and max(2, BENCH_RUNS // 2) timed runs). Queries write to Spark's ``noop`` sink, so the time is the full
plan without driver-side collection. The job queries include their table writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barlake import queries as q  # noqa: E402
from barlake import testdata as td  # noqa: E402
from barlake.operators import daily_metrics, daily_metrics_join  # noqa: E402
from barlake.session import build_session  # noqa: E402


def _events_bars(spark, sf_dir):
    return td.bars(td.table(spark, sf_dir, "events"), td.NULL_CLOSE_EVERY)


def _lineitem_bars(spark, sf_dir):
    return td.lineitem_bars(td.table(spark, sf_dir, "lineitem"))


def _lineitem_month_bars(spark, sf_dir):
    return td.lineitem_month_bars(td.table(spark, sf_dir, "lineitem"))


# name -> (spark, sf_dir) -> DataFrame: registered queries, and the "*_reference_shape" entries, which
BENCH = {
    "events_daily_metrics": q.QUERIES["daily_metrics"],
    "events_daily_metrics_reference_shape": lambda s, d: daily_metrics_join(_events_bars(s, d)),
    "lineitem_month_metrics": q.QUERIES["monthly_metrics_lineitem"],
    "lineitem_month_metrics_reference_shape": lambda s, d: daily_metrics_join(_lineitem_month_bars(s, d)),
    "lineitem_daily_metrics": q.QUERIES["daily_metrics_lineitem"],
    "lineitem_daily_metrics_reference_shape": lambda s, d: daily_metrics_join(_lineitem_bars(s, d)),
    "lineitem_daily_metrics_untied": lambda s, d: daily_metrics(_lineitem_bars(s, d)),
    "latest_record": q.QUERIES["latest_record"],
    "row_number_asc": q.QUERIES["row_number_asc"],
    "bars_conform": q.QUERIES["bars_conform"],
    "profile_conform": q.QUERIES["profile_conform"],
    "distinct_rows": q.QUERIES["distinct_rows"],
    "daily_sse": q.QUERIES["daily_sse"],
    "upsert_metrics": q.QUERIES["upsert_metrics"],
}

# End-to-end jobs: the timed unit is the whole callable (writes included).
JOBS = {
    "silver_bars_job": q.QUERIES["silver_bars_job"],
    "gold_metrics_job": q.QUERIES["gold_metrics_job"],
}


def _time(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def _median_or_none(fn, warmups: int, runs: int, errors: dict, name: str) -> float | None:
    """Median of ``runs`` timings after ``warmups`` runs; None (and the error kept)
    if the query fails, so one broken entry does not lose the others."""
    try:
        for _ in range(warmups):
            fn()
        return round(statistics.median(_time(fn) for _ in range(runs)), 3)
    except Exception as e:  # noqa: BLE001 - reported in the JSON line
        errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        return None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(f"local[{cpus}]", app_name="barlake-bench", shuffle_partitions=cpus)
    results: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    # Warm the JVM once over every query shape before timing any of them.
    for name, build in BENCH.items():
        _median_or_none(lambda b=build: b(spark, sf_dir).write.format("noop").mode("overwrite").save(), 0, 1, {}, name)
    for name, build in BENCH.items():
        def run(build=build):
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        results[name] = _median_or_none(run, 1, runs, errors, name)
    for name, job in JOBS.items():
        def run_job(job=job):
            job(spark, sf_dir).write.format("noop").mode("overwrite").save()
        results[name] = _median_or_none(run_job, 1, max(2, runs // 2), errors, name)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(v for v in results.values() if v is not None), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
