"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query runs once to warm up; the second run is measured.  It is planned and
fully executed (a ``noop`` write forces all
columns).  ``full_report`` is the realistic end-to-end use: one flow over the
raw feedback where the de-duplicated rows and the validated table are
written once as tables in the checkpoint folder and every result (audit, log,
distributions, crosstabs, conflicts, trend, recommendations, spotlight, KPIs,
actions, corrections, review queue) is computed from them.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "audit", "audit_documents", "cleaning_log", "enrich_rows", "validated", "corrections_log",
    "dist_category", "xtab_category", "weekly_trend", "trend_status", "recommendations",
    "exec_kpis", "response_merge", "doc_patterns", "duplicate_text",
]

REPORT_PARTS = [
    "audit", "cleaning_log", "metrics", "corrections", "review_queue", "category_distribution",
    "sentiment_distribution", "source_distribution", "source_vs_category", "source_vs_sentiment",
    "conflicts", "conflict_sample", "weekly", "trend", "recommendations", "spotlight",
    "exec_kpis", "audit_actions",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from critiq.plans import fixtures as fx
    from critiq.plans.flow import analyse
    from critiq.plans.registry import queries
    from critiq.session import local_session

    n = int(cpus) if cpus.isdigit() else os.cpu_count() or 8
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * n), app="critiq-bench")
    qs = queries()
    times: dict[str, float] = {}
    # JVM warm-up outside the measurement (session start, first parquet read).
    run(fx.events(spark, sf_dir).limit(1))
    for name in HEADLINE:
        run(qs[name](spark, sf_dir))  # compiles the query's code
        t0 = time.perf_counter()
        run(qs[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    an = analyse(fx.feedback_raw(spark, sf_dir), materialize="table")
    for part in REPORT_PARTS:
        run(getattr(an, part))
    times["full_report"] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
