"""Summarise the physical plans of registered queries: exchanges, join strategies,
windows, partial top-k, and what each parquet scan reads.

Usage: python tools/plan_report.py [sf_dir] [name ...]   (plans after execution, AQE final)
"""
from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from critiq.plans.registry import queries  # noqa: E402
from critiq.session import local_session  # noqa: E402

OPS = ["Exchange hashpartitioning", "Exchange SinglePartition", "Exchange rangepartitioning",
       "Exchange RoundRobinPartitioning", "BroadcastExchange", "BroadcastHashJoin",
       "SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window ",
       "WindowGroupLimit", "TakeOrderedAndProject", "HashAggregate", "SortAggregate",
       "ObjectHashAggregate", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Subquery "]


def summarise(plan: str) -> dict:
    c = Counter()
    for op in OPS:
        c[op.strip()] = plan.count(op)
    scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", plan)) - {"[]"})
    return {"ops": {k: v for k, v in c.items() if v}, "scans": scans, "pushed": pushed}


def flow_stages(spark, sf):
    """The three written stages of the flow, each planned from the previous table."""
    from critiq.operators import audit, enrich, validate
    from critiq.operators.clean import (Cleaned, drop_exact_duplicates, fill_and_impute,
                                        pattern_table, prepare_rows)
    from critiq.functions import normalize_text
    from critiq.plans import fixtures as fx
    from critiq.session import materialize
    from pyspark.sql import functions as F
    raw = fx.feedback_raw(spark, sf)
    prepared = prepare_rows(raw)
    yield "stage 0: audit (raw)", audit(raw)
    yield "stage 1: prepared rows", prepared
    p = materialize(prepared, "table")
    rows = drop_exact_duplicates(fill_and_impute(p).drop("_parsed")).withColumn(
        "normalized_text", normalize_text(F.col("feedback_text")))
    yield "stage 2: filled, imputed, de-duplicated rows", rows
    r = materialize(rows, "table")
    yield "stage 3: enriched + validated", validate(enrich(Cleaned(r, pattern_table(r), raw)), 80).table


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or ["dist_category", "category_examples", "conflict_sample",
                             "exec_kpis", "duplicate_text", "doc_patterns", "response_merge"]
    spark = local_session(8)
    qs = queries()
    items = list(flow_stages(spark, sf)) + [(n, qs[n](spark, sf)) for n in names]
    for name, df in items:
        df.write.format("noop").mode("overwrite").save()
        simple = df._jdf.queryExecution().executedPlan().toString()
        formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        s = summarise(simple)
        f = summarise(formatted)
        print(f"### {name}\n- operators: {s['ops']}\n- scans: {f['scans']}\n"
              f"- pushed filters: {f['pushed']}\n")


if __name__ == "__main__":
    main()
