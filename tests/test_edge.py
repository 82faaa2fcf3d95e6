"""Edge cases: empty input and the driver contract."""
import importlib.util
import os

from critiq import analyse
from critiq.plans.registry import oracle_sql, queries


def test_empty_input(spark, raw):
    empty = raw.limit(0)
    an = analyse(empty, materialize="table")
    a = an.audit.collect()[0]
    assert (a.total_records, a.health_score, a.deductions) == (0, 100, 0.0)
    log = an.cleaning_log.collect()[0]
    assert (log.total_raw, log.total_cleaned_saved, log.exact_duplicates_removed) == (0, 0, 0)
    assert {r.ai_category: r["count"] for r in an.category_distribution.collect()} == \
        {"Billing": 0, "App Bug": 0, "Delivery": 0, "Staff/Support": 0, "Other": 0}
    t = an.trend.collect()[0]
    assert (t.status, t.reason) == ("Stable", "Insufficient timestamp data to compute trend.")
    recs = an.recommendations.collect()
    assert [r.title for r in recs] == ["Establish Feedback Loops for Category Hotspots"]
    m = an.metrics.collect()[0]
    assert (m.average_confidence, m.low_confidence_count, m.low_confidence_percentage) == (1.0, 0, 0.0)
    k = an.exec_kpis.collect()[0]
    assert (k.raw_records, k.valid_complaints, k.most_negative_source) == (0, 0, "N/A")


def test_entry_contract(spark):
    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() == 1 and "raw_records" in df.columns
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert set(oracle_sql()) <= set(queries())
    assert not [k for k in queries() if k.startswith("op") or k == "pipeline"]
