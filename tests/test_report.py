"""The report payload against the frames it bundles; a hot pattern (a third of the rows)."""
import json

from pyspark.sql import functions as F

from critiq import analyse


def test_payload_matches_frames(raw):
    an = analyse(raw, materialize="table")
    doc = json.loads(an.report_payload.collect()[0].payload)
    audit = an.audit.collect()[0].asDict()
    assert doc["audit_results"] == audit
    assert doc["cleaning_log"] == an.cleaning_log.collect()[0].asDict()
    m = an.metrics.collect()[0].asDict()
    assert doc["validation_metrics"] == m
    cats = [(c["ai_category"], c["count"], c["percentage"]) for c in doc["distributions"]["category"]]
    want = [(r.ai_category, r["count"], r.percentage)
            for r in an.category_distribution.orderBy("_rank").collect()]
    assert cats == want
    assert all(len(c["examples"]) == 3 for c in doc["distributions"]["category"])
    t = an.trend.collect()[0]
    assert (doc["trends"]["status"], doc["trends"]["reason"]) == (t.status, t.reason)
    assert len(doc["trends"]["weekly_data"]) == t.weeks
    weeks = [w["week_end"] for w in doc["trends"]["weekly_data"]]
    assert weeks == sorted(weeks)
    recs = [(r["title"], r["impact"]) for r in doc["recommendations"]]
    assert recs == [(r.title, r.impact) for r in an.recommendations.orderBy("priority").collect()]
    c = an.conflicts.collect()[0]
    assert doc["conflicts"]["conflict_count"] == c.conflict_count
    assert [s["id"] for s in doc["conflicts"]["conflicts_sample"]] == \
        [r.id for r in an.conflict_sample.collect()]


def test_hot_pattern_third_of_rows(raw):
    """One complaint text on a third of the rows (different ids, dates, ratings)."""
    hot = raw.withColumn("feedback_text", F.when(F.col("id") % 3 == 0,
                                                 F.lit("App crashed on loading screen"))
                         .otherwise(F.col("feedback_text")))
    base = analyse(hot)
    counts = {r.normalized_text: r.complaint_count for r in base.cleaned.patterns.collect()}
    top = max(counts.values())
    assert top >= sum(counts.values()) / 3 - 50
    v1 = sorted(tuple(r) for r in base.validated.drop("seq").collect())
    v2 = sorted(tuple(r) for r in analyse(hot.repartition(3)).validated.drop("seq").collect())
    assert v1 == v2
    hot_rows = base.validated.filter(F.col("normalized_text") == "app crashed on loading screen")
    assert hot_rows.select("ai_category").distinct().collect()[0][0] == "App Bug"
