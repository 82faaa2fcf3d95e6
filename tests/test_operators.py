"""Operator tests: fixture counts, brute-force comparisons, properties, partition independence."""
import random

from pyspark.sql import functions as F

from critiq import analyse
from critiq.operators import audit, fill_in_order, merge_responses, response_results, validate
from critiq.operators.clean import drop_exact_duplicates
from critiq.sources import dense_rank_by


def test_audit_counts(raw):
    a = audit(raw).collect()[0].asDict()
    assert a["total_records"] == 1050 and a["missing_timestamp_count"] == 192
    assert a["missing_rating_count"] == 118 and a["duplicate_row_count"] == 50
    assert a["duplicate_feedback_count"] == 826 and a["empty_feedback_count"] == 262
    assert a["invalid_timestamp_count"] == 95 and a["contradiction_count"] == 143
    assert (a["agent_mentions_count"], a["order_number_count"], a["multilingual_count"]) == (130, 136, 131)
    assert a["deductions"] == 151.4286 and a["health_score"] == 0


def test_health_slice_not_clamped(spark, sf):
    from critiq.plans import fixtures as fx
    a = audit(fx.health_slice(spark, sf)).collect()[0]
    assert (a.total_records, a.deductions, a.health_score) == (136, 44.8529, 55)


def test_cleaning_and_insights(raw):
    an = analyse(raw)
    log = an.cleaning_log.collect()[0]
    assert (log.total_cleaned_saved, log.exact_duplicates_removed, log.timestamps_standardized) == (744, 44, 580)
    assert log.normalized_duplicates_removed == 0 and log.unparseable_timestamps_kept == 0
    cats = {r.ai_category: r["count"] for r in an.category_distribution.collect()}
    assert cats == {"Billing": 194, "App Bug": 154, "Delivery": 176, "Staff/Support": 181, "Other": 39}
    sents = {r.ai_sentiment: r["count"] for r in an.sentiment_distribution.collect()}
    assert sents == {"Negative": 533, "Positive": 178, "Neutral": 33}
    c = an.conflicts.collect()[0]
    assert (c.conflict_count, c.conflict_percentage) == (265, 35.62)
    m = an.metrics.collect()[0]
    assert (m.low_confidence_count, m.average_confidence) == (368, 0.6269)
    t = an.trend.collect()[0]
    assert (t.weeks, t.status) == (14, "Worsening")
    # properties
    v = an.validated
    total = v.count()
    patterns = an.cleaned.patterns
    assert patterns.agg(F.sum("complaint_count")).collect()[0][0] == total
    assert v.filter(~F.col("ai_category").isin("Billing", "App Bug", "Delivery", "Staff/Support", "Other")).count() == 0
    assert v.filter(F.col("timestamp").isNull()).count() == 0
    assert v.filter(F.col("normalized_text") == "").count() == 0


def _py_fill(vals):
    out = list(vals)
    last = None
    for i, v in enumerate(out):
        if v is None:
            out[i] = last
        else:
            last = v
    nxt = None
    for i in range(len(out) - 1, -1, -1):
        if out[i] is None:
            out[i] = nxt
        else:
            nxt = out[i]
    return out


def test_fill_matches_brute_force(spark):
    rnd = random.Random(7)
    for density in (0.0, 0.05, 0.3, 0.9):
        n = 300
        vals = [f"d{i}" if rnd.random() < density else None for i in range(n)]
        seqs = sorted(rnd.sample(range(5 * n), n))
        df = spark.createDataFrame(list(zip(seqs, vals)), "seq long, v string").repartition(5)
        got = {r.seq: r.v for r in fill_in_order(df, "v", "seq", chunk=37).collect()}
        assert [got[s] for s in seqs] == _py_fill(vals)


def test_keep_first_duplicates(spark):
    rows = [(5, "a", 1), (2, "a", 1), (9, None, 1), (3, None, 1), (4, "b", 2)]
    df = spark.createDataFrame(rows, "seq long, x string, y int").repartition(3)
    got = sorted((r.seq, r.x) for r in drop_exact_duplicates(df).collect())
    assert got == [(2, "a"), (3, None), (4, "b")]


def test_dense_rank(spark):
    seqs = random.Random(3).sample(range(100000), 2000)
    df = spark.createDataFrame([(s,) for s in seqs], "seq long").repartition(7)
    got = sorted((r.seq, r.rank0) for r in dense_rank_by(df, "seq", "rank0").collect())
    assert [r for _, r in got] == list(range(2000))


def test_partition_independence(raw):
    base = sorted(tuple(r) for r in analyse(raw).validated.drop("seq").collect())
    for n in (1, 7):
        again = sorted(tuple(r) for r in analyse(raw.repartition(n)).validated.drop("seq").collect())
        assert again == base


def test_validation_goldens(spark):
    df = spark.createDataFrame(
        [(1, "Slightly Negative", "Payment Issue", 0.9, "x"), (2, "Positive", "misc", 0.5, "the app froze"),
         (3, None, None, 0.8, None), (4, "negative", "Delivery", 0.69, "y")],
        "id long, ai_sentiment string, ai_category string, ai_confidence double, feedback_text string")
    v = validate(df, 80)
    got = {r.id: (r.ai_sentiment, r.ai_category, r.needs_human_review) for r in v.table.collect()}
    assert got == {1: ("Negative", "Billing", False), 2: ("Positive", "App Bug", True),
                   3: ("Neutral", "Other", False), 4: ("Negative", "Delivery", True)}
    log = sorted((r.record_id, r.field, r.corrected_value) for r in v.corrections.collect())
    assert log == [(1, "category", "Billing"), (1, "sentiment", "Negative"), (2, "category", "App Bug"),
                   (3, "category", "Other"), (3, "sentiment", "Neutral"), (4, "sentiment", "Negative")]
    reason = [r.reason for r in v.corrections.collect() if r.record_id == 3 and r.field == "sentiment"][0]
    assert reason == "Value 'None' mapped to standard sentiment 'Neutral'"


def test_responses(spark):
    resp = spark.createDataFrame([
        (1, '```json{"results":[{"id":1,"sentiment":"Negative","category":"Delivery","confidence":0.9}]}```'),
        (2, "oops"), (3, '{"results":[]}'), (4, '{"results":[{"id":4},{"id":4,"sentiment":"Positive"}]}')],
        "batch_id long, response string")
    rec = spark.createDataFrame([(1, 1, "late driver", "1"), (2, 2, "App crashed", "5"),
                                 (3, 3, "love it", "5"), (4, 4, "ok text", None)],
                                "batch_id long, id long, feedback_text string, rating string")
    parsed = {r.id: r.sentiment for r in response_results(resp).collect()}
    assert parsed == {1: "Negative", 4: "Positive"}
    m = {r.id: r for r in merge_responses(rec, resp).collect()}
    assert m[1].status == "answered" and m[1].ai_summary == "late driver" and m[1].ai_confidence == 0.9
    assert m[2].status == "failed" and m[2].ai_confidence == 0.45
    assert m[3].status == "missing" and m[4].ai_sentiment == "Positive"
    s = {r.id: r for r in merge_responses(rec, resp, mode="single", breaker=True).collect()}
    assert s[2].status == "single_failed" and s[2].ai_confidence == 0.45
    assert s[3].status == "skipped" and s[4].status == "skipped" and s[1].status == "answered"
