"""Digest-keyed groups with forced collisions, plans without row sorts, skew
splitting of both pattern joins, and the one-pass cube."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from critiq import analyse
from critiq.functions.dates import parse_date, parse_unwrapped, unwrap
from critiq.operators import audit, clean, insight_cube, pattern_table
from critiq.operators.audit import audit_by_columns
from critiq.operators.digest import KEY, duplicate_counts, groups, keyed, repeats
from critiq.operators.insights import category_counts, conflict_summary, value_distribution, weekly_trend
from critiq.session import materialize


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def conf(spark):
    """Set session options for one test."""
    old = {}

    def put(**options):
        for k, v in options.items():
            k = "spark.sql." + k.replace("_", ".")
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield put
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def weak(cols):
    """Hashes of three values only: nearly every group is mixed."""
    return [F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(3)).alias(KEY[0]), F.lit(0).cast("bigint").alias(KEY[1])]


ROWS = [(i, random.Random(i).choice(["a", "b", "", None, "long " * 30]), random.Random(i * 7).choice([1.0, None, float("nan"), -0.0, 0.0])) for i in range(200)]


@pytest.mark.parametrize("hashes", [None, weak])
def test_digest_groups_equal_groups_by_columns(spark, hashes):
    df = spark.createDataFrame(ROWS, "seq long, x string, `y.z` double").repartition(5)
    more = {} if hashes is None else {"hashes": hashes}
    firsts = {r[0] for r in df.groupBy("x", "`y.z`").agg(F.min("seq")).select("min(seq)").collect()}
    for mode in ("none", "table"):
        assert {r.seq for r in repeats(df, ["x", "y.z"], "seq", mode, **more).collect()} == {s for s, _, _ in ROWS} - firsts
    renamed = df.withColumnRenamed("y.z", "y")
    for cols in (["x"], ["x", "y"]):
        got = duplicate_counts(renamed, cols, **more).first()
        assert tuple(got) == (200, 200 - renamed.select(*cols).distinct().count())


def test_nulls_are_told_apart(spark):
    rows = [(0, None, "a"), (1, "a", None), (2, None, "a"), (3, None, None), (4, "", None)]
    df = spark.createDataFrame(rows, "seq long, x string, y string")
    assert [r.seq for r in repeats(df, ["x", "y"], "seq").collect()] == [2]


def test_audit_with_collisions(raw):
    want = audit_by_columns(raw).first()
    assert audit(raw).first() == want
    assert audit(raw, hashes=weak).first() == want


def test_no_text_is_a_shuffle_key(raw):
    rows = clean(raw, materialize="table").prepared.select("id", "seq", "feedback_text")
    plan = final_plan(groups(keyed(rows, ["id", "feedback_text"])))
    assert "hashpartitioning(_d1" in plan and "SortAggregate" not in plan
    above = plan.split("== Initial Plan ==")[0].split("Exchange")[0] + "".join(ln for ln in plan.splitlines() if "Exchange" in ln)
    assert "feedback_text" not in above


def test_pattern_table_sorts_no_rows(raw, conf):
    rows = clean(raw, materialize="table").rows
    small = final_plan(pattern_table(rows))
    assert "Sort" not in small and "HashAggregate" in small
    # Without a broadcast the smaller side is hashed, not both sides sorted.
    conf(autoBroadcastJoinThreshold="-1")
    large = final_plan(pattern_table(rows))
    assert "ShuffledHashJoin" in large and "Sort [" not in large.split("== Initial Plan ==")[0]


def test_hot_pattern_is_split_in_both_joins(raw, conf):
    hot = materialize(raw.withColumn("feedback_text", F.when(F.col("id") % 3 == 0, F.lit("App crashed on loading screen"))
                                     .otherwise(F.concat("feedback_text", F.lit(" "), F.col("id")))))
    an = analyse(hot, materialize="table")
    want = {r.id: r.complaint_count for r in an.cleaned.table.collect()}
    conf(autoBroadcastJoinThreshold="-1", adaptive_skewJoin_skewedPartitionThresholdInBytes="1k", adaptive_skewJoin_skewedPartitionFactor="1.2",
         adaptive_advisoryPartitionSizeInBytes="1k", adaptive_coalescePartitions_enabled="false")
    for df in (an.cleaned.table, an.enriched):
        # The rows side must arrive in several map outputs to be split.
        plan = final_plan(df)
        assert "skew=true" in plan, plan[:4000]
    assert {r.id: r.complaint_count for r in an.cleaned.table.collect()} == want


def test_cube_equals_separate_aggregates(raw):
    v = materialize(analyse(raw, materialize="table").validated)
    cube = insight_cube(v)
    assert v.count() == cube.filter("level = 'all'").first()["n"]
    for col in ("source", "ai_sentiment"):
        want = {r[0]: r[1] for r in v.filter(F.col(col).isNotNull()).groupBy(col).count().collect()}
        assert {r[0]: r["count"] for r in value_distribution(cube, col).collect()} == want
    weeks = sum(r.total_complaints for r in weekly_trend(cube).collect())
    assert weeks == v.filter("timestamp is not null").count()
    assert {r.ai_category: r["count"] for r in category_counts(v).collect()} == {r.ai_category: r["count"] for r in category_counts(cube).collect()}
    empty = insight_cube(v.limit(0))
    assert conflict_summary(empty).first().asDict() == {"conflict_count": 0, "conflict_percentage": 0.0}
    assert [r["count"] for r in category_counts(empty).collect()] == [0] * 5


def test_kpis_read_the_rows_once(raw):
    an = analyse(raw, materialize="table", keep_validated=False)
    an.audit, an.cleaning_log, an.cube, an.metrics
    plan = final_plan(an.exec_kpis)
    # Only one-row tables and the cube are read.
    assert "feedback_text" not in plan and "normalized_text" not in plan


DATES = {
    "2024-03-05": ["2024_03_05", "5 – March – 2024", "March-5,2024", "05Mar2024", "Mar. 5, 2024", "2024 Mar 5", "5/mar/24", "MARCH 5 2024", "3|5|2024", "05.03.2024", "2024-3-5"],
    "2024-12-31": ["31~12~2024", "12\\31\\2024", "31.12.24", "12.31.2024", "31dec24"],
    None: ["March 2024", "5 March", "2024-03", "123", "1234567", "123456789", "2024-02-30", "31/04/2024", "5 Marchember 2024", "1 2 3", "1 2 345", "123 4 2024", "2024 5 2024", "a b c",
           "13.13.2024", "2024-Mar-2024", "5 Mar 5", "one two 2024", "", " "],
}


def test_dates_by_tokens(spark):
    rows = [(want, text) for want, texts in DATES.items() for text in texts]
    df = spark.createDataFrame(rows, "want string, text string").withColumn("v", unwrap(F.col("text")))
    got = df.select("text", "want", parse_unwrapped("v").cast("string").alias("got")).collect()
    assert [(r.text, r.want, r.got) for r in got if r.got != r.want] == []
    old = spark.createDataFrame([("5-Mar-85",), ("5-Mar-24",), ("2085-03-05",)], "v string").select(parse_unwrapped("v", 70).cast("string").alias("d")).collect()
    assert [r.d for r in old] == ["1985-03-05", "2024-03-05", "2085-03-05"]


def test_every_written_form_of_every_day(spark):
    """All days of two years in the forms that name their parts unmistakably."""
    forms = ["%Y-%m-%d", "%d %B %Y", "%b %d, %Y", "%Y%m%d", "%d.%m.%Y", "%m/%d/%Y", "%Y/%b/%d", "%d-%b-%y"]
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(731)]
    df = spark.createDataFrame([(d, d.strftime(f)) for d in days for f in forms], "d date, text string")
    assert df.filter(~F.col("d").eqNullSafe(parse_date(F.col("text")))).count() == 0
