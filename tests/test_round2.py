"""Cases outside the fixture: date forms, text ids, scan layout, responses, sinks."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from critiq.functions.dates import parse_unwrapped, unwrap
from critiq.operators.clean import drop_exact_duplicates, with_surrogate_id
from critiq.operators.fill import fill_in_order
from critiq.operators.responses import merge_responses
from critiq.sources import dense_rank_by, read_feedback, write_table

FORMS = {
    "2024-03-25": ["2024-03-25T16:31:48", "2024-03-25T16:31", "2024-03-25T16:31:48.123Z", "2024-03-25 16:31:48.123", "2024-03-25T16:31:48+05:30",
                   "2024/03/25 10:00", "2024-Mar-25", "2024.03.25", "20240325T163148", "2024-03-25 16:31:48", "20240325", "25.3.2024"],
    "2024-02-14": ["02-14-2024", "14-02-2024", "14-02-24", "02/14/2024 16:31", "02/14/2024 16:31:48", "14/02/2024 16:31", "14 Feb 2024 10:30", "2/14/24 4:30 PM",
                   "14-February-2024", "Feb-14-2024", "14/Feb/2024", "02/14/24", "14-Feb-24"],
    "2024-03-18": ["18-03-2024 10:00", "Mar 18, 2024 5:00 PM", "March 18 2024", "18 March, 2024", "Mon Mar 18 10:00:00 2024", "Monday, March 18, 2024"],
    "2024-09-05": ["Sept 5, 2024"],
    "2024-03-01": ["1st March 2024"],
    None: ["March", "12:30", "March 18", "not a date", "2024-13-45", "10:00 PM", "25/25/2024", "2024"],
}


def test_date_forms(spark):
    rows = [(want, text) for want, texts in FORMS.items() for text in texts]
    df = spark.createDataFrame(rows, "want string, text string").withColumn("v", unwrap(F.col("text")))
    got = df.select("want", "text", parse_unwrapped("v").cast("string").alias("got")).collect()
    assert [(r.text, r.got) for r in got if r.got != r.want] == []


def test_date_forms_match_oracle():
    import duckdb
    from critiq.plans import oracle
    con = duckdb.connect()
    con.execute("CREATE TABLE t (want VARCHAR, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(w, t) for w, ts in FORMS.items() for t in ts])
    assert con.execute(f"SELECT x, want, {oracle.iso_date('x')} AS got FROM t WHERE got IS DISTINCT FROM want").fetchall() == []


def test_text_ids_stay_apart(spark):
    df = spark.createDataFrame([(0, "A1", "t"), (1, "B2", "t"), (2, "3.0", "t"), (3, "3", "t"), (4, None, "t")], "seq long, id string, feedback_text string")
    out = drop_exact_duplicates(with_surrogate_id(df)).collect()
    assert sorted((r.id or "", r.seq) for r in out) == [("", 4), ("3", 2), ("A1", 0), ("B2", 1)]
    whole = spark.createDataFrame([(0, 7)], "seq long, id int")
    assert with_surrogate_id(whole).schema["id"].dataType.simpleString() == "bigint"


def test_file_order_survives_another_scan_layout(spark, tmp_path):
    rows = [(str(i), "web", "3", f"text {i}") for i in range(1500)]
    write_table(spark.createDataFrame(rows, "timestamp string, source string, rating string, feedback_text string").coalesce(3), str(tmp_path / "x"), "csv")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "2")
        out = read_feedback(spark, str(tmp_path / "x"), "csv")
        spark.conf.set("spark.sql.files.minPartitionNum", "16")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        seq = sorted(r.seq for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert seq == list(range(1500))


def test_csv_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,source,rating,feedback_text\n2024-01-01,web,3,ok\n" * 1)
    (tmp_path / "b.csv").write_text("source,timestamp,feedback_text,rating\nweb,2024-01-01,Food was cold,3\n")
    with pytest.raises(Exception):
        read_feedback(spark, str(tmp_path), "csv", with_seq=False).collect()


def test_csv_sink_keeps_values(spark, tmp_path):
    rows = [(" web ", 'say "hi", ok')]
    write_table(spark.createDataFrame(rows, "a string, b string"), str(tmp_path / "o"), "csv")
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "o"))
    assert [tuple(r) for r in back.collect()] == rows


def test_dense_rank_first_query(spark):
    df = spark.range(20000).select((F.col("id") * 7 % 20011).alias("seq")).repartition(5)
    got = sorted((r.seq, r.rank0) for r in dense_rank_by(df, "seq").collect())
    assert [r for _, r in got] == list(range(20000))


def test_fill_matches_brute_force(spark):
    import random
    rng = random.Random(3)
    rows = [(i, None if rng.random() < 0.7 else f"v{i}") for i in range(400)]
    rows[:30] = [(i, None) for i in range(30)]
    got = {r.seq: r.t for r in fill_in_order(spark.createDataFrame(rows, "seq long, t string"), "t", chunk=16).collect()}
    last, want = None, {}
    for i, v in rows:
        last = v or last
        want[i] = last
    first = next(v for _, v in rows if v)
    assert got == {i: v or first for i, v in want.items()}


def test_responses(spark):
    rec = spark.createDataFrame([(b, 10 * b + i, "App crashed again", "1") for b in range(1, 5) for i in range(2)], "batch_id long, id long, feedback_text string, rating string")
    one = '{"results":[{"id":%s,"sentiment":"Positive","category":"Other","summary":"s","confidence":%s}]}'
    resp = spark.createDataFrame([(1, one % ('"10"', '"0.9"')), (1, one % ("11", "0.7")), (2, one % ("20", '"high"')), (4, one % ("40", "0.5"))], "batch_id long, response string")
    out = {r.id: (r.status, r.ai_confidence) for r in merge_responses(rec, resp).collect()}
    assert len(out) == 8 and out[10] == ("answered", 0.9) and out[11] == ("answered", 0.7)
    assert out[20][0] == out[21][0] == "failed" and out[30][0] == "failed" and out[40][0] == "answered" and out[41][0] == "missing"
    skip = {r.id: r.status for r in merge_responses(rec, resp.where("batch_id != 2"), breaker=True).collect()}
    assert skip[10] == "answered" and skip[20] == "failed" and skip[30] == "skipped" and skip[40] == "skipped"


def test_plugin_batches_are_dense(spark):
    from critiq.operators import classify_patterns
    df = spark.createDataFrame([(f"p{i}", 1, 50 * i, "text", 3.0) for i in range(41)], "normalized_text string, complaint_count long, first_seq long, first_text string, first_rating double")

    def sizes(frames):
        for f in frames:
            out = f[["normalized_text"]].copy()
            out["sentiment"] = out["category"] = "Other"
            out["summary"], out["confidence"] = f"{int(f['batch_id'].iloc[0])}:{len(f)}", 1.0
            yield out

    got = {r.normalized_text: r.ai_summary for r in classify_patterns(df, sizes).collect()}
    assert got == {f"p{i}": f"{i // 20}:{20 if i < 40 else 1}" for i in range(41)}


def test_scratch_is_removed(spark):
    import os
    from critiq.session import materialize, scratch_path
    from critiq import session
    df = materialize(spark.range(3).toDF("x"), "table")
    assert df.count() == 3
    here = scratch_path(spark, "probe-only")
    assert os.path.isdir(os.path.dirname(here).replace("file:", ""))
    # Only this application's folder is named.
    assert spark.sparkContext.applicationId in here and callable(session.drop_scratch)
