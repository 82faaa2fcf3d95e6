"""Row ordinals from Parquet, checked CSV, format dispatch, column contract,
corrections sink, plug-in accounting."""
import os
import uuid

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from critiq import analyse
from critiq.operators.enrich import classifier_answers, classifier_batches
from critiq.session import drop_scratch, scratch_path
from critiq.sources import detect_format, read_csv_checked, read_feedback, require_columns, with_row_index, write_corrections, write_table


def folder(spark, name):
    path = scratch_path(spark, f"{name}/{uuid.uuid4().hex}")
    os.makedirs(path, exist_ok=True)
    return path


def test_parquet_ordinals_are_lazy_and_dense(spark):
    path = os.path.join(folder(spark, "rows"), "x.parquet")
    rows = spark.range(3000).select(F.col("id").cast("string").alias("timestamp"), F.lit("web").alias("source"), F.lit("3").alias("rating"), F.repeat(F.lit("text "), 20).alias("feedback_text"))
    rows.coalesce(3).sortWithinPartitions("timestamp").write.option("parquet.block.size", "4096").parquet(path)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    want = {}
    for f in files:
        for r in spark.read.parquet(os.path.join(path, f)).coalesce(1).collect():
            want[r.timestamp] = len(want)
    scratch = scratch_path(spark, "tables")
    before = set(os.listdir(scratch)) if os.path.exists(scratch) else set()
    for size in ("2048", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {r.timestamp: r.seq for r in read_feedback(spark, path).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == want and sorted(got.values()) == list(range(3000))
    assert (set(os.listdir(scratch)) if os.path.exists(scratch) else set()) == before
    # Only the file sizes are read for the offsets: no data column.
    plan = with_row_index(spark.read.parquet(path)).select("seq")._jdf.queryExecution().executedPlan().toString()
    assert "feedback_text" not in plan


def test_checked_csv(spark):
    path = folder(spark, "checked")
    head = "timestamp,source,rating,feedback_text\n"
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write(head + '2024-01-01,web,3,"fine, ""quoted"""\n2024-01-02,web,4\n\n2024-01-03,web,5,one,two\n2024-01-04,web,1,"open\n'
                '2024-01-05,"web"x,1,after\n2024-01-06,web,2,5" pipe\n2024-01-07,web,NA,last\n')
    with open(os.path.join(path, "b.csv"), "w") as f:
        f.write(head + "2024-02-01,,2,\n")
    rows, malformed = read_csv_checked(spark, path)
    assert [(r.seq, r.timestamp, r.source, r.rating, r.feedback_text) for r in rows.orderBy("seq").collect()] == [
        (0, "2024-01-01", "web", "3", 'fine, "quoted"'), (6, "2024-01-07", "web", None, "last"), (7, "2024-02-01", None, "2", None)]
    assert [(r.seq, r.kind) for r in malformed.orderBy("seq").collect()] == [(1, "short"), (2, "long"), (3, "quoted"), (4, "quoted"), (5, "quoted")]
    log = analyse(rows, materialize="table", malformed=malformed).cleaning_log.first()
    assert (log.total_raw, log.malformed_records) == (3, 5)
    with open(os.path.join(path, "c.csv"), "w") as f:
        f.write("timestamp,source,feedback_text,rating\n2024-01-01,web,x,3\n")
    with pytest.raises(ValueError, match="c.csv"):
        read_csv_checked(spark, path)


def test_format_dispatch_and_columns(spark, tmp_path):
    assert [detect_format(p) for p in ("a.CSV", "b.parquet/", "s3://x/c.jsonl", "d.json")] == ["csv", "parquet", "json", "json"]
    with pytest.raises(ValueError, match="xlsx"):
        detect_format("e.xlsx")
    rows = [("2024-01-01", "web", "3", f"text {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "timestamp string, source string, rating string, feedback_text string")
    for fmt in ("parquet", "json", "csv"):
        path = write_table(df, str(tmp_path / f"x.{fmt}"), fmt)
        back = read_feedback(spark, path)
        assert sorted(r.seq for r in back.collect()) == list(range(20))
        assert sorted(r.feedback_text for r in back.collect()) == sorted(r[3] for r in rows)
    df.createOrReplaceTempView("feedback_rows")
    assert read_feedback(spark, "feedback_rows", "table").filter("seq is not null").count() == 20
    with pytest.raises(ValueError, match="unsupported feedback format"):
        read_feedback(spark, "x", "xlsx")
    with pytest.raises(ValueError, match="rating"):
        require_columns(df.drop("rating"))


def test_corrections_sink(spark, raw):
    an = analyse(raw, classifier=invalid_labels(), materialize="table")
    log = an.corrections
    path = write_corrections(log, os.path.join(folder(spark, "corrections"), "log"))
    back = spark.read.schema(log.schema).json(path)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, log.collect())) and back.count() == an.exec_kpis.first().corrections_applied > 0


def invalid_labels():
    """A plug-in whose sentiments need correcting (workers cannot import tests)."""
    def run(frames):
        for f in frames:
            out = f[["normalized_text"]].copy()
            out["sentiment"], out["category"], out["summary"], out["confidence"] = "negative", "Billing", "s", 0.9
            yield out
    return run


def test_failed_batches_fall_back_alone(spark, raw):
    answer = invalid_labels()

    def flaky(frames):
        for f in frames:
            if f["batch_id"].iloc[0] == 0:
                raise ValueError("x" * 1000)
            yield from answer([f])

    seen = Observation("plug-in")
    an = analyse(raw, classifier=flaky, materialize="table", observation=seen)
    batches = {r.batch_id: r for r in an.classifier_batches.collect()}
    assert batches[0].status == "failed" and batches[0].answered == 0 and batches[0].error.startswith("ValueError: xxx") and len(batches[0].error) == 500
    assert all(r.status == "answered" and r.answered == r.asked for i, r in batches.items() if i)
    n = an.cleaned.patterns.count()
    assert seen.get == {"batches": len(batches), "failed_batches": 1, "asked": n, "answered": n - batches[0].asked}
    # The failed batch has the heuristic's labels, which need no correction.
    fixed = an.corrections.select("record_id").distinct().count()
    assert 0 < fixed < an.validated.count()
    nothing = classifier_answers(an.cleaned.patterns.limit(3), lambda frames: iter(()))
    assert [(r.asked, r.answered, r.status) for r in classifier_batches(nothing).collect()] == [(3, 0, "answered")]
    with pytest.raises(ValueError):
        analyse(raw).classifier_batches


def test_drop_scratch_removes_written_tables(spark, monkeypatch, tmp_path):
    from critiq.session import materialize
    monkeypatch.setattr("critiq.session.ensure_checkpoint_dir", lambda session: str(tmp_path))
    df = materialize(spark.range(10), "table")
    assert df.count() == 10 and [f.name for f in tmp_path.rglob("_SUCCESS")]
    drop_scratch(spark)
    assert not [f for f in tmp_path.rglob("*") if f.is_file()]
