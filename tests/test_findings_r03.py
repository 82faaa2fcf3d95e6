"""Findings of round 3: one pass over the raw rows for a report, compiled date rules."""
from pyspark.sql import functions as F

from critiq import analyse
from critiq.functions.dates import parse_unwrapped, unwrap, with_date
from critiq.operators.audit import audit

TEXTS = ["App crashed on loading screen", "Great service, love it", None, "", "meh", "Refund missing (order #12)", "Agent Priya was rude"]
DATES = ["2024-03-25", "14-Feb-24", "02/14/2024", "25.3.2024", "March 18, 2024", "20240325", "1st March 2024", "not a date", "2024-13-45", "March 18",
         "25/25/2024", "1/2", "a b c d", "12345-1-1", "", " ", None]


def rows(spark):
    data = [(k, k // 2, DATES[k % len(DATES)], "web" if k % 3 else None, str(1 + k % 5), TEXTS[k % len(TEXTS)]) for k in range(400)]
    return spark.createDataFrame(data + [(1000 + k, *data[k][1:]) for k in range(0, 400, 7)], "seq long, id long, timestamp string, source string, rating string, feedback_text string")


def test_report_reads_the_raw_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = rows(spark)
    n = raw.count()
    got = sorted(map(str, analyse(raw.mapInArrow(count, raw.schema), materialize="table").report_sections.collect()))
    assert seen.value == n
    apart = analyse(raw, materialize="table", keep_validated=False)
    assert got == sorted(map(str, apart.report_sections.collect()))
    assert sorted(map(tuple, analyse(raw, materialize="table").cleaned.rows.collect())) == sorted(map(tuple, analyse(raw).cleaned.rows.collect()))


def test_audit_of_tested_rows_keeps_names_of_the_input(spark):
    raw = rows(spark).withColumn("_date", F.lit("kept"))
    an = analyse(raw, materialize="table")
    assert an._tested is None and an.audit.first() == audit(rows(spark)).first()


def test_compiled_dates_equal_the_expression(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "text string").withColumn("v", unwrap(F.col("text")))
    for pivot in (None, 20):
        x = with_date(df, "v", "d", pivot)
        assert x.columns == ["text", "v", "d"]
        assert x.filter(~F.col("d").eqNullSafe(parse_unwrapped("v", pivot))).count() == 0
    assert with_date(df, "v", "d").filter("d is not null").count() == 7
