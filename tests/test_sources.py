"""Sources and sinks: CSV round trip with missing-value tokens and file order."""
import os
import uuid

from critiq.sources import read_feedback, write_table
from critiq.session import scratch_path


def test_csv_file_order_and_tokens(spark):
    base = scratch_path(spark, f"test_csv/{uuid.uuid4().hex}")
    os.makedirs(base, exist_ok=True)
    rows = []
    for f in range(3):
        lines = ["timestamp,source,rating,feedback_text"]
        for i in range(500):
            n = f * 500 + i
            text = "NA" if n % 50 == 0 else f'"row {n}, quoted ""x"""'
            lines.append(f"2024-01-{1 + n % 28:02d},web,{'N/A' if n % 7 == 0 else n % 5 + 1},{text}")
            rows.append(n)
        with open(os.path.join(base, f"part-{f}.csv"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_feedback(spark, base, "csv")
        got = df.orderBy("seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.seq for r in got] == list(range(1500))
    assert got[1].feedback_text == 'row 1, quoted "x"'
    assert got[0].feedback_text is None and got[7].rating is None


def test_write_table_roundtrip(spark, raw):
    path = scratch_path(spark, f"test_write/{uuid.uuid4().hex}")
    write_table(raw, path, "parquet")
    assert spark.read.parquet(path).count() == raw.count()
