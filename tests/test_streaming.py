"""Streaming intake: each dropped file is analysed on its own; all rows are seen once."""
import os
import uuid

from pyspark.sql import functions as F

from critiq.session import scratch_path
from critiq.streaming import start_intake


def test_intake_one_batch_per_file(spark, raw):
    run = scratch_path(spark, f"test_stream/{uuid.uuid4().hex}")
    src, sink = os.path.join(run, "in"), os.path.join(run, "out")
    parts = raw.withColumn("_ch", F.coalesce("source", F.lit("unknown")))
    (parts.repartition("_ch").sortWithinPartitions("seq").drop("seq")
          .write.partitionBy("_ch").option("header", True).option("escape", '"').csv(src))
    q = start_intake(spark, os.path.join(src, "*"), sink, outputs=["audit", "cleaning_log"])
    q.awaitTermination()
    audit = spark.read.parquet(os.path.join(sink, "audit"))
    # No intermediate table of a batch is left.
    assert not os.path.exists(scratch_path(spark, "scopes")) or not os.listdir(scratch_path(spark, "scopes"))
    assert audit.count() == 5
    assert audit.agg(F.sum("total_records")).collect()[0][0] == raw.count()
    assert audit.select("source_file").distinct().count() == 5
    # restarting the finished query processes nothing new
    q2 = start_intake(spark, os.path.join(src, "*"), sink, outputs=["audit", "cleaning_log"])
    q2.awaitTermination()
    assert spark.read.parquet(os.path.join(sink, "audit")).count() == 5
