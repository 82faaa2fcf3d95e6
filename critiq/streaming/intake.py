"""Streaming intake: every file dropped into a folder is one upload, analysed on its own.

The batch engine analyses one whole feedback file per run (a new upload
replaces the previous analysis).  As a stream this is a file source with one
file per micro-batch; ``foreachBatch`` runs the full flow on that file and
writes its result tables, tagged with the file, to the batch's folder
(``batch_id=N``) under the sink folder.  Progress (which files were done) lives in the checkpoint
location under the cluster's checkpoint folder, so a restarted or
executor-lost query resumes without redoing or skipping files.  Nothing is
kept in state between files, so no watermark is needed.
"""
from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.flow import analyse
from ..session import ensure_checkpoint_dir, scratch_scope
from ..sources.ordering import with_file_order
from ..sources.readers import REQUIRED, null_tokens

OUTPUTS = ["audit", "cleaning_log", "metrics", "exec_kpis", "recommendations"]


def feedback_schema(extra=("id",)) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*extra, *REQUIRED]])


def _analyse_file(batch: DataFrame, batch_id: int, sink: str, key: str, outputs) -> None:
    if batch.isEmpty():
        return
    # The batch's intermediate tables go when its results are written.
    with scratch_scope(batch.sparkSession, f"intake-{key}-{batch_id}"):
        # File order: split offset, then position inside the split.
        ranked = with_file_order(batch, "seq", file_col="_file", block_col="_b")
        src = batch.select(F.min("_file")).scalar()
        an = analyse(null_tokens(ranked.drop(*[c for c in ranked.columns if c.startswith("_")])),
                     materialize="table")
        for name in outputs:
            out = getattr(an, name).withColumn("source_file", src)
            # A folder a batch, overwritten: a batch that is retried replaces what
            # its first attempt wrote.
            out.write.mode("overwrite").parquet(os.path.join(sink, name, f"batch_id={batch_id}"))


def start_intake(spark: SparkSession, source_dir: str, sink_dir: str, *,
                 checkpoint: str | None = None, available_now: bool = True,
                 outputs=OUTPUTS, schema: T.StructType | None = None):
    """Start the intake stream; returns the ``StreamingQuery``."""
    base = ensure_checkpoint_dir(spark)
    key = hashlib.sha1(sink_dir.rstrip("/").encode()).hexdigest()[:16]
    checkpoint = checkpoint or os.path.join(base, "critiq-intake", key)
    stream = (spark.readStream.schema(schema or feedback_schema())
              .option("header", True).option("escape", '"').option("maxFilesPerTrigger", 1)
              .csv(source_dir)
              .withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_b", F.col("_metadata.file_block_start")))
    w = (stream.writeStream
         .foreachBatch(lambda df, bid: _analyse_file(df, bid, sink_dir, key, outputs))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
