"""Row ordinals.  File order is part of the semantics (fill direction, keep-first
duplicate removal, first row per pattern), so every working frame carries
``seq``.  These helpers assign it without a global sort or a single-task window
over the rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOW33 = (1 << 33) - 1


def with_file_order(df: DataFrame, seq: str = "seq", file_col: str | None = None,
                    block_col: str | None = None) -> DataFrame:
    """Dense 0-based ``seq`` in file order for a frame read from files.

    The rows are written once with their file path, split start and running id;
    a file split always lands in one partition and is read in order, so the ids
    of a split are consecutive.  Split offsets and rows are both read from that
    table, so no second scan of the input, with whatever split layout, can
    disagree with the first, and no row can miss its split.
    ``file_col``/``block_col`` name already selected metadata columns (streams)."""
    x = (df.withColumn("_f", F.col(file_col) if file_col else F.col("_metadata.file_path"))
           .withColumn("_b", F.col(block_col) if block_col else F.col("_metadata.file_block_start"))
           .withColumn("_m", F.monotonically_increasing_id()))
    x = materialize(x, "table")
    splits = x.groupBy("_f", "_b").agg(F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    # One row per file split; AQE broadcasts it when it is small in bytes.
    w = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_f", "_b", "_m0",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = x.join(offsets, ["_f", "_b"]).withColumn(seq, F.col("_off") + F.col("_m") - F.col("_m0"))
    drop = ["_f", "_b", "_m", "_m0", "_off"] + [c for c in (file_col, block_col) if c]
    return out.drop(*drop)


def with_row_index(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Dense 0-based ``seq`` in file order for a frame read from Parquet files, as
    a lazy plan: the reader's row index says where a row lies in its file, and
    the rows of the files before it are added.  Nothing is written, and no split
    layout changes the result.  The rows of each file are counted by a scan of no
    data column (the file footers hold them)."""
    index = df.select(F.col("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_i"))
    sizes = index.groupBy("_f").agg((F.max("_i") + 1).alias("_n"))
    w = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)   # one row a file
    offsets = sizes.select("_f", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    x = df.withColumn("_f", F.col("_metadata.file_path")).withColumn("_i", F.col("_metadata.row_index"))
    return x.join(offsets, "_f").withColumn(seq, F.col("_off") + F.col("_i")).drop("_f", "_i", "_off")


def with_arrival_order(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Sparse but monotone ``seq`` for sources without files (tables, streams):
    partition order, then row order inside the partition."""
    return df.withColumn(seq, F.monotonically_increasing_id())


def dense_rank_by(df: DataFrame, order_col: str, out: str = "rank0") -> DataFrame:
    """0-based dense position of each row ordered by a unique ``order_col``.

    One range shuffle sorts the rows; they are written once with their partition
    number and position in it.  Row counts per partition (one row a partition)
    become running offsets, read from the same table, so ranks are consistent
    whatever is recomputed."""
    x = (df.repartitionByRange(F.col(order_col)).sortWithinPartitions(order_col)
           .withColumn("_m", F.monotonically_increasing_id()))
    x = materialize(x, "table").withColumn("_p", F.shiftright("_m", 33))
    counts = x.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_p", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    r = x.join(F.broadcast(offs), "_p").withColumn(
        out, F.col("_off") + F.col("_m").bitwiseAND(F.lit(_LOW33)))
    return r.drop("_p", "_m", "_off")
