"""Forward-then-backward fill in file order, without a single-task window.

Semantics: each null takes the last non-null value before it in ``seq`` order;
leading nulls take the first non-null value after them; all-null stays null.

A window ordered by ``seq`` over the whole frame would run in one task.
Instead rows are cut into chunks of at most ``chunk`` consecutive ``seq``
values (adaptive by default: see ``chunk_width``).  Per chunk we keep its last and first non-null value (a map-side
combined aggregate), carry them across chunks with a window over the small
chunk table, and join the carries back; the fill inside a chunk is then a
window partitioned by chunk.  The join and the window share the chunk
partitioning, so the rows are shuffled once, and a task holds whole chunks of
bounded size regardless of key skew.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = None      # adaptive, see below
MIN_CHUNK = 8_192
MAX_CHUNKS = 100_000


def chunk_width(df: DataFrame, order: str = "seq") -> Column:
    """``seq`` values per chunk: at least MIN_CHUNK, and wide enough that there
    are at most MAX_CHUNKS chunks, so the single-task carry window stays small
    at any scale.  A scalar subquery over the ordinal column."""
    span = df.select((F.max(order) - F.min(order) + F.lit(1)).alias("s")).scalar()
    return F.greatest(F.lit(MIN_CHUNK), F.ceil(span / F.lit(MAX_CHUNKS)))


def fill_in_order(df: DataFrame, col: str, order: str = "seq",
                  chunk: int | None = DEFAULT_CHUNK) -> DataFrame:
    val = F.col(col)
    width = F.lit(chunk) if chunk is not None else chunk_width(df, order)
    # One shuffle of the rows: every chunk lands whole in one task.  The chunk
    # summary below is a second, narrow branch over the same input (only
    # ``order`` and ``col`` survive column pruning); give this operator a
    # materialized input (``clean`` does) so that branch is a two-column read
    # rather than a recomputation.
    x = df.withColumn("_ch", F.floor(F.col(order) / width)).repartition("_ch")
    # A running frame only (UNBOUNDED PRECEDING .. x): it is evaluated
    # incrementally.  A row without a value before it in its chunk and without
    # one carried over precedes the chunk's first value, so that one is next.
    up = Window.partitionBy("_ch").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    y = x.withColumn("_lf", F.last(val, ignorenulls=True).over(up))
    pair = F.struct(F.col(order).alias("o"), val.alias("v"))
    ends = x.groupBy("_ch").agg(
        F.max(F.when(val.isNotNull(), pair)).getField("v").alias("_last"),
        F.min(F.when(val.isNotNull(), pair)).getField("v").alias("_first"))
    before = Window.orderBy("_ch").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.desc("_ch")).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("_ch", "_first",
                        F.last("_last", ignorenulls=True).over(before).alias("_prev"),
                        F.last("_first", ignorenulls=True).over(after).alias("_next"))
    out = y.join(carry, "_ch", "left")
    filled = F.coalesce(F.col("_lf"), F.col("_prev"), F.col("_first"), F.col("_next"))
    return out.withColumn(col, filled).drop("_ch", "_lf", "_first", "_prev", "_next")
