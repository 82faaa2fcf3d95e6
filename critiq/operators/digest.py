"""Equality of whole records by a 128-bit digest instead of the records.

Grouping records by their texts sends every distinct text through the shuffle.
Here a record is keyed by two 64-bit hashes of all its columns, so a group costs
a few numbers.  A third value from another hash family, with the records' byte
length, is carried along: a group whose members differ in it holds different
records, and such groups alone are compared by their columns.  Null equals null.

The hashes are Spark's own and take every column type; a mask tells nulls apart
from values that would hash alike.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["_d1", "_d2"]


def digest(cols: list[str]) -> list[Column]:
    """The two key hashes of the columns, as ``_d1`` and ``_d2``."""
    mask = F.concat(*[F.when(F.col(f"`{c}`").isNull(), F.lit("n")).otherwise(F.lit("v")) for c in cols])
    values = [mask, *[F.col(f"`{c}`") for c in cols]]
    return [F.xxhash64(F.lit(salt), *values).alias(name) for salt, name in zip(("a", "b"), KEY)]


def check(df: DataFrame, cols: list[str]) -> Column:
    """The value that tells records of one digest apart: murmur3 and length."""
    kinds = dict(df.dtypes)
    size = F.lit(0)
    for c in cols:
        if kinds[c] in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
    return F.shiftleft(F.hash(*[F.col(f"`{c}`") for c in cols]).cast("bigint"), 32).bitwiseXOR(size.cast("bigint"))


def keyed(df: DataFrame, cols: list[str], hashes=digest) -> DataFrame:
    """``df`` with the key ``_d1``, ``_d2`` and the check ``_chk`` of ``cols``."""
    return df.select("*", *hashes(cols), check(df, cols).alias("_chk"))


def groups(df: DataFrame, *aggregates: Column) -> DataFrame:
    """Groups of a ``keyed`` frame: ``_n`` rows, ``_mixed`` (different records) and
    the given aggregates (numbers: a hash aggregate)."""
    g = df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"), F.min("_chk").alias("_lo"), F.max("_chk").alias("_hi"), *aggregates)
    return g.withColumn("_mixed", F.col("_lo") != F.col("_hi")).drop("_lo", "_hi")


def members(df: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of the mixed groups."""
    return df.join(mixed.filter("_mixed").select(*KEY), KEY, "left_semi")


def repeats(df: DataFrame, cols: list[str], order: str, mode: str = "none", hashes=digest) -> DataFrame:
    """(``order``): the rows beyond the first, by the unique number ``order``, of
    each group of equal records.  Only numbers are shuffled."""
    from ..session import materialize
    rows = keyed(df, cols, hashes)
    twice = materialize(groups(rows, F.min(order).alias("_first")).filter("_n > 1"), mode)
    # The few groups that hold a repeat meet the narrow rows again.
    pairs = rows.select(*KEY, order).join(twice.filter(~F.col("_mixed")).select(*KEY, "_first"), KEY)
    out = pairs.filter(F.col(order) > F.col("_first")).select(order)
    if mode == "none" or not twice.filter("_mixed").isEmpty():
        same = members(rows, twice)
        firsts = same.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.min(order).alias(order))
        out = out.unionByName(same.select(order).join(firsts.select(order), order, "left_anti"))
    return out


def duplicate_counts(df: DataFrame, cols: list[str], hashes=digest) -> DataFrame:
    """One row (total_rows, duplicate_rows): rows beyond the first of each group of
    equal ``cols``.  Map-side combined, so a hot value costs one partial row per
    task.  The groups are added up in one written row, which also tells whether
    any group has to be compared by its columns."""
    from ..session import materialize
    rows = keyed(df.select(*cols), cols, hashes)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    g = groups(rows)
    one = materialize(g.agg(total("_n").alias("total_rows"), total(F.when(~F.col("_mixed"), F.col("_n") - 1)).alias("duplicate_rows"),
                            F.count_if("_mixed").alias("_mixed")), "table")
    if one.first()["_mixed"]:
        exact = members(rows, g).groupBy(*[F.col(f"`{c}`") for c in cols]).count()
        extra = exact.agg(total(F.col("count") - 1)).scalar()
        one = one.withColumn("duplicate_rows", F.col("duplicate_rows") + extra)
    return one.drop("_mixed")
