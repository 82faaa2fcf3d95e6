"""Insights over the validated table: distributions, crosstabs, conflicts and
the weekly trend, all cut from one aggregate.

``insight_cube`` reads the validated rows once: a map-side combined aggregate by
(category, sentiment, source, week) leaves a few cells, and ``GROUPING SETS``
over those cells add up every table that is needed (one ``level`` each).  A
category or source that holds a third of all rows costs one partial row a task.
Every function below takes either validated rows or a cube; give several of them
one written cube, as ``plans.flow`` does, and the rows are read once for all.
Windows appear only over frames bounded by a label domain or the number of weeks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import week_end

DIMENSIONS = ("ai_category", "ai_sentiment", "source", "week")
# What a cell sums: rows, rating conflicts, rows below the review threshold,
# rows with a confidence, their confidence, corrected labels.
MEASURES = ("n", "conflicts", "low", "rated", "confidence", "corrected")
LEVELS = {"all": (), "category": ("ai_category",), "sentiment": ("ai_sentiment",), "source": ("source",),
          "source_category": ("source", "ai_category"), "source_sentiment": ("source", "ai_sentiment"),
          "week_sentiment": ("week", "ai_sentiment")}


def insight_cube(v: DataFrame) -> DataFrame:
    """(level, ai_category, ai_sentiment, source, week, measures): one row per
    value combination of each of ``LEVELS``.  Columns that a level does not group
    by are null.  ``_corrected``, if a column of ``v``, counts corrected labels."""
    corrected = F.col("_corrected") if "_corrected" in v.columns else F.lit(0)
    conf = F.col("ai_confidence")
    cells = v.withColumn("week", week_end(F.to_date("timestamp"))).groupBy(*DIMENSIONS).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(conflict_flag(v)).alias("conflicts"),
        F.count_if(conf < K.REVIEW_THRESHOLD).alias("low"), F.count(conf).alias("rated"),
        F.sum(conf).alias("confidence"), F.sum(corrected).cast("bigint").alias("corrected"))
    g = cells.groupingSets([[F.col(c) for c in cols] for cols in LEVELS.values()], *DIMENSIONS).agg(
        F.grouping_id().alias("_set"), *[F.sum(m).alias(m) for m in MEASURES])
    # A bit of the grouping id is set where the column is not grouped by.
    bit = {c: 1 << i for i, c in enumerate(reversed(DIMENSIONS))}
    level = F.lit(None).cast("string")
    for name, cols in LEVELS.items():
        level = F.when(F.col("_set") == sum(b for c, b in bit.items() if c not in cols), F.lit(name)).otherwise(level)
    return g.select(level.alias("level"), *DIMENSIONS, *MEASURES)


def cube_of(v: DataFrame) -> DataFrame:
    """``v`` itself if it is a cube, else the cube of the rows."""
    return v if "level" in v.columns and "conflicts" in v.columns else insight_cube(v)


def _level(cube: DataFrame, name: str) -> DataFrame:
    return cube.filter(F.col("level") == name)


def _total(cube: DataFrame, measure: str = "n") -> Column:
    """A measure over all rows as a scalar, 0 when there are none."""
    return F.coalesce(_level(cube, "all").agg(F.max(measure).alias("t")).scalar(), F.lit(0))


def pct(n: Column, d: Column, digits: int = 2) -> Column:
    """round(n / d * 100, digits); 0.0 when d is 0."""
    return F.when(d > 0, F.round(n / d * 100.0, digits)).otherwise(F.lit(0.0))


def _stack(domain, value_col: str, cols) -> Column:
    """inline(array(struct(label, counts...))) for a fixed label domain."""
    return F.inline(F.array(*[
        F.struct(F.lit(lbl).alias(value_col), F.lit(i).alias("_rank"),
                 *[F.col(f"{c}_{i}").alias(c) for c in cols])
        for i, lbl in enumerate(domain)]))


def category_counts(v: DataFrame) -> DataFrame:
    """(ai_category, count, percentage) for the five categories, zero-filled."""
    x = cube_of(v).filter(F.col("level").isin("all", "category"))
    n = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    wide = x.agg(n(F.col("level") == "all").alias("_total"),
                 *[n((F.col("level") == "category") & (F.col("ai_category") == c)).alias(f"count_{i}")
                   for i, c in enumerate(K.CATEGORIES)])
    long = wide.select("_total", _stack(K.CATEGORIES, "ai_category", ["count"]))
    return long.select("ai_category", "_rank", "count",
                       pct(F.col("count"), F.col("_total")).alias("percentage"))


def category_examples(v: DataFrame, k: int = K.CATEGORY_EXAMPLES) -> DataFrame:
    """(ai_category, examples): up to k texts per category by confidence desc, file order on ties.
    The row_number filter plans as a partial WindowGroupLimit before the shuffle."""
    w = Window.partitionBy("ai_category").orderBy(F.desc("ai_confidence"), F.asc("seq"))
    top = (v.filter(F.col("ai_category").isin(K.CATEGORIES))
            .select("ai_category", "ai_confidence", "seq", "feedback_text")
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k))
    return top.groupBy("ai_category").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", "feedback_text"))),
                    lambda e: e.getField("feedback_text")).alias("examples"))


def category_distribution(v: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """(ai_category, count, percentage, examples) over the five categories."""
    ex = category_examples(v)          # at most 5 rows: filtered to the category domain
    d = category_counts(v if cube is None else cube).join(F.broadcast(ex), "ai_category", "left")
    return d.select("ai_category", "count", "percentage",
                    F.coalesce("examples", F.array().cast("array<string>")).alias("examples"),
                    "_rank")


def value_distribution(v: DataFrame, col: str) -> DataFrame:
    """(value, count, percentage) over observed non-null values of ``source`` or
    ``ai_sentiment``; the denominator is every row (null values included)."""
    cube = cube_of(v)
    g = _level(cube, {"ai_sentiment": "sentiment", "source": "source"}[col])
    # A scalar subquery: a window over all values would run in one task.
    return (g.withColumn("_total", _total(cube)).filter(F.col(col).isNotNull())
             .select(col, F.col("n").alias("count"), pct(F.col("n"), F.col("_total")).alias("percentage")))


def crosstab(v: DataFrame, col: str, domain, label: str) -> DataFrame:
    """(source, <label>, percentage): row-normalised shares of ``col`` per source,
    over rows where both are set; labels never observed are left out."""
    cube = cube_of(v)
    x = _level(cube, {"ai_category": "source_category", "ai_sentiment": "source_sentiment"}[col]).filter(
        F.col("source").isNotNull() & F.col(col).isNotNull())
    n = lambda lbl: F.coalesce(F.sum(F.when(F.col(col) == lbl, F.col("n"))), F.lit(0))
    wide = x.groupBy("source").agg(F.sum("n").alias("_row"), *[n(lbl).alias(f"n_{i}") for i, lbl in enumerate(domain)])
    long = wide.select("source", "_row", _stack(domain, label, ["n"]))
    # Counts of the labels as one scalar subquery: a window a label would put
    # all sources into a few tasks.
    seen = x.agg(F.array(*[n(lbl) for lbl in domain]).alias("n")).scalar()
    return (long.withColumn("_seen", F.element_at(seen, F.col("_rank") + 1)).filter(F.col("_seen") > 0)
                .select("source", label, pct(F.col("n"), F.col("_row")).alias("percentage")))


def conflict_flag(v: DataFrame) -> Column:
    r, s = F.col("rating"), F.col("ai_sentiment")
    return F.coalesce(((r >= 4) & (s == "Negative")) | ((r <= 2) & (s == "Positive")), F.lit(False))


def conflict_summary(v: DataFrame) -> DataFrame:
    """(conflict_count, conflict_percentage)."""
    m = _level(cube_of(v), "all").agg(F.coalesce(F.max("conflicts"), F.lit(0)).alias("conflict_count"),
                                      F.coalesce(F.max("n"), F.lit(0)).alias("_n"))
    return m.select("conflict_count", pct(F.col("conflict_count"), F.col("_n")).alias(
        "conflict_percentage"))


def conflict_sample(v: DataFrame, k: int = K.CONFLICT_SAMPLE, with_seq: bool = False) -> DataFrame:
    """First k conflicting rows in file order (a TakeOrdered, no full sort)."""
    cols = ["id", "rating", "ai_sentiment", "feedback_text"]
    return (v.filter(conflict_flag(v)).orderBy("seq").limit(k)
             .select(*(["seq", *cols] if with_seq else cols)))


def weekly_trend(v: DataFrame) -> DataFrame:
    """(week_end, total_complaints, negative_sentiment_percentage) for weeks with rows."""
    x = _level(cube_of(v), "week_sentiment").filter(F.col("week").isNotNull())
    g = x.groupBy("week").agg(F.sum("n").alias("total_complaints"),
                              F.coalesce(F.sum(F.when(F.col("ai_sentiment") == "Negative", F.col("n"))), F.lit(0)).alias("_neg"))
    return g.select(F.date_format("week", "yyyy-MM-dd").alias("week_end"), "total_complaints",
                    pct(F.col("_neg"), F.col("total_complaints")).alias(
                        "negative_sentiment_percentage"))


def _one_decimal(c: Column) -> Column:
    return F.round(c, 1).cast("string")


def trend_status(weekly: DataFrame) -> DataFrame:
    """One row (status, reason, weeks, start_avg, end_avg) comparing the mean weekly
    negative share of the first and last max(1, n // 3) weeks."""
    p = F.col("negative_sentiment_percentage")
    n = F.count(F.lit(1)).over(Window.partitionBy())
    up = Window.orderBy("week_end")
    ranked = (weekly.withColumn("_n", n)
                    .withColumn("_i", F.row_number().over(up))
                    .withColumn("_k", F.greatest(F.lit(1), F.floor(F.col("_n") / 3))))
    m = ranked.agg(
        F.coalesce(F.max("_n"), F.lit(0)).alias("weeks"),
        F.avg(F.when(F.col("_i") <= F.col("_k"), p)).alias("start_avg"),
        F.avg(F.when(F.col("_i") > F.col("_n") - F.col("_k"), p)).alias("end_avg"))
    diff = F.col("end_avg") - F.col("start_avg")
    s, e = _one_decimal(F.col("start_avg")), _one_decimal(F.col("end_avg"))
    status = (F.when(F.col("weeks") < 2, F.lit("Stable"))
               .when(diff < -K.TREND_THRESHOLD, F.lit("Improving"))
               .when(diff > K.TREND_THRESHOLD, F.lit("Worsening"))
               .otherwise(F.lit("Stable")))
    reason = (F.when(F.col("weeks") == 0, F.lit(K.TREND_NO_DATES))
               .when(F.col("weeks") < 2, F.lit(K.TREND_FEW_WEEKS))
               .when(diff < -K.TREND_THRESHOLD, F.format_string(K.TREND_IMPROVING, s, e))
               .when(diff > K.TREND_THRESHOLD, F.format_string(K.TREND_WORSENING, s, e))
               .otherwise(F.format_string(K.TREND_STABLE, s, e)))
    return m.select(status.alias("status"), reason.alias("reason"), "weeks",
                    F.round("start_avg", 4).alias("start_avg"),
                    F.round("end_avg", 4).alias("end_avg"))


def unique_patterns(v: DataFrame) -> DataFrame:
    """Exact number of distinct complaint patterns."""
    return v.agg(F.count_distinct("normalized_text").alias("unique_patterns"))
