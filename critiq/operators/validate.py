"""Validation: map invalid labels onto the allowed sets, log every correction,
flag low-confidence rows and summarise confidence.

Row-local CASE expressions; the log is ``inline`` over a filtered array of
(at most two) correction structs per row, so it is produced in the same pass.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import contains_any, py_strip
from ..functions.keywords import contains_any_sql, sql_ref, sql_string


@dataclass
class Validated:
    """``counted``: corrected labels, review flag and ``_corrected``, the number of
    corrected labels of a row; ``table``: the same without ``_corrected``;
    ``corrections`` and ``metrics`` are planned on first access."""
    counted: DataFrame
    source: DataFrame
    health: Column | int = 80

    @property
    def table(self) -> DataFrame:
        return self.counted.drop("_corrected")

    @property
    def corrections(self) -> DataFrame:
        return corrections_log(self.source)

    @property
    def metrics(self) -> DataFrame:
        return validation_metrics(self.source, self.health)


def _as_text(c: Column) -> Column:
    """``str(x).lower().strip()`` with None spelled 'none'."""
    return F.coalesce(py_strip(F.lower(c)), F.lit("none"))


def is_valid(c: Column, allowed) -> Column:
    return F.coalesce(c.isin(list(allowed)), F.lit(False))


def correct_sentiment(orig: Column, as_text: str | None = None) -> Column:
    """``as_text``: name of a staged ``str(orig).lower().strip()`` column."""
    s = _as_text(orig) if as_text is None else as_text
    fix = (F.when(contains_any(s, K.SENTIMENT_NEGATIVE_HINTS), F.lit("Negative"))
            .when(contains_any(s, K.SENTIMENT_POSITIVE_HINTS), F.lit("Positive"))
            .otherwise(F.lit("Neutral")))
    return F.when(is_valid(orig, K.SENTIMENTS), orig).otherwise(fix)


def correct_category(orig: Column, text: Column, as_text: str | None = None,
                     text_low: str | None = None) -> Column:
    """Fallback map (first contained key wins), then the category keyword scan of
    the row's text in category order, else Other.  ``as_text`` / ``text_low``:
    staged ``str(orig).lower().strip()`` and ``str(text).lower()`` columns."""
    s = _as_text(orig) if as_text is None else as_text
    t = F.lower(F.coalesce(text, F.lit("None"))) if text_low is None else text_low
    if isinstance(s, str) and isinstance(t, str):
        arms = [f"WHEN contains({sql_ref(s)}, {sql_string(k)}) THEN {sql_string(c)}"
                for k, c in K.CATEGORY_FALLBACK]
        arms += [f"WHEN {contains_any_sql(t, kws)} THEN {sql_string(c)}"
                 for c, kws in K.CATEGORY_KEYWORDS.items()]
        fix = F.expr("CASE " + " ".join(arms) + " ELSE 'Other' END")
    else:
        sc = F.col(s) if isinstance(s, str) else s
        fix = None
        for key, cat in K.CATEGORY_FALLBACK:
            fix = (F.when if fix is None else fix.when)(sc.contains(key), F.lit(cat))
        for cat, kws in K.CATEGORY_KEYWORDS.items():
            fix = fix.when(contains_any(t, kws), F.lit(cat))
        fix = fix.otherwise(F.lit("Other"))
    return F.when(is_valid(orig, K.CATEGORIES), orig).otherwise(fix)


def reliability(health: Column, avg_conf: Column) -> Column:
    """High / Medium / Limited by Source Data Quality."""
    return (F.when((health >= K.RELIABILITY_HIGH_HEALTH) & (avg_conf >= K.RELIABILITY_HIGH_CONFIDENCE),
                   F.lit("High"))
             .when((health < K.RELIABILITY_LOW_HEALTH) | (avg_conf < K.RELIABILITY_LOW_CONFIDENCE),
                   F.lit(K.LIMITED))
             .otherwise(F.lit("Medium")))


def _entry(invalid: Column, rid: Column, field: str, orig: Column, fixed: Column,
           template: str) -> Column:
    return F.when(invalid, F.struct(
        rid.alias("record_id"), F.lit(field).alias("field"), orig.alias("original_value"),
        fixed.alias("corrected_value"),
        F.format_string(template, F.coalesce(orig, F.lit("None")), fixed).alias("reason")))


def _staged(df: DataFrame) -> DataFrame:
    return df.withColumns({"_sv": _as_text(F.col("ai_sentiment")),
                           "_cv": _as_text(F.col("ai_category")),
                           "_tl": F.lower(F.coalesce(F.col("feedback_text"), F.lit("None")))})


def _fixes(df: DataFrame) -> DataFrame:
    x = _staged(df)
    return (x.withColumns({
        "_s_fix": correct_sentiment(F.col("ai_sentiment"), "_sv"),
        "_c_fix": correct_category(F.col("ai_category"), F.col("feedback_text"), "_cv", "_tl")})
        .drop("_sv", "_cv", "_tl"))


def corrections_log(df: DataFrame) -> DataFrame:
    """One row per corrected field (sentiment before category within a record)."""
    s, c = F.col("ai_sentiment"), F.col("ai_category")
    rid = F.col("id").cast("bigint")
    x = _fixes(df)
    arr = F.array(
        _entry(~is_valid(s, K.SENTIMENTS), rid, "sentiment", s, F.col("_s_fix"),
               K.SENTIMENT_REASON),
        _entry(~is_valid(c, K.CATEGORIES), rid, "category", c, F.col("_c_fix"),
               K.CATEGORY_REASON))
    return x.select(F.inline(F.filter(arr, lambda e: e.isNotNull())))


def validation_metrics(df: DataFrame, health: Column | int) -> DataFrame:
    """average_confidence (4 d.p.), low_confidence_count, low_confidence_percentage,
    reliability, of rows with ``ai_confidence`` or of their insight cube."""
    h = health if isinstance(health, Column) else F.lit(health)
    if "level" in df.columns:
        m = df.filter(F.col("level") == "all").agg(
            F.max(F.col("confidence") / F.nullif(F.col("rated"), F.lit(0))).alias("_avg"),
            F.coalesce(F.max("low"), F.lit(0)).alias("_low"), F.coalesce(F.max("n"), F.lit(0)).alias("_n"))
    else:
        conf = F.col("ai_confidence")
        m = df.agg(F.avg(conf).alias("_avg"), F.count_if(conf < K.REVIEW_THRESHOLD).alias("_low"),
                   F.count(F.lit(1)).alias("_n"))
    avg = F.coalesce(F.col("_avg"), F.lit(1.0))
    return m.select(
        F.round(avg, 4).alias("average_confidence"),
        F.col("_low").alias("low_confidence_count"),
        F.when(F.col("_n") > 0, F.round(F.col("_low") / F.col("_n") * 100.0, 2))
         .otherwise(F.lit(0.0)).alias("low_confidence_percentage"),
        reliability(h, avg).alias("insight_reliability"))


def validate(enriched: DataFrame, health: Column | int = 80) -> Validated:
    wrong = (~is_valid(F.col("ai_sentiment"), K.SENTIMENTS)).cast("int") + (~is_valid(F.col("ai_category"), K.CATEGORIES)).cast("int")
    counted = (_fixes(enriched)
               .withColumn("_corrected", wrong)
               .withColumn("ai_sentiment", F.col("_s_fix"))
               .withColumn("ai_category", F.col("_c_fix"))
               .drop("_s_fix", "_c_fix")
               .withColumn("needs_human_review", F.col("ai_confidence") < K.REVIEW_THRESHOLD))
    return Validated(counted=counted, source=enriched, health=health)


def review_queue(validated: DataFrame) -> DataFrame:
    """Rows flagged for human review, in the dashboard's column selection."""
    return validated.filter("needs_human_review").select(
        "id", "feedback_text", "rating", "ai_sentiment", "ai_category", "ai_confidence",
        "complaint_count")
