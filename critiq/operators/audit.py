"""Data-quality audit of raw feedback: twelve counts and one health score.

Plan shape (one scan, two narrow shuffles, no per-row Python): the row tests are
counted while the rows are grouped by the digests of record and text
(``operators.digest``), so no text is a shuffle key; groups of equal texts are
added up from them, then the totals.  Exact-duplicate rows = rows - distinct
records, duplicate texts likewise; null equals null.  If a digest turns out to
hold different records or texts, the audit is done by the columns themselves.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import (contradicts, is_meaningless, is_missing_timestamp,
                         is_multilingual, mentions_agent, mentions_order_number, parse_rating,
                         py_strip)
from ..functions.dates import unwrap, with_date
from ..session import materialize
from .digest import check, digest, groups

AUDIT_COLUMNS = ["total_records", "health_score", "missing_timestamp_count",
                 "missing_rating_count", "duplicate_row_count", "duplicate_feedback_count",
                 "empty_feedback_count", "invalid_timestamp_count", "contradiction_count",
                 "agent_mentions_count", "order_number_count", "multilingual_count"]


def health(total: Column, counts: dict) -> tuple[Column, Column]:
    """(deductions, health_score) from the six penalised counts."""
    t = total.cast("double")
    parts = [
        (counts["missing_timestamp_count"], K.PENALTY_MISSING_TIMESTAMP),
        (counts["missing_rating_count"], K.PENALTY_MISSING_RATING),
        (counts["duplicate_row_count"], K.PENALTY_DUPLICATE_ROW),
        (counts["duplicate_feedback_count"], K.PENALTY_DUPLICATE_FEEDBACK),
        (counts["empty_feedback_count"], K.PENALTY_EMPTY_FEEDBACK),
        (counts["invalid_timestamp_count"], K.PENALTY_INVALID_TIMESTAMP),
    ]
    ded = None
    for c, w in parts:
        term = c / t * F.lit(100.0) * F.lit(w)
        ded = term if ded is None else ded + term
    ded = F.when(total > 0, ded).otherwise(F.lit(0.0))
    score = F.when(total > 0, F.greatest(F.lit(0), F.least(F.lit(100), (F.lit(100.0) - ded).cast("int"))))
    return ded, F.coalesce(score, F.lit(100))


def _flags(raw: DataFrame, text: str, ts: str, rating: str) -> DataFrame:
    """``raw`` with one boolean column per row test (named as its count)."""
    t = F.col(text)
    x = (with_date(raw.withColumn("_tsv", unwrap(F.col(ts))), "_tsv", "_date").withColumn("_low", F.lower(t))
            .withColumn("_r", parse_rating(F.col(rating))).withColumn("_s", py_strip(t)))
    return x.withColumns({
        "missing_timestamp_count": is_missing_timestamp(F.col(ts)),
        "missing_rating_count": F.col(rating).isNull(),
        "empty_feedback_count": is_meaningless(t, F.col("_s")),
        "invalid_timestamp_count": ~is_missing_timestamp(F.col(ts)) & F.col("_date").isNull(),
        "contradiction_count": contradicts(F.col(rating), t, "_low", F.col("_r")),
        "agent_mentions_count": mentions_agent(t),
        "order_number_count": mentions_order_number(t),
        "multilingual_count": is_multilingual(t, "_low")}).drop("_tsv", "_low", "_r", "_s")


def tested_rows(raw: DataFrame, mode: str) -> DataFrame | None:
    """``raw`` with the row tests of the audit and ``_date``, the parsed timestamp,
    written once for the audit and the cleaning (None where nothing is written, or
    a column has such a name already)."""
    if mode == "none" or {"_date", *FLAGS} & {c.lower() for c in raw.columns}:
        return None
    return materialize(_flags(raw, "feedback_text", "timestamp", "rating"), mode)


FLAGS = ["missing_timestamp_count", "missing_rating_count", "empty_feedback_count", "invalid_timestamp_count",
         "contradiction_count", "agent_mentions_count", "order_number_count", "multilingual_count"]


def _scored(agg: DataFrame, *more: str) -> DataFrame:
    counts = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in AUDIT_COLUMNS
              if c != "health_score"}
    ded, score = health(counts["total_records"], counts)
    return agg.select(
        counts["total_records"].alias("total_records"),
        score.cast("int").alias("health_score"),
        *[counts[c].alias(c) for c in AUDIT_COLUMNS[2:]],
        F.round(ded, 4).alias("deductions"), *more,
    )


def audit(raw: DataFrame, text: str = "feedback_text", ts: str = "timestamp",
          rating: str = "rating", hashes=digest, tested: DataFrame | None = None) -> DataFrame:
    """One-row audit frame: the twelve audit counts plus unclamped ``deductions``.
    The row is computed and written when this is called.  ``tested``: the rows as
    ``tested_rows`` gave them."""
    cols = [c for c in raw.columns if c != "seq"]
    x = _flags(raw, text, ts, rating) if tested is None else tested
    t1, t2 = hashes([text])
    x = x.select(*FLAGS, *hashes(cols), check(x, cols).alias("_chk"), t1.alias("_t1"), t2.alias("_t2"), check(x, [text]).alias("_tchk"))
    records = groups(x, F.first("_t1").alias("_t1"), F.first("_t2").alias("_t2"),
                     F.min("_tchk").alias("_tlo"), F.max("_tchk").alias("_thi"), *[F.count_if(c).alias(c) for c in FLAGS])
    texts = records.groupBy("_t1", "_t2").agg(
        F.sum("_n").alias("_m"), F.sum(F.col("_n") - 1).alias("_dup_rows"),
        (F.max("_mixed") | (F.min("_tlo") != F.max("_thi"))).alias("_mixed"), *[F.sum(c).alias(c) for c in FLAGS])
    one = materialize(_scored(texts.agg(
        F.sum("_m").alias("total_records"), F.sum("_dup_rows").alias("duplicate_row_count"),
        F.sum(F.col("_m") - 1).alias("duplicate_feedback_count"), F.count_if("_mixed").alias("_mixed"),
        *[F.sum(c).alias(c) for c in FLAGS]), "_mixed"), "table")
    if one.first()["_mixed"]:
        return audit_by_columns(raw, text, ts, rating)
    return one.drop("_mixed")


def audit_by_columns(raw: DataFrame, text: str = "feedback_text", ts: str = "timestamp",
                     rating: str = "rating") -> DataFrame:
    """The audit with whole records and texts as keys."""
    cols = [c for c in raw.columns if c != "seq"]
    records = _flags(raw, text, ts, rating).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(c).alias(c) for c in FLAGS])
    texts = records.groupBy(text).agg(F.sum("_n").alias("_m"), F.sum(F.col("_n") - 1).alias("_dup_rows"), *[F.sum(c).alias(c) for c in FLAGS])
    return _scored(texts.agg(
        F.sum("_m").alias("total_records"), F.sum("_dup_rows").alias("duplicate_row_count"),
        F.sum(F.col("_m") - 1).alias("duplicate_feedback_count"), *[F.sum(c).alias(c) for c in FLAGS]))
