"""Classifier responses: parse raw model answers and merge them with the
records of their batch.

A response is JSON ``{"results":[{"id":..,"sentiment":..,"category":..,
"summary":..,"confidence":..}]}``, possibly fenced in a json code block.  Parsing
is ``from_json`` with a fixed schema (malformed text gives null, never an
error).  Merging is a left join of records to exploded results on
(batch_id, id).  A record without an answer falls back to the heuristic
classifier.  Failure handling:
  * a batch whose response is malformed is ``failed``: heuristic, no penalty;
  * with ``breaker=True`` every batch after the first failure (in batch order)
    is ``skipped``: heuristic, no penalty (the first failure opens a breaker);
  * in ``mode='single'`` (one record per call) a failed call keeps the
    heuristic answer but caps its confidence at 0.6.
The first failing batch is found with a global ``min`` (a scalar subquery),
not a window over all batches.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .classify import classify_frame

RESULT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])
# As read: ids and confidences may come as numbers or as text.
_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in RESULT])
RESPONSE = T.StructType([T.StructField("results", T.ArrayType(_TEXT))])


def strip_fence(c: Column) -> Column:
    """Drop a leading json code-fence opener and a trailing fence, then trim."""
    a = F.when(c.startswith("```json"), F.substr(c, F.lit(8))).otherwise(c)
    b = F.when(a.endswith("```"), F.substring(a, F.lit(1), F.length(a) - 3)).otherwise(a)
    return F.trim(b)


def parse_response(c: Column) -> Column:
    """Array of result structs; null when the text is not a JSON object, or when
    an id or a confidence in it is not a number (as text or not).
    A missing ``results`` key reads as an empty list."""
    body = strip_fence(c)
    found = F.coalesce(F.from_json(body, RESPONSE).getField("results"), F.array().cast(T.ArrayType(_TEXT)))
    ok = body.startswith("{") & F.coalesce(F.get_json_object(body, "$").isNotNull(), F.lit(False))

    def bad(e: Column) -> Column:
        return ((e.getField("id").isNotNull() & e.getField("id").try_cast("double").isNull())
                | (e.getField("confidence").isNotNull() & e.getField("confidence").try_cast("double").isNull()))

    def typed(e: Column) -> Column:
        return F.struct(e.getField("id").try_cast("double").cast("bigint").alias("id"), e.getField("sentiment").alias("sentiment"),
                        e.getField("category").alias("category"), e.getField("summary").alias("summary"),
                        e.getField("confidence").try_cast("double").alias("confidence"))

    return F.when(ok & ~F.exists(found, bad), F.transform(found, typed))


def response_results(responses: DataFrame, batch_col: str = "batch_id",
                     response_col: str = "response") -> DataFrame:
    """(batch_id, id, sentiment, category, summary, confidence, parsed) — one row per
    answered id; a later entry for the same id wins; entries without id are ignored."""
    p = responses.select(F.col(batch_col).alias("batch_id"),
                         parse_response(F.col(response_col)).alias("_r"))
    items = (p.select("batch_id", F.posexplode("_r").alias("_pos", "_e"))
              .filter(F.col("_e.id").isNotNull()))
    last = (items.groupBy("batch_id", F.col("_e.id").alias("id"))
                 .agg(F.max_by("_e", "_pos").alias("_e")))
    return last.select("batch_id", "id", "_e.sentiment", "_e.category", "_e.summary",
                       "_e.confidence")


def merge_responses(records: DataFrame, responses: DataFrame, *, mode: str = "batch",
                    breaker: bool = False) -> DataFrame:
    """records: (batch_id, id, feedback_text, rating); responses: (batch_id, response).

    Returns (batch_id, id, status, ai_sentiment, ai_category, ai_summary, ai_confidence);
    status is answered / missing / failed / single_failed / skipped."""
    # One status per batch, however many responses it has: answered if any parses.
    status_of = responses.groupBy("batch_id").agg(
        F.min(F.when(parse_response(F.col("response")).isNull(), F.lit("failed"))
               .otherwise(F.lit("answered"))).alias("_bstatus"))
    answers = response_results(responses).withColumn("_hit", F.lit(True))
    r = (records.join(status_of, "batch_id", "left")
                .join(answers, ["batch_id", "id"], "left"))
    if breaker:
        # A batch without a response has failed as well.
        first_fail = (records.select("batch_id").distinct().join(status_of, "batch_id", "left")
                      .filter(F.coalesce(F.col("_bstatus") == "failed", F.lit(True)))
                      .select(F.min("batch_id")).scalar())
        skipped = F.coalesce(F.col("batch_id") > first_fail, F.lit(False))
    else:
        skipped = F.lit(False)
    failed = F.coalesce(F.col("_bstatus") == "failed", F.lit(True))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    status = (F.when(skipped, F.lit("skipped"))
               .when(failed, F.lit("single_failed" if mode == "single" else "failed"))
               .when(hit, F.lit("answered"))
               .otherwise(F.lit("missing")))
    h = F.col("_h")
    text = F.coalesce(F.col("feedback_text"), F.lit(""))
    use = F.col("status") == "answered"
    conf_h = F.when(F.col("status") == "single_failed",
                    F.least(h.getField("confidence"), F.lit(K.CONFIDENCE_FAILED_CALL_CAP))
                    ).otherwise(h.getField("confidence"))
    x = classify_frame(r.withColumn("_txt", text), "_txt", "rating", "_h").withColumn(
        "status", status)
    return x.select(
        "batch_id", "id", "status",
        F.when(use, F.coalesce("sentiment", F.lit(K.DEFAULT_SENTIMENT)))
         .otherwise(h.getField("sentiment")).alias("ai_sentiment"),
        F.when(use, F.coalesce("category", F.lit(K.DEFAULT_CATEGORY)))
         .otherwise(h.getField("category")).alias("ai_category"),
        F.when(use, F.coalesce("summary", F.substring(text, 1, K.DEFAULT_SUMMARY_CHARS)))
         .otherwise(h.getField("summary")).alias("ai_summary"),
        F.when(use, F.coalesce("confidence", F.lit(K.DEFAULT_CONFIDENCE)))
         .otherwise(conf_h).cast("double").alias("ai_confidence"))



def batch_assign(patterns: DataFrame, order_col: str = "first_seq",
                 size: int = K.CLASSIFIER_BATCH_SIZE) -> DataFrame:
    """Group patterns into classifier batches of ``size`` in first-seen order:
    ``batch_id`` = dense position div size, ``batch_pos`` = position mod size."""
    from ..sources.ordering import dense_rank_by
    r = dense_rank_by(patterns, order_col, "_pos")
    return (r.withColumn("batch_id", F.floor(F.col("_pos") / size))
             .withColumn("batch_pos", F.col("_pos") % size).drop("_pos"))
