"""Enrichment: classify each complaint pattern once and copy the result to
every row of that pattern.

The pattern table (one row per ``normalized_text`` with its first row in file
order) is built by a map-side combined aggregate, the classifier runs over it,
and the result is written and joined back to the rows once.  A pattern holding a
third of all rows costs one partial row per task in the aggregate; in the
join-back AQE broadcasts the pattern side when it is small and splits the hot
partition otherwise.  A pluggable classifier (e.g. a remote model) is called once per
batch of ``CLASSIFIER_BATCH_SIZE`` patterns in first-seen order; its batches are
accounted for one by one, and one that fails falls back alone.
"""
from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import constants as K
from ..session import materialize
from .classify import classify_frame
from .clean import CLEANED_COLUMNS, Cleaned, pattern_table
from .responses import batch_assign

ENRICHED_COLUMNS = CLEANED_COLUMNS + ["ai_sentiment", "ai_category", "ai_summary",
                                      "ai_confidence"]
PLUGIN_SCHEMA = ("normalized_text string, sentiment string, category string, "
                 "summary string, confidence double")
PLUGIN_COLUMNS = ["normalized_text", "sentiment", "category", "summary", "confidence"]
# What is kept of a batch beside its answers: one row a batch is its ``head``.
_BATCH_SCHEMA = ", batch_id long, head boolean, asked long, status string, error string"
ERROR_CHARS = 500

Classifier = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def classifier_answers(patterns: DataFrame, classifier: Classifier, observation: Observation | None = None) -> DataFrame:
    """A plug-in's answers to every batch, with a ``head`` row a batch.

    The plug-in receives one pandas frame with (normalized_text, feedback_text,
    rating, batch_id) a batch and yields frames with ``PLUGIN_SCHEMA``.  A batch for
    which it raises has no answers and the status ``failed``; the others go on.
    ``observation`` collects batches, failed_batches, asked and answered while the
    frame is computed."""
    ask = batch_assign(patterns.select("normalized_text", F.col("first_text").alias("feedback_text"),
                                       F.col("first_rating").alias("rating"), "first_seq"))

    def one_batch(frame):
        frame = frame.sort_values("batch_pos")
        columns = ["normalized_text", "feedback_text", "rating", "batch_id"]
        status, error, found = "answered", None, []
        try:
            found = [f[PLUGIN_COLUMNS] for f in classifier(iter([frame[columns].reset_index(drop=True)])) if len(f)]
        except Exception as e:  # any fault of a plug-in is its batch's alone
            status, error, found = "failed", f"{type(e).__name__}: {e}"[:ERROR_CHARS], []
        head = pd.DataFrame({c: [None] for c in PLUGIN_COLUMNS} | {"batch_id": [frame["batch_id"].iloc[0]], "head": [True], "asked": [len(frame)],
                                                                   "status": [status], "error": [error]})
        head["confidence"] = head["confidence"].astype("float64")
        if not found:
            return head
        rows = pd.concat(found, ignore_index=True).assign(batch_id=frame["batch_id"].iloc[0], head=False, asked=0, status=status, error=None)
        return pd.concat([head, rows.astype({"confidence": "float64"})], ignore_index=True)

    answers = ask.groupBy("batch_id").applyInPandas(one_batch, PLUGIN_SCHEMA + _BATCH_SCHEMA)
    if observation is not None:
        answers = answers.observe(observation, F.count_if("head").alias("batches"), F.count_if(F.col("head") & (F.col("status") == "failed")).alias("failed_batches"),
                                  F.sum("asked").alias("asked"), F.count_if(~F.col("head")).alias("answered"))
    return answers


def classifier_batches(answers: DataFrame) -> DataFrame:
    """(batch_id, asked, answered, status, error): one row per batch."""
    g = answers.groupBy("batch_id").agg(F.sum("asked").alias("asked"), F.count_if(~F.col("head")).alias("answered"),
                                        F.max("status").alias("status"), F.max("error").alias("error"))
    return g.select("batch_id", "asked", "answered", "status", "error")


def classify_patterns(patterns: DataFrame, classifier: Classifier | None = None, answers: DataFrame | None = None) -> DataFrame:
    """Add ``ai_*`` columns to the pattern table.

    Default: the native heuristic.  With a plug-in, or its already written
    ``answers``, patterns that it did not answer keep the heuristic's labels."""
    base = classify_frame(patterns, "first_text", "first_rating", "_h")
    if answers is None and classifier is not None:
        answers = classifier_answers(patterns, classifier)
    if answers is not None:
        own = answers.filter(~F.col("head")).select(F.col("normalized_text").alias("_nt"), *PLUGIN_COLUMNS[1:])
        base = base.join(own, base.normalized_text == own._nt, "left").drop("_nt")
        pick = lambda f: F.coalesce(F.col(f), F.col("_h").getField(f))
    else:
        pick = lambda f: F.col("_h").getField(f)
    return base.select(
        *patterns.columns,
        pick("sentiment").alias("ai_sentiment"),
        pick("category").alias("ai_category"),
        pick("summary").alias("ai_summary"),
        pick("confidence").cast("double").alias("ai_confidence"))


def enrich(cleaned: Cleaned | DataFrame, classifier: Classifier | None = None, answers: DataFrame | None = None) -> DataFrame:
    """Enriched table (cleaned columns + ai_* + seq)."""
    if isinstance(cleaned, Cleaned):
        rows, patterns = cleaned.rows, cleaned.patterns
    else:
        rows = cleaned.drop("complaint_count")
        patterns = pattern_table(rows)
    # Written once: a join of two tables has a shuffle right under each side, so
    # AQE can split a hot pattern, no reader classifies anew, and no filter on a
    # label is pushed down into ~165 keyword tests.
    labels = materialize(classify_patterns(patterns, classifier, answers).select(
        "normalized_text", "complaint_count", "ai_sentiment", "ai_category", "ai_summary",
        "ai_confidence"), "table")
    j = rows.join(labels, "normalized_text", "left")
    return j.select(
        *[c for c in CLEANED_COLUMNS],
        F.coalesce("ai_sentiment", F.lit(K.DEFAULT_SENTIMENT)).alias("ai_sentiment"),
        F.coalesce("ai_category", F.lit(K.DEFAULT_CATEGORY)).alias("ai_category"),
        F.coalesce("ai_summary", F.substring("feedback_text", 1, K.DEFAULT_SUMMARY_CHARS)
                   ).alias("ai_summary"),
        F.coalesce("ai_confidence", F.lit(K.DEFAULT_CONFIDENCE)).alias("ai_confidence"),
        "seq")
