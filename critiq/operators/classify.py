"""Heuristic classifier: (text, rating) -> sentiment, category, summary, confidence.

Pure Column expressions (substring keyword counts, CASE rules), so it runs
inside whole-stage codegen.  It is applied once per complaint pattern, not
once per row (see ``enrich``).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import keyword_count, parse_rating, py_strip, summary_line

CLASS_FIELDS = ["sentiment", "category", "summary", "confidence"]


def lowered(text: Column) -> Column:
    """The form every keyword test runs on: lower(strip(text))."""
    return F.lower(py_strip(text))


def category_scores(text: Column, low: str | None = None) -> dict[str, Column]:
    """Keyword hits per category over lower(strip(text)); Other is always 0."""
    t = lowered(text) if low is None else low
    return {cat: keyword_count(t, kws) for cat, kws in K.CATEGORY_KEYWORDS.items()}


def best_category(scores: dict[str, Column]) -> Column:
    """Highest score; ties go to the earlier category; all zero -> Other."""
    ordered = [c for c in K.CATEGORIES if c in scores]
    top = F.greatest(*[scores[c] for c in ordered])
    expr = F.when(top == 0, F.lit("Other"))
    for c in ordered:
        expr = expr.when(scores[c] == top, F.lit(c))
    return expr


def sentiment_scores(text: Column, low: str | None = None) -> tuple[Column, Column]:
    """(positive hits, negative hits)."""
    t = lowered(text) if low is None else low
    return (keyword_count(t, K.SENTIMENT_KEYWORDS["Positive"]),
            keyword_count(t, K.SENTIMENT_KEYWORDS["Negative"]))


def text_sentiment(pos: Column, neg: Column) -> Column:
    return (F.when(pos > neg, F.lit("Positive")).when(neg > pos, F.lit("Negative"))
             .otherwise(F.lit("Neutral")))


def final_sentiment(pos: Column, neg: Column, r: Column) -> Column:
    """A high rating is Positive unless negatives outweigh; a low rating is
    Negative unless positives outweigh; otherwise (3 or no rating) the text decides."""
    return (F.when(r >= 4.0, F.when(neg > pos, F.lit("Negative")).otherwise(F.lit("Positive")))
             .when(r <= 2.0, F.when(pos > neg, F.lit("Positive")).otherwise(F.lit("Negative")))
             .otherwise(text_sentiment(pos, neg)))


def confidence(pos: Column, neg: Column, r: Column, sentiment: Column) -> Column:
    """Closed set of levels, written as literals (no float arithmetic)."""
    base = (F.when(r.isNull(), F.lit(0.75))
             .when((r >= 4.0) & (sentiment == "Negative"), F.lit(0.45))
             .when((r <= 2.0) & (sentiment == "Positive"), F.lit(0.50))
             .otherwise(F.lit(0.85)))
    mixed = (F.when(base == 0.75, F.lit(0.60)).when(base == 0.45, F.lit(0.30))
              .when(base == 0.50, F.lit(0.35)).otherwise(F.lit(0.70)))
    return F.when((pos > 0) & (neg > 0), mixed).otherwise(base).cast("double")


def classify(text: Column, rating: Column, low: str | None = None,
             rating_value: Column | None = None) -> Column:
    """Struct(sentiment, category, summary, confidence).

    The keyword tests reference ``lower(strip(text))`` ~165 times: on large
    frames stage it as a column and pass its name as ``low`` (``classify_frame`` does)."""
    r = parse_rating(rating) if rating_value is None else rating_value
    pos, neg = sentiment_scores(text, low)
    sent = final_sentiment(pos, neg, r)
    return F.struct(
        sent.alias("sentiment"),
        best_category(category_scores(text, low)).alias("category"),
        summary_line(text).alias("summary"),
        confidence(pos, neg, r, sent).alias("confidence"),
    )


def classify_frame(df, text: str, rating: str, out: str = "_class"):
    """Add the classification struct as column ``out``.

    The lowered text, the parsed rating and the keyword scores are staged as
    columns: the rules reference each score several times, and a staged column
    is computed once per row instead of once per reference."""
    t, r = F.col(text), F.col(rating)
    x = df.withColumns({"_low": lowered(t), "_rv": parse_rating(r)})
    pos, neg = sentiment_scores(t, "_low")
    cats = category_scores(t, "_low")
    names = {c: f"_c{i}" for i, c in enumerate(cats)}
    x = x.withColumns({"_pos": pos, "_neg": neg, **{names[c]: v for c, v in cats.items()}})
    p, n, rv = F.col("_pos"), F.col("_neg"), F.col("_rv")
    x = x.withColumns({"_sent": final_sentiment(p, n, rv),
                       "_cat": best_category({c: F.col(names[c]) for c in cats})})
    return x.withColumn(out, F.struct(
        F.col("_sent").alias("sentiment"), F.col("_cat").alias("category"),
        summary_line(t).alias("summary"),
        confidence(p, n, rv, F.col("_sent")).alias("confidence"),
    )).drop("_low", "_rv", "_pos", "_neg", "_cat", "_sent", *names.values())
