"""Cleaning: drop meaningless texts, tidy text, standardise and fill dates,
impute ratings, drop exact duplicates (keep the first in file order), and key
every row by its complaint pattern.

Plan shape: filter and per-row expressions are narrow; the fill shuffles once
by chunk.  No text is a shuffle key: duplicate removal groups the rows by a
128-bit digest (``operators.digest``) and removes the listed repeats by their
``seq``; the pattern table is a hash aggregate (count and first ``seq`` per
pattern) whose first rows are then fetched by ``seq``.  A hot pattern is
pre-aggregated map-side; the pattern table is written before it is joined back,
so that AQE broadcasts it when it is small and splits the hot partition of the
rows otherwise.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (clean_text, impute_rating, is_meaningless, iso_date, normalize_text,
                         py_strip)
from ..functions.dates import unwrap, with_date
from .digest import repeats
from .fill import DEFAULT_CHUNK, fill_in_order

CLEANED_COLUMNS = ["id", "timestamp", "source", "rating", "feedback_text", "normalized_text",
                   "complaint_count"]


@dataclass
class Cleaned:
    """``rows``: de-duplicated rows with ``normalized_text`` and ``seq``;
    ``patterns``: one row per pattern (count, first row); ``log``: one-row counts
    (planned on first access)."""
    rows: DataFrame
    patterns: DataFrame
    raw: DataFrame
    prepared: DataFrame | None = None

    @property
    def log(self) -> DataFrame:
        return cleaning_log(self.raw, self.patterns, self.prepared)

    @property
    def table(self) -> DataFrame:
        """The cleaned table: seven columns plus ``seq``."""
        counts = self.patterns.select("normalized_text", "complaint_count")
        return self.rows.join(counts, "normalized_text").select(*CLEANED_COLUMNS, "seq")


def with_surrogate_id(raw: DataFrame) -> DataFrame:
    """``id`` = 1..n in file order when the input has none (needs a dense ``seq``).
    It is assigned before duplicate removal, so identical records keep distinct ids.
    An id column of the input keeps its values: whole numbers become ``bigint``;
    text stays text (``3.0`` reads as ``3``), so different ids never merge."""
    if "id" in raw.columns:
        kind = raw.schema["id"].dataType.simpleString()
        if kind in ("tinyint", "smallint", "int", "bigint"):
            return raw.withColumn("id", F.col("id").cast("bigint"))
        return raw.withColumn("id", F.regexp_replace(F.trim(F.col("id").cast("string")), r"^([+-]?\d+)\.0+$", "$1"))
    return raw.withColumn("id", F.col("seq") + 1)


def prepare_rows(raw: DataFrame, tested: DataFrame | None = None) -> DataFrame:
    """Kept rows with tidy text and the standardised (not yet filled) date;
    ``_parsed`` marks rows whose own date parsed.  ``tested``: the rows as
    ``audit.tested_rows`` gave them."""
    text = F.col("feedback_text")
    if tested is not None:
        x = with_surrogate_id(tested.filter(~F.col("empty_feedback_count")))
        return (x.withColumn("feedback_text", clean_text(text)).withColumn("timestamp", F.date_format("_date", "yyyy-MM-dd"))
                 .withColumn("_parsed", F.col("timestamp").isNotNull())
                 .select(*with_surrogate_id(raw).columns, "_parsed"))
    x = with_surrogate_id(raw).withColumn("_s", py_strip(text))
    x = x.filter(~is_meaningless(text, F.col("_s")))
    return (x.withColumn("feedback_text", clean_text(text, F.col("_s")))
             .withColumn("_tsv", unwrap(F.col("timestamp")))
             .transform(with_date, "_tsv", "_date")
             .withColumn("timestamp", F.date_format("_date", "yyyy-MM-dd"))
             .withColumn("_parsed", F.col("timestamp").isNotNull())
             .drop("_s", "_tsv", "_date"))


def fill_and_impute(prepared: DataFrame, chunk: int | None = DEFAULT_CHUNK) -> DataFrame:
    """Fill dates in file order, then impute ratings from the tidy text."""
    x = fill_in_order(prepared, "timestamp", "seq", chunk)
    x = x.withColumn("_low", F.lower(F.col("feedback_text")))
    return x.withColumn("rating", impute_rating(F.col("rating"), F.col("feedback_text"),
                                                "_low")).drop("_low")


def stage_rows(raw: DataFrame, chunk: int | None = DEFAULT_CHUNK) -> DataFrame:
    """Kept rows after text tidy, date standardise + fill and rating impute
    (before duplicate removal).  Keeps ``_parsed`` (date parsed before fill)."""
    return fill_and_impute(prepare_rows(raw), chunk)


def drop_exact_duplicates(df: DataFrame, order: str = "seq", mode: str = "none", ignore: tuple[str, ...] = ()) -> DataFrame:
    """Keep the first (lowest ``order``, a unique number) of each group of records
    that are equal but for ``order`` and the ``ignore`` columns.  With a ``mode``
    of ``session.materialize`` the list of repeats is written once; if it is too
    long to broadcast, the rows kept are written too, so that they are joined
    with it only once."""
    from ..session import fits_broadcast, materialize
    drop = materialize(repeats(df, [c for c in df.columns if c != order and c not in ignore], order, mode), mode)
    kept = df.join(drop, order, "left_anti").select(*df.columns)
    if mode == "none" or fits_broadcast(drop, 8):
        return kept
    return materialize(kept, mode)


def pattern_table(rows: DataFrame) -> DataFrame:
    """One row per ``normalized_text``: ``complaint_count`` and the pattern's first
    row.  Count and first ``seq`` are a hash aggregate; text and rating of the
    first rows are fetched by ``seq``, which is unique."""
    firsts = rows.groupBy("normalized_text").agg(F.count(F.lit(1)).alias("complaint_count"), F.min("seq").alias("first_seq"))
    fetch = rows.select(F.col("seq").alias("first_seq"), F.col("feedback_text").alias("first_text"), F.col("rating").alias("first_rating"))
    return firsts.join(fetch, "first_seq").select("normalized_text", "complaint_count", "first_seq", "first_text", "first_rating")


def cleaning_log(raw: DataFrame, patterns: DataFrame,
                 prepared: DataFrame | None = None) -> DataFrame:
    """Counts of every cleaning decision; the last two columns are the true
    near-duplicate and unparseable counts (the classic log reports both as 0).

    Two jobs: one aggregate over the raw rows (kept and parsed are row-local
    tests), and one over the pattern table (Σ complaint_count = rows left
    after duplicate removal)."""
    p = patterns.select(F.struct(F.count(F.lit(1)).alias("n"),
                                 F.sum("complaint_count").alias("rows")).alias("p")).scalar()
    pattern_n = p.getField("n")
    dedup_n = F.coalesce(p.getField("rows"), F.lit(0)).cast("bigint")
    if prepared is not None:
        # kept and parsed come from the already written prepared rows
        kp = prepared.select(F.struct(F.count(F.lit(1)).alias("k"),
                                      F.count_if("_parsed").alias("p")).alias("s")).scalar()
        counts = raw.agg(F.count(F.lit(1)).alias("total_raw")).select(
            "total_raw", kp.getField("k").alias("kept"), kp.getField("p").alias("parsed"))
    else:
        staged = (raw.withColumn("_s", py_strip(F.col("feedback_text")))
                     .withColumn("_tsv", unwrap(F.col("timestamp"))))
        keep = ~is_meaningless(F.col("feedback_text"), F.col("_s"))
        parsed = iso_date("_tsv", unwrapped=True).isNotNull()
        counts = staged.agg(F.count(F.lit(1)).alias("total_raw"),
                            F.count_if(keep).alias("kept"),
                            F.count_if(keep & parsed).alias("parsed"))
    return counts.select(
        F.col("total_raw"),
        (F.col("total_raw") - F.col("kept")).alias("empty_removed"),
        (F.col("kept") - dedup_n).alias("exact_duplicates_removed"),
        F.lit(0).cast("bigint").alias("normalized_duplicates_removed"),
        F.col("parsed").alias("timestamps_standardized"),
        F.lit(0).cast("bigint").alias("unparseable_timestamps_kept"),
        dedup_n.alias("total_cleaned_saved"),
        (dedup_n - pattern_n).alias("near_duplicate_rows"),
        (F.col("kept") - F.col("parsed")).alias("unparseable_timestamps"),
    )


def clean(raw: DataFrame, chunk: int | None = DEFAULT_CHUNK, materialize: str = "none", tested: DataFrame | None = None) -> Cleaned:
    """Plan the cleaning.  With ``materialize`` (``table`` / ``checkpoint``) the
    prepared rows, the staged rows and the pattern table are written once: each
    feeds two branches (fill summary + rows; repeats + pattern table + rows;
    classifier + counts) that would otherwise recompute everything before them.
    ``tested``: written rows of ``audit.tested_rows``, which stand in for both the
    raw and the prepared rows."""
    from ..session import materialize as mat
    prepared = mat(prepare_rows(raw), materialize) if tested is None else prepare_rows(raw, tested)
    staged = fill_and_impute(prepared, chunk).drop("_parsed")
    staged = mat(staged.withColumn("normalized_text", normalize_text(F.col("feedback_text"))), materialize)
    # The pattern key is a function of the text: it takes no part in the comparison.
    rows = drop_exact_duplicates(staged, mode=materialize, ignore=("normalized_text",))
    patterns = mat(pattern_table(rows), materialize)
    return Cleaned(rows=rows, patterns=patterns, raw=raw if tested is None else tested,
                   prepared=prepared if materialize != "none" else None)
