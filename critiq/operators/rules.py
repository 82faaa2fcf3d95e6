"""Rule operators: KPIs -> recommendations, spotlight, executive KPI row,
audit action table and the report payload.

Inputs are one-row frames (global aggregates, exactly one row each) or
frames bounded by a label domain.  One-row results are attached to another
frame as scalar subqueries (``DataFrame.scalar()``), never by joining, and
rule rows are generated with ``inline`` over a literal array.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import prettify_label, slug
from .insights import (category_counts, category_distribution, conflict_sample, conflict_summary, cube_of,
                       trend_status, value_distribution, weekly_trend)


def as_struct(one_row: DataFrame) -> Column:
    """A one-row frame as a struct-valued scalar subquery."""
    return one_row.select(F.struct(*one_row.columns).alias("s")).scalar()


def insight_kpis(v: DataFrame, trend: DataFrame) -> DataFrame:
    """One row: category percentages, conflict percentage and trend status
    (``v``: validated rows or their cube)."""
    cube = cube_of(v)
    names = {"Delivery": "delivery_pct", "App Bug": "app_pct", "Billing": "billing_pct", "Staff/Support": "support_pct"}
    cats = category_counts(cube).agg(*[F.max(F.when(F.col("ai_category") == c, F.col("percentage"))).alias(name)
                                       for c, name in names.items()])
    return cats.select(*names.values(), conflict_summary(cube).select("conflict_percentage").scalar().alias("conflict_pct"),
                       trend.select("status").scalar().alias("trend_status"))


def _rule(no: int, rule, fired: Column, value: Column | None = None) -> Column:
    title, impact, desc = rule
    text = F.format_string(desc, value.cast("string")) if value is not None else F.lit(desc)
    return F.struct(F.lit(no).alias("rule_no"), F.lit(title).alias("title"),
                    F.lit(impact).alias("impact"), text.alias("description"),
                    fired.alias("fired"))


def recommendations(kpis: DataFrame) -> DataFrame:
    """(priority, impact, title, description) sorted Critical, High, Medium, Low; stable."""
    c = F.col
    rules = [
        (K.REC_DELIVERY, c("delivery_pct") > K.REC_DELIVERY_OVER, c("delivery_pct")),
        (K.REC_APP, c("app_pct") > K.REC_APP_OVER, c("app_pct")),
        (K.REC_BILLING, c("billing_pct") > K.REC_BILLING_OVER, c("billing_pct")),
        (K.REC_SUPPORT, c("support_pct") > K.REC_SUPPORT_OVER, c("support_pct")),
        (K.REC_WORSENING, c("trend_status") == "Worsening", None),
        (K.REC_STABLE, c("trend_status") == "Stable", None),
        (K.REC_CONFLICT, c("conflict_pct") > K.REC_CONFLICT_OVER, c("conflict_pct")),
    ]
    fired = [F.coalesce(f, F.lit(False)) for _, f, _ in rules]
    none_fired = ~F.greatest(*fired) if len(fired) > 1 else ~fired[0]
    arr = [_rule(i + 1, r, f, val) for i, ((r, _, val), f) in enumerate(zip(rules, fired))]
    arr.append(_rule(len(rules) + 1, K.REC_GENERIC, none_fired))
    rows = kpis.select(F.inline(F.array(*arr))).filter("fired")
    rank = F.array_position(F.array(*[F.lit(i) for i in K.IMPACT_ORDER]), F.col("impact"))
    w = Window.orderBy(rank, F.col("rule_no"))      # at most 8 rows
    return rows.select(F.row_number().over(w).alias("priority"), "impact", "title", "description")


def spotlight(cat_counts: DataFrame) -> DataFrame:
    """Top three categories by count (ties: category order) with their template."""
    w = Window.orderBy(F.desc("count"), F.asc("_rank"))   # five rows
    titles = F.create_map(*[x for c, (t, _) in K.SPOTLIGHT.items() for x in (F.lit(c), F.lit(t))])
    recs = F.create_map(*[x for c, (_, r) in K.SPOTLIGHT.items() for x in (F.lit(c), F.lit(r))])
    top = cat_counts.withColumn("priority", F.row_number().over(w)).filter(
        F.col("priority") <= K.SPOTLIGHT_TOP)
    return top.select("priority", F.col("ai_category").alias("category"),
                      titles[F.col("ai_category")].alias("title"),
                      recs[F.col("ai_category")].alias("recommendation"), "percentage")


def top_category(cat_counts: DataFrame) -> DataFrame:
    """One row (top_category, top_category_pct): highest count, first in category order on ties."""
    best = F.min_by(F.struct("ai_category", "percentage"),
                    F.struct(-F.col("count"), F.col("_rank")))
    return cat_counts.agg(best.alias("b")).select(F.col("b.ai_category").alias("top_category"),
                                                  F.col("b.percentage").alias("top_category_pct"))


def most_negative_source(v: DataFrame) -> DataFrame:
    """One row: the source with the highest Negative share (ties: name ascending);
    'N/A' and 0.0 when no row has a source (``v``: validated rows or their cube)."""
    x = cube_of(v).filter((F.col("level") == "source_sentiment") & F.col("source").isNotNull() & F.col("ai_sentiment").isNotNull())
    g = x.groupBy("source").agg(F.sum("n").alias("_row"),
                                F.coalesce(F.sum(F.when(F.col("ai_sentiment") == "Negative", F.col("n"))), F.lit(0)).alias("_neg"))
    g = g.select("source", F.round(F.col("_neg") / F.col("_row") * 100.0, 2).alias("p"))
    best = F.min_by(F.struct("source", "p"), F.struct(-F.col("p"), F.col("source")))
    m = g.agg(best.alias("b"))
    return m.select(F.coalesce(F.col("b.source"), F.lit("N/A")).alias("most_negative_source"),
                    F.when(F.col("b.source").isNull(), F.lit("N/A"))
                     .otherwise(prettify_label(F.col("b.source"))).alias("most_negative_source_label"),
                    F.coalesce(F.col("b.p"), F.lit(0.0)).alias("most_negative_source_pct"))


def exec_kpis(audit: DataFrame, log: DataFrame, cube: DataFrame, metrics: DataFrame) -> DataFrame:
    """The executive KPI row, from one-row frames and the insight cube; no row of
    the validated table is read.  Each one-row input is attached once as a staged
    struct column (a scalar subquery evaluated once), then its fields are read."""
    base = cube.filter(F.col("level") == "all").agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("valid_complaints"), F.coalesce(F.max("corrected"), F.lit(0)).alias("_c"))
    base = base.withColumns({
        "_a": as_struct(audit), "_l": as_struct(log), "_m": as_struct(metrics),
        "_t": as_struct(top_category(category_counts(cube))), "_s": as_struct(most_negative_source(cube)),
        "_r": as_struct(trend_status(weekly_trend(cube)))})
    # The patterns were counted with the cleaning: rows kept less repeats of a pattern.
    base = base.withColumn("unique_patterns", F.col("_l").getField("total_cleaned_saved") - F.col("_l").getField("near_duplicate_rows"))
    a, lg, mt = F.col("_a"), F.col("_l"), F.col("_m")
    tc, ms, tr = F.col("_t"), F.col("_s"), F.col("_r")
    raw_n = a.getField("total_records")
    removed = lg.getField("empty_removed") + lg.getField("exact_duplicates_removed")
    rel = mt.getField("insight_reliability")
    return base.select(
        raw_n.alias("raw_records"), "valid_complaints", "unique_patterns",
        removed.alias("records_removed"),
        F.when(raw_n > 0, F.round(removed / raw_n * 100.0, 1)).otherwise(F.lit(0.0)).alias(
            "reduction_pct"),
        a.getField("health_score").alias("health_score"),
        rel.alias("insight_reliability"), slug(rel).alias("reliability_class"),
        tc.getField("top_category").alias("top_category"),
        tc.getField("top_category_pct").alias("top_category_pct"),
        ms.getField("most_negative_source").alias("most_negative_source"),
        ms.getField("most_negative_source_label").alias("most_negative_source_label"),
        ms.getField("most_negative_source_pct").alias("most_negative_source_pct"),
        tr.getField("status").alias("trend_status"), tr.getField("reason").alias("trend_reason"),
        F.round(mt.getField("average_confidence") * 100.0, 1).alias("avg_confidence_pct"),
        F.col("_c").alias("corrections_applied"),
        (a.getField("contradiction_count") > 0).alias("contradiction_alert"),
        (rel == K.LIMITED).alias("limited_quality_notice"),
        (mt.getField("low_confidence_count") > 0).alias("review_queue_pending"))


def audit_actions(audit: DataFrame, log: DataFrame) -> DataFrame:
    """Six audit issues with their count and the action taken."""
    lg = as_struct(log)
    rows = []
    for i, (issue, count_col, log_col, action) in enumerate(K.AUDIT_ACTIONS):
        text = (F.format_string(action, lg.getField(log_col).cast("string")) if log_col
                else F.lit(action))
        rows.append(F.struct(F.lit(i + 1).alias("row_no"), F.lit(issue).alias("issue"),
                             F.col(count_col).alias("count"), text.alias("action")))
    return audit.select(F.inline(F.array(*rows)))


def _collect(df: DataFrame, order: list[str], cols: list[str]) -> Column:
    """Small frame -> ordered array of structs (scalar subquery)."""
    s = F.struct(*[F.col(c) for c in order], F.struct(*cols).alias("v"))
    arr = df.agg(F.array_sort(F.collect_list(s)).alias("a")).select(
        F.transform("a", lambda e: e.getField("v")).alias("a"))
    return arr.scalar()


def report_sections(audit: DataFrame, log: DataFrame, v: DataFrame, cube: DataFrame, metrics: DataFrame,
                    recs: DataFrame) -> DataFrame:
    """(section, position, payload): the report as JSON lines.  Sections that hold
    one document, and lists with one row an element; ``position`` orders a list
    (null where the order has no meaning: a source is one row of its own, so any
    number of sources is written side by side)."""
    weekly = weekly_trend(cube)
    week_no = F.datediff(F.to_date("week_end"), F.lit("1970-01-04").cast("date")) / 7
    parts = [
        ("audit_results", audit, None, audit.columns),
        ("cleaning_log", log, None, log.columns),
        ("validation_metrics", metrics, None, metrics.columns),
        ("category", category_distribution(v, cube), F.col("_rank"), ["ai_category", "count", "percentage", "examples"]),
        ("sentiment", value_distribution(cube, "ai_sentiment"), None, ["ai_sentiment", "count", "percentage"]),
        ("source", value_distribution(cube, "source"), None, ["source", "count", "percentage"]),
        ("conflicts", conflict_summary(cube), None, ["conflict_count", "conflict_percentage"]),
        ("conflicts_sample", conflict_sample(v, with_seq=True), F.col("seq"), ["id", "rating", "ai_sentiment", "feedback_text"]),
        ("trend", trend_status(weekly), None, ["status", "reason"]),
        ("weekly_data", weekly, week_no, ["week_end", "total_complaints", "negative_sentiment_percentage"]),
        ("recommendations", recs, F.col("priority"), ["title", "impact", "description"]),
    ]
    out = None
    for name, df, position, cols in parts:
        pos = (F.lit(None) if position is None else position).cast("bigint")
        part = df.select(F.lit(name).alias("section"), pos.alias("position"), F.to_json(F.struct(*cols)).alias("payload"))
        out = part if out is None else out.unionByName(part)
    return out


def report_payload(audit: DataFrame, log: DataFrame, v: DataFrame, metrics: DataFrame,
                   recs: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """One row, one column ``payload``: the whole report as one JSON document (for
    a page; all sources are in it, so prefer ``report_sections`` for many sources)."""
    cube = cube_of(v) if cube is None else cube
    cats = category_distribution(v, cube)
    weekly = weekly_trend(cube)
    trend = trend_status(weekly)
    sent = value_distribution(cube, "ai_sentiment")
    src = value_distribution(cube, "source")
    conf = conflict_summary(cube)
    carrier = metrics.withColumns({"_conf": as_struct(conf), "_trend": as_struct(trend)})
    doc = F.struct(
        as_struct(audit).alias("audit_results"),
        as_struct(log).alias("cleaning_log"),
        F.struct(*[F.col(c) for c in metrics.columns]).alias("validation_metrics"),
        F.struct(
            _collect(cats, ["_rank"], ["ai_category", "count", "percentage", "examples"]
                     ).alias("category"),
            _collect(sent, ["ai_sentiment"], ["ai_sentiment", "count", "percentage"]).alias("sentiment"),
            _collect(src, ["source"], ["source", "count", "percentage"]).alias("source"),
        ).alias("distributions"),
        F.struct(
            F.col("_conf").getField("conflict_count").alias("conflict_count"),
            F.col("_conf").getField("conflict_percentage").alias("conflict_percentage"),
            _collect(conflict_sample(v, with_seq=True),
                     ["seq"], ["id", "rating", "ai_sentiment", "feedback_text"]
                     ).alias("conflicts_sample"),
        ).alias("conflicts"),
        F.struct(F.col("_trend").getField("status").alias("status"),
                 F.col("_trend").getField("reason").alias("reason"),
                 _collect(weekly, ["week_end"], ["week_end", "total_complaints",
                                                 "negative_sentiment_percentage"]
                          ).alias("weekly_data")).alias("trends"),
        _collect(recs, ["priority"], ["title", "impact", "description"]).alias("recommendations"),
    )
    return carrier.select(F.to_json(doc).alias("payload"))
