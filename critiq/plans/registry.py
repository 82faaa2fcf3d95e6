"""Query registry: one entry per operator of the inventory.

Every query reads the driver tables (``events`` through the ``feedback_raw``
and ``labels_dirty`` views, or ``documents`` directly) and runs on all of
their rows.  Each entry pairs the Spark plan with an independent DuckDB SQL
oracle (``None`` where the operator writes and reads files, which the oracle
cannot mirror; those get a row-count check).
"""
from __future__ import annotations

import os
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import unwrap
from ..functions import (clean_text, contradicts, impute_rating, is_invalid_timestamp,
                         is_meaningless, is_missing_timestamp, is_multilingual, iso_date,
                         mentions_agent, mentions_order_number, normalize_text, parse_rating,
                         summary_line, week_end)
from ..operators import (audit, batch_assign, classify_patterns, merge_responses,
                         response_results, validate)
from ..operators.digest import duplicate_counts
from ..operators.classify import (best_category, category_scores, classify_frame,
                                  lowered, sentiment_scores)
from ..operators.insights import category_examples
from ..sources import dense_rank_by, null_tokens, read_csv_checked, read_feedback, write_sections, write_table
from ..session import scratch_path
from . import fixtures as fx
from . import oracle as O
from .flow import Analysis, analyse

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _an(spark: SparkSession, sf: str, many: bool = False) -> Analysis:
    """The flow over the fixture, with its shared frames written once as tables
    in the checkpoint folder (see ``plans.flow``).  ``many``: the query combines
    several results, so the validated table is written once as well."""
    return analyse(fx.feedback_raw(spark, sf), materialize="table", keep_validated=many)


def _fb(spark, sf):
    return fx.feedback_raw(spark, sf)


def _docs(spark, sf):
    return fx.documents(spark, sf)


def _texts(spark, sf):
    """Fixture rows with the cleaned text (pure-function checks)."""
    fb = _fb(spark, sf)
    return fb.withColumn("text", clean_text(F.col("feedback_text")))


def _first_per_id(spark, sf):
    """One feedback row per id (the first in file order): text and raw rating."""
    fb = _fb(spark, sf)
    first = F.min_by(F.struct("feedback_text", "rating"), F.col("seq"))
    return fb.groupBy("id").agg(first.alias("f")).select(
        "id", F.col("f.feedback_text").alias("feedback_text"), F.col("f.rating").alias("rating"))


def _labelled(spark, sf):
    """labels_dirty with the text of its record."""
    return fx.labels_dirty(spark, sf).join(_first_per_id(spark, sf).select("id", "feedback_text"),
                                           "id", "left")


def _drop_seq(df: DataFrame) -> DataFrame:
    return df.drop("seq")


# ---------------------------------------------------------------------------
# SQL building blocks
# ---------------------------------------------------------------------------
FB = O.with_(O.fb_cte())
PIPE = O.with_(O.fb_cte(), O.pipeline_ctes())
AUD = O.with_(O.fb_cte(), O.audit_ctes())
FIRST = (", firsts as (select id, arg_min(feedback_text, seq) as feedback_text, "
         "arg_min(rating, seq) as rating from fb group by id)")
LAB = O.with_(O.fb_cte(), ", " + O.labels_cte(), FIRST,
              ", labtext as (select l.*, f.feedback_text from lab l left join firsts f using (id))")
INS = O.with_(O.fb_cte(), O.pipeline_ctes(), O.insight_ctes())


def _vcorr_sql(orig: str, text: str | None) -> tuple[str, str]:
    """(sentiment fix, category fix) SQL for labels."""
    s = f"coalesce({O.strip(f'lower({orig}_s)')}, 'none')"
    sfix = (f"case when coalesce({orig}_s in ('Positive','Neutral','Negative'), false) then {orig}_s "
            f"when {O.any_of(s, K.SENTIMENT_NEGATIVE_HINTS)} then 'Negative' "
            f"when {O.any_of(s, K.SENTIMENT_POSITIVE_HINTS)} then 'Positive' else 'Neutral' end")
    c = f"coalesce({O.strip(f'lower({orig}_c)')}, 'none')"
    t = f"lower(coalesce({text}, 'None'))"
    arms = " ".join(f"when contains({c}, {O.q(k)}) then {O.q(v)}" for k, v in K.CATEGORY_FALLBACK)
    arms += " " + " ".join(f"when {O.any_of(t, kws)} then {O.q(cat)}"
                           for cat, kws in K.CATEGORY_KEYWORDS.items())
    cats = ", ".join(O.q(x) for x in K.CATEGORIES)
    cfix = (f"case when coalesce({orig}_c in ({cats}), false) then {orig}_c {arms} else 'Other' end")
    return sfix, cfix


_SFIX, _CFIX = _vcorr_sql("ai", "feedback_text")
_LABV = (LAB.replace("labtext as (select l.*, f.feedback_text",
                     "labtext as (select l.*, f.feedback_text") +
         ", labv as (select *, " + _SFIX.replace("ai_s", "ai_sentiment") + " as s_fix, " +
         _CFIX.replace("ai_c", "ai_category") + " as c_fix from labtext)")


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------
@register("na_tokens", FB + " select seq, id, " + ", ".join(
    f"case when {c} in ({', '.join(O.q(t) for t in K.NA_TOKENS)}) then null else {c} end as {c}"
    for c in ["timestamp", "source", "rating", "feedback_text"]) + " from fb")
def q_na_tokens(spark, sf):
    return null_tokens(_fb(spark, sf))


@register("surrogate_id", FB + " select seq, row_number() over (order by seq) as surrogate_id from fb")
def q_surrogate_id(spark, sf):
    r = dense_rank_by(_fb(spark, sf).select("seq"), "seq", "_r")
    return r.select("seq", (F.col("_r") + 1).alias("surrogate_id"))


@register("scan_csv", FB + " select cast(row_number() over (order by seq) - 1 as bigint) as seq, " + ", ".join(
    f"case when {c} in ({', '.join(O.q(t) for t in K.NA_TOKENS)}) then null else {c} end as {c}"
    for c in ["timestamp", "source", "rating", "feedback_text"]) + " from fb")
def q_scan_csv(spark, sf):
    """Write the raw fixture as CSV (no id column) in file order, read it back."""
    path = scratch_path(spark, f"scan_csv/{uuid.uuid4().hex}")
    raw = _fb(spark, sf).repartitionByRange("seq").sortWithinPartitions("seq").drop("seq", "id")
    write_table(raw, path, "csv")
    back = read_feedback(spark, path, "csv")
    return back.select("seq", "timestamp", "source", "rating", "feedback_text")


_CSV_FIELDS = ["id", "timestamp", "source", "rating", "feedback_text"]


@register("scan_csv_checked", FB + ", r as (select id, feedback_text, case id % 40 when 0 then 'short' when 1 then 'long' when 2 then 'quoted' "
          "when 3 then 'quoted' end as kind from fb) select cast(id as varchar) as id, kind, case when kind is null and feedback_text not in ("
          + ", ".join(O.q(t) for t in K.NA_TOKENS) + ") then feedback_text end as feedback_text from r")
def q_scan_csv_checked(spark, sf):
    """The fixture as CSV lines, some cut short, too long or badly quoted, in four
    files; the good records and those set aside."""
    path = scratch_path(spark, f"scan_checked/{uuid.uuid4().hex}")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    kind, fields = F.col("id") % 40, [quoted(c) for c in _CSV_FIELDS]
    line = (F.when(kind == 0, F.concat_ws(",", *fields[:-1])).when(kind == 1, F.concat_ws(",", *fields, F.lit("more")))
             .when(kind == 2, F.concat_ws(",", *fields[:-1], F.lit('"open'))).when(kind == 3, F.concat_ws(",", *fields[:-1], F.concat(fields[-1], F.lit(" tail"))))
             .otherwise(F.concat_ws(",", *fields)))
    lines = _fb(spark, sf).select((F.col("id") % 4).alias("part"), F.col("seq").alias("o"), line.alias("value"))
    heads = spark.range(4).select(F.col("id").alias("part"), F.lit(-1).cast("long").alias("o"), F.lit(",".join(_CSV_FIELDS)).alias("value"))
    lines.unionAll(heads).repartition("part").sortWithinPartitions("part", "o").select("part", "value").write.partitionBy("part").text(path)
    rows, malformed = read_csv_checked(spark, os.path.join(path, "*"))
    # The id is the first field of every line here.
    bad = malformed.select(F.regexp_extract("record", r'^"(\d+)"', 1).alias("id"), "kind", F.lit(None).cast("string").alias("feedback_text"))
    return rows.select("id", F.lit(None).cast("string").alias("kind"), "feedback_text").unionAll(bad)


@register("export_enriched", PIPE + " select * exclude (seq) from validated")
def q_export_enriched(spark, sf):
    """Write the validated table as CSV and read it back."""
    path = scratch_path(spark, f"export/{uuid.uuid4().hex}")
    from ..sources import write_enriched
    rows = _an(spark, sf).validated
    write_enriched(rows, path)
    return spark.read.option("header", True).option("escape", '"').schema(_drop_seq(rows).schema).csv(path)


_CHANNELS = ["app_store", "google_play", "web", "support", "unknown"]


def _stream_sql() -> str:
    keep = lambda c: f"case when {c} in ({', '.join(O.q(t) for t in K.NA_TOKENS)}) then null else {c} end as {c}"
    ctes = f", fbn as (select seq, id, {', '.join(keep(c) for c in _CSV_FIELDS[1:])}, coalesce(source, 'unknown') as channel from fb)"
    for ch in _CHANNELS:
        ctes += f", fb_{ch} as (select * from fbn where channel = {O.q(ch)})" + O.audit_ctes(f"fb_{ch}", f"aud_{ch}")
    return O.with_(O.fb_cte(), ctes) + " union all ".join(
        f" select {O.q(ch)} as channel, * from aud_{ch} where exists (select 1 from fb_{ch})" for ch in _CHANNELS)


@register("stream_intake", _stream_sql())
def q_stream_intake(spark, sf):
    """The fixture written as one CSV file per source channel (every row lands in
    exactly one file), streamed through the intake: one audit row per file."""
    from ..streaming import start_intake
    run = scratch_path(spark, f"stream/{uuid.uuid4().hex}")
    src, sink = os.path.join(run, "in"), os.path.join(run, "out")
    raw = _fb(spark, sf).withColumn("_ch", F.coalesce("source", F.lit("unknown")))
    (raw.repartition("_ch").sortWithinPartitions("seq").drop("seq")
        .write.partitionBy("_ch").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(src))
    q = start_intake(spark, os.path.join(src, "*"), sink, outputs=["audit"])
    q.awaitTermination()
    audits = spark.read.parquet(os.path.join(sink, "audit")).drop("batch_id")
    return audits.withColumn("channel", F.regexp_extract("source_file", "_ch=([^/]+)/", 1)).drop("source_file")


@register("report_payload", None)
def q_report_payload(spark, sf):
    return _an(spark, sf, many=True).report_payload


# ---------------------------------------------------------------------------
# Predicates and scalar functions (per fixture row)
# ---------------------------------------------------------------------------
@register("pred_meaningless", FB + f" select seq, {O.meaningless('feedback_text')} as meaningless from fb")
def q_pred_meaningless(spark, sf):
    return _fb(spark, sf).select("seq", is_meaningless(F.col("feedback_text")).alias("meaningless"))


@register("drop_meaningless", FB + f" select * from fb where not {O.meaningless('feedback_text')}")
def q_drop_meaningless(spark, sf):
    return _fb(spark, sf).filter(~is_meaningless(F.col("feedback_text")))


@register("pred_invalid_ts", FB + f" select seq, {O.missing_ts('timestamp')} as missing_timestamp, "
          f"{O.invalid_ts('timestamp')} as invalid_timestamp from fb")
def q_pred_invalid_ts(spark, sf):
    ts = F.col("timestamp")
    x = _fb(spark, sf).withColumn("_v", unwrap(ts))
    return x.select("seq", is_missing_timestamp(ts).alias("missing_timestamp"),
                    is_invalid_timestamp(ts, "_v").alias("invalid_timestamp"))


@register("parse_date", FB + f" select seq, timestamp, {O.iso_date('timestamp')} as parsed_date from fb")
def q_parse_date(spark, sf):
    x = _fb(spark, sf).withColumn("_v", unwrap(F.col("timestamp")))
    return x.select("seq", "timestamp", iso_date("_v", unwrapped=True).alias("parsed_date"))


@register("contradictions", FB + f" select seq, {O.contradicts('rating', 'feedback_text')} as contradiction from fb")
def q_contradictions(spark, sf):
    return _fb(spark, sf).select("seq", contradicts(F.col("rating"), F.col("feedback_text")).alias(
        "contradiction"))


@register("agent_mentions", FB + f" select seq, {O.agent('feedback_text')} as agent_mention from fb")
def q_agent_mentions(spark, sf):
    return _fb(spark, sf).select("seq", mentions_agent(F.col("feedback_text")).alias("agent_mention"))


@register("order_mentions", FB + f" select seq, {O.order_no('feedback_text')} as order_mention from fb")
def q_order_mentions(spark, sf):
    return _fb(spark, sf).select("seq", mentions_order_number(F.col("feedback_text")).alias(
        "order_mention"))


@register("multilingual", FB + f" select seq, {O.multilingual('feedback_text')} as multilingual from fb")
def q_multilingual(spark, sf):
    return _fb(spark, sf).select("seq", is_multilingual(F.col("feedback_text")).alias("multilingual"))


@register("clean_text", FB + f" select seq, {O.clean_text('feedback_text')} as clean_text from fb")
def q_clean_text(spark, sf):
    return _fb(spark, sf).select("seq", clean_text(F.col("feedback_text")).alias("clean_text"))


@register("normalize_text", FB + f" select seq, {O.normalize(O.clean_text('feedback_text'))} "
          "as normalized_text from fb")
def q_normalize_text(spark, sf):
    x = _texts(spark, sf)
    return x.select("seq", normalize_text(F.col("text")).alias("normalized_text"))


@register("rating_parse", FB + f" select seq, rating, {O.rating('rating')} as rating_value from fb")
def q_rating_parse(spark, sf):
    return _fb(spark, sf).select("seq", "rating", parse_rating(F.col("rating")).alias("rating_value"))


@register("impute_rating", FB + f" select seq, {O.impute('rating', O.clean_text('feedback_text'))} "
          "as rating_imputed from fb")
def q_impute_rating(spark, sf):
    x = _texts(spark, sf)
    return x.select("seq", impute_rating(F.col("rating"), F.col("text")).alias("rating_imputed"))


@register("summary_line", FB + f" select seq, {O.summary(O.clean_text('feedback_text'))} as summary from fb")
def q_summary_line(spark, sf):
    return _texts(spark, sf).select("seq", summary_line(F.col("text")).alias("summary"))


@register("week_end", "select event_id, strftime(cast(date_trunc('week', cast(ts as date)) as date) + 6, "
          "'%Y-%m-%d') as week_end from events")
def q_week_end(spark, sf):
    ev = fx.events(spark, sf)
    return ev.select("event_id", F.date_format(week_end(F.to_date("ts")), "yyyy-MM-dd").alias(
        "week_end"))


# ---------------------------------------------------------------------------
# Classifier (per fixture row; text = cleaned text, rating = raw rating)
# ---------------------------------------------------------------------------
_SCORED = FB + ", t as (select seq, " + O.clean_text("feedback_text") + " as text, rating from fb)" + \
    ", s as (" + O.with_scores("t", "text", "rating", "seq, text") + ")"


@register("category_scores", _SCORED + ' select seq, "_s_Billing" as billing, "_s_App Bug" as app_bug, '
          '"_s_Delivery" as delivery, "_s_Staff/Support" as staff_support from s')
def q_category_scores(spark, sf):
    x = _texts(spark, sf).withColumn("_low", lowered(F.col("text")))
    sc = category_scores(F.col("text"), F.col("_low"))
    return x.select("seq", sc["Billing"].alias("billing"), sc["App Bug"].alias("app_bug"),
                    sc["Delivery"].alias("delivery"), sc["Staff/Support"].alias("staff_support"))


@register("classify_category", _SCORED + f" select seq, {O.best_category()} as category from s")
def q_classify_category(spark, sf):
    x = _texts(spark, sf).withColumn("_low", lowered(F.col("text")))
    x = x.select("seq", *[v.alias(f"_c{i}") for i, v in enumerate(
        category_scores(F.col("text"), F.col("_low")).values())])
    names = list(K.CATEGORY_KEYWORDS)
    return x.select("seq", best_category({n: F.col(f"_c{i}") for i, n in enumerate(names)}).alias(
        "category"))


@register("sentiment_scores", _SCORED + " select seq, _pos as positive_hits, _neg as negative_hits from s")
def q_sentiment_scores(spark, sf):
    x = _texts(spark, sf).withColumn("_low", lowered(F.col("text")))
    pos, neg = sentiment_scores(F.col("text"), F.col("_low"))
    return x.select("seq", pos.alias("positive_hits"), neg.alias("negative_hits"))


@register("classify_sentiment", _SCORED + f" select seq, {O.sentiment()} as sentiment from s")
def q_classify_sentiment(spark, sf):
    c = classify_frame(_texts(spark, sf), "text", "rating", "_c")
    return c.select("seq", F.col("_c.sentiment").alias("sentiment"))


@register("classify_confidence", _SCORED + f" select seq, {O.confidence(O.sentiment())} as confidence from s")
def q_classify_confidence(spark, sf):
    c = classify_frame(_texts(spark, sf), "text", "rating", "_c")
    return c.select("seq", F.col("_c.confidence").alias("confidence"))


# ---------------------------------------------------------------------------
# Audit
# ---------------------------------------------------------------------------
@register("audit", AUD + " select * from aud")
def q_audit(spark, sf):
    return _an(spark, sf).audit


@register("health_score", AUD + " select total_records, deductions, health_score from aud")
def q_health_score(spark, sf):
    """``deductions`` is the score before it is clamped."""
    return _an(spark, sf).audit.select("total_records", "deductions", "health_score")


_DOC_COLS = "text, lang, source, n_chars"


@register("duplicate_rows", f"select cast(sum(n) as bigint) as total_rows, cast(sum(n - 1) as bigint) "
          f"as duplicate_rows from (select count(*) as n from documents group by {_DOC_COLS})")
def q_duplicate_rows(spark, sf):
    return duplicate_counts(_docs(spark, sf), ["text", "lang", "source", "n_chars"])


@register("duplicate_text", "select cast(sum(n) as bigint) as total_rows, cast(sum(n - 1) as bigint) "
          "as duplicate_rows from (select count(*) as n from documents group by text)")
def q_duplicate_text(spark, sf):
    return duplicate_counts(_docs(spark, sf), ["text"])


@register("audit_documents", O.with_(
    "dsrc as (select doc_id as seq, cast(null as varchar) as timestamp, source, "
    "cast(null as varchar) as rating, text as feedback_text, lang from documents)",
    O.audit_ctes("dsrc", "aud", "timestamp, source, rating, feedback_text, lang")) + " select * from aud")
def q_audit_documents(spark, sf):
    d = _docs(spark, sf).select(F.col("doc_id").alias("seq"), F.lit(None).cast("string").alias("timestamp"),
                                "source", F.lit(None).cast("string").alias("rating"),
                                F.col("text").alias("feedback_text"), "lang")
    return audit(d)


# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------
@register("fill_dates", PIPE + " select seq, timestamp from filled")
def q_fill_dates(spark, sf):
    from ..session import materialize
    from ..operators.clean import fill_and_impute, prepare_rows
    prepared = materialize(prepare_rows(_fb(spark, sf)), "table")
    return fill_and_impute(prepared).select("seq", "timestamp")


@register("drop_duplicates", PIPE + " select seq, id, timestamp, source, rating, feedback_text from dedup")
def q_drop_duplicates(spark, sf):
    return _an(spark, sf).cleaned.rows.select("seq", "id", "timestamp", "source", "rating",
                                              "feedback_text")


@register("cleaning_log", PIPE + O.log_ctes() + " select * from clog")
def q_cleaning_log(spark, sf):
    return _an(spark, sf).cleaning_log


@register("complaint_count", PIPE + " select * exclude (seq) from cleaned")
def q_complaint_count(spark, sf):
    return _drop_seq(_an(spark, sf).cleaned.table)


@register("first_of_pattern", PIPE + " select * from patterns")
def q_first_of_pattern(spark, sf):
    return _an(spark, sf).cleaned.patterns


@register("doc_patterns", f"select {O.normalize(O.clean_text('text'))} as normalized_text, "
          "cast(count(*) as bigint) as complaint_count from documents group by 1")
def q_doc_patterns(spark, sf):
    d = _docs(spark, sf).select(normalize_text(clean_text(F.col("text"))).alias("normalized_text"))
    return d.groupBy("normalized_text").agg(F.count(F.lit(1)).alias("complaint_count"))


# ---------------------------------------------------------------------------
# Enrichment
# ---------------------------------------------------------------------------
@register("pattern_classify", PIPE + " select normalized_text, c_sentiment as ai_sentiment, "
          "c_category as ai_category, c_summary as ai_summary, c_confidence as ai_confidence from pclass")
def q_pattern_classify(spark, sf):
    p = classify_patterns(_an(spark, sf).cleaned.patterns)
    return p.select("normalized_text", "ai_sentiment", "ai_category", "ai_summary", "ai_confidence")


def _echo_batches(frames):
    """A plug-in with known answers: tells each pattern's batch, leaves every
    fifth pattern of a batch unanswered."""
    for f in frames:
        out = f[["normalized_text"]].copy()
        out["sentiment"], out["category"] = "Neutral", "Other"
        out["summary"], out["confidence"] = f["batch_id"].astype(str), 0.5
        yield out[out.index % 5 != 4]


@register("plugin_classify", PIPE + ", pos as (select normalized_text, row_number() over (order by first_seq) - 1 as p from pclass) "
          "select c.normalized_text, case when p % 20 % 5 = 4 then c_sentiment else 'Neutral' end as ai_sentiment, "
          "case when p % 20 % 5 = 4 then c_category else 'Other' end as ai_category, "
          "case when p % 20 % 5 = 4 then c_summary else cast(p // 20 as varchar) end as ai_summary, "
          "case when p % 20 % 5 = 4 then c_confidence else 0.5 end as ai_confidence from pclass c join pos using (normalized_text)")
def q_plugin_classify(spark, sf):
    p = classify_patterns(_an(spark, sf).cleaned.patterns, _echo_batches)
    return p.select("normalized_text", "ai_sentiment", "ai_category", "ai_summary", "ai_confidence")


def _flaky_batches(frames):
    """As ``_echo_batches``, but every third batch raises."""
    for f in frames:
        if f["batch_id"].iloc[0] % 3 == 1:
            raise RuntimeError("no answer")
        yield from _echo_batches([f])


@register("plugin_accounting", PIPE + ", pos as (select row_number() over (order by first_seq) - 1 as p from patterns) "
          "select cast(p // 20 as bigint) as batch_id, cast(count(*) as bigint) as asked, "
          "cast(case when p // 20 % 3 = 1 then 0 else count(*) filter (where p % 20 % 5 <> 4) end as bigint) as answered, "
          "case when p // 20 % 3 = 1 then 'failed' else 'answered' end as status, "
          "case when p // 20 % 3 = 1 then 'RuntimeError: no answer' end as error from pos group by p // 20")
def q_plugin_accounting(spark, sf):
    return analyse(fx.feedback_raw(spark, sf), classifier=_flaky_batches, materialize="table").classifier_batches


@register("enrich_rows", PIPE + " select * exclude (seq) from enriched")
def q_enrich_rows(spark, sf):
    return _drop_seq(_an(spark, sf).enriched)


@register("batch_assign", PIPE + " select normalized_text, first_seq, (row_number() over (order by first_seq) - 1) // "
          f"{K.CLASSIFIER_BATCH_SIZE} as batch_id, (row_number() over (order by first_seq) - 1) % "
          f"{K.CLASSIFIER_BATCH_SIZE} as batch_pos from patterns")
def q_batch_assign(spark, sf):
    p = _an(spark, sf).cleaned.patterns.select("normalized_text", "first_seq")
    return batch_assign(p, "first_seq")


# ---------------------------------------------------------------------------
# Validation
# ---------------------------------------------------------------------------
@register("validated", PIPE + " select * exclude (seq) from validated")
def q_validated(spark, sf):
    return _drop_seq(_an(spark, sf).validated)


@register("review_queue", PIPE + " select id, feedback_text, rating, ai_sentiment, ai_category, "
          "ai_confidence, complaint_count from validated where needs_human_review")
def q_review_queue(spark, sf):
    return _an(spark, sf).review_queue


_VM = (", vm as (select round(coalesce(avg(ai_confidence), 1.0), 4) as average_confidence, "
       "cast(count(*) filter (where ai_confidence < 0.7) as bigint) as low_confidence_count, "
       "case when count(*) > 0 then round(count(*) filter (where ai_confidence < 0.7) / count(*) * 100.0, 2) "
       "else 0.0 end as low_confidence_percentage, "
       "case when (select health_score from aud) >= 80 and coalesce(avg(ai_confidence), 1.0) >= 0.85 then 'High' "
       "when (select health_score from aud) < 60 or coalesce(avg(ai_confidence), 1.0) < 0.7 "
       f"then {O.q(K.LIMITED)} else 'Medium' end as insight_reliability from enriched)")


@register("validation_metrics", O.with_(O.fb_cte(), O.pipeline_ctes(), O.audit_ctes(), _VM) +
          " select * from vm")
def q_validation_metrics(spark, sf):
    return _an(spark, sf).metrics


@register("reliability", O.with_(O.fb_cte(), O.pipeline_ctes(), O.audit_ctes(), _VM) +
          " select (select health_score from aud) as health_score, average_confidence, "
          "insight_reliability from vm")
def q_reliability(spark, sf):
    an = _an(spark, sf)
    h = an.audit.select("health_score").scalar()
    return an.metrics.select(h.alias("health_score"), "average_confidence", "insight_reliability")


@register("validate_sentiment", _LABV + " select id, ai_sentiment as original_value, s_fix as corrected_value "
          "from labv")
def q_validate_sentiment(spark, sf):
    v = validate(_labelled(spark, sf)).table
    orig = fx.labels_dirty(spark, sf).select("id", F.col("ai_sentiment").alias("original_value"))
    return orig.join(v.select("id", F.col("ai_sentiment").alias("corrected_value")), "id")


@register("validate_category", _LABV + " select id, ai_category as original_value, c_fix as corrected_value "
          "from labv")
def q_validate_category(spark, sf):
    v = validate(_labelled(spark, sf)).table
    orig = fx.labels_dirty(spark, sf).select("id", F.col("ai_category").alias("original_value"))
    return orig.join(v.select("id", F.col("ai_category").alias("corrected_value")), "id")


@register("corrections_log", _LABV + """ select * from (
  select id as record_id, 'sentiment' as field, ai_sentiment as original_value, s_fix as corrected_value,
    format('Value ''{}'' mapped to standard sentiment ''{}''', coalesce(ai_sentiment, 'None'), s_fix) as reason
  from labv where not coalesce(ai_sentiment in ('Positive','Neutral','Negative'), false)
  union all
  select id, 'category', ai_category, c_fix,
    format('Value ''{}'' mapped to standard category ''{}''', coalesce(ai_category, 'None'), c_fix)
  from labv where not coalesce(ai_category in ('Billing','App Bug','Delivery','Staff/Support','Other'), false))""")
def q_corrections_log(spark, sf):
    return validate(_labelled(spark, sf)).corrections


# ---------------------------------------------------------------------------
# Classifier responses
# ---------------------------------------------------------------------------
_RESP_SCHEMA = ('{"results": [{"id": "BIGINT", "sentiment": "VARCHAR", "category": "VARCHAR", '
                '"summary": "VARCHAR", "confidence": "DOUBLE"}]}')
_BODY = ("trim(case when ends_with(b1, '```') then left(b1, length(b1) - 3) else b1 end)")
_RESP = LAB + f""", rb as (select id as batch_id, case when starts_with(response, '```json') then substr(response, 8)
   else response end as b1 from lab),
rp as (select batch_id, {_BODY} as body from rb),
rv as (select batch_id, case when starts_with(body, '{{') and json_valid(body)
   then coalesce(from_json(body, '{_RESP_SCHEMA}').results, []) end as arr from rp),
items as (select batch_id, unnest(arr) as e, generate_subscripts(arr, 1) as pos from rv where arr is not null),
answers as (select batch_id, e.id as id, arg_max(e, pos) as e from items where e.id is not null group by all),
resp as (select batch_id, id, e.sentiment as sentiment, e.category as category, e.summary as summary,
   e.confidence as confidence from answers)"""


@register("response_parse", _RESP + " select * from resp")
def q_response_parse(spark, sf):
    lab = fx.labels_dirty(spark, sf).select(F.col("id").alias("batch_id"), "response")
    return response_results(lab)


def _merge_sql(mode: str, breaker: bool) -> str:
    failed_label = "single_failed" if mode == "single" else "failed"
    skip = ("r.batch_id > (select min(batch_id) from rv where arr is null)" if breaker else "false")
    return _RESP + f""", rec as (select f.id as batch_id, f.id, coalesce(f.feedback_text, '') as text,
   f.rating from firsts f),
m as (select rec.*, rv.arr, resp.sentiment, resp.category, resp.summary, resp.confidence,
   resp.id is not null as hit, case when coalesce({skip.replace('r.batch_id', 'rec.batch_id')}, false)
   then 'skipped' when rv.arr is null then '{failed_label}' when resp.id is not null then 'answered'
   else 'missing' end as status
   from rec left join rv using (batch_id) left join resp using (batch_id, id)),
c as ({O.classified('m', 'text', 'rating')})
select batch_id, id, status,
  case when status = 'answered' then coalesce(sentiment, 'Neutral') else c_sentiment end as ai_sentiment,
  case when status = 'answered' then coalesce(category, 'Other') else c_category end as ai_category,
  case when status = 'answered' then coalesce(summary, left(text, 50)) else c_summary end as ai_summary,
  cast(case when status = 'answered' then coalesce(confidence, 0.8)
       when status = 'single_failed' then least(c_confidence, 0.6) else c_confidence end as double)
   as ai_confidence from c"""


def _records_and_responses(spark, sf):
    rec = _first_per_id(spark, sf).withColumn("batch_id", F.col("id"))
    resp = fx.labels_dirty(spark, sf).select(F.col("id").alias("batch_id"), "response")
    return rec, resp


@register("response_merge", _merge_sql("batch", False))
def q_response_merge(spark, sf):
    rec, resp = _records_and_responses(spark, sf)
    return merge_responses(rec, resp)


@register("fallback_penalty", _merge_sql("single", True))
def q_fallback_penalty(spark, sf):
    rec, resp = _records_and_responses(spark, sf)
    return merge_responses(rec, resp, mode="single", breaker=True)


# ---------------------------------------------------------------------------
# Insights
# ---------------------------------------------------------------------------
@register("dist_category", INS + " select ai_category, count, percentage from catcnt")
def q_dist_category(spark, sf):
    return _an(spark, sf).category_counts.select("ai_category", "count", "percentage")


@register("category_examples", INS + " select ai_category, cast(rn as integer) as example_rank, feedback_text from ("
          "select ai_category, feedback_text, row_number() over (partition by ai_category "
          "order by ai_confidence desc, seq asc) as rn from validated) where rn <= 3")
def q_category_examples(spark, sf):
    v = _an(spark, sf).validated
    ex = category_examples(v)
    return ex.select("ai_category", F.posexplode("examples").alias("_p", "feedback_text")).select(
        "ai_category", (F.col("_p") + 1).cast("int").alias("example_rank"), "feedback_text")


def _dist_sql(col: str) -> str:
    return INS + (f" select {col}, cast(count(*) as bigint) as count, "
                  f"round(count(*) / (select count(*) from validated) * 100.0, 2) as percentage "
                  f"from validated where {col} is not null group by {col}")


@register("dist_sentiment", _dist_sql("ai_sentiment"))
def q_dist_sentiment(spark, sf):
    return _an(spark, sf).sentiment_distribution


@register("dist_source", _dist_sql("source"))
def q_dist_source(spark, sf):
    return _an(spark, sf).source_distribution


def _xtab_sql(col: str) -> str:
    return INS + f""", x as (select source, {col}, count(*) as n, sum(count(*)) over (partition by source) as rowtot
  from validated where source is not null and {col} is not null group by source, {col}),
srcs as (select distinct source from x), labs as (select distinct {col} from x)
select s.source, l.{col}, round(coalesce(x.n, 0) / (select max(rowtot) from x x2 where x2.source = s.source) * 100.0, 2)
  as percentage from srcs s, labs l left join x on x.source = s.source and x.{col} = l.{col}"""


@register("xtab_category", _xtab_sql("ai_category"))
def q_xtab_category(spark, sf):
    return _an(spark, sf).source_vs_category


@register("xtab_sentiment", _xtab_sql("ai_sentiment"))
def q_xtab_sentiment(spark, sf):
    return _an(spark, sf).source_vs_sentiment


_CONFLICT = ("coalesce((rating >= 4 and ai_sentiment = 'Negative') or "
             "(rating <= 2 and ai_sentiment = 'Positive'), false)")


@register("conflict_summary", INS + " select * from conf")
def q_conflict_summary(spark, sf):
    return _an(spark, sf).conflicts


@register("conflict_rows", INS + f" select id, rating, ai_sentiment, feedback_text from validated where {_CONFLICT}")
def q_conflict_rows(spark, sf):
    v = _an(spark, sf).validated
    from ..operators.insights import conflict_flag
    return v.filter(conflict_flag(v)).select("id", "rating", "ai_sentiment", "feedback_text")


@register("conflict_sample", INS + f" select id, rating, ai_sentiment, feedback_text from validated "
          f"where {_CONFLICT} order by seq limit {K.CONFLICT_SAMPLE}")
def q_conflict_sample(spark, sf):
    return _an(spark, sf).conflict_sample


@register("weekly_trend", INS + " select * from weekly")
def q_weekly_trend(spark, sf):
    return _an(spark, sf).weekly


@register("trend_status", INS + " select * from trend")
def q_trend_status(spark, sf):
    return _an(spark, sf).trend


@register("unique_patterns", INS + " select cast(count(distinct normalized_text) as bigint) as unique_patterns "
          "from validated")
def q_unique_patterns(spark, sf):
    return _an(spark, sf).unique_patterns


# ---------------------------------------------------------------------------
# Rules
# ---------------------------------------------------------------------------
@register("recommendations", INS + " select * from recommendations")
def q_recommendations(spark, sf):
    return _an(spark, sf).recommendations


_SPOT = ", ".join(f"({O.q(c)}, {O.q(t)}, {O.q(r)})" for c, (t, r) in K.SPOTLIGHT.items())


@register("spotlight", INS + f""", tpl as (select * from (values {_SPOT}) v(ai_category, title, recommendation))
select * from (select cast(row_number() over (order by count desc, _rank) as integer) as priority,
  c.ai_category as category, t.title, t.recommendation, c.percentage
  from catcnt c join tpl t using (ai_category)) where priority <= {K.SPOTLIGHT_TOP}""")
def q_spotlight(spark, sf):
    return _an(spark, sf).spotlight


_PRETTY = ("array_to_string(list_transform(string_split(replace(source, '_', ' '), ' '), "
           "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')")
def _kpi_sql(pipeline: str, corrections: str) -> str:
    return O.with_(O.fb_cte(), pipeline, O.insight_ctes(), O.audit_ctes(), O.log_ctes(), _VM) + f""",
negsrc as (select source, round(count(*) filter (where ai_sentiment = 'Negative') / count(*) * 100.0, 2) as p
   from validated where source is not null and ai_sentiment is not null group by source),
mns as (select source, {_PRETTY} as label, p from negsrc order by p desc, source limit 1),
topc as (select ai_category, percentage from catcnt order by count desc, _rank limit 1)
select (select total_records from aud) as raw_records,
  (select cast(count(*) as bigint) from validated) as valid_complaints,
  (select cast(count(distinct normalized_text) as bigint) from validated) as unique_patterns,
  (select empty_removed + exact_duplicates_removed from clog) as records_removed,
  case when (select total_records from aud) > 0 then round((select empty_removed + exact_duplicates_removed
    from clog) / (select total_records from aud) * 100.0, 1) else 0.0 end as reduction_pct,
  (select health_score from aud) as health_score,
  (select insight_reliability from vm) as insight_reliability,
  lower(replace((select insight_reliability from vm), ' ', '-')) as reliability_class,
  (select ai_category from topc) as top_category, (select percentage from topc) as top_category_pct,
  coalesce((select source from mns), 'N/A') as most_negative_source,
  coalesce((select label from mns), 'N/A') as most_negative_source_label,
  coalesce((select p from mns), 0.0) as most_negative_source_pct,
  (select status from trend) as trend_status, (select reason from trend) as trend_reason,
  round((select average_confidence from vm) * 100.0, 1) as avg_confidence_pct,
  cast(({corrections}) as bigint) as corrections_applied,
  (select contradiction_count from aud) > 0 as contradiction_alert,
  (select insight_reliability from vm) = {O.q(K.LIMITED)} as limited_quality_notice,
  (select low_confidence_count from vm) > 0 as review_queue_pending"""


# Every fourth pattern (by the length of its key) gets labels outside the sets,
# the plug-in below gives the same.
_DIRTY = {0: ("Slightly Negative", "Payment Issue", 0.65), 1: ("Positive", "DELIVERY ", 0.9), 2: ("very good", "misc", 0.8)}


def _dirty_pipeline() -> str:
    pick = lambda i, rest: "case length(normalized_text) % 4 " + " ".join(
        f"when {k} then {O.q(v[i]) if i < 2 else v[i]}" for k, v in _DIRTY.items()) + f" else {rest} end"
    dirty = (f"pdirty as (select * replace ({pick(0, 'c_sentiment')} as c_sentiment, {pick(1, 'c_category')} as c_category, "
             f"cast({pick(2, 'c_confidence')} as double) as c_confidence) from pclass),\ncleaned as (")
    fixed = (f"fixed as (select *, {_SFIX.replace('ai_s', 'ai_sentiment')} as s_fix, {_CFIX.replace('ai_c', 'ai_category')} as c_fix from enriched),\n"
             "validated as (select * exclude (s_fix, c_fix) replace (s_fix as ai_sentiment, c_fix as ai_category), ")
    p = O.pipeline_ctes().replace("cleaned as (", dirty, 1).replace("join pclass p using", "join pdirty p using")
    a, b = p.split("validated as (select *, ")
    return a + fixed + b.replace("from enriched)", "from fixed)")


_CORRECTED = ("select coalesce(sum(case when ai_sentiment in ('Positive','Neutral','Negative') then 0 else 1 end + "
              "case when ai_category in (" + ", ".join(O.q(c) for c in K.CATEGORIES) + ") then 0 else 1 end), 0) from enriched")
_KPI = _kpi_sql(O.pipeline_ctes(), _CORRECTED)


def _dirty_batches(frames):
    """A plug-in that leaves the label sets for some patterns and answers others
    with nulls (the heuristic's labels)."""
    for f in frames:
        kind = f["normalized_text"].str.len() % 4
        out = f[["normalized_text"]].copy()
        for i, name in enumerate(["sentiment", "category", "confidence"]):
            out[name] = [_DIRTY[k][i] if k in _DIRTY else None for k in kind]
        out["summary"] = None
        yield out[["normalized_text", "sentiment", "category", "summary", "confidence"]]


@register("exec_kpis_corrected", _kpi_sql(_dirty_pipeline(), _CORRECTED))
def q_exec_kpis_corrected(spark, sf):
    """The KPI row over a classifier whose labels need correcting."""
    return analyse(fx.feedback_raw(spark, sf), classifier=_dirty_batches, materialize="table", keep_validated=False).exec_kpis


@register("exec_kpis", _KPI)
def q_exec_kpis(spark, sf):
    return _an(spark, sf).exec_kpis


_SECTIONS = O.with_(O.fb_cte(), O.pipeline_ctes(), O.insight_ctes(), O.audit_ctes(), O.log_ctes(), _VM) + f""",
ex as (select ai_category, string_agg(feedback_text, '|' order by rn) as texts from (select ai_category, feedback_text,
   row_number() over (partition by ai_category order by ai_confidence desc, seq) as rn from validated) where rn <= 3 group by ai_category),
sent as (select ai_sentiment, count(*) as n, round(count(*) / (select count(*) from validated) * 100.0, 2) as p from validated where ai_sentiment is not null group by 1),
srcs as (select source, count(*) as n, round(count(*) / (select count(*) from validated) * 100.0, 2) as p from validated where source is not null group by 1),
conflicting as (select seq, id, cast(rating as double) as rating, ai_sentiment, feedback_text from validated where {_CONFLICT} order by seq limit {K.CONFLICT_SAMPLE}),
parts(section, position, label, n, share, detail) as (
  select 'audit_results', null, null, total_records, cast(health_score as double), null from aud
  union all select 'cleaning_log', null, null, total_raw, cast(total_cleaned_saved as double), null from clog
  union all select 'validation_metrics', null, null, low_confidence_count, average_confidence, insight_reliability from vm
  union all select 'category', _rank, ai_category, count, percentage, coalesce(texts, '') from catcnt left join ex using (ai_category)
  union all select 'sentiment', null, ai_sentiment, n, p, null from sent
  union all select 'source', null, source, n, p, null from srcs
  union all select 'conflicts', null, null, conflict_count, conflict_percentage, null from conf
  union all select 'conflicts_sample', seq, ai_sentiment, id, rating, feedback_text from conflicting
  union all select 'trend', null, status, null, null, reason from trend
  union all select 'weekly_data', datediff('day', date '1970-01-04', cast(week_end as date)) // 7, week_end, total_complaints, negative_sentiment_percentage, null from weekly
  union all select 'recommendations', priority, title, null, null, impact || ': ' || description from recommendations)
select section, cast(position as bigint) as position, label, cast(n as bigint) as n, cast(share as double) as share, detail from parts"""

_SECTION_FIELDS = ("total_records bigint, health_score int, total_raw bigint, total_cleaned_saved bigint, low_confidence_count bigint, "
                   "average_confidence double, insight_reliability string, ai_category string, count bigint, percentage double, "
                   "examples array<string>, ai_sentiment string, source string, conflict_count bigint, conflict_percentage double, "
                   "id bigint, rating double, feedback_text string, status string, reason string, week_end string, "
                   "total_complaints bigint, negative_sentiment_percentage double, title string, impact string, description string")


@register("report_sections", _SECTIONS)
def q_report_sections(spark, sf):
    """The report written as JSON lines, one folder a section, read back and parsed."""
    path = scratch_path(spark, f"report/{uuid.uuid4().hex}")
    write_sections(_an(spark, sf, many=True).report_sections, path)
    doc = F.from_json("payload", _SECTION_FIELDS).alias("d")
    x = spark.read.schema("position long, payload string, section string").json(path).select("section", "position", doc).select("section", "position", "d.*")
    first = lambda *names: F.coalesce(*[F.col(n) if isinstance(n, str) else n for n in names])
    return x.select(
        "section", "position", first("ai_category", "source", "ai_sentiment", "status", "week_end", "title").alias("label"),
        first("total_records", "total_raw", "low_confidence_count", "count", "conflict_count", "id", "total_complaints").alias("n"),
        first("percentage", "average_confidence", "conflict_percentage", "rating", "negative_sentiment_percentage",
              F.col("health_score").cast("double"), F.col("total_cleaned_saved").cast("double")).alias("share"),
        first("insight_reliability", F.array_join("examples", "|"), "feedback_text", "reason", F.concat("impact", F.lit(": "), "description")).alias("detail"))


def _actions_sql() -> str:
    parts = []
    for i, (issue, cnt, logc, action) in enumerate(K.AUDIT_ACTIONS):
        if logc:
            act = f"replace({O.q(action)}, '%s', cast((select {logc} from clog) as varchar))"
        else:
            act = O.q(action)
        parts.append(f"select {i + 1} as row_no, {O.q(issue)} as issue, (select {cnt} from aud) as count, "
                     f"{act} as action")
    return (O.with_(O.fb_cte(), O.pipeline_ctes(), O.audit_ctes(), O.log_ctes()) + " " +
            " union all ".join(parts))


@register("audit_actions", _actions_sql())
def q_audit_actions(spark, sf):
    return _an(spark, sf).audit_actions


def queries() -> dict[str, Query]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}
