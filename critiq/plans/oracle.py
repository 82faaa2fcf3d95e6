"""DuckDB SQL oracle for every registered query.

The SQL is written independently of the Spark plans (window functions over
the whole table, ``group by all``, ``try_strptime`` with a format list,
``arg_min``) and shares only the fixed values of ``constants``.  RE2 (DuckDB)
has ASCII ``\\w \\d \\b``; the fixture texts are ASCII where those matter.
Python's white space set is spelled out as a class in both engines.
"""
from __future__ import annotations

from .. import constants as K
from .fixtures import feedback_raw_sql, labels_dirty_sql

WS_BODY = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"
WS = "[" + WS_BODY + "]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(x: str) -> str:
    return f"trim({x}, {q(WS_CHARS)})"


def clean_text(x: str) -> str:
    return f"coalesce(regexp_replace({strip(x)}, '{WS}+', ' ', 'g'), '')"


def meaningless(x: str) -> str:
    s = strip(x)
    low = f"lower({s})"
    ph = ", ".join(q(p) for p in K.PLACEHOLDER_TEXTS)
    return (f"(case when {x} is null then true else (length({s}) < {K.MIN_TEXT_LENGTH} "
            f"or {low} in ({ph}) or not regexp_matches({s}, '[a-zA-Z0-9]') "
            f"or (length(replace({low}, left({low}, 1), '')) = 0 and length({s}) > 3)) end)")


def _re(p: str) -> str:
    """Python pattern -> RE2 with \\s as Python white space."""
    out, in_class, i = [], False, 0
    while i < len(p):
        ch = p[i]
        if ch == "\\":
            tok = p[i:i + 2]
            out.append((WS_BODY if in_class else WS) if tok == r"\s" else tok)
            i += 2
            continue
        if ch == "[":
            in_class = True
        elif ch == "]":
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


def normalize(x: str) -> str:
    base = strip(f"lower({x})")
    out = base
    for pat, rep in K.NORMALISE_PATTERNS:
        out = f"regexp_replace({out}, {q(_re(pat))}, {q(rep)}, 'gi')"
    out = strip(out)
    return f"coalesce(nullif({out}, ''), {base}, '')"


# Spark pattern -> strftime, in the engine's order.
STRPTIME = {
    "yyyy-M-d": "%Y-%m-%d", "yyyy/M/d": "%Y/%m/%d", "yyyy.M.d": "%Y.%m.%d", "yyyyMMdd": "%Y%m%d",
    "yyyy-MMM-d": "%Y-%b-%d", "d-MMM-yy": "%d-%b-%y", "d-MMM-yyyy": "%d-%b-%Y",
    "d-MMMM-yyyy": "%d-%B-%Y", "MMM-d-yyyy": "%b-%d-%Y", "d/MMM/yyyy": "%d/%b/%Y",
    "M-d-yy": "%m-%d-%y", "d-M-yy": "%d-%m-%y", "M-d-yyyy": "%m-%d-%Y", "d-M-yyyy": "%d-%m-%Y",
    "M/d/yyyy": "%m/%d/%Y", "d/M/yyyy": "%d/%m/%Y", "M/d/yy": "%m/%d/%y", "d/M/yy": "%d/%m/%y",
    "d.M.yyyy": "%d.%m.%Y", "MMMM d, yyyy": "%B %d, %Y", "MMM d, yyyy": "%b %d, %Y",
    "MMMM d yyyy": "%B %d %Y", "MMM d yyyy": "%b %d %Y", "d MMMM yyyy": "%d %B %Y",
    "d MMM yyyy": "%d %b %Y", "d MMMM, yyyy": "%d %B, %Y", "d MMM, yyyy": "%d %b, %Y",
}


def unwrap(x: str) -> str:
    s = strip(x)
    s = f"regexp_replace({s}, '^\"+|\"+$', '', 'g')"
    s = f"regexp_replace({s}, '^''+|''+$', '', 'g')"
    for pattern, put in K.DATE_REWRITES:
        s = f"regexp_replace({s}, {q(pattern)}, {q(put.replace('$', chr(92)))}, 'g')"
    return s


def iso_date(x: str) -> str:
    v = unwrap(x)
    # %Y also takes two digits here, so the two-digit years are tried first.
    order = sorted(STRPTIME, key=lambda f: "yyyy" in f)
    fmts = "[" + ", ".join(q(STRPTIME[f]) for f in order) + "]"
    return (f"(case when {v} = '' then null else strftime(cast(try_strptime({v}, {fmts}) as date), "
            f"'%Y-%m-%d') end)")


def missing_ts(x: str) -> str:
    return f"({x} is null or {strip(x)} = '')"


def invalid_ts(x: str) -> str:
    return f"(not {missing_ts(x)} and {iso_date(x)} is null)"


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def rating(x: str) -> str:
    s = strip(f"cast({x} as varchar)")
    return f"(case when regexp_matches({s}, {q(NUMBER)}) then try_cast({s} as double) end)"


def any_of(t: str, words) -> str:
    return "(" + " or ".join(f"contains({t}, {q(w)})" for w in dict.fromkeys(words)) + ")"


def count_of(t: str, words) -> str:
    return "(" + " + ".join(f"(case when contains({t}, {q(w)}) then 1 else 0 end)"
                            for w in words) + ")"


def impute(r: str, text: str) -> str:
    t = f"lower(coalesce({text}, ''))"
    return (f"coalesce({rating(r)}, case when {any_of(t, K.IMPUTE_NEGATIVE)} then 1.0 "
            f"when {any_of(t, K.IMPUTE_POSITIVE)} then 5.0 else 3.0 end)")


def contradicts(r: str, text: str) -> str:
    rv, t = rating(r), f"lower({text})"
    pos, neg = any_of(t, K.CONTRADICTION_POSITIVE), any_of(t, K.CONTRADICTION_NEGATIVE)
    return (f"coalesce(({rv} >= 4 and {neg} and not {pos}) or ({rv} <= 2 and {pos} and not {neg}),"
            f" false)")


def agent(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {q('(?i)' + _re(r'agent\s+(' + '|'.join(K.AGENT_NAMES) + ')'))}), false)"


def order_no(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {q('(?i)' + _re(r'order\s*#\s*\d+'))}), false)"


def multilingual(x: str) -> str:
    return f"coalesce({any_of(f'lower({x})', K.FOREIGN_WORDS)}, false)"


def summary(t: str) -> str:
    pre = "(?i)^(" + "|".join(K.SUMMARY_PREFIXES) + r")\b"
    rest = strip(f"regexp_replace({t}, {q(pre)}, '')")
    s = f"(case when length({rest}) > 5 then upper(left({t}, 1)) || substr({t}, 2) else {t} end)"
    return f"(case when length({s}) > 60 then left({s}, 57) || '...' else {s} end)"


def with_scores(src: str, text: str, rating_col: str, extra: str = "*") -> str:
    """SELECT over ``src`` adding _pos, _neg, per-category scores and _rv."""
    low = f"lower({strip(text)})"
    cats = ", ".join(f"{count_of(low, kws)} as \"_s_{cat}\"" for cat, kws in K.CATEGORY_KEYWORDS.items())
    return (f"select {extra}, {count_of(low, K.SENTIMENT_KEYWORDS['Positive'])} as _pos, "
            f"{count_of(low, K.SENTIMENT_KEYWORDS['Negative'])} as _neg, {cats}, "
            f"{rating(rating_col)} as _rv from {src}")


def best_category() -> str:
    cats = [c for c in K.CATEGORIES if c in K.CATEGORY_KEYWORDS]
    top = "greatest(" + ", ".join(f'"_s_{c}"' for c in cats) + ")"
    arms = " ".join(f"when \"_s_{c}\" = {top} then {q(c)}" for c in cats)
    return f"(case when {top} = 0 then 'Other' {arms} end)"


def sentiment() -> str:
    ts = "(case when _pos > _neg then 'Positive' when _neg > _pos then 'Negative' else 'Neutral' end)"
    return (f"(case when _rv >= 4 then (case when _neg > _pos then 'Negative' else 'Positive' end) "
            f"when _rv <= 2 then (case when _pos > _neg then 'Positive' else 'Negative' end) "
            f"else {ts} end)")


def confidence(sent: str) -> str:
    base = (f"(case when _rv is null then 0.75 when _rv >= 4 and {sent} = 'Negative' then 0.45 "
            f"when _rv <= 2 and {sent} = 'Positive' then 0.50 else 0.85 end)")
    mixed = (f"(case when {base} = 0.75 then 0.60 when {base} = 0.45 then 0.30 "
             f"when {base} = 0.50 then 0.35 else 0.70 end)")
    return f"cast(case when _pos > 0 and _neg > 0 then {mixed} else {base} end as double)"


def classified(src: str, text: str, rating_col: str) -> str:
    """SELECT * of ``src`` plus c_sentiment, c_category, c_summary, c_confidence."""
    scored = with_scores(src, text, rating_col)
    sent = sentiment()
    return (f"select *, {sent} as c_sentiment, {best_category()} as c_category, "
            f"{summary(text)} as c_summary, {confidence(sent)} as c_confidence from ({scored})")


# ----------------------------------------------------------------------------
# CTE chains
# ----------------------------------------------------------------------------
def fb_cte() -> str:
    return f"fb as (select * from ({feedback_raw_sql('duckdb')}))"


def labels_cte() -> str:
    return f"lab as (select * from ({labels_dirty_sql()}))"


def pipeline_ctes(src: str = "fb") -> str:
    """kept .. validated over the raw CTE ``src`` (seq, id, timestamp, source, rating, feedback_text)."""
    return f""",
kept as (select * from {src} where not {meaningless('feedback_text')}),
staged as (select seq, id, {clean_text('feedback_text')} as feedback_text,
                  {iso_date('timestamp')} as ts_parsed, source, rating from kept),
filled as (select *, coalesce(
    last_value(ts_parsed ignore nulls) over (order by seq rows between unbounded preceding and current row),
    first_value(ts_parsed ignore nulls) over (order by seq rows between current row and unbounded following))
    as timestamp from staged),
rated as (select seq, id, timestamp, source, {impute('rating', 'feedback_text')} as rating,
                 feedback_text from filled),
dedup as (select id, timestamp, source, rating, feedback_text, min(seq) as seq from rated group by all),
normed as (select *, {normalize('feedback_text')} as normalized_text from dedup),
patterns as (select normalized_text, count(*) as complaint_count, min(seq) as first_seq,
                    arg_min(feedback_text, seq) as first_text, arg_min(rating, seq) as first_rating
             from normed group by normalized_text),
pclass as ({classified('patterns', 'first_text', 'first_rating')}),
cleaned as (select n.id, n.timestamp, n.source, n.rating, n.feedback_text, n.normalized_text,
                   p.complaint_count, n.seq from normed n join patterns p using (normalized_text)),
enriched as (select c.*, p.c_sentiment as ai_sentiment, p.c_category as ai_category,
                    p.c_summary as ai_summary, p.c_confidence as ai_confidence
             from cleaned c join pclass p using (normalized_text)),
validated as (select *, ai_confidence < {K.REVIEW_THRESHOLD} as needs_human_review from enriched)"""


def audit_ctes(src: str = "fb", name: str = "aud",
               cols: str = "id, timestamp, source, rating, feedback_text") -> str:
    cnt = lambda e: f"cast(count(*) filter (where {e}) as bigint)"
    return f""",
{name}_rows as (select cast(count(*) as bigint) as total_records,
   {cnt(missing_ts('timestamp'))} as missing_timestamp_count,
   {cnt('rating is null')} as missing_rating_count,
   {cnt(meaningless('feedback_text'))} as empty_feedback_count,
   {cnt(invalid_ts('timestamp'))} as invalid_timestamp_count,
   {cnt(contradicts('rating', 'feedback_text'))} as contradiction_count,
   {cnt(agent('feedback_text'))} as agent_mentions_count,
   {cnt(order_no('feedback_text'))} as order_number_count,
   {cnt(multilingual('feedback_text'))} as multilingual_count from {src}),
{name}_dr as (select coalesce(cast(sum(n - 1) as bigint), 0) as duplicate_row_count from
   (select count(*) as n from {src} group by {cols})),
{name}_dt as (select coalesce(cast(sum(n - 1) as bigint), 0) as duplicate_feedback_count from
   (select count(*) as n from {src} group by feedback_text)),
{name}_m as (select * from {name}_rows, {name}_dr, {name}_dt),
{name}_d as (select *, case when total_records > 0 then
   missing_timestamp_count / total_records * 100.0 * {K.PENALTY_MISSING_TIMESTAMP}
 + missing_rating_count / total_records * 100.0 * {K.PENALTY_MISSING_RATING}
 + duplicate_row_count / total_records * 100.0 * {K.PENALTY_DUPLICATE_ROW}
 + duplicate_feedback_count / total_records * 100.0 * {K.PENALTY_DUPLICATE_FEEDBACK}
 + empty_feedback_count / total_records * 100.0 * {K.PENALTY_EMPTY_FEEDBACK}
 + invalid_timestamp_count / total_records * 100.0 * {K.PENALTY_INVALID_TIMESTAMP}
 else 0.0 end as ded from {name}_m),
{name} as (select total_records,
   cast(case when total_records > 0 then greatest(0, least(100, cast(trunc(100.0 - ded) as integer)))
        else 100 end as integer) as health_score,
   missing_timestamp_count, missing_rating_count, duplicate_row_count, duplicate_feedback_count,
   empty_feedback_count, invalid_timestamp_count, contradiction_count, agent_mentions_count,
   order_number_count, multilingual_count, round(ded, 4) as deductions from {name}_d)"""


def log_ctes(src: str = "fb") -> str:
    return f""",
clog as (select r.total_raw, r.total_raw - r.kept as empty_removed,
   r.kept - d.n as exact_duplicates_removed, cast(0 as bigint) as normalized_duplicates_removed,
   r.parsed as timestamps_standardized, cast(0 as bigint) as unparseable_timestamps_kept,
   d.n as total_cleaned_saved, d.n - p.n as near_duplicate_rows, r.kept - r.parsed as unparseable_timestamps
 from (select cast(count(*) as bigint) as total_raw,
              cast(count(*) filter (where not {meaningless('feedback_text')}) as bigint) as kept,
              cast(count(*) filter (where not {meaningless('feedback_text')}
                                    and {iso_date('timestamp')} is not null) as bigint) as parsed
       from {src}) r,
      (select cast(count(*) as bigint) as n from dedup) d,
      (select cast(count(*) as bigint) as n from patterns) p)"""


def pct(n: str, d: str, digits: int = 2) -> str:
    return f"(case when {d} > 0 then round({n} / {d} * 100.0, {digits}) else 0.0 end)"


def insight_ctes() -> str:
    cats = ", ".join(f"({i}, {q(c)})" for i, c in enumerate(K.CATEGORIES))
    conflict = ("coalesce((rating >= 4 and ai_sentiment = 'Negative') or "
                "(rating <= 2 and ai_sentiment = 'Positive'), false)")
    return f""",
catdom as (select * from (values {cats}) v(_rank, ai_category)),
catcnt as (select d.ai_category, d._rank, cast(count(v.ai_category) as bigint) as count,
   {pct('count(v.ai_category)', '(select count(*) from validated)')} as percentage
 from catdom d left join validated v on v.ai_category = d.ai_category group by d.ai_category, d._rank),
weekly as (select strftime(cast(date_trunc('week', cast(timestamp as date)) as date) + 6, '%Y-%m-%d') as week_end,
   cast(count(*) as bigint) as total_complaints,
   {pct("count(*) filter (where ai_sentiment = 'Negative')", 'count(*)')} as negative_sentiment_percentage
 from validated where timestamp is not null group by 1),
wk as (select *, row_number() over (order by week_end) as i, count(*) over () as n,
   greatest(1, n // 3) as k from weekly),
tr0 as (select cast(count(*) as bigint) as weeks,
   avg(negative_sentiment_percentage) filter (where i <= k) as s,
   avg(negative_sentiment_percentage) filter (where i > n - k) as e from wk),
trend as (select case when weeks < 2 then 'Stable' when e - s < -2.0 then 'Improving'
   when e - s > 2.0 then 'Worsening' else 'Stable' end as status,
 case when weeks = 0 then {q(K.TREND_NO_DATES)} when weeks < 2 then {q(K.TREND_FEW_WEEKS)}
   when e - s < -2.0 then format({q(K.TREND_IMPROVING.replace('%s', '{}').replace('%%', '%'))},
        cast(round(s, 1) as varchar), cast(round(e, 1) as varchar))
   when e - s > 2.0 then format({q(K.TREND_WORSENING.replace('%s', '{}').replace('%%', '%'))},
        cast(round(s, 1) as varchar), cast(round(e, 1) as varchar))
   else format({q(K.TREND_STABLE.replace('%s', '{}').replace('%%', '%'))},
        cast(round(s, 1) as varchar), cast(round(e, 1) as varchar)) end as reason,
 weeks, round(s, 4) as start_avg, round(e, 4) as end_avg from tr0),
conf as (select cast(count(*) filter (where {conflict}) as bigint) as conflict_count,
   {pct(f'count(*) filter (where {conflict})', 'count(*)')} as conflict_percentage from validated),
kpi as (select
   (select percentage from catcnt where ai_category = 'Delivery') as delivery_pct,
   (select percentage from catcnt where ai_category = 'App Bug') as app_pct,
   (select percentage from catcnt where ai_category = 'Billing') as billing_pct,
   (select percentage from catcnt where ai_category = 'Staff/Support') as support_pct,
   (select conflict_percentage from conf) as conflict_pct,
   (select status from trend) as trend_status),
rules as (select * from (
   select 1 as rule_no, {q(K.REC_DELIVERY[0])} as title, {q(K.REC_DELIVERY[1])} as impact,
     format({q(K.REC_DELIVERY[2].replace('%s', '{}').replace('%%', '%'))}, cast(delivery_pct as varchar)) as description,
     delivery_pct > {K.REC_DELIVERY_OVER} as fired from kpi
   union all select 2, {q(K.REC_APP[0])}, {q(K.REC_APP[1])},
     format({q(K.REC_APP[2].replace('%s', '{}').replace('%%', '%'))}, cast(app_pct as varchar)),
     app_pct > {K.REC_APP_OVER} from kpi
   union all select 3, {q(K.REC_BILLING[0])}, {q(K.REC_BILLING[1])},
     format({q(K.REC_BILLING[2].replace('%s', '{}').replace('%%', '%'))}, cast(billing_pct as varchar)),
     billing_pct > {K.REC_BILLING_OVER} from kpi
   union all select 4, {q(K.REC_SUPPORT[0])}, {q(K.REC_SUPPORT[1])},
     format({q(K.REC_SUPPORT[2].replace('%s', '{}').replace('%%', '%'))}, cast(support_pct as varchar)),
     support_pct > {K.REC_SUPPORT_OVER} from kpi
   union all select 5, {q(K.REC_WORSENING[0])}, {q(K.REC_WORSENING[1])}, {q(K.REC_WORSENING[2])},
     trend_status = 'Worsening' from kpi
   union all select 6, {q(K.REC_STABLE[0])}, {q(K.REC_STABLE[1])}, {q(K.REC_STABLE[2])},
     trend_status = 'Stable' from kpi
   union all select 7, {q(K.REC_CONFLICT[0])}, {q(K.REC_CONFLICT[1])},
     format({q(K.REC_CONFLICT[2].replace('%s', '{}').replace('%%', '%'))}, cast(conflict_pct as varchar)),
     conflict_pct > {K.REC_CONFLICT_OVER} from kpi)),
recs as (select * from rules where fired
   union all select 8, {q(K.REC_GENERIC[0])}, {q(K.REC_GENERIC[1])}, {q(K.REC_GENERIC[2])}, true
   where not exists (select 1 from rules where fired)),
recommendations as (select cast(row_number() over (order by case impact when 'Critical' then 1
   when 'High' then 2 when 'Medium' then 3 else 4 end, rule_no) as integer) as priority,
   impact, title, description from recs)"""


def with_(*parts: str) -> str:
    return "with " + "".join(parts)


FULL = lambda: with_(fb_cte(), pipeline_ctes())
