"""Test tables derived from the driver's ``events`` table.

The feedback engine needs raw customer feedback; the driver tables hold none,
so ``feedback_raw`` is a deterministic SQL view over ``events`` (one feedback
row per event plus an exact copy of every 20th).  Its work grows with
``events``.  The same template renders for Spark and for DuckDB (only the date
formatting function differs), so the oracle sees identical input.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Spark pattern -> strftime pattern, for the seven formats the fixture writes.
_STRFTIME = {
    "dd-MMM-yy": "%d-%b-%y",
    "MM/dd/yyyy": "%m/%d/%Y",
    "dd/MM/yyyy": "%d/%m/%Y",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "MMMM dd, yyyy": "%B %d, %Y",
    "MMM dd yyyy": "%b %d %Y",
    "yyyy-MM-dd": "%Y-%m-%d",
}

# FIXED VALUES: the 24 feedback texts of the fixture.
FIXTURE_TEXTS = [
    "App crashed on loading screen",
    "Login button is greyed out and the update drains battery",
    "Driver was rude and threw the bag at my door",
    "Food arrived cold and spilled inside the bag",
    "Refund still missing, charged double for one payment",
    "Coupon SAVE50 failed during checkout",
    "Customer care kept me on hold and no reply to email",
    "Agent solved my issue, great and friendly support",
    "Great service, fast and smooth, love it",
    "Please add vegan restaurants",
    "Mera refund abhi tak nahi aaya, bahut bura service",
    "El pedido llego tarde y la aplicacion se cierra",
    "Le livreur etait impoli",
    "Crashed again, just love it",
    "Thanks, the refund came quick and the charge was fixed",
    "meh",
    "",
    None,
    "????!!",
    "aaaaaaa",
    "ok i guess",
    "  Order   was delivered to the wrong   address ",
    "Invoice price was wrong, unauthorized fee deducted",
    "Wonderful support, excellent and helpful",
]


def _lit(s):
    return "cast(null as varchar(100))" if s is None else "'" + s.replace("'", "''") + "'"


def _texts_sql() -> str:
    rows = ",\n  ".join(f"({i},{_lit(t)})" for i, t in enumerate(FIXTURE_TEXTS))
    return f"select * from (values {rows}) v(k,txt)"


def _fmt(dialect: str, pattern: str) -> str:
    if dialect == "spark":
        return f"date_format(ts,'{pattern}')"
    return f"strftime(ts,'{_STRFTIME[pattern]}')"


def feedback_raw_sql(dialect: str = "duckdb", events: str = "events") -> str:
    """``feedback_raw`` as one SELECT (for a CTE or a view)."""
    f = lambda p: _fmt(dialect, p)
    return f"""with t(k,txt) as ({_texts_sql()}),
e as (select event_id, user_id, ts, cast((event_id*7+user_id)%24 as int) k,
             cast((floor(event_id/24)+user_id)%6 as int) j from {events}),
r as (select e.event_id, e.event_id as id,
 case e.event_id%11 when 0 then null when 1 then ' ' when 2 then 'not a date'
  when 3 then {f('dd-MMM-yy')} when 4 then {f('MM/dd/yyyy')} when 5 then {f('dd/MM/yyyy')}
  when 6 then {f('yyyy-MM-dd HH:mm:ss')} when 7 then {f('MMMM dd, yyyy')}
  when 8 then {f('MMM dd yyyy')} else {f('yyyy-MM-dd')} end as timestamp,
 case when e.event_id%53=0 then null else case e.user_id%4 when 0 then 'app_store'
  when 1 then 'google_play' when 2 then 'web' else 'support' end end as source,
 case when e.event_id%9=0 then null when e.event_id%97=0 then 'five' when e.k=9 then '3'
  else cast(1+(e.event_id+e.user_id)%5 as varchar(4)) end as rating,
 case when t.k between 15 and 20 then t.txt else concat(t.txt, case e.j when 0 then ''
  when 1 then concat(' (order #',cast(100000+e.event_id as varchar(12)),')')
  when 2 then ' Agent Priya was handling it.!!!' when 3 then ' - my thali order in Pune'
  when 4 then ' This is the third time.' else '!!!' end) end as feedback_text
 from e join t on e.k=t.k)
select event_id*2 as seq, id, timestamp, source, rating, feedback_text from r
union all
select event_id*2+1 as seq, id, timestamp, source, rating, feedback_text from r where event_id%20=0"""


def labels_dirty_sql(events: str = "events") -> str:
    """Model labels with invalid values and raw classifier responses, one per event."""
    return f"""select event_id as id,
 case event_id%9 when 0 then 'Positive' when 1 then 'Neutral' when 2 then 'Negative'
  when 3 then 'negative' when 4 then 'Slightly Negative' when 5 then 'very bad'
  when 6 then '5 star' when 7 then 'unclear' else null end as ai_sentiment,
 case event_id%13 when 0 then 'Billing' when 1 then 'App Bug' when 2 then 'Delivery'
  when 3 then 'Staff/Support' when 4 then 'Other' when 5 then 'Payment Issue'
  when 6 then 'technical error' when 7 then 'order late' when 8 then 'customer care'
  when 9 then 'Feedback' when 10 then 'misc' when 11 then null else 'DELIVERY ' end as ai_category,
 cast(case event_id%8 when 0 then 0.85 when 1 then 0.75 when 2 then 0.70 when 3 then 0.60
  when 4 then 0.50 when 5 then 0.45 when 6 then 0.35 else 0.30 end as double) as ai_confidence,
 case event_id%10 when 0 then 'oops'
  when 1 then concat('{{"results":[{{"id":',cast(event_id+1 as varchar(12)),
   ',"sentiment":"Positive","category":"Other","summary":"s","confidence":0.9}}]}}')
  when 2 then concat('{{"results":[{{"id":',cast(event_id as varchar(12)),',"sentiment":"Neutral"}}]}}')
  when 3 then '{{"results":[]}}'
  else concat('```json','{{"results":[{{"id":',cast(event_id as varchar(12)),
   ',"sentiment":"Negative","category":"Delivery","summary":"late order","confidence":0.92}}]}}','```')
  end as response
from {events}"""


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over the cores when it arrives in fewer splits than the
    default parallelism (the driver tables are single-row-group files).  A
    large multi-file table already has more splits and is left as it is."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(os.path.join(sf_dir, "events.parquet")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(os.path.join(sf_dir, "documents.parquet")))


def feedback_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feedback rows (seq, id, timestamp, source, rating, feedback_text)."""
    sql = feedback_raw_sql("spark", events="{events}")
    df = spark.sql(sql, events=events(spark, sf_dir))
    return df.selectExpr("seq", "id", "cast(timestamp as string) timestamp",
                         "cast(source as string) source", "cast(rating as string) rating",
                         "cast(feedback_text as string) feedback_text")


def health_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows carrying an order number in brackets: a slice whose health is not clamped."""
    fb = feedback_raw(spark, sf_dir)
    return fb.filter(fb.feedback_text.like("%(order #%"))


def labels_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, ai_sentiment, ai_category, ai_confidence, response)."""
    sql = labels_dirty_sql("__events__").replace("{", "{{").replace("}", "}}")
    return spark.sql(sql.replace("__events__", "{events}"), events=events(spark, sf_dir))
