"""Feedback sources: CSV, Parquet, JSON files or a catalog table.

CSV is read with every column as text (no inference: a rating column holding
'five' must stay text), quotes escaped by doubling, and the missing-value
tokens a spreadsheet export uses turned into null.  ``multiLine`` is only
switched on when texts hold line breaks, because it makes a file unsplittable.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .ordering import with_arrival_order, with_file_order, with_row_index

REQUIRED = ["timestamp", "source", "rating", "feedback_text"]
_FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json"}


def null_tokens(df: DataFrame, tokens=K.NA_TOKENS) -> DataFrame:
    """Turn the usual missing-value spellings into null on every text column."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(list(tokens)), c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def require_columns(df: DataFrame, required=REQUIRED) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"feedback input lacks column(s) {missing}; "
                         f"expected at least {required}")
    return df


def detect_format(path: str) -> str:
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext in _FORMATS:
        return _FORMATS[ext]
    raise ValueError(f"unsupported feedback file type '{ext}' (csv, parquet, json or a table)")


def read_feedback(spark: SparkSession, path: str, fmt: str | None = None, *,
                  multiline: bool = False, with_seq: bool = True) -> DataFrame:
    """Read raw feedback and attach the file-order ordinal ``seq``."""
    fmt = fmt or detect_format(path)
    if fmt == "csv":
        df = (spark.read.option("header", True).option("escape", '"')
              # Every file's header must name the same columns in the same order;
              # Spark raises otherwise instead of reading by position.
              .option("enforceSchema", False)
              .option("multiLine", multiline).option("mode", "PERMISSIVE").csv(path))
        df = null_tokens(df)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "json":
        df = spark.read.option("multiLine", multiline).json(path)
    elif fmt == "table":
        df = spark.table(path)
    else:
        raise ValueError(f"unsupported feedback format '{fmt}'")
    require_columns(df)
    if not with_seq or "seq" in df.columns:
        return df
    if fmt == "table":
        return with_arrival_order(df)
    return with_row_index(df) if fmt == "parquet" else with_file_order(df)


# A quoted field with its inner quotes doubled, and marks beside one that leave
# no comma between it and the next field.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_FIELD = "\u0001"


def read_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed) of CSV files with one record a line.

    ``rows`` are the records with as many fields as the header names, as
    ``read_feedback`` gives them.  ``malformed`` holds every other line with its
    ``seq``, file, text (``record``) and ``kind``: ``short`` or ``long`` (too few or
    too many fields), or ``quoted`` (a quote that is not closed or stands inside a
    field).  Both carry the line order ``seq``, so nothing is lost between them.
    The lines are written once when this is called."""
    names = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False).csv(path).columns
    lines = spark.read.text(path).withColumn("file", F.col("_metadata.file_path")).filter(F.trim("value") != "")
    lines = with_file_order(lines, "_line")
    # The first line of each file is its header (one row a file).
    heads = lines.groupBy("file").agg(F.min("_line").alias("_head"))
    heads = heads.withColumn("_files", F.row_number().over(Window.orderBy("_head")))
    x = lines.join(heads, "file")
    fields = ", ".join(f"`{n}` string" for n in names)
    record = lambda c: F.from_csv(c, F.lit(fields), {"escape": '"'})
    first = x.filter("_line = _head").select("file", record(F.col("value")).alias("r")).select("file", F.array("r.*").alias("h"))
    other = first.filter(F.col("h") != F.array(*[F.lit(n) for n in names])).select("file").first()
    if other is not None:
        raise ValueError(f"the header of {other['file']} differs from {names}")
    x = x.filter("_line > _head").withColumn("seq", F.col("_line") - F.col("_files"))
    bare = F.regexp_replace("value", _QUOTED, _FIELD)
    x = x.withColumn("_bare", bare)
    commas = F.length("_bare") - F.length(F.replace("_bare", F.lit(","), F.lit("")))
    x = x.withColumn("kind", F.when(F.col("_bare").rlike(f'"|[^,]{_FIELD}|{_FIELD}[^,]'), "quoted")
                     .when(commas < len(names) - 1, "short").when(commas > len(names) - 1, "long"))
    rows = x.filter(F.col("kind").isNull()).select(record(F.col("value")).alias("r"), "seq").select("r.*", "seq")
    malformed = x.filter(F.col("kind").isNotNull()).select("seq", "file", "kind", F.col("value").alias("record"))
    return require_columns(null_tokens(rows)), malformed
