"""Sinks: enriched table, corrections log, report payload."""
from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a result table (``csv`` gets a header row)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = (w.option("header", True).option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    w.format(fmt).save(path)
    return path


def write_enriched(validated: DataFrame, path: str, fmt: str = "csv") -> str:
    """The validated table without the internal ordinal, as CSV by default."""
    cols = [c for c in validated.columns if c != "seq"]
    return write_table(validated.select(*cols), path, fmt)


def write_corrections(log: DataFrame, path: str) -> str:
    """Corrections log as JSON lines."""
    return write_table(log, path, "json")


def write_payload(payload: DataFrame, path: str) -> str:
    """The one-row report payload as a text file holding one JSON document."""
    payload.select("payload").write.mode("overwrite").text(path)
    return path


def write_sections(sections: DataFrame, path: str) -> str:
    """The report's sections as JSON lines, one folder a section."""
    sections.write.mode("overwrite").partitionBy("section").json(path)
    return path
