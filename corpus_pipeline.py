"""A training-corpus pipeline over ``documents``.

STAGES holds (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the docs of
the next.  All stages but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from critiq.llm import mixing, ngram_join, packing, quality_rules, secrets
from critiq.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by n-gram Jaccard similarity stays."""
    return ngram_join.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by the rates that bring the domains to their targets:
    clean ones stay (some twice), toxic and poor ones thin out."""
    return mixing.resample(docs, table(spark, sf_dir, "labels"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece, with its ids."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("secret scans", secret_scan),
          ("mixing sources to target weights", mix_sources), ("packing", pack)]

# No SQL form: the stages hold robust estimates, lexing and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
