"""Queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame,
and the DuckDB SQL of those that SQL can express."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe_automaton, embedding_dedup, html_text, importance, lexical_rank, mixing, ngram_join, packing, quality_model,
               quality_rules, secrets, token_counts, token_files)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_table(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_table(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_table(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup_table(table(spark, sf_dir, "embeddings"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.bpe_table(table(spark, sf_dir, "documents"))


def op13_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_rank.rank_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_secret_scan, op2_quality_rules, op3_html_text, op4_quality_model, op5_token_files, op6_packing, op7_mixing, op8_ngram_join, op9_token_counts,
                                                   op10_embedding_dedup, op11_importance, op12_bpe, op13_lexical_rank)}
ORACLES: dict[str, str] = {"op8_ngram_join": ngram_join.ORACLE, "op10_embedding_dedup": embedding_dedup.ORACLE, "op11_importance": importance.ORACLE,
                           "op13_lexical_rank": lexical_rank.ORACLE}
