"""The whole analysis as one lazily planned flow:
raw -> audit | clean -> enrich -> validate -> insights -> rules.

``analyse`` only builds plans.  Four frames feed more than one branch (the
prepared rows, the staged rows, the validated table and the insight cube); with
``materialize='table'`` (or ``'checkpoint'``) they are written once under the
shared checkpoint folder, which both cuts the lineage (a lost executor re-reads
them instead of re-running the cleaning) and stops every branch and every
result from re-running the cleaning.  All counts, shares, crosstabs and weeks
come from the cube, i.e. from one pass over the validated rows.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import (audit, audit_actions, category_distribution, classifier_answers,
                         classifier_batches, clean, conflict_sample,
                         conflict_summary, crosstab, enrich, exec_kpis, insight_cube, insight_kpis,
                         recommendations, report_payload, report_sections, review_queue, spotlight,
                         trend_status, unique_patterns, validate, value_distribution, weekly_trend)
from ..operators.audit import tested_rows
from ..operators.clean import Cleaned
from ..operators.insights import category_counts
from ..operators.fill import DEFAULT_CHUNK
from ..session import materialize


@dataclass
class Analysis:
    raw: DataFrame
    classifier: object = None
    materialize: str = "none"
    keep_validated: bool = True
    chunk: int | None = DEFAULT_CHUNK
    malformed: DataFrame | None = None
    observation: object = None

    def _keep(self, df: DataFrame) -> DataFrame:
        return df if self.materialize == "none" else materialize(df, self.materialize)

    @cached_property
    def audit(self) -> DataFrame:
        """One row, written once (it feeds the health score, the KPI row, the action
        table and the payload)."""
        return audit(self.raw, tested=self._tested)

    @cached_property
    def _tested(self) -> DataFrame | None:
        """Rows with their tests and parsed date, written once where both audit and
        cleaning are asked for (they would read and parse all rows each)."""
        return tested_rows(self.raw, self.materialize) if self.keep_validated else None

    @cached_property
    def cleaned(self) -> Cleaned:
        return clean(self.raw, self.chunk, self.materialize, self._tested)

    @cached_property
    def cleaning_log(self) -> DataFrame:
        """The counts of the cleaning; with a frame of malformed records (see
        ``sources.read_csv_checked``) also their number."""
        log = self.cleaned.log
        if self.malformed is not None:
            log = log.withColumn("malformed_records", self.malformed.agg(F.count(F.lit(1))).scalar())
        return self._keep(log)

    @cached_property
    def answers(self) -> DataFrame | None:
        """What a plug-in classifier answered, written once (None without one)."""
        if self.classifier is None:
            return None
        return materialize(classifier_answers(self.cleaned.patterns, self.classifier, self.observation), "table")

    @property
    def classifier_batches(self) -> DataFrame:
        """(batch_id, asked, answered, status, error) of a plug-in's batches."""
        if self.answers is None:
            raise ValueError("the flow has no plug-in classifier")
        return classifier_batches(self.answers)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.cleaned, answers=self.answers)

    @cached_property
    def _validated(self):
        # health only feeds the metrics: attach it lazily so that results that
        # do not need it never plan (or run) the audit
        return validate(self.enriched)

    @cached_property
    def _counted(self) -> DataFrame:
        counted = self._validated.counted
        return materialize(counted, self.materialize) if self.keep_validated else counted

    @property
    def validated(self) -> DataFrame:
        return self._counted.drop("_corrected")

    @cached_property
    def cube(self) -> DataFrame:
        """Every distribution, crosstab, conflict and week of the validated rows,
        from one pass over them; written once in materialized mode."""
        return self._keep(insight_cube(self._counted))

    @property
    def corrections(self) -> DataFrame:
        return self._validated.corrections

    @cached_property
    def metrics(self) -> DataFrame:
        from ..operators.validate import validation_metrics
        health = self.audit.select("health_score").scalar()
        return self._keep(validation_metrics(self.cube, health))

    @property
    def review_queue(self) -> DataFrame:
        return review_queue(self.validated)

    # insights
    @property
    def category_distribution(self) -> DataFrame:
        return category_distribution(self.validated, self.cube)

    @property
    def category_counts(self) -> DataFrame:
        return category_counts(self.cube)

    @property
    def sentiment_distribution(self) -> DataFrame:
        return value_distribution(self.cube, "ai_sentiment")

    @property
    def source_distribution(self) -> DataFrame:
        return value_distribution(self.cube, "source")

    @property
    def source_vs_category(self) -> DataFrame:
        return crosstab(self.cube, "ai_category", K.CATEGORIES, "ai_category")

    @property
    def source_vs_sentiment(self) -> DataFrame:
        return crosstab(self.cube, "ai_sentiment", K.SENTIMENTS, "ai_sentiment")

    @property
    def conflicts(self) -> DataFrame:
        return conflict_summary(self.cube)

    @property
    def conflict_sample(self) -> DataFrame:
        return conflict_sample(self.validated)

    @property
    def weekly(self) -> DataFrame:
        return weekly_trend(self.cube)

    @property
    def trend(self) -> DataFrame:
        return trend_status(self.weekly)

    @property
    def unique_patterns(self) -> DataFrame:
        return unique_patterns(self.validated)

    # rules
    @property
    def recommendations(self) -> DataFrame:
        return recommendations(insight_kpis(self.cube, self.trend))

    @property
    def spotlight(self) -> DataFrame:
        return spotlight(self.category_counts)

    @property
    def exec_kpis(self) -> DataFrame:
        return exec_kpis(self.audit, self.cleaning_log, self.cube, self.metrics)

    @property
    def audit_actions(self) -> DataFrame:
        return audit_actions(self.audit, self.cleaning_log)

    @property
    def report_payload(self) -> DataFrame:
        return report_payload(self.audit, self.cleaning_log, self.validated, self.metrics,
                              self.recommendations, self.cube)

    @property
    def report_sections(self) -> DataFrame:
        return report_sections(self.audit, self.cleaning_log, self.validated, self.cube, self.metrics,
                               self.recommendations)


def analyse(raw: DataFrame, classifier=None, materialize: str = "none",
            chunk: int | None = DEFAULT_CHUNK, keep_validated: bool = True,
            malformed: DataFrame | None = None, observation: object = None) -> Analysis:
    """Plan the full analysis of a raw feedback frame (must carry ``seq``).
    ``malformed``: records that the reader set aside, counted in the cleaning log;
    ``observation``: collects the progress of a plug-in classifier."""
    if "seq" not in raw.columns:
        raise ValueError("raw feedback needs a file-order column 'seq' "
                         "(use critiq.sources.read_feedback)")
    return Analysis(raw=raw, classifier=classifier, materialize=materialize, chunk=chunk,
                    keep_validated=keep_validated, malformed=malformed, observation=observation)


def strip_seq(df: DataFrame) -> DataFrame:
    return df.drop("seq") if "seq" in df.columns else df


__all__ = ["Analysis", "analyse", "strip_seq"]
