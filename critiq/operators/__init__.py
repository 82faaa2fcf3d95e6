"""Operators: each takes DataFrames and returns DataFrames (lazy plans)."""
from .audit import AUDIT_COLUMNS, audit
from .classify import classify
from .clean import CLEANED_COLUMNS, Cleaned, clean, drop_exact_duplicates, pattern_table
from .enrich import (ENRICHED_COLUMNS, classifier_answers, classifier_batches, classify_patterns,
                     enrich)
from .fill import fill_in_order
from .insights import (category_distribution, conflict_sample, conflict_summary, crosstab,
                       cube_of, insight_cube, trend_status, unique_patterns, value_distribution, weekly_trend)
from .responses import batch_assign, merge_responses, parse_response, response_results
from .rules import (audit_actions, exec_kpis, insight_kpis, recommendations, report_payload,
                    report_sections, spotlight)
from .validate import Validated, corrections_log, reliability, review_queue, validate

__all__ = [
    "AUDIT_COLUMNS", "CLEANED_COLUMNS", "Cleaned", "ENRICHED_COLUMNS", "Validated", "audit",
    "audit_actions", "batch_assign", "category_distribution", "classifier_answers", "classifier_batches", "classify", "classify_patterns",
    "clean", "conflict_sample", "conflict_summary", "corrections_log", "crosstab", "cube_of",
    "drop_exact_duplicates", "enrich", "exec_kpis", "fill_in_order", "insight_cube", "insight_kpis",
    "merge_responses", "parse_response", "pattern_table", "recommendations", "reliability",
    "report_payload", "report_sections", "response_results", "review_queue", "spotlight", "trend_status",
    "unique_patterns", "validate", "value_distribution", "weekly_trend",
]
