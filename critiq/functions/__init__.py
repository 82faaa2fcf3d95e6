"""Column builders: every function takes and returns ``pyspark.sql.Column``."""
from .dates import is_invalid_timestamp, is_missing_timestamp, iso_date, parse_date, week_end
from .keywords import contains_any, keyword_count
from .ratings import contradicts, impute_rating, parse_rating
from .text import (clean_text, is_meaningless, is_multilingual, mentions_agent,
                   mentions_order_number, normalize_text, prettify_label, py_strip, slug,
                   summary_line)

__all__ = [
    "clean_text", "contains_any", "contradicts", "impute_rating", "is_invalid_timestamp",
    "is_meaningless", "is_missing_timestamp", "is_multilingual", "iso_date", "keyword_count",
    "mentions_agent", "mentions_order_number", "normalize_text", "parse_date", "parse_rating",
    "prettify_label", "py_strip", "slug", "summary_line", "week_end",
]
