"""Rating parsing, imputation and the rating/text contradiction test."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .keywords import contains_any
from .text import py_strip

# A plain decimal or scientific number (what float() accepts, minus inf/nan/underscores).
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_rating(c: Column) -> Column:
    """Rating as DOUBLE, null when missing or not a number.  Works on any input type."""
    s = py_strip(c.cast("string"))
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def impute_rating(rating: Column, text: Column, lowered: str | None = None) -> Column:
    """Parsed rating, else 1.0 for negative words, 5.0 for positive words, else 3.0.
    ``lowered``: name of a staged ``lower(text)`` column (faster to plan)."""
    t = F.lower(F.coalesce(text, F.lit(""))) if lowered is None else lowered
    guess = (F.when(contains_any(t, K.IMPUTE_NEGATIVE), F.lit(K.IMPUTE_NEGATIVE_RATING))
             .when(contains_any(t, K.IMPUTE_POSITIVE), F.lit(K.IMPUTE_POSITIVE_RATING))
             .otherwise(F.lit(K.IMPUTE_NEUTRAL_RATING)))
    return F.coalesce(parse_rating(rating), guess)


def contradicts(rating: Column, text: Column, lowered: str | None = None,
                parsed: Column | None = None) -> Column:
    """High rating with only negative trigger words, or low rating with only positive ones.
    ``lowered``: name of a staged ``lower(text)`` column; ``parsed``: staged rating."""
    r = parse_rating(rating) if parsed is None else parsed
    t = F.lower(text) if lowered is None else lowered
    pos = contains_any(t, K.CONTRADICTION_POSITIVE)
    neg = contains_any(t, K.CONTRADICTION_NEGATIVE)
    return F.coalesce(((r >= 4.0) & neg & ~pos) | ((r <= 2.0) & pos & ~neg), F.lit(False))
