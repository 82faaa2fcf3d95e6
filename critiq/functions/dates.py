"""Date parsing and week bucketing.

``unwrap`` leaves the written date of a value; ``parse_unwrapped`` cuts it into
three tokens (numbers or month names, whatever stands between them) with one
regular expression and resolves their roles by a small rule table:

* a month name in the middle: day month year, or year month day if the first
  token has four digits;
* a month name first: month day year;
* numbers only: year month day if the first has four digits, else month first,
  unless it cannot be one, or day first where the tokens are parted by dots.

Eight digits in a row are year, month and day.  Anything else, and any date that
does not exist, is null; so are partial dates.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .text import py_strip

# What may part two tokens: anything but letters and digits, or the change from
# the one to the other.
_GAP = r"(?:[^\p{L}\p{N}]+|(?<=\d)(?=\p{L})|(?<=\p{L})(?=\d))"
_TOKENS = rf"^(?:(\d{{4}})(\d{{2}})(\d{{2}})|(\d{{1,4}}|\p{{L}}{{3,9}}){_GAP}(\d{{1,2}}|\p{{L}}{{3,9}}){_GAP}(\d{{1,2}}|\d{{4}}))$"
_MONTH_NAMES = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def unwrap(c: Column) -> Column:
    """The date part of a value: without white space and quotes around it (double,
    then single) and without weekday, ordinal suffix, time and zone."""
    s = F.regexp_replace(py_strip(c), '^"+|"+$', "")
    s = F.regexp_replace(s, "^'+|'+$", "")
    for pattern, put in K.DATE_REWRITES:
        s = F.regexp_replace(s, pattern, put)
    return s


def parse_date(c: Column, two_digit_pivot: int | None = None) -> Column:
    """Parse a free-form date string to a DATE, or null when no rule fits.

    ``two_digit_pivot``: two-digit years at or above it are read as 19xx
    (otherwise every two-digit year is 20xx)."""
    return parse_unwrapped(unwrap(c), two_digit_pivot)


def _month(token: Column) -> Column:
    """Number of a month name or its abbreviation, else null."""
    number = {n: i + 1 for i, name in enumerate(_MONTH_NAMES) for n in (name, name[:3])} | {"sept": 9}
    return F.try_element_at(F.create_map(*[x for k, v in number.items() for x in (F.lit(k), F.lit(v))]), F.lower(token))


def _parts(p: Column) -> dict[str, Column]:
    """What the rules ask of three tokens: their numbers, and the months that the
    first two name."""
    number = lambda i: p[i].try_cast("int")
    return {"a": number(0), "b": number(1), "c": number(2), "ma": _month(p[0]), "mb": _month(p[1])}


def _date(p: list[Column], a: Column, b: Column, c: Column, ma: Column, mb: Column, dotted: Column, pivot: int | None) -> Column:
    """The date of three tokens ``p`` by their parts."""
    first, named = F.length(p[0]) == 4, mb.isNotNull()
    day_first = F.when(dotted, b <= 12).otherwise(a > 12)
    month = F.when(ma.isNotNull(), ma).when(named, mb).when(first, b).when(day_first, b).otherwise(a)
    day = F.when(ma.isNotNull(), b).when(first, c).when(named | day_first, a).otherwise(b)
    short = (F.length(p[2]) == 2) & ~first
    century = F.lit(2000) if pivot is None else F.when(c >= pivot, F.lit(1900)).otherwise(F.lit(2000))
    year = F.when(first, a).when(short, century + c).otherwise(c)
    # A year is written with four digits, or with two at the end; days and months with two at most.
    fits = F.when(first, F.length(p[2]) <= 2).otherwise((F.length(p[2]).isin(2, 4)) & (a.isNull() | (F.length(p[0]) <= 2)))
    text = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string"))
    return F.when(fits, text.try_cast("date"))


def _tokens(v: Column) -> Column:
    # A value that is no date is left as it is by the replacement, and is then no
    # three tokens of the right kind.
    return F.split(F.regexp_replace(v, _TOKENS, "$1$4 $2$5 $3$6"), " ")


def _resolve(p: Column, dotted: Column, pivot: int | None) -> Column:
    """The date of three tokens.  Every intermediate is bound once by a lambda."""
    parts = F.struct(*[v.alias(k) for k, v in _parts(p).items()])
    found = F.transform(F.array(parts), lambda x: _date([p[0], p[1], p[2]], *[x.getField(k) for k in ("a", "b", "c", "ma", "mb")], dotted, pivot))[0]
    return F.when(F.size(p) == 3, found)


def with_date(df: DataFrame, unwrapped: str, out: str, two_digit_pivot: int | None = None) -> DataFrame:
    """``df`` with ``parse_unwrapped`` of a column as column ``out``.  Tokens and
    parts are staged as columns, so the rules are compiled: lambdas are not."""
    x = df.withColumn("_dp", _tokens(F.col(unwrapped)))
    x = x.withColumn("_dp", F.when(F.size("_dp") == 3, F.col("_dp")))
    parts = _parts(F.col("_dp"))
    x = x.withColumns({f"_d_{k}": v for k, v in parts.items()})
    p = [F.col("_dp")[i] for i in range(3)]
    found = _date(p, *[F.col(f"_d_{k}") for k in parts], F.contains(F.col(unwrapped), F.lit(".")), two_digit_pivot)
    return x.withColumn(out, found).drop("_dp", *[f"_d_{k}" for k in parts])


def parse_unwrapped(v: Column | str, two_digit_pivot: int | None = None) -> Column:
    """``parse_date`` for a value (or a column name) that ``unwrap`` has left."""
    v = F.col(v) if isinstance(v, str) else v
    return F.transform(F.array(_tokens(v)), lambda p: _resolve(p, F.contains(v, F.lit(".")), two_digit_pivot))[0]


def iso_date(c: Column | str, two_digit_pivot: int | None = None, unwrapped: bool = False) -> Column:
    """``parse_date`` written as ``yyyy-MM-dd`` text."""
    d = parse_unwrapped(c, two_digit_pivot) if unwrapped else parse_date(c, two_digit_pivot)
    return F.date_format(d, "yyyy-MM-dd")


def is_missing_timestamp(c: Column) -> Column:
    """Null, or blank after stripping."""
    return c.isNull() | (py_strip(c) == "")


def is_invalid_timestamp(c: Column, unwrapped: Column | str | None = None) -> Column:
    """Present and not blank, but no format parses it (``unwrapped``: staged ``unwrap(c)``)."""
    d = parse_date(c) if unwrapped is None else parse_unwrapped(unwrapped)
    return ~is_missing_timestamp(c) & d.isNull()


def week_end(d: Column) -> Column:
    """The Sunday that closes the (Monday..Sunday) week holding ``d``."""
    return F.date_add(F.to_date(F.date_trunc("week", d)), 6)
