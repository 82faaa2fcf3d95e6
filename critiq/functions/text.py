"""Text column builders: stripping, cleaning, pattern keys, predicates, summaries.

Regular expressions run in Java.  ``WS`` is the exact set of characters that
Python's ``str.isspace`` (and so ``str.strip`` and ``\\s``) treats as white
space; Spark's ``trim`` strips only the space character and Java's ``\\s``
knows six characters, so the class is spelled out.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .keywords import contains_any

WS_BODY = r"\t-\r\x1c-\x20\x85\p{Z}"
WS = "[" + WS_BODY + "]"
# The same set as characters (Python's definition of white space), for trim.
WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def py_strip(c: Column) -> Column:
    """``str.strip()``: remove leading and trailing white space (a character-set
    trim, no regular expression)."""
    return F.trim(c, F.lit(WS_CHARS))


def clean_text(c: Column, stripped: Column | None = None) -> Column:
    """Strip, collapse inner white space runs to one space; null becomes ''."""
    s = py_strip(c) if stripped is None else stripped
    return F.coalesce(F.regexp_replace(s, WS + "+", " "), F.lit(""))


def is_meaningless(c: Column, stripped: Column | None = None) -> Column:
    """Missing, blank, too short, a placeholder, no ASCII letter/digit, or one repeated char.
    ``stripped``: a staged ``py_strip(c)`` column (referenced several times here)."""
    s = py_strip(c) if stripped is None else stripped
    low = F.lower(s)
    one_char = (F.length(F.replace(low, F.substring(low, 1, 1), F.lit(""))) == 0) & \
        (F.length(s) > K.MIN_TEXT_LENGTH - 1)
    test = ((F.length(s) < K.MIN_TEXT_LENGTH)
            | low.isin(K.PLACEHOLDER_TEXTS)
            | ~s.rlike("[a-zA-Z0-9]")
            | one_char)
    return F.when(c.isNull(), F.lit(True)).otherwise(test)


def _sub(p: str) -> str:
    """Write a pattern with ``\\s`` meaning Python white space, Unicode ``\\w \\d \\b``."""
    out, in_class, i = [], False, 0
    while i < len(p):
        ch = p[i]
        if ch == "\\":
            tok = p[i:i + 2]
            out.append((WS_BODY if in_class else WS) if tok == r"\s" else tok)
            i += 2
            continue
        if ch == "[":
            in_class = True
        elif ch == "]":
            in_class = False
        out.append(ch)
        i += 1
    return "(?iU)" + "".join(out)


def normalize_text(c: Column) -> Column:
    """Pattern key: boilerplate (agent, order number, city, repeat tags) and
    repeated punctuation removed.  Falls back to lower(strip(text)) when that
    leaves nothing; null becomes ''."""
    base = py_strip(F.lower(c))
    out = base
    for pattern, repl in K.NORMALISE_PATTERNS:
        out = F.regexp_replace(out, _sub(pattern), repl)
    out = py_strip(out)
    # nullif + coalesce keeps a single copy of the chain in the expression tree
    return F.coalesce(F.nullif(out, F.lit("")), base, F.lit(""))


def mentions_agent(c: Column) -> Column:
    """``agent <known name>`` anywhere, any case."""
    return F.coalesce(c.rlike(_sub(r"agent\s+(" + "|".join(K.AGENT_NAMES) + ")")), F.lit(False))


def mentions_order_number(c: Column) -> Column:
    """``order #123`` anywhere, any case, spaces allowed around ``#``."""
    return F.coalesce(c.rlike(_sub(r"order\s*#\s*\d+")), F.lit(False))


def is_multilingual(c: Column, lowered: str | None = None) -> Column:
    """Lower-cased text contains one of the foreign-language hint words."""
    t = F.lower(c) if lowered is None else lowered
    return F.coalesce(contains_any(t, K.FOREIGN_WORDS), F.lit(False))


_SUMMARY_PREFIX = "(?iU)^(" + "|".join(K.SUMMARY_PREFIXES) + r")\b"


def summary_line(c: Column) -> Column:
    """One-line summary: capitalise the first character when the text, minus a
    leading stock phrase, is longer than five characters; cut to 57 + '...'
    when longer than 60."""
    rest = py_strip(F.regexp_replace(c, _SUMMARY_PREFIX, ""))
    capital = F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))
    s = F.when(F.length(rest) > K.SUMMARY_MIN_REST, capital).otherwise(c)
    return F.when(F.length(s) > K.SUMMARY_MAX,
                  F.concat(F.substring(s, 1, K.SUMMARY_CUT), F.lit("..."))).otherwise(s)


def prettify_label(c: Column) -> Column:
    """``app_store`` -> ``App Store``."""
    return F.initcap(F.regexp_replace(c, "_", " "))


def slug(c: Column) -> Column:
    """``Limited by Source Data Quality`` -> ``limited-by-source-data-quality``."""
    return F.lower(F.regexp_replace(c, " ", "-"))
