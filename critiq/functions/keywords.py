"""Substring keyword tests shared by the audit, the imputer, the classifier and
the validator.

All tests are plain substring tests (``contains``), never word tests, so
"app" is found in "happy".  They compile to JVM ``contains`` calls inside
whole-stage codegen; no Python runs per row.

Given a column *name*, the expression is written as SQL text and parsed once
by ``F.expr`` (one call into the JVM); building the same tree node by node
from Python costs one call per node, which for ~165 keyword tests is seconds
of driver time per plan.  Operators stage the tested text as a named column
and pass its name.
"""
from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_string(s: str) -> str:
    """A Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_ref(name: str) -> str:
    """A Spark SQL column reference."""
    return "`" + name.replace("`", "``") + "`"


def contains_any_sql(name: str, words) -> str:
    ref = sql_ref(name)
    return "(" + " OR ".join(f"contains({ref}, {sql_string(w)})" for w in dict.fromkeys(words)) + ")"


def keyword_count_sql(name: str, words) -> str:
    ref = sql_ref(name)
    return "(" + " + ".join(f"(CASE WHEN contains({ref}, {sql_string(w)}) THEN {n} ELSE 0 END)"
                            for w, n in Counter(words).items()) + ")"


def contains_any(text: Column | str, words) -> Column:
    """True when ``text`` contains at least one of ``words`` (null when text is null)."""
    if isinstance(text, str):
        return F.expr(contains_any_sql(text, words))
    return reduce(lambda a, b: a | b, [text.contains(w) for w in dict.fromkeys(words)])


def keyword_count(text: Column | str, words) -> Column:
    """Number of list entries contained in ``text``; a word listed twice counts twice."""
    if isinstance(text, str):
        return F.expr(keyword_count_sql(text, words))
    terms = [F.when(text.contains(w), F.lit(n)).otherwise(F.lit(0))
             for w, n in Counter(words).items()]
    return reduce(lambda a, b: a + b, terms)
