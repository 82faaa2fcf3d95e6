"""A fast subset of the registered queries against their DuckDB oracle at sf0.001."""
import os

import duckdb
import pytest

from critiq.plans.registry import oracle_sql, queries

SUBSET = ["audit", "cleaning_log", "normalize_text", "parse_date", "classify_confidence",
          "validated", "corrections_log", "response_merge", "xtab_category", "trend_status",
          "recommendations", "exec_kpis", "audit_actions", "duplicate_text"]


def _norm(rows):
    def n(v):
        return round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in ["events", "documents"]:
        c.sql(f"create view {t} as select * from '{os.path.join(sf, t)}.parquet'")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_against_oracle(spark, sf, con, name):
    df = queries()[name](spark, sf)
    res = con.sql(oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(res.columns)
    got = _norm(df.select(*cols).collect())
    want = _norm(con.sql(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({oracle_sql()[name]})").fetchall())
    assert got == want
