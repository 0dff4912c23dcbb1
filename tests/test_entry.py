"""Driver contract and a cross-check of a few queries against their DuckDB oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE

TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "route_id" in df.columns


def test_every_query_has_an_oracle():
    from headway.plans.catalog import QUERIES
    from headway.plans.oracle import ORACLE

    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_works_without_the_optional_subpackage(monkeypatch):
    monkeypatch.setattr(E, "find_spec", lambda name: None)
    from headway.plans.catalog import QUERIES

    assert set(E.queries()) == set(QUERIES) == set(E.oracle_sql())


def test_entry_works_where_the_optional_subpackage_cannot_be_imported(monkeypatch):
    import sys

    from headway.plans.catalog import QUERIES

    monkeypatch.setattr(E, "find_spec", lambda name: name)
    for name in [n for n in sys.modules if n.startswith("headway.llm")] + ["headway.llm.queries"]:
        monkeypatch.setitem(sys.modules, name, None)  # as if what it needs were not installed
    assert set(E.queries()) == set(QUERIES) == set(E.oracle_sql())


@pytest.mark.parametrize("name", ["route_performance", "stop_performance", "event_window_impact", "risk_forecast",
                                  "mart_reconciliation", "coverage_strict"])
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMOKE, t)}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    df = E.queries()[name](spark, SMOKE)
    got = [tuple(r[c] for c in cols) for r in df.collect()]

    def norm(rows):
        return sorted(tuple("NULL" if v is None else (round(v, 6) if isinstance(v, float) else str(v)) for v in r) for r in rows)

    assert sorted(df.columns) == sorted(cols)
    assert norm(got) == norm(want)
