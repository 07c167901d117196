"""The registered queries: every one has a callable, every SQL a query, and the flagship runs."""

from __future__ import annotations

import __spark_entry__ as entry


def test_registered():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 100
    assert all(map(callable, queries.values()))


def test_the_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
