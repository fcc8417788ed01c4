"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import pytest

from conftest import DATA, by_duckdb, plain
from ledgerspark.plans import catalogue

SMALL = str(DATA / "sf0.001")


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, name):
    ours = catalogue.queries()[name](spark, SMALL).toPandas()
    theirs = by_duckdb(catalogue.oracle_sql()[name], SMALL)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_runs(spark, name):
    assert catalogue.queries()[name](spark, SMALL).count() >= 0
