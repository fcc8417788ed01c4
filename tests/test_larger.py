"""Queries against their SQL on tables that have what only larger ones have."""

from __future__ import annotations

import duckdb
import pytest

from conftest import DATA, TABLES, by_duckdb, plain
from ledgerspark.plans import catalogue

SMALL = DATA / "sf0.001"


def altered(folder, **tables: str) -> str:
    """The small tables in ``folder``, those named as SQL over the small ones."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    for name in TABLES:
        con.execute(f"COPY ({tables.get(name, f'FROM {name}')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


def same(spark, name: str, folder: str) -> int:
    """Number of rows of the query, which must equal those of its SQL."""
    ours, theirs = catalogue.queries()[name](spark, folder).toPandas(), by_duckdb(catalogue.oracle_sql()[name], folder)
    assert plain(ours) == plain(theirs)
    return len(ours)


@pytest.mark.parametrize(("events", "rows"), [
    # The start itself is a busy sender, so the walk ends there.
    ("SELECT event_id, ts, CASE WHEN event_id < 60 THEN 7 ELSE user_id END AS user_id, event_type, value, CASE WHEN event_id < 60 THEN '{\"k\": ' || event_id || '}' ELSE props END AS props FROM events", 1),
    # One account reaches the start by a transfer of nothing alone.
    ("SELECT * FROM (FROM events LIMIT 1) UNION ALL BY NAME SELECT 1000 AS event_id, TIMESTAMP '2024-01-02' AS ts, 99 AS user_id, 'view' AS event_type, 0.0 AS value, '{\"k\": 7}' AS props", 2),
])
def test_ancestors_of_a_busy_start_and_through_nothing(spark, tmp_path, events, rows):
    assert same(spark, "ancestors_bfs", altered(tmp_path, events=events)) == rows


def test_waves_derive_the_ledger_once(spark, monkeypatch):
    from ledgerspark.plans import deep_queries

    calls, derived = [], deep_queries.trade_ledger
    monkeypatch.setattr(deep_queries, "trade_ledger", lambda *a: calls.append(a) or derived(*a))
    catalogue.queries()["wave_segments"](spark, str(SMALL))
    assert len(calls) == 1


def test_stability_replays_once(spark, monkeypatch):
    from ledgerspark.operators import provenance

    done, kept = [], __import__("ledgerspark.functions.shared", fromlist=["checkpointed"])
    real = kept.checkpointed
    found = spark.createDataFrame([("e", p, "MINT", 5.0) for p in provenance.POLICIES], "entity string, policy string, kind string, amount double")
    monkeypatch.setattr(kept, "checkpointed", lambda df: done.append(df.columns) or real(df))
    one = provenance.stability(found, spark.createDataFrame([("e", 5)], "entity string, balance long"), spark.createDataFrame([(5,)], "net long")).first()
    assert (one["agree"], one["stable"], one["fifo"]) == (True, True, "MINT") and done == [found.columns]
