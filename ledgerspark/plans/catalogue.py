"""All registered queries of the ledger library."""

from __future__ import annotations

from ledgerspark.plans import cost_queries, deep_queries, graph_queries, label_queries, ledger_queries, market_queries, reconcile_queries, scanner_queries, selection_queries, sequence_queries, source_queries, stream_queries  # noqa: F401
from ledgerspark.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
