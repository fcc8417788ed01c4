"""Register of queries over the standard tables and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None, *common: str) -> Callable[[Query], Query]:
    """Register the function under its name; ``common``: table expressions that ``sql`` builds on."""

    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            body = sql.strip()
            if common:
                shared = ",".join(c.strip() for c in common)
                body = f"WITH {shared}, {body[5:].lstrip()}" if body.startswith("WITH ") else f"WITH {shared} {body}"
            ORACLES[query.__name__] = body
        return query

    return add


def longs(df: DataFrame, *columns: str) -> DataFrame:
    """Casts the columns to long for the result."""
    return df.withColumns({c: df[c].cast("long") for c in columns})
