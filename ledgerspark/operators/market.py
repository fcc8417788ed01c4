"""Prices on transfers: as-of joins, bars, closes and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.ranges import by_ranges, last_known

def beside_series(rows: DataFrame, series: DataFrame, key: str) -> DataFrame:
    """Rows and ``series`` (unique ``key``) in one table by ranges: ``_row`` (null for the series), ``_at`` (null for rows), ``_tie``.

    A row comes after the series' entry of its own key. Ties are split by a digest of the row.
    """
    left = rows.select(F.col(key), F.struct(*rows.columns).alias("_row"))
    left = left.withColumn("_tie", F.xxhash64("_row")).withColumn("_after", F.lit(1))
    at = F.struct(*series.columns)
    right = series.select(F.col(key), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.lit(0).cast("long").alias("_tie"), F.lit(0).alias("_after"), at.alias("_at"))
    both = left.withColumn("_at", F.lit(None).cast(right.schema["_at"].dataType)).unionByName(right)
    return by_ranges(both, key, "_after", "_tie")


def asof(rows: DataFrame, series: DataFrame) -> DataFrame:
    """Adds ``price``, the last of ``series`` (ts, price; unique ts) at or before each row's ``ts``; before the first bar, the first."""
    found = last_known(beside_series(rows, series, "ts"), ["ts", "_after", "_tie"], F.col("_at"), "_bar").filter("_row is not null")
    opening = series.agg(F.min_by("price", "ts").alias("_first"))
    # One row.
    return found.join(F.broadcast(opening)).select("_row.*", F.coalesce("_bar.price", "_first").alias("price"))


def interpolated(rows: DataFrame, anchors: DataFrame, key: str, value: str, extrapolate: bool = False) -> DataFrame:
    """Adds ``value`` to rows by the line between the nearest ``anchors`` (unique key, value) on either side, rounded down.

    Beyond the first and last anchor the value is theirs, or, with ``extrapolate``, on the line through the two outermost.
    """
    order = [key, "_after", "_tie"]
    both = beside_series(rows, anchors.select(key, value), key)
    found = last_known(last_known(both, order, F.when(F.col("_at").isNotNull(), F.col("_at")), "_lo", strict=True), order, F.col("_at"), "_hi", strict=True, backward=True)
    ends = anchors.agg(*[f(F.struct(key, value)).alias(n) for f, n in ((F.min, "_first"), (F.max, "_last"))])
    second = anchors.join(F.broadcast(ends)).agg(F.min(F.when(F.col(key) > F.col(f"_first.{key}"), F.struct(key, value))).alias("_second"), F.max(F.when(F.col(key) < F.col(f"_last.{key}"), F.struct(key, value))).alias("_penult"))
    # Both are one row.
    found = found.filter("_row is not null").join(F.broadcast(ends)).join(F.broadcast(second))
    line = lambda a, b: F.col(f"{a}.{value}") + F.floor((F.col(f"{b}.{value}") - F.col(f"{a}.{value}")) * (F.col(key) - F.col(f"{a}.{key}")) / F.greatest(F.col(f"{b}.{key}") - F.col(f"{a}.{key}"), F.lit(1)))
    low, high = F.col(f"_first.{value}"), F.col(f"_last.{value}")
    if extrapolate:
        low, high = F.coalesce(line("_first", "_second"), low), F.coalesce(line("_penult", "_last"), high)
    exact = F.when(F.col(f"_lo.{key}") == F.col(key), F.col(f"_lo.{value}"))
    inside = F.when(F.col("_lo").isNull(), low).when(F.col("_hi").isNull(), high).otherwise(line("_lo", "_hi"))
    return found.select("_row.*", F.coalesce(exact, inside).cast("long").alias(value))


def in_bars(rows: DataFrame, bars: DataFrame, width: int) -> DataFrame:
    """Rows with the ``price`` of the bar (bar, price) that covers their ``ts``: ``bar <= ts < bar + width``; bars start at multiples of the width."""
    return rows.withColumn("bar", F.floor(F.col("ts") / width) * width).join(bars.select("bar", "price"), "bar", "left")


def on_grid(changes: DataFrame, key: str, at: str, value: str, step: int) -> DataFrame:
    """(key, at, value): the last known value of each key at every multiple of ``step`` from its first change to the last of all."""
    end = changes.agg(F.max(at).alias("_end"))
    spans = changes.groupBy(key).agg(F.min(at).alias("_begin")).join(F.broadcast(end))
    up = lambda c: F.ceil(F.col(c) / step) * step
    points = spans.filter(up("_begin") <= F.col("_end")).select(key, F.explode(F.sequence(up("_begin").cast("long"), F.col("_end").cast("long"), F.lit(step).cast("long"))).alias(at))
    both = points.select(key, at, F.lit(None).cast(changes.schema[value].dataType).alias(value), F.lit(1).alias("_after")).unionByName(changes.select(key, at, value, F.lit(0).alias("_after")))
    known = last_known(by_ranges(both, key, at, "_after"), [at, "_after"], F.col(value), "_known", key)
    return known.filter("_after = 1").select(key, at, F.col("_known").alias(value))


def bars(ticks: DataFrame, width: int) -> DataFrame:
    """(bar, price, n): last price of each bar of ``width`` seconds by (ts, seq)."""
    return ticks.groupBy((F.floor(F.col("ts") / width) * width).alias("bar")).agg(F.max_by("price", F.struct("ts", "seq")).alias("price"), F.count("*").alias("n"))


def compare(a: DataFrame, b: DataFrame, warn_pct: int = 5, fail_pct: int = 15) -> DataFrame:
    """(bar, a, b, verdict): symmetric deviation of two series; SKIP where one has no price."""
    both = a.select("bar", F.col("price").alias("a")).join(b.select("bar", F.col("price").alias("b")), "bar", "full")
    gap, total = F.abs(F.col("a") - F.col("b")) * 200, F.col("a") + F.col("b")
    verdict = F.when(F.col("a").isNull() | F.col("b").isNull(), "SKIP").when(gap > total * fail_pct, "FAIL").when(gap > total * warn_pct, "WARN").otherwise("OK")
    return both.withColumn("verdict", verdict)
