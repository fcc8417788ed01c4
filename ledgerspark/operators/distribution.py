"""Shape of a holder distribution: concentration, histogram, equal balances, bumps."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def head_concentration(held: DataFrame) -> DataFrame:
    """One row: owners, sum, shares of the top 1, 3, 5 and 10, HHI and the ratio of the first two. ``held``: (addr, balance) above zero."""
    total = held.agg(F.count("*").alias("owners"), F.sum("balance").alias("total"))
    squares = held.join(F.broadcast(total.select("total"))).agg(F.sum(F.pow(F.col("balance").cast("double") / F.col("total").cast("double"), F.lit(2))).alias("hhi"))
    # Ten rows: the limit keeps ten of each task.
    top = held.orderBy(F.desc("balance"), "addr").limit(10).agg(F.sort_array(F.collect_list("balance"), asc=False).alias("top"))
    one = total.join(F.broadcast(squares)).join(F.broadcast(top))
    share = lambda k: F.aggregate(F.slice("top", 1, k), F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)")).cast("double") / F.col("total").cast("double")
    return one.select("owners", "total", share(1).alias("top1"), share(3).alias("top3"), share(5).alias("top5"), share(10).alias("top10"), "hhi", (F.get("top", F.lit(0)).cast("double") / F.get("top", F.lit(1)).cast("double")).alias("first_to_second"))


def bin_of(balance: Column, total: Column, least_ppm: int = 1, shift: float = 0.0) -> Column:
    """Number of the geometric bin (ratio sqrt 2) of a balance; 0 below ``least_ppm`` millionths of the total."""
    ratio = balance.cast("double") * 1_000_000 / (total.cast("double") * least_ppm)
    return F.when(ratio < 1, 0).otherwise(F.floor(F.log2(ratio) * 2 + shift) + 1).cast("long")


def equal_balances(held: DataFrame, least: int = 5) -> DataFrame:
    """(balance, owners, total): identical balances of several owners."""
    return held.groupBy("balance").agg(F.count("*").alias("owners"), F.sum("balance").alias("total")).filter(F.col("owners") >= least)


def partition(held: DataFrame, bucket: Column) -> DataFrame:
    """(bucket, owners, total): sums of the buckets, which cover every owner once."""
    return held.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("owners"), F.sum("balance").alias("total"))


def isotonic_down(values: list[float]) -> list[float]:
    """Least-squares non-increasing fit: neighbours that rise are pooled to their mean."""
    blocks: list[list[float]] = []
    for value in values:
        blocks.append([float(value), 1.0])
        while len(blocks) > 1 and blocks[-1][0] > blocks[-2][0]:
            mean, n = blocks.pop()
            last = blocks[-1]
            last[0], last[1] = (last[0] * last[1] + mean * n) / (last[1] + n), last[1] + n
    return [mean for mean, n in blocks for _ in range(int(n))]


def poisson_tail(count: float, expected: float) -> float:
    """P(X >= count) by the normal approximation with continuity correction."""
    if expected <= 0:
        return 0.0 if count > 0 else 1.0
    return 0.5 * math.erfc((count - 0.5 - expected) / math.sqrt(expected) / math.sqrt(2))


def holm(p_values: list[float], alpha: float = 0.01) -> list[bool]:
    """Which hypotheses a step-down family test rejects."""
    out, m = [False] * len(p_values), len(p_values)
    for rank, k in enumerate(sorted(range(m), key=lambda k: (p_values[k], k))):
        if p_values[k] > alpha / (m - rank):
            break
        out[k] = True
    return out


def _runs(flags: list[bool]) -> list[tuple[int, int]]:
    """First and last place of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], np.array(flags, dtype=np.int8), [0]))))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def bumps(held: DataFrame, alpha: float = 0.01, least_owners: int = 5, least_pct: float = 2.0, overlap: float = 0.8, least_sample: int = 100, least_ppm: int = 1) -> DataFrame:
    """(verdict, first_bin, last_bin, owners, share): bins that rise above a falling curve in both of two binnings.

    The histograms are aggregated by Spark; only their bins (some sixty, whatever the number
    of owners) come to the driver for the fit. A bump counts if the half-shifted binning
    finds one whose owners agree with it to ``overlap`` by Jaccard.
    """
    spark = held.sparkSession
    schema = "verdict string, first_bin long, last_bin long, owners long, share double"
    total = held.agg(F.sum("balance").alias("total"))
    binned = held.join(F.broadcast(total)).select("addr", "balance", "total", bin_of(F.col("balance"), F.col("total"), least_ppm).alias("b0"), bin_of(F.col("balance"), F.col("total"), least_ppm, 0.5).alias("b1"))
    cells = binned.groupBy("b0", "b1").agg(F.count("*").alias("n"), F.sum(F.col("balance").cast("double") / F.col("total").cast("double")).alias("share")).collect()
    owners = sum(c["n"] for c in cells)
    if owners < least_sample:
        return spark.createDataFrame([("NOT_EVALUABLE", None, None, owners, None)], schema)

    def found(name: str) -> list[tuple[int, int]]:
        top = max(c[name] for c in cells)
        counts = [sum(c["n"] for c in cells if c[name] == k) for k in range(1, top + 1)]
        fit = isotonic_down(counts)
        hit = holm([poisson_tail(n, e) if n > e else 1.0 for n, e in zip(counts, fit, strict=True)], alpha)
        return [(a + 1, b + 1) for a, b in _runs(hit)]

    inside = lambda c, name, run: run[0] <= c[name] <= run[1]
    out = []
    shifted = found("b1")
    for run in found("b0"):
        own = [c for c in cells if inside(c, "b0", run)]
        n, share = sum(c["n"] for c in own), sum(c["share"] for c in own)
        alike = 0.0
        for other in shifted:
            both = sum(c["n"] for c in own if inside(c, "b1", other))
            either = n + sum(c["n"] for c in cells if inside(c, "b1", other)) - both
            alike = max(alike, both / either if either else 0.0)
        if n >= least_owners and share * 100 >= least_pct and alike >= overlap:
            out.append(("ABNORMAL", run[0], run[1], n, share))
    return spark.createDataFrame(out or [("NORMAL", None, None, owners, None)], schema)
