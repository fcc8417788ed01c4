"""Waves: accounts that build up together, found greedily from dense windows of first days, and merged by their joint peak.

The greedy choice runs over days: the driver holds counts and sums of individual peaks for each day (one row a
day, whatever the number of accounts) and asks Spark for the joint peaks of all candidate windows at once.
"""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Wave = tuple[int, int]


def day_flows(daily: DataFrame, summary: DataFrame) -> DataFrame:
    """(first_day, day, delta): changes of all accounts that first were meaningful on one day, added up. Days by days."""
    first = summary.filter("first_day is not null and peak > 0").select("addr", "first_day")
    return daily.join(first, "addr").groupBy("first_day", "day").agg(F.sum("delta").alias("delta"))


def window_peaks(flows: DataFrame, days: int, windows: list[int]) -> dict[int, int]:
    """Largest sum of the balances of the accounts whose first day lies in each window of ``days`` days that begins on one of the given days, in one job."""
    starts = F.sequence(F.col("first_day") - days + 1, F.col("first_day"))
    each = flows.select(F.explode(starts).alias("window"), "day", "delta").filter(F.col("window").isin(windows))
    per = each.groupBy("window", "day").agg(F.sum("delta").alias("delta"))
    # One row a day in each window.
    held = per.select("window", F.sum("delta").over(Window.partitionBy("window").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)).alias("held"))
    return {r["window"]: int(r["peak"] or 0) for r in held.groupBy("window").agg(F.max("held").alias("peak")).collect()}


def grown(count: dict[int, int], low: int, high: int, most_days: int, gap: int) -> Wave:
    """The window widened a day at a time on each side as long as a member lies within ``gap`` days beyond it."""
    while high - low + 1 < most_days:
        left = any(count.get(low - 1 - g) for g in range(gap))
        right = any(count.get(high + 1 + g) for g in range(gap))
        if not (left or right):
            break
        low -= left
        high += right and high - low + 1 < most_days
    return low, high


def find(flows: DataFrame, summary: DataFrame, least_peak: int, days: int = 10, members: int = 20, most_days: int = 45, gap: int = 3) -> list[tuple[int, int, Wave]]:
    """(first day, last day, seed) of each wave. Seeds are taken by most members, of equal ones the latest.

    A window is a seed if it has enough members and their joint peak reaches ``least_peak``; the
    sum of their single peaks bounds it, so most windows need no joint peak.
    """
    rows = summary.filter("first_day is not null and peak > 0").groupBy("first_day").agg(F.count("*").alias("n"), F.sum("peak").alias("peak")).collect()
    count, peaks = {r["first_day"]: r["n"] for r in rows}, {r["first_day"]: int(r["peak"]) for r in rows}
    inside = lambda d, of: sum(of.get(d + k, 0) for k in range(days))
    waves: list[tuple[int, int, Wave]] = []
    joint: dict[int, int] = {}
    while True:
        # Of the windows with enough members and single peaks, those whose members changed have no joint peak yet.
        able = sorted(((inside(d, count), d) for d in count if inside(d, count) >= members and inside(d, peaks) >= least_peak), reverse=True)
        if new := [d for _, d in able if d not in joint]:
            taken = sorted(d for low, high, _ in waves for d in range(low, high + 1))
            joint |= window_peaks(flows.filter(~F.col("first_day").isin(taken)) if taken else flows, days, new)
        seed = next((d for _, d in able if joint.get(d, 0) >= least_peak), None)
        if seed is None:
            return waves
        low, high = grown(count, seed, seed + days - 1, most_days, gap)
        for d in range(low, high + 1):
            count.pop(d, None)
            peaks.pop(d, None)
        joint = {d: x for d, x in joint.items() if d + days - 1 < low or d > high}
        waves.append((low, high, (seed, seed + days - 1)))


def merged(flows: DataFrame, waves: list[tuple[int, int, Wave]], gap: int = 7, gain_pct: int = 115) -> list[tuple[int, int, int, Wave]]:
    """(first day, last day, peak, seed): neighbours become one if their joint peak exceeds both by the gain, again until none does.

    Members are the accounts whose first day lies in a wave; days between two merged waves belong to none. Of two seeds that of the higher wave stays.
    """
    spans = flows.sparkSession.createDataFrame([(low, high) for low, high, _ in waves], "low long, high long")
    # One row for each wave and day on which it changed, whatever the number of accounts.
    rows = flows.join(F.broadcast(spans), F.col("first_day").between(F.col("low"), F.col("high"))).groupBy("low", "day").agg(F.sum("delta").alias("delta")).collect()
    moves: dict[int, Counter] = {low: Counter() for low, _, _ in waves}
    for r in rows:
        moves[r["low"]][r["day"]] = int(r["delta"])

    def peak(change: Counter) -> int:
        return max(accumulate(change[d] for d in sorted(change)), default=0)

    def total(a: Counter, b: Counter) -> Counter:
        return Counter({d: a[d] + b[d] for d in a.keys() | b.keys()})

    parts = [(low, high, moves[low], peak(moves[low]), seed, peak(moves[low])) for low, high, seed in sorted(waves)]
    at = 0
    while at + 1 < len(parts):
        a, b = parts[at], parts[at + 1]
        both = total(a[2], b[2])
        if b[0] - a[1] <= gap and peak(both) * 100 > max(a[3], b[3]) * gain_pct:
            parts[at : at + 2] = [(a[0], b[1], both, peak(both), *(a[4:] if a[5] >= b[5] else b[4:]))]
            at = 0
        else:
            at += 1
    return [(low, high, most, seed) for low, high, _, most, seed, _ in parts]


def waves(daily: DataFrame, summary: DataFrame, least_peak: int, **options) -> DataFrame:
    """(first_day, last_day, members, peak, seed_day, cleared, partial, retained) of each wave, merged ones as one."""
    from ledgerspark.functions.shared import checkpointed
    from ledgerspark.operators.scanners import retention_bucket

    spark = daily.sparkSession
    summary = checkpointed(summary.select("addr", "peak", "final", "first_day"))
    flows = checkpointed(day_flows(daily, summary))
    found = find(flows, summary, least_peak, **options)
    schema = "first_day long, last_day long, peak decimal(38,0), seed_day long"
    spans = spark.createDataFrame([(low, high, Decimal(peak), seed[0]) for low, high, peak, seed in merged(flows, found)], schema)
    parts = spark.createDataFrame([(low, high) for low, high, _ in found], "low long, high long")
    # A few waves: broadcast.
    own = summary.filter("first_day is not null and peak > 0").join(F.broadcast(parts), F.col("first_day").between(F.col("low"), F.col("high")))
    own = own.withColumnRenamed("first_day", "day").drop("peak_").join(F.broadcast(spans.withColumnRenamed("peak", "joint")), F.col("day").between(F.col("first_day"), F.col("last_day")))
    bucket = retention_bucket(F.col("final"), F.col("peak"))
    counts = [F.count_if(bucket == b).alias(b) for b in ("cleared", "partial", "retained")]
    return own.groupBy("first_day", "last_day", F.col("joint").alias("peak"), "seed_day").agg(F.count("*").alias("members"), *counts)
