"""Sliding windows with sums and distinct members, as a sweep over enter and leave events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.functions.prefix import prefix_sums
from ledgerspark.functions.rows import rows


def sliding(df: DataFrame, key: str, ts: str, value: str, member: str, width: int) -> DataFrame:
    """(key, ts, total, members): for each time with a row, sum and distinct members over ``[ts - width, ts]``.

    ``ts`` is whole numbers. A value enters at its time and leaves ``width + 1`` later; a
    member leaves then or when it comes again, whichever is first. Running sums of these
    events are the windows: linear in the rows, without sets and without joins of rows, and
    a hot key is spread by ``prefix_sums``.
    """
    once = df.groupBy(key, member, ts).agg(F.sum(value).alias("_v"))
    again = F.lead(ts).over(Window.partitionBy(key, member).orderBy(ts))
    gone = F.col(ts) + width + 1
    spans = once.select(key, F.col(ts).alias("_t"), "_v", gone.alias("_gone"), F.least(F.coalesce(again, gone), gone).alias("_left"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    events = spans.select(
        key,
        rows(
            ["_at", "_sum", "_n", "_rows"],
            (F.col("_t"), F.col("_v"), one, one),
            (F.col("_gone"), -F.col("_v"), zero, zero),
            (F.col("_left"), F.col("_v") * 0, -one, zero),
        ),
    )
    points = events.groupBy(key, "_at").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), F.sum("_rows").alias("_rows"))
    span = max(256, width)
    running = prefix_sums(prefix_sums(points, key, "_at", "_sum", "total", span), key, "_at", "_n", "members", span)
    return running.filter("_rows > 0").select(key, F.col("_at").alias(ts), "total", "members")


def best_window(windows: DataFrame, key: str, ts: str, least: int, members: int) -> DataFrame:
    """The largest window of each key with both thresholds met; of equal ones the earliest. Thresholds are inclusive."""
    good = windows.filter((F.col("total") >= least) & (F.col("members") >= members))
    top = F.max(F.struct("total", (-F.col(ts)).alias("before"), "members")).alias("top")
    return good.groupBy(key).agg(top).select(key, (-F.col("top.before")).alias("window_end"), F.col("top.total").alias("total"), F.col("top.members").alias("members"))
