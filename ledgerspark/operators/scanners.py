"""Mechanical scanners: address summaries, universes, seed windows, feeders, equal amounts, sinks and sprays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.functions.prefix import prefix_sums
from ledgerspark.functions.sliding import best_window, sliding
from ledgerspark.sources.adapters import SINKS


def closes(daily: DataFrame) -> DataFrame:
    """(addr, day, close) from daily deltas."""
    return prefix_sums(daily.select("addr", "day", "delta"), "addr", "day", "delta", "close").drop("delta")


def summaries(daily: DataFrame, num: int = 1, den: int = 2) -> DataFrame:
    """(addr, peak, peak_day, least, final, last_day, first_day): ``first_day`` is the first close of at least num/den of the peak."""
    series = closes(daily)
    sums = series.groupBy("addr").agg(
        F.max("close").alias("peak"), F.max_by("day", F.struct("close", -F.col("day"))).alias("peak_day"), F.min("close").alias("least"), F.max_by("close", "day").alias("final"), F.max("day").alias("last_day")
    )
    reached = series.join(sums.select("addr", "peak"), "addr").filter((F.col("peak") > 0) & (F.col("close") * den >= F.col("peak") * num))
    return sums.join(reached.groupBy("addr").agg(F.min("day").alias("first_day")), "addr", "left")


def retention_bucket(final, peak) -> F.Column:
    """cleared below a tenth of the peak, partial up to a half, else retained."""
    return F.when(final * 10 < peak, "cleared").when(final * 2 <= peak, "partial").otherwise("retained")


def universe(summary: DataFrame, net_supply: DataFrame, last_block: DataFrame, bps: int = 2, top: int = 200, must_bps: int = 10, drawdown_pct: int = 80, dormant_days: int = 30) -> DataFrame:
    """(addr, peak, final, reasons): accounts whose peak reaches ``bps`` of the supply, with the reasons to judge them."""
    listed = summary.filter(~F.col("addr").isin(*SINKS)).join(F.broadcast(net_supply.select("net")), F.col("peak") * 10_000 >= F.col("net") * bps)
    listed = listed.join(F.broadcast(last_block.select(F.col("last").alias("now"))))
    # A limit keeps ``top`` rows of each task; no task sorts all accounts.
    first = summary.filter(~F.col("addr").isin(*SINKS)).orderBy(F.desc("peak"), "addr").limit(top).select("addr", F.lit(True).alias("in_top"))
    listed = listed.join(F.broadcast(first), "addr", "left")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("in_top"), "top"),
            F.when(F.col("peak") * 10_000 >= F.col("net") * must_bps, "large"),
            F.when((F.col("peak") - F.col("final")) * 100 >= F.col("peak") * drawdown_pct, "drawdown"),
            F.when(F.col("now") - F.col("last_day") >= dormant_days, "dormant"),
        )
    )
    return listed.select("addr", "peak", "final", reasons.alias("reasons"))


def seed_windows(summary: DataFrame, days: int) -> DataFrame:
    """(day, members): accounts whose first meaningful day lies in ``[day, day + days)``, for every such day."""
    counts = summary.filter("first_day is not null").groupBy(F.col("first_day").alias("day")).agg(F.count("*").alias("n"))
    # One row a day, whatever the number of accounts.
    return counts.select("day", F.sum("n").over(Window.orderBy("day").rangeBetween(0, days - 1)).alias("members"))


def combined(daily: DataFrame, members: DataFrame, group: str) -> DataFrame:
    """(group, peak, peak_day, final) of the summed balances of each group of accounts."""
    days = daily.join(members, "addr").groupBy(group, "day").agg(F.sum("delta").alias("delta"))
    series = prefix_sums(days, group, "day", "delta", "close")
    return series.groupBy(group).agg(F.max("close").alias("peak"), F.max_by("day", F.struct("close", -F.col("day"))).alias("peak_day"), F.max_by("close", "day").alias("final"))


def feeders(pairs: DataFrame, share_pct: int = 90, out_degree: int = 2) -> DataFrame:
    """(addr, feeder, v, total, degree): accounts that got at least the share from one sender of few recipients."""
    real = pairs.filter(~F.col("frm").isin(*SINKS) & (F.col("frm") != F.col("dst")))
    top = real.groupBy(F.col("dst").alias("addr")).agg(F.sum("v").alias("total"), F.max(F.struct("v", "frm")).alias("top"))
    rich = top.select("addr", F.col("top.frm").alias("feeder"), F.col("top.v").alias("v"), "total").filter(F.col("v") * 100 >= F.col("total") * share_pct)
    degree = real.groupBy(F.col("frm").alias("feeder")).agg(F.count("*").alias("degree")).filter(F.col("degree") <= out_degree)
    return rich.join(degree, "feeder")


def peak_to_target(daily: DataFrame, summary: DataFrame, pct: int = 30) -> DataFrame:
    """(addr, days): days from the peak to the first later close of at most ``pct`` percent of it; null if never."""
    tops = summary.filter("peak > 0").select("addr", "peak", "peak_day")
    after = closes(daily).join(tops, "addr").filter((F.col("day") > F.col("peak_day")) & (F.col("close") * 100 <= F.col("peak") * pct))
    fell = after.groupBy("addr").agg(F.min("day").alias("at"))
    return tops.join(fell, "addr", "left").select("addr", (F.col("at") - F.col("peak_day")).alias("days"))


def equal_amounts(transfers: DataFrame, amount: str, day: str, width: int = 7, recipients: int = 20, least_amount: int = 1, least_total: int = 1) -> DataFrame:
    """(amount, window_end, recipients, total, all_recipients, top_sender): amounts sent to many accounts within a few days.

    The densest window counts, of equal ones the earliest; the top sender has most distinct
    recipients of the amount, of equal ones the largest name.
    """
    rows = transfers.filter((F.col(amount) >= least_amount) & (F.col("frm") != F.col("dst")) & ~F.col("dst").isin(*SINKS)).select(F.col(amount).alias("amount"), "frm", "dst", F.col(day).alias("day"))
    # Only amounts with enough recipients at all enter the windows.
    by_dst = rows.groupBy("amount", "dst").agg(F.count("*").alias("n"))
    able = by_dst.groupBy("amount").agg(F.count("*").alias("all_recipients"), F.sum("n").alias("n")).withColumn("total", F.col("amount") * F.col("n"))
    able = able.filter((F.col("all_recipients") >= recipients) & (F.col("total") >= least_total)).drop("n")
    ones = rows.join(able.select("amount"), "amount", "left_semi").withColumn("one", F.lit(1).cast("long"))
    dense = sliding(ones, "amount", "day", "one", "dst", width - 1)
    top = dense.groupBy("amount").agg(F.max(F.struct("members", (-F.col("day")).alias("before"))).alias("top"))
    top = top.select("amount", F.col("top.members").alias("recipients"), (-F.col("top.before")).alias("window_end")).filter(F.col("recipients") >= recipients)
    senders = rows.groupBy("amount", "frm", "dst").agg(F.lit(1).alias("one")).groupBy("amount", "frm").agg(F.count("*").alias("n"))
    best = senders.groupBy("amount").agg(F.max(F.struct("n", "frm")).alias("best")).select("amount", F.col("best.frm").alias("top_sender"))
    return top.join(able, "amount").join(best, "amount")


def real_flows(transfers: DataFrame) -> DataFrame:
    """Positive transfers between different accounts, neither of which is a sink."""
    return transfers.filter((F.col("v") > 0) & (F.col("frm") != F.col("dst")) & ~F.col("frm").isin(*SINKS) & ~F.col("dst").isin(*SINKS))


def sinks(transfers: DataFrame, ts: str, width: int, least: int, sources: int) -> DataFrame:
    """(addr, window_end, total, members, net_inflow): accounts that took at least ``least`` from ``sources`` senders in one window."""
    flows = real_flows(transfers)
    # An account below the threshold over all time has no window above it.
    able = flows.groupBy("dst").agg(F.sum("v").alias("all")).filter(F.col("all") >= least).select("dst")
    best = best_window(sliding(flows.join(able, "dst", "left_semi"), "dst", ts, "v", "frm", width), "dst", ts, least, sources)
    sent = flows.groupBy(F.col("frm").alias("dst")).agg(F.sum("v").alias("sent"))
    got = flows.groupBy("dst").agg(F.sum("v").alias("got"))
    return best.join(got, "dst").join(sent, "dst", "left").select(F.col("dst").alias("addr"), "window_end", "total", "members", (F.col("got") - F.coalesce("sent", F.lit(0))).alias("net_inflow"))


def sprays(transfers: DataFrame, ts: str, width: int, least: int, recipients: int, fresh_only: bool = False) -> DataFrame:
    """(addr, window_end, total, members): accounts that paid at least ``least`` to ``recipients`` accounts in one window.

    ``fresh_only``: only an account's first receipt ever makes it a recipient.
    """
    flows = real_flows(transfers)
    if fresh_only:
        first = flows.groupBy("dst").agg(F.min(ts).alias("_first"))
        flows = flows.join(first, "dst").filter(F.col(ts) == F.col("_first")).drop("_first")
    able = flows.groupBy("frm").agg(F.sum("v").alias("all")).filter(F.col("all") >= least).select("frm")
    best = best_window(sliding(flows.join(able, "frm", "left_semi"), "frm", ts, "v", "dst", width), "frm", ts, least, recipients)
    return best.withColumnRenamed("frm", "addr")


def slow_sprays(transfers: DataFrame, least: int, recipients: int) -> DataFrame:
    """(addr, total, members): accounts that paid enough to enough recipients over all time."""
    pairs = real_flows(transfers).groupBy("frm", "dst").agg(F.sum("v").alias("v"))
    return pairs.groupBy(F.col("frm").alias("addr")).agg(F.sum("v").alias("total"), F.count("*").alias("members")).filter((F.col("total") >= least) & (F.col("members") >= recipients))
