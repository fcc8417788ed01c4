"""Documented methods: fingerprints of groups, market states, and holdings under several denominators."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.functions.ranges import PART, by_ranges, last_known, running
from ledgerspark.functions.shared import checkpointed
from ledgerspark.operators.setjoin import similar_sets
from ledgerspark.sources.adapters import SINKS


def funnels(pairs: DataFrame, markets: DataFrame, sold_pct: int = 90) -> DataFrame:
    """(addr, got, sold): accounts that got tokens from no market and sold at least the share of them to one."""
    m = markets.select("addr").distinct()
    got = pairs.join(m.select(F.col("addr").alias("frm")), "frm", "left_anti").filter(~F.col("frm").isin(*SINKS)).groupBy(F.col("dst").alias("addr")).agg(F.sum("v").alias("got"))
    sold = pairs.join(m.select(F.col("addr").alias("dst")), "dst", "left_semi").groupBy(F.col("frm").alias("addr")).agg(F.sum("v").alias("sold"))
    return got.join(sold, "addr").filter(F.col("sold") * 100 >= F.col("got") * sold_pct)


def interval_groups(buys: DataFrame, gap: int = 20, ratio_pct: int = 80, members: int = 10) -> DataFrame:
    """(batch, members, lowest, highest, first, last): runs of buys less than ``gap`` seconds apart, by enough accounts and of alike amounts.

    ``buys``: (ts, seq, addr, v).
    """
    return _alike(_batches(buys, gap), ratio_pct, members)


def _batches(buys: DataFrame, gap: int) -> DataFrame:
    """(ts, addr, v, batch): buys numbered by runs less than ``gap`` seconds apart."""
    order = ["ts", "seq"]
    before = last_known(by_ranges(buys, *order), order, F.col("ts"), "_b", strict=True)
    fresh = F.coalesce((F.col("ts") - F.col("_b") >= gap).cast("long"), F.lit(1).cast("long"))
    return running(before, order, fresh, "batch").select("ts", "addr", "v", "batch")


def _alike(batches: DataFrame, ratio_pct: int, members: int) -> DataFrame:
    per = batches.groupBy("batch", "addr").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    out = per.groupBy("batch").agg(F.count("*").alias("members"), F.min("lo").alias("lowest"), F.max("hi").alias("highest"), F.min("a").alias("first"), F.max("b").alias("last"))
    return out.filter((F.col("members") >= members) & (F.col("lowest") * 100 >= F.col("highest") * ratio_pct))


def first_movers(actions: DataFrame, batch: str, member: str, least: int = 2) -> DataFrame:
    """(member, firsts, batches): members that come first in several batches, and in how many they act at all. ``actions``: (batch, member, rank)."""
    return actions.groupBy(member).agg(F.count_if(F.col("rank") == 1).alias("firsts"), F.count("*").alias("batches")).filter(F.col("firsts") >= least)


def first_mover_chance(actions: DataFrame, batch: str, member: str, least: int = 2, limit: float = 0.002) -> DataFrame:
    """(member, firsts, batches, expected, chance, order): how often a member comes first in its batches against a random order.

    In random order each of a batch's members is first alike; ``chance`` bounds the probability of so many firsts from above
    (Chernoff: e^(k - m) (m / k)^k for k firsts where m are expected). ``fixed`` if it is at most ``limit``, else ``random``.
    """
    sizes = actions.groupBy(batch).agg(F.count("*").alias("_n"))
    per = actions.join(sizes, batch).groupBy(member).agg(F.count_if(F.col("rank") == 1).alias("firsts"), F.count("*").alias("batches"), F.sum(1 / F.col("_n")).alias("expected"))
    k, m = F.col("firsts").cast("double"), F.col("expected")
    chance = F.when(k > m, F.exp(k - m - k * F.ln(k / m))).otherwise(1.0)
    out = per.filter(F.col("firsts") >= least).withColumn("chance", chance)
    return out.withColumn("order", F.when(F.col("chance") <= limit, "fixed").otherwise("random"))


def repeated_groups(buys: DataFrame, gap: int = 20, ratio_pct: int = 80, members: int = 10) -> DataFrame:
    """(a, b, common): batches of ``interval_groups`` at least ``members`` of whose accounts come again in another such batch.

    ``buys``: (ts, seq, addr, v). Batches meet through their rare accounts.
    """
    rows = checkpointed(_batches(buys, gap))
    good = _alike(rows, ratio_pct, members).select("batch")
    sets = rows.join(good, "batch", "left_semi").select(F.col("batch").alias("set"), F.col("addr").alias("item"))
    return similar_sets(sets, least=members).select("a", "b", "common")


def token_pairs(holdings: DataFrame, support: int = 3, jaccard_pct: int = 50) -> DataFrame:
    """(a, b, common, either): members that share at least ``support`` items and enough of all that either has. ``holdings``: (member, item). Members meet through their rare items."""
    found = similar_sets(holdings.select(F.col("member").alias("set"), "item"), least=support, jaccard_pct=jaccard_pct)
    return found.select("a", "b", "common", (F.col("na") + F.col("nb") - F.col("common")).alias("either"))


def token_groups(pairs: DataFrame) -> DataFrame:
    """(addr, root): members joined through all ``pairs`` (a, b)."""
    from ledgerspark.operators.graph import components

    return components(pairs.select(F.col("a").alias("frm"), F.col("b").alias("dst")))


def co_timed_pairs(pairs: DataFrame, firsts: DataFrame, width: int = 6 * 3600, least: int = 1) -> DataFrame:
    """(a, b, timed) of ``pairs``: items that both first touched within ``width`` seconds. ``firsts``: (member, item, ts)."""
    a = firsts.select(F.col("member").alias("a"), "item", F.col("ts").alias("ta"))
    b = firsts.select(F.col("member").alias("b"), "item", F.col("ts").alias("tb"))
    met = pairs.select("a", "b").join(a, "a").join(b, ["b", "item"]).filter(F.abs(F.col("ta") - F.col("tb")) <= width)
    return met.groupBy("a", "b").agg(F.count("*").alias("timed")).filter(F.col("timed") >= least)


def open_interest(series: DataFrame) -> DataFrame:
    """(bar, state) of (bar, price, interest): crowding if both rise, short_covering if interest falls while the price rises, else long_building or unwinding."""
    order = ["bar"]
    before = last_known(by_ranges(series, "bar"), order, F.struct("price", "interest"), "_b", strict=True).filter("_b is not null")
    up, more = F.col("price") > F.col("_b.price"), F.col("interest") > F.col("_b.interest")
    state = F.when(up & more, "crowding").when(up, "short_covering").when(more, "short_building").otherwise("unwinding")
    return before.select("bar", state.alias("state"))


def revivals(days: DataFrame, quiet_days: int, quiet: int, burst: int) -> DataFrame:
    """(item, day, volume): days of at least ``burst`` after ``quiet_days`` days none of which reached ``quiet``. ``days``: (item, day, volume)."""
    window = Window.partitionBy("item").orderBy("day").rangeBetween(-quiet_days, -1)
    marked = days.withColumns({"_most": F.coalesce(F.max("volume").over(window), F.lit(0)), "_first": F.min("day").over(Window.partitionBy("item"))})
    return marked.filter((F.col("volume") >= burst) & (F.col("_most") < quiet) & (F.col("day") - F.col("_first") >= quiet_days)).select("item", "day", "volume")


def bursts(events: DataFrame, width: int, factor: int) -> DataFrame:
    """(bar, n, before): bars of ``width`` seconds with ``factor`` times the events of the busiest of the twelve bars before."""
    bars = events.groupBy((F.floor(F.col("ts") / width) * width).alias("bar")).agg(F.count("*").alias("n"))
    # Each bar tells the twelve after it how busy it was.
    ahead = F.explode(F.sequence(F.lit(0), F.lit(12)))
    told = bars.select("n", "bar", ahead.alias("k")).select((F.col("bar") + F.col("k") * width).alias("bar"), F.when(F.col("k") == 0, F.col("n")).alias("own"), F.when(F.col("k") > 0, F.col("n")).alias("n"))
    both = told.groupBy("bar").agg(F.max("own").alias("own"), F.max("n").alias("before"))
    return both.filter(F.col("own") >= F.col("before") * factor).select("bar", F.col("own").alias("n"), "before")


def pull_leverage(days: DataFrame, span: int) -> DataFrame:
    """(day, cap_change, turnover, leverage): change of the market cap over ``span`` days against what was traded for it, in whole thousandths.

    ``days``: (day, close, supply, volume), a row a day at most. The change is from the day ``span`` days before, which must be there;
    the turnover is of the days after it up to this one. Days without turnover have no leverage.
    """
    told = days.select("day", F.col("volume").alias("v"), (F.col("close").cast("decimal(19,0)") * F.col("supply").cast("decimal(19,0)")).alias("cap"), F.explode(F.sequence(F.lit(0), F.lit(span))).alias("k"))
    late, last = F.col("k") < span, F.col("k") == span
    # Each day tells itself and those after it what was traded, and the one a span later what the cap was.
    spans = told.groupBy((F.col("day") + F.col("k")).alias("day")).agg(
        F.max(F.when(F.col("k") == 0, F.col("cap"))).alias("cap"),
        F.max(F.when(last, F.col("cap"))).alias("before"),
        F.sum(F.when(late, F.col("v"))).alias("turnover"),
    )
    change = F.col("cap") - F.col("before")
    leverage = F.when(F.col("turnover") > 0, F.floor(F.abs(change).cast("double") * 1000 / F.col("turnover").cast("double")).cast("long"))
    return spans.filter(change.isNotNull()).select("day", change.alias("cap_change"), "turnover", leverage.alias("leverage"))


def price_walls(events: DataFrame, closes: DataFrame) -> DataFrame:
    """(day, narrow, one_sided, wall, close) of (day, lower, upper, amount0, amount1, price): ranges of one tick, one-sided ones, and the mean wall price beside the day's close."""
    lone = (F.col("amount0") == 0) != (F.col("amount1") == 0)
    size = (F.col("amount0") + F.col("amount1")).cast("double")
    days = events.groupBy("day").agg(F.count_if(F.col("upper") - F.col("lower") == 1).alias("narrow"), F.count_if(lone).alias("one_sided"), (F.sum(size * F.col("price")) / F.sum(size)).alias("wall"))
    return days.join(closes, "day", "left")


def netted_peak(transfers: DataFrame, members: DataFrame, group: str) -> DataFrame:
    """(group, peak, peak_tx): largest balance of a group after each transaction, with transfers inside it netted first.

    ``transfers``: (block, tx, frm, dst, v); transactions are ordered by (block, tx).
    """
    own = members.select("addr", group)
    legs = transfers.select("block", "tx", F.inline(F.array(F.struct(F.col("dst").alias("addr"), F.col("v").alias("x")), F.struct(F.col("frm").alias("addr"), (-F.col("v")).alias("x")))))
    net = legs.join(own, "addr").groupBy(group, "block", "tx").agg(F.sum("x").alias("x"))
    held = running(by_ranges(net, group, "block", "tx"), ["block", "tx"], F.col("x"), "held", group)
    return held.groupBy(group).agg(F.max("held").alias("peak"), F.max_by("tx", F.struct("held", -F.col("block"), -F.col("tx"))).alias("peak_tx"))


def float_share(held: DataFrame, supply: DataFrame, pool: DataFrame, least_pct: int = 15) -> DataFrame:
    """(day, held, of_total, of_float): a balance over the net supply and over what lies outside the pool; the latter only while it is at least the share of the supply.

    ``held``, ``pool``: (day, balance) on days of change; ``supply``: (day, net) on every day.
    """
    days = supply.select("day", "net")
    for name, series in (("held", held), ("pool", pool)):
        days = days.join(series.select("day", F.col("balance").alias(name)), "day", "left")
    ranged = by_ranges(days, "day")
    for name in ("held", "pool"):
        ranged = last_known(ranged, ["day"], F.col(name), f"_{name}")
    h, p = F.coalesce("_held", F.lit(0)).cast("double"), F.coalesce("_pool", F.lit(0)).cast("double")
    net = F.col("net").cast("double")
    free = net - p
    return ranged.select("day", F.coalesce("_held", F.lit(0)).alias("held"), F.when(net > 0, h / net).alias("of_total"), F.when((net > 0) & (free * 100 >= net * least_pct), h / free).alias("of_float"))


def _tail(n: int, k: int, total: int, marked: int) -> float:
    """P(at least ``k`` marked among ``n`` drawn of ``total`` with ``marked``)."""
    return float(sum(math.comb(marked, i) * math.comb(total - marked, n - i) for i in range(k, min(n, marked) + 1)) / math.comb(total, n))


def retention_test(members: DataFrame) -> DataFrame:
    """(window, members, kept, rate, p): share of long-holders in each window, and the chance of so many by a draw of all. ``members``: (window, long_holder)."""
    per = members.groupBy("window").agg(F.count("*").alias("members"), F.count_if("long_holder").alias("kept"))
    every = per.agg(F.sum("members").alias("_total"), F.sum("kept").alias("_marked"))

    @F.pandas_udf("double")
    def tail(n: pd.Series, k: pd.Series, total: pd.Series, marked: pd.Series) -> pd.Series:
        return pd.Series([_tail(*map(int, x)) for x in zip(n, k, total, marked, strict=True)], dtype="float64")

    both = per.join(F.broadcast(every))
    return both.select("window", "members", "kept", (F.col("kept") / F.col("members")).alias("rate"), tail("members", "kept", "_total", "_marked").alias("p"))


def economic_control(claims: DataFrame) -> DataFrame:
    """(entity, kind, amount): claims (entity, kind, right, amount), each right counted once; of several claims to one the largest, then the first entity."""
    one = claims.groupBy("right").agg(F.min(F.struct((-F.col("amount")).alias("less"), "entity", "kind")).alias("b"))
    return one.select("b.entity", "b.kind", (-F.col("b.less")).alias("amount")).groupBy("entity", "kind").agg(F.sum("amount").alias("amount"))


def wash_pairs(pairs: DataFrame) -> DataFrame:
    """(a, b, gross, net): two-way flows between two accounts, from ``edges``."""
    sides = pairs.filter("frm <> dst").select(F.least("frm", "dst").alias("a"), F.greatest("frm", "dst").alias("b"), F.when(F.col("frm") < F.col("dst"), F.col("v")).otherwise(-F.col("v")).alias("x"))
    out = sides.groupBy("a", "b").agg(F.sum(F.abs("x")).alias("gross"), F.sum("x").alias("net"), F.count("*").alias("ways"))
    return out.filter("ways = 2").drop("ways")

