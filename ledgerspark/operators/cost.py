"""Costs and pools: what accounts paid, curves, stakes, liquidity and holdings against depth."""

from __future__ import annotations

from decimal import Decimal, getcontext

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.ranges import PART, by_ranges, last_known, running
from ledgerspark.functions.scan import scanned
from ledgerspark.functions.shared import checkpointed


def trade_pnl(tokens: DataFrame, quotes: DataFrame, least: Column | None = None) -> DataFrame:
    """(addr, bought, paid, sold, got, realised, unpriced): what each account's share of a transaction's quote leg came to.

    ``tokens``: (tx, addr, delta) net of markets; ``quotes``: (tx, into, out) of the pool. Buyers of a transaction
    share what went in, sellers what came out, by tokens; buys without a quote are unpriced.
    Realised: what sales brought less the average cost of what was sold.
    """
    net = tokens.groupBy("tx", "addr").agg(F.sum("delta").alias("d")).filter("d <> 0")
    up, down = F.greatest("d", F.lit(0)), F.greatest(-F.col("d"), F.lit(0))
    sums = net.groupBy("tx").agg(F.sum(up).alias("all_up"), F.sum(down).alias("all_down"))
    legs = net.join(sums.join(quotes, "tx", "left").fillna(0, ["into", "out"]), "tx")
    part = lambda quote, own, of: F.when((F.col(quote) > 0) & (own > 0), F.col(quote).cast("double") * own.cast("double") / F.col(of).cast("double")).otherwise(0.0)
    priced = F.col("into") > 0
    out = legs.groupBy("addr").agg(
        F.sum(F.when(priced, up).otherwise(0)).alias("bought"),
        F.sum(part("into", up, "all_up")).alias("paid"),
        F.sum(F.when(F.col("out") > 0, down).otherwise(0)).alias("sold"),
        F.sum(part("out", down, "all_down")).alias("got"),
        F.sum(F.when(~priced, up).otherwise(0)).alias("unpriced"),
    )
    if least is not None:
        out = out.filter(F.col("bought") + F.col("sold") >= least)
    cost = F.when(F.col("bought") > 0, F.col("paid") * F.least("sold", "bought").cast("double") / F.col("bought").cast("double")).otherwise(0.0)
    return out.withColumn("realised", F.col("got") - cost)


def curve_costs(trades: DataFrame, virtual_tokens: float, virtual_quote: float) -> DataFrame:
    """(addr, ts, amount, reserve, cost) of each buy on a constant-product curve. ``trades``: (ts, seq, addr, amount), sales negative.

    The reserve after a trade is the start less all that was sold till then, so the cost is a closed form of it.
    """
    k = virtual_tokens * virtual_quote
    sold = running(by_ranges(trades, "ts", "seq"), ["ts", "seq"], F.col("amount"), "_sold").drop(PART)
    after = F.lit(virtual_tokens) - F.col("_sold")
    before = after + F.col("amount")
    return sold.filter("amount > 0").select("addr", "ts", "seq", "amount", after.alias("reserve"), (F.lit(k) / after - F.lit(k) / before).alias("cost"))


def buyer_costs(costs: DataFrame) -> DataFrame:
    """(addr, tokens, paid, buys, first, last)."""
    return costs.groupBy("addr").agg(F.sum("amount").alias("tokens"), F.sum("cost").alias("paid"), F.count("*").alias("buys"), F.min("ts").alias("first"), F.max("ts").alias("last"))


def graduation(costs: DataFrame, virtual_tokens: float, virtual_quote: float, market_price: Column, warn_pct: int = 20) -> DataFrame:
    """One row (reserve, price, gap, verdict): the curve's marginal price after the last buy against the market's."""
    last = costs.agg(F.min_by("reserve", F.struct(-F.col("ts"), -F.col("seq"))).alias("reserve"))
    price = F.lit(virtual_tokens * virtual_quote) / F.col("reserve") / F.col("reserve")
    out = last.withColumn("price", price).withColumn("gap", F.abs(price - market_price) / market_price)
    return out.withColumn("verdict", F.when(F.col("gap") * 100 > warn_pct, "WARN").otherwise("OK"))


def stakes(moves: DataFrame, pool: str) -> DataFrame:
    """(addr, staked, unstaked, net) of transfers to and from a pool."""
    out = F.col("dst") == pool
    rows = moves.filter((F.col("frm") == pool) != out).select(F.when(out, F.col("frm")).otherwise(F.col("dst")).alias("addr"), F.when(out, F.col("v")).otherwise(0).alias("s"), F.when(out, 0).otherwise(F.col("v")).alias("u"))
    sums = rows.groupBy("addr").agg(F.sum("s").alias("staked"), F.sum("u").alias("unstaked"))
    return sums.withColumn("net", F.col("staked") - F.col("unstaked"))


def stake_closure(ledger: DataFrame, balance: DataFrame, slack: int = 2) -> DataFrame:
    """One row (net, balance, passes): all net stakes against the pool's balance (one row), within ``slack`` units."""
    both = ledger.agg(F.sum("net").alias("net")).join(F.broadcast(balance.select("balance")))
    return both.withColumn("passes", F.abs(F.col("net") - F.col("balance")) <= slack)


def liquidity(events: DataFrame) -> DataFrame:
    """(operator, adds, removes, added, removed, one_sided) of (operator, lower, upper, amount0, amount1, liquidity): signed liquidity changes."""
    add = F.col("liquidity") > 0
    lone = add & ((F.col("amount0") == 0) != (F.col("amount1") == 0))
    return events.groupBy("operator").agg(
        F.count_if(add).alias("adds"),
        F.count_if(F.col("liquidity") < 0).alias("removes"),
        F.sum(F.greatest("liquidity", F.lit(0))).alias("added"),
        F.sum(F.greatest(-F.col("liquidity"), F.lit(0))).alias("removed"),
        F.count_if(lone).alias("one_sided"),
    )


def liquidity_walls(events: DataFrame) -> DataFrame:
    """(lower, upper, width, events, one_sided, strangers): price ranges, and how many took out of them what others had put in."""
    add = F.col("liquidity") > 0
    lone = add & ((F.col("amount0") == 0) != (F.col("amount1") == 0))
    per = events.groupBy("lower", "upper", "operator").agg(F.count("*").alias("n"), F.count_if(add).alias("adds"), F.count_if(lone).alias("lone"), F.count_if(F.col("liquidity") < 0).alias("removes"))
    strange = F.count_if((F.col("adds") == 0) & (F.col("removes") > 0))
    return per.groupBy("lower", "upper", (F.col("upper") - F.col("lower")).alias("width")).agg(F.sum("n").alias("events"), F.sum("lone").alias("one_sided"), strange.alias("strangers"))


def sqrt_price(rows: DataFrame, column: str, decimals0: int, decimals1: int, inverse: bool = False, out: str = "price") -> DataFrame:
    """Adds ``out``, the price of a square root in 96-bit fixed point given as a text of digits; ninety digits, then a double."""

    @F.pandas_udf("double")
    def price(values: pd.Series) -> pd.Series:
        getcontext().prec = 90
        scale = Decimal(10) ** (decimals0 - decimals1)
        found = [None if v is None else Decimal(v) * Decimal(v) / Decimal(2) ** 192 * scale for v in values]
        return pd.Series([None if x is None else float(1 / x if inverse and x else x) for x in found], dtype="float64")

    return rows.withColumn(out, price(F.col(column).cast("string")))


def fee_growth(now: str, then: str) -> Column:
    """Growth of a counter that wraps at 2^256, given as texts of digits; text of the difference."""

    @F.pandas_udf("string")
    def grown(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else str((int(x) - int(y)) % 2**256) for x, y in zip(a, b, strict=True)], dtype=object)

    return grown(F.col(now), F.col(then))


def pool_fee(volume: Column, fee_ppm: int) -> Column:
    """Fee of a swap in whole units, rounded up."""
    return F.ceil(volume.cast("decimal(38,0)") * fee_ppm / 1_000_000)


def fee_shares(swaps: DataFrame, positions: DataFrame, fee_ppm: int) -> DataFrame:
    """(owner, fee): each swap's fee shared by the liquidity in range at its tick; owners with no fee in range are left out.

    ``swaps``: (swap, tick, volume); ``positions``: (owner, lower, upper, liquidity), in range if lower <= tick < upper.
    No position meets a tick: liquidity in range is a running sum of what begins and ends along the ticks, the fee of a unit of
    liquidity another, and a position gets the difference of the latter at its two ends.
    """
    fees = swaps.groupBy(F.col("tick").alias("at")).agg(F.sum(pool_fee(F.col("volume"), fee_ppm)).alias("fee"), F.lit(1).alias("touched"))
    real = positions.filter("lower < upper")
    liquid = F.col("liquidity").cast("decimal(38,0)")
    ends = real.select(F.inline(F.array(F.struct(F.col("lower").alias("at"), liquid.alias("moved")), F.struct(F.col("upper").alias("at"), (-liquid).alias("moved")))))
    steps = ends.groupBy("at").agg(F.sum("moved").cast("decimal(38,0)").alias("moved")).join(fees, "at", "full").fillna(0, ["moved", "fee", "touched"])
    deep = running(by_ranges(steps, "at"), ["at"], F.col("moved"), "depth")
    paid = (F.col("touched") > 0) & (F.col("depth") > 0)
    grown = running(running(deep, ["at"], F.when(paid, F.col("fee").cast("double") / F.col("depth").cast("double")).otherwise(0.0), "growth"), ["at"], paid.cast("long"), "ticks")
    # What lies before a tick: the sums up to it without its own.
    grown = checkpointed(grown.select("at", (F.col("growth") - F.when(paid, F.col("fee").cast("double") / F.col("depth").cast("double")).otherwise(0.0)).alias("growth"), (F.col("ticks") - paid.cast("long")).alias("ticks")))
    for end in ("lower", "upper"):
        real = real.join(grown.select(F.col("at").alias(end), F.col("growth").alias(f"g_{end}"), F.col("ticks").alias(f"n_{end}")), end)
    gained = F.col("liquidity").cast("double") * (F.col("g_upper") - F.col("g_lower"))
    return real.filter("n_upper > n_lower").groupBy("owner").agg(F.sum(gained).alias("fee"))


def range_totals(points: DataFrame, at: str, ranges: DataFrame, owner: str, low: str, high: str) -> DataFrame:
    """(owner, n, total): number and sum of the ``at`` of ``points`` in the owner's closed ranges of longs; owners without any are left out.

    No point meets a range: running sums along the places of points and ends are taken once, and a range gets their difference at its two ends.
    """
    real = ranges.filter(F.col(low) <= F.col(high)).select(F.col(owner).alias("_owner"), F.col(low).alias("_low"), (F.col(high) + 1).alias("_high"))
    placed = points.filter(F.col(at).isNotNull()).groupBy(F.col(at).alias("at")).agg(F.count("*").alias("n"))
    ends = real.select(F.explode(F.array("_low", "_high")).alias("at")).distinct()
    steps = by_ranges(placed.join(ends, "at", "full").fillna(0, ["n"]), "at")
    own = F.col("at").cast("decimal(38,0)") * F.col("n")
    sums = running(running(steps, ["at"], F.col("n"), "_n"), ["at"], own, "_total")
    # What lies before a place: the sums up to it without its own.
    before = checkpointed(sums.join(ends, "at", "left_semi").select("at", (F.col("_n") - F.col("n")).alias("n"), (F.col("_total") - own).cast("decimal(38,0)").alias("total")))
    for end in ("_low", "_high"):
        real = real.join(before.select(F.col("at").alias(end), F.col("n").alias(f"n{end}"), F.col("total").alias(f"total{end}")), end)
    out = real.groupBy(F.col("_owner").alias(owner)).agg(F.sum(F.col("n_high") - F.col("n_low")).alias("n"), F.sum(F.col("total_high") - F.col("total_low")).alias("total"))
    return out.filter("n > 0")


def net_buy_cost(trades: DataFrame) -> DataFrame:
    """(addr, segment, holding, cost): net paid per unit held in each stretch between full exits. ``trades``: (addr, ts, seq, amount, price), sales negative."""
    order = ["ts", "seq"]
    held = running(by_ranges(trades, "addr", *order), order, F.col("amount"), "held", "addr")
    was_out = last_known(held, order, F.col("held"), "_was", "addr", strict=True).withColumn("_new", (F.coalesce("_was", F.lit(0)) <= 0).cast("long"))
    parts = running(was_out, order, F.col("_new"), "segment", "addr")
    sums = parts.groupBy("addr", "segment").agg(F.sum("amount").alias("holding"), F.sum(F.col("amount") * F.col("price")).alias("net_paid"))
    return sums.withColumn("cost", F.when(F.col("holding") > 0, F.col("net_paid").cast("double") / F.col("holding").cast("double")))


def tainted(moves: DataFrame) -> DataFrame:
    """(addr, injected, passed, retained): proportional taint of accounts, each on its own. ``moves``: (addr, ts, seq, amount, taint).

    ``amount``: signed; ``taint``: what of an incoming amount is tainted. An outgoing amount takes its share of the account's
    taint; what goes out beyond the holding counts as all of it. Two scans: a holding after a move is the larger of a
    bound and a sum; with the holdings known, the taint after a move is a multiple of that before and what came in.
    """
    rows = by_ranges(moves.select("addr", "ts", "seq", F.col("amount").cast("double").alias("amount"), F.col("taint").cast("double").alias("taint")), "addr", "ts", "seq")
    order = ["ts", "seq"]
    # (s, c): h becomes max(c, h + s).
    held = scanned(rows, "addr", order, ["amount"], lambda x: (x, 0.0), lambda f, g: (f[0] + g[0], max(g[1], f[1] + g[0])), lambda f, h: max(f[1], h + f[0]), "_was", "_is")
    left = F.when(F.col("amount") > 0, 1.0).when(F.col("_was") > 0, F.col("_is") / F.col("_was")).otherwise(1.0)
    put = F.when(F.col("amount") > 0, F.col("taint")).otherwise(0.0)
    # (r, b): t becomes r t + b.
    marked = checkpointed(held.withColumns({"_left": left, "_put": put}))
    found = scanned(marked, "addr", order, ["_left", "_put"], lambda r, b: (r, b), lambda f, g: (f[0] * g[0], g[0] * f[1] + g[1]), lambda f, t: f[0] * t + f[1], "_before", "_after")
    out = found.groupBy("addr").agg(F.sum("_put").alias("injected"), F.sum(F.col("_before") * (1 - F.col("_left"))).alias("passed"), F.max_by("_after", F.struct(*order)).alias("retained"))
    return out.select("addr", "injected", "passed", "retained")


def exit_depth(held: Column, price: Column, pool_tokens: Column, pool_quote: Column) -> dict[str, Column]:
    """``ratio`` of a holding's value to the pool's quote side, and ``proceeds`` of selling it all into a constant product."""
    value = held.cast("double") * price
    return {"ratio": value / pool_quote.cast("double"), "proceeds": pool_quote.cast("double") * held.cast("double") / (pool_tokens.cast("double") + held.cast("double"))}
