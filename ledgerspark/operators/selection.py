"""Choices with a total order, moves classified by counterparty, and other row-level rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.functions.joins import range_blocks
from ledgerspark.functions.ranges import PART, by_ranges, last_known, running
from ledgerspark.functions.shared import checkpointed
from ledgerspark.sources.adapters import SINKS, ZERO


def pct_to_raw(total: Column, pct_num: int, pct_den: int = 100) -> Column:
    """Least whole amount that is at least ``pct_num / pct_den`` percent of ``total``."""
    scale = pct_den * 100
    return F.ceil(total.cast("decimal(38,0)") * pct_num / scale).cast("decimal(38,0)")


def raw_integer(text: Column) -> Column:
    """A non-negative whole number from its text; null for anything else: signs, blanks, points, exponents, leading zeros."""
    return F.when(text.rlike("^(0|[1-9][0-9]{0,37})$"), text).try_cast("decimal(38,0)")


def units(raw: Column, decimals: int) -> Column:
    """``raw / 10^decimals`` with its decimals: eighteen places are given before the division, since a quotient alone keeps only six."""
    return (raw.cast("decimal(38,18)") / F.lit(10**decimals).cast("decimal(20,0)")).cast("decimal(38,18)")


def across_entities(transfers: DataFrame, members: DataFrame, entity: str = "entity") -> DataFrame:
    """Transfers without those whose two ends belong to one entity. ``members``: (addr, entity), an address in one entity at most."""
    frm = members.select(F.col("addr").alias("frm"), F.col(entity).alias("_a"))
    dst = members.select(F.col("addr").alias("dst"), F.col(entity).alias("_b"))
    return transfers.join(frm, "frm", "left").join(dst, "dst", "left").filter("_a is null or _b is null or _a <> _b").select(*transfers.columns)


def touching(transfers: DataFrame, nodes: DataFrame) -> DataFrame:
    """Transfers of which at least one end is in ``nodes`` (addr): two joins on one key each, not one join with an OR."""
    own = nodes.select("addr").distinct()
    a = transfers.join(own.select(F.col("addr").alias("frm"), F.lit(True).alias("_a")), "frm", "left")
    return a.join(own.select(F.col("addr").alias("dst"), F.lit(True).alias("_b")), "dst", "left").filter("_a or _b").select(*transfers.columns)


def top_recipients(transfers: DataFrame, sender: str, most: int) -> DataFrame:
    """(dst, v, n): the ``most`` recipients with most; of equal sums the smallest name. Only ``most`` rows of each task are kept."""
    sums = transfers.filter(F.col("frm") == sender).groupBy("dst").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    return sums.orderBy(F.desc("v"), "dst").limit(most)


def recipients_summary(transfers: DataFrame, most: int = 500) -> DataFrame:
    """(frm, recipients, top_v): of each sender, the number and the sum of its ``most`` largest recipients."""
    pairs = transfers.groupBy("frm", "dst").agg(F.sum("v").alias("v"))
    placed = running(by_ranges(pairs.withColumn("_down", -F.col("v")), "frm", "_down", "dst"), ["_down", "dst"], F.lit(1).cast("long"), "_k", "frm").filter(F.col("_k") <= most)
    return placed.groupBy("frm").agg(F.count("*").alias("recipients"), F.sum("v").alias("top_v"))


def largest(rows: DataFrame, value: str, *ties: str) -> DataFrame:
    """The one row of largest ``value``; of equal ones the smallest by ``ties``, which tell all rows apart."""
    return rows.orderBy(F.desc(value), *ties).limit(1)


def neighbours(rows: DataFrame, key: str, boundary: Column, *ties: str) -> DataFrame:
    """(side, ...): the last row before ``boundary`` and the first one at or after it; ``boundary`` may be a column of every row."""
    row = F.struct(key, *ties, *[c for c in rows.columns if c not in (key, *ties)])
    both = rows.agg(F.max(F.when(F.col(key) < boundary, row)).alias("before"), F.min(F.when(F.col(key) >= boundary, row)).alias("after"))
    return both.select(F.inline(F.array(F.struct(F.lit("before").alias("side"), F.col("before").alias("row")), F.struct(F.lit("after").alias("side"), F.col("after").alias("row"))))).filter("row is not null").select("side", "row.*")


def evenly_spaced(rows: DataFrame, key: str, points: int) -> DataFrame:
    """``points`` rows at even places in the order of ``key`` (unique): the first, the last and those between, places rounded half to even."""
    placed = running(by_ranges(rows, key), [key], F.lit(1).cast("long"), "_k").drop(PART)
    total = rows.agg(F.count("*").alias("_n"))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(max(1, points - 1))).cast("long") + 1)
    # One row.
    places = total.select(F.explode(F.array_distinct(wanted)).alias("_k"))
    return placed.join(F.broadcast(places), "_k").drop("_k")


def clean_samples(transfers: DataFrame, most: int) -> DataFrame:
    """(addr, block, side): addresses with a single event in their block, the newest first, the receiving side preferred."""
    legs = transfers.select("block", F.inline(F.array(F.struct(F.col("dst").alias("addr"), F.lit("to").alias("side")), F.struct(F.col("frm").alias("addr"), F.lit("from").alias("side")))))
    single = legs.groupBy("block", "addr").agg(F.count("*").alias("n"), F.max("side").alias("side")).filter(F.col("n") == 1).filter(~F.col("addr").isin(*SINKS))
    return single.orderBy(F.desc("block"), F.desc("side"), "addr").limit(most).select("addr", "block", "side")


def owner_deltas(balances: DataFrame) -> DataFrame:
    """(tx, owner, delta) from (tx, pre_owner, pre, post_owner, post): the owner before is debited, the owner after credited."""
    legs = F.array(F.struct(F.col("pre_owner").alias("owner"), (-F.col("pre")).alias("x")), F.struct(F.col("post_owner").alias("owner"), F.col("post").alias("x")))
    return balances.select("tx", F.inline(legs)).filter("owner is not null").groupBy("tx", "owner").agg(F.sum("x").alias("delta")).filter("delta <> 0")


def succeeded(rows: DataFrame, status: DataFrame, *key: str) -> DataFrame:
    """Rows whose transaction has exactly one status (key, err) and no error."""
    good = status.groupBy(*key).agg(F.count("*").alias("_n"), F.count("err").alias("_e")).filter("_n = 1 and _e = 0").select(*key)
    return rows.join(good, list(key), "left_semi")


def window_moves(transfers: DataFrame, account: str, pools: DataFrame) -> DataFrame:
    """(kind, n, v): what an account moved, by direction and by whether the counterparty is a pool."""
    own = transfers.filter((F.col("frm") == account) | (F.col("dst") == account)).filter(F.col("frm") != F.col("dst"))
    out = F.col("frm") == account
    peers = own.withColumn("addr", F.when(out, F.col("dst")).otherwise(F.col("frm"))).join(pools.select("addr", F.lit(True).alias("_pool")), "addr", "left")
    side = F.when(F.col("_pool"), F.when(out, "sold").otherwise("bought")).when(F.col("addr").isin(*SINKS), F.when(out, "burnt").otherwise("minted")).otherwise(F.when(out, "sent").otherwise("received"))
    return peers.groupBy(side.alias("kind")).agg(F.count("*").alias("n"), F.sum("v").alias("v"))


def direct_pairs(transfers: DataFrame, excluded: DataFrame) -> DataFrame:
    """(frm, dst, v, n): sums per pair without pools and sinks at either end."""
    rows = transfers.filter(~F.col("frm").isin(*SINKS) & ~F.col("dst").isin(*SINKS))
    for end in ("frm", "dst"):
        rows = rows.join(excluded.select(F.col("addr").alias(end)), end, "left_anti")
    return rows.groupBy("frm", "dst").agg(F.sum("v").alias("v"), F.count("*").alias("n"))


def snipers(transfers: DataFrame, launch: DataFrame, width: int) -> DataFrame:
    """(addr, first): accounts whose first receipt comes within ``width`` of the launch (one row, ``at``)."""
    first = transfers.filter(~F.col("dst").isin(*SINKS)).groupBy(F.col("dst").alias("addr")).agg(F.min("ts").alias("first"))
    return first.join(F.broadcast(launch.select("at")), F.col("first") <= F.col("at") + width).select("addr", "first")


def price_gap(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (n, median, p90) of the relative differences of two series (bar, price), at the places n // 2 and n * 9 // 10, in millionths."""
    both = a.select("bar", F.col("price").alias("a")).join(b.select("bar", F.col("price").alias("b")), "bar").filter("b <> 0")
    gaps = both.select("bar", F.floor(F.abs(F.col("a") - F.col("b")).cast("decimal(38,0)") * 1_000_000 / F.abs(F.col("b"))).cast("long").alias("gap"))
    placed = running(by_ranges(gaps, "gap", "bar"), ["gap", "bar"], F.lit(1).cast("long"), "_k").join(F.broadcast(gaps.agg(F.count("*").alias("_n"))))
    return placed.agg(F.max("_n").alias("n"), F.max(F.when(F.col("_k") == F.floor(F.col("_n") / 2) + 1, F.col("gap"))).alias("median"), F.max(F.when(F.col("_k") == F.floor(F.col("_n") * 9 / 10) + 1, F.col("gap"))).alias("p90"))


def content_id(prefix: str, members: Column, length: int = 12) -> Column:
    """``prefix-`` and the first digits of the SHA-256 of the sorted members."""
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha2(F.array_join(F.array_sort(members), ","), 256), 1, length))


def code_matches(codes: DataFrame, known: DataFrame) -> DataFrame:
    """(addr, name, how) of code fingerprints: the exact hash, else equal selectors and a length within max(64, 2%).

    ``codes``: (addr, hash, selectors, size); ``known``: (name, hash, selectors, size). The least name of the better way counts.
    """
    # The least name stands for all known codes with one hash, and for all whose band of sizes has a block: a code looks names up and meets no other code.
    exact = codes.join(known.groupBy("hash").agg(F.min("name").alias("name")), "hash").select("addr", "name", F.lit("exact").alias("how"))
    size = F.col("size").cast("long")
    slack = F.floor(F.greatest(size, F.lit(3200)) / 50).cast("long")
    bands = known.filter("size is not null").groupBy("selectors", "size").agg(F.min("name").alias("name"))
    blocks = bands.select("selectors", "name", F.explode(range_blocks(size - slack, size + slack)).alias("_b")).groupBy("selectors", "_b.level", "_b.cell").agg(F.min("name").alias("name"))
    blocks = checkpointed(blocks)
    # At most 63 numbers.
    levels = [r["level"] for r in blocks.select("level").distinct().collect()]
    kinds = codes.select("selectors", size.alias("size")).distinct().withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    met = kinds.withColumn("cell", F.call_function("shiftright", F.col("size"), F.col("level"))).join(blocks, ["selectors", "level", "cell"])
    near = codes.join(met.groupBy("selectors", "size").agg(F.min("name").alias("name")), ["selectors", "size"]).select("addr", "name", F.lit("similar").alias("how"))
    return exact.unionByName(near).groupBy("addr").agg(F.min(F.struct("how", "name")).alias("_b")).select("addr", "_b.name", "_b.how")


def first_funder(native: DataFrame) -> DataFrame:
    """(addr, funder): in the earliest transaction that credits an account, the account with the most negative delta.

    ``native``: (tx, seq, addr, delta).
    """
    first = native.filter("delta > 0").groupBy("addr").agg(F.min(F.struct("seq", "tx")).alias("at")).select("addr", "at.tx")
    payer = native.filter("delta < 0").groupBy("tx").agg(F.min(F.struct("delta", "addr")).alias("by")).select("tx", F.col("by.addr").alias("funder"))
    return first.join(payer, "tx").filter("addr <> funder").select("addr", "funder")


def running_share(daily: DataFrame, total: DataFrame, bps: int) -> DataFrame:
    """(addr, peak, final): accounts whose running balance ever reaches ``bps`` of the total (one row, ``net``). ``daily``: (addr, day, delta)."""
    from ledgerspark.operators.scanners import closes

    tops = closes(daily).groupBy("addr").agg(F.max("close").alias("peak"), F.max_by("close", "day").alias("final")).filter(~F.col("addr").isin(*SINKS))
    return tops.join(F.broadcast(total.select("net")), F.col("peak") * 10_000 >= F.col("net") * bps).drop("net")


def canonical_order(transfers: DataFrame, *order: str) -> DataFrame:
    """``place`` of each transfer in chain order, nulls first; ``order`` tells rows apart."""
    return running(by_ranges(transfers, *order), list(order), F.lit(1).cast("long"), "place").drop(PART)


def hourly_groups(transfers: DataFrame, members: DataFrame, group: str, hour: Column, stakes: str) -> DataFrame:
    """(hour, group, held, staked): positive balances of groups at the end of each hour in which something moved.

    What an account sends to ``stakes`` still counts as its own, as ``staked``; what it takes back is no longer.
    """
    legs = transfers.withColumn("hour", hour).select(
        "hour",
        F.inline(
            F.array(
                F.struct(F.col("dst").alias("addr"), F.when(F.col("dst") == stakes, 0).otherwise(F.col("v")).alias("x"), F.when(F.col("frm") == stakes, -F.col("v")).otherwise(0).alias("s")),
                F.struct(F.col("frm").alias("addr"), F.when(F.col("frm") == stakes, 0).otherwise(-F.col("v")).alias("x"), F.when(F.col("dst") == stakes, F.col("v")).otherwise(0).alias("s")),
            )
        ),
    ).filter((F.col("addr") != ZERO) & (F.col("addr") != stakes))
    moves = legs.groupBy("addr", "hour").agg(F.sum("x").alias("x"), F.sum("s").alias("s"))
    ranged = by_ranges(moves, "addr", "hour")
    held = running(running(ranged, ["hour"], F.col("x"), "held", "addr"), ["hour"], F.col("s"), "staked", "addr")
    held = held.select("addr", "hour", F.greatest("held", F.lit(0)).alias("held"), F.greatest("staked", F.lit(0)).alias("staked"), PART)
    before = last_known(held, ["hour"], F.struct("held", "staked"), "_was", "addr", strict=True)
    steps = before.select("addr", "hour", (F.col("held") - F.coalesce("_was.held", F.lit(0))).alias("dh"), (F.col("staked") - F.coalesce("_was.staked", F.lit(0))).alias("ds"))
    hours = steps.join(members, "addr").groupBy(group, "hour").agg(F.sum("dh").alias("dh"), F.sum("ds").alias("ds"))
    # One row for each group and hour.
    upto = Window.partitionBy(group).orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return hours.select("hour", group, F.sum("dh").over(upto).alias("held"), F.sum("ds").over(upto).alias("staked"))
