"""Counterparty graphs: edges, profiles, merge evidence and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.joins import hub_join
from ledgerspark.functions.rows import rows
from ledgerspark.functions.shared import checkpointed
from ledgerspark.sources.adapters import SINKS, ZERO


def edges(transfers: DataFrame) -> DataFrame:
    """(frm, dst, v, n): sums per pair; transfers of nothing don't count."""
    return transfers.filter("v > 0").groupBy("frm", "dst").agg(F.sum("v").alias("v"), F.count("*").alias("n"))


def profiles(pairs: DataFrame) -> DataFrame:
    """Fans, transfers, flows and peers of each account, from ``edges`` alone."""
    zero = F.lit(0).cast("long")
    none = F.col("v") * 0
    legs = pairs.select(
        rows(
            ["addr", "peer", "tx_in", "tx_out", "inflow", "outflow"],
            (F.col("frm"), F.col("dst"), zero, F.col("n"), none, F.col("v")),
            (F.col("dst"), F.col("frm"), F.col("n"), zero, F.col("v"), none),
        )
    )
    by_peer = legs.groupBy("addr", "peer").agg(*[F.sum(c).alias(c) for c in ("tx_in", "tx_out", "inflow", "outflow")])
    out = by_peer.groupBy("addr").agg(
        F.count_if(F.col("tx_in") > 0).alias("fan_in"),
        F.count_if(F.col("tx_out") > 0).alias("fan_out"),
        *[F.sum(c).alias(c) for c in ("tx_in", "tx_out", "inflow", "outflow")],
        F.max(F.col("inflow") + F.col("outflow")).alias("max_peer_flow"),
        F.count("*").alias("peers"),
    )
    kept = F.greatest(F.col("inflow") - F.col("outflow"), F.lit(0)).cast("double")
    flow = F.col("inflow") + F.col("outflow")
    return out.withColumns({
        "retention": F.when(F.col("inflow") > 0, kept / F.col("inflow").cast("double")),
        "top_peer_share": F.when(flow > 0, F.col("max_peer_flow").cast("double") / flow.cast("double")),
    })


def funnel_verdict(fan: int = 30, tx: int = 80, retention_pct: int = 5, degree: int = 120, candidate_pct: int = 15) -> Column:
    """FUNNEL, FUNNEL_CANDIDATE or NONE for a profile; retention is compared in integers."""
    kept = F.greatest(F.col("inflow") - F.col("outflow"), F.lit(0)) * 100
    moved = F.col("tx_in") + F.col("tx_out")
    funnel = (F.col("fan_in") >= fan) & (F.col("fan_out") >= fan) & (moved >= tx) & (F.col("inflow") > 0) & (kept <= F.col("inflow") * retention_pct)
    candidate = (F.col("peers") >= degree) & (F.col("inflow") > 0) & (kept <= F.col("inflow") * candidate_pct)
    return F.when(funnel, "FUNNEL").when(candidate, "FUNNEL_CANDIDATE").otherwise("NONE")


def transfer_evidence(pairs: DataFrame, profile: DataFrame, net_supply: DataFrame, excluded: DataFrame, divisor: int = 20_000, degree: int = 200) -> DataFrame:
    """(frm, dst, v): pairs whose sum reaches supply / divisor and none of whose ends is excluded or a hub."""
    hubs = profile.filter(F.col("peers") > degree).select("addr").unionByName(excluded.select("addr")).distinct()
    big = pairs.filter(~F.col("frm").isin(*SINKS) & ~F.col("dst").isin(*SINKS) & (F.col("frm") != F.col("dst")))
    # The net supply is one row.
    big = big.join(F.broadcast(net_supply.select("net")), F.col("v") * divisor >= F.col("net")).drop("net")
    for end in ("frm", "dst"):
        big = big.join(hubs.withColumnRenamed("addr", end), end, "left_anti")
    return big.select("frm", "dst", "v")


def funders(transfers: DataFrame, *order: str) -> DataFrame:
    """(addr, funder): first sender to each account that is not a mint and not the account itself."""
    real = transfers.filter((F.col("frm") != ZERO) & (F.col("frm") != F.col("dst")))
    return real.groupBy(F.col("dst").alias("addr")).agg(F.min(F.struct(*order, "frm")).alias("first")).select("addr", F.col("first.frm").alias("funder"))


def shared_funder(first: DataFrame, excluded: DataFrame, least: int = 2, most: int | None = None) -> DataFrame:
    """(frm, dst): star edges from funders of at least ``least`` (at most ``most``) accounts to those accounts."""
    known = first.join(excluded.select(F.col("addr").alias("funder")), "funder", "left_anti")
    size = known.groupBy("funder").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    size = size.filter(F.col("n") <= most) if most else size
    return known.join(size, "funder").select(F.col("funder").alias("frm"), F.col("addr").alias("dst"))


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(addr, root): smallest account of each connected component of ``links`` (frm, dst), for all accounts in them.

    Alternating large-star and small-star steps: rounds grow with the logarithm of the
    longest path, each is a few joins on edges, and lineage is cut at each round. An account with a large
    share of all edges gets its smallest neighbour by broadcast, so its edges stay spread.
    """
    pairs = links.filter("frm <> dst").select(F.greatest("frm", "dst").alias("u"), F.least("frm", "dst").alias("v")).distinct()
    pairs = checkpointed(pairs)
    seen, most = None, pairs.count()
    for _ in range(most_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n")).filter("n > 0")
        # Every edge has one larger end, so both steps join at most as many rows as there are edges.
        raised = hub_join(both.filter("v > u"), least, "u", "n", most)
        large = checkpointed(raised.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        near = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = hub_join(large, near, "u", "n", most).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = checkpointed(small.unionByName(near.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            tops = pairs.select(F.col("v").alias("addr"), F.col("v").alias("root")).distinct()
            return pairs.select(F.col("u").alias("addr"), F.col("v").alias("root")).unionByName(tops)
        seen, most = state, state[0]
    raise RuntimeError("components did not settle")


def clusters(roots: DataFrame, held: DataFrame, net_supply: DataFrame, divisor: int = 10_000, least: int = 3) -> DataFrame:
    """(cluster, members, total, share): components admitted by their balance or by their size."""
    sums = roots.join(held, "addr", "left").groupBy(F.col("root").alias("cluster")).agg(F.count("*").alias("members"), F.sum(F.coalesce("balance", F.lit(0))).alias("total"))
    out = sums.join(F.broadcast(net_supply.select("net")), (F.col("total") * divisor >= F.col("net")) | (F.col("members") >= least))
    return out.select("cluster", "members", "total", (F.col("total").cast("double") / F.col("net").cast("double")).alias("share"))


def tier(total: Column, net: Column, big_bps: int = 2000, small_bps: int = 500) -> Column:
    """big, small or none by the share of the supply in basis points."""
    return F.when(total * 10_000 >= net * big_bps, "big").when(total * 10_000 >= net * small_bps, "small").otherwise("none")


def ancestors(pairs: DataFrame, start: list[str], terminal: DataFrame, depth: int = 10, most_nodes: int | None = None) -> DataFrame:
    """(addr, depth, terminal): accounts that reach ``start`` against the flow, each at its least depth.

    Terminals are listed but not expanded, nor is a start that is one. ``most_nodes`` raises instead of cutting the result short.
    """
    spark = pairs.sparkSession
    back = checkpointed(pairs.filter("frm <> dst").select("frm", "dst").distinct())
    ends = checkpointed(terminal.select("addr").distinct().withColumn("terminal", F.lit(True)))
    found = checkpointed(spark.createDataFrame([(a, 0, False) for a in start], "addr string, depth int, terminal boolean"))
    frontier = found.join(ends.select("addr"), "addr", "left_anti")
    for level in range(1, depth + 1):
        live = frontier.filter(~F.col("terminal")).select(F.col("addr").alias("dst"))
        new = back.join(live, "dst", "left_semi").select(F.col("frm").alias("addr")).distinct().join(found.select("addr"), "addr", "left_anti")
        new = new.join(ends, "addr", "left").select("addr", F.lit(level).alias("depth"), F.coalesce("terminal", F.lit(False)).alias("terminal"))
        frontier = checkpointed(new)
        if frontier.isEmpty():
            break
        found = checkpointed(found.unionByName(frontier))
        if most_nodes and found.count() > most_nodes:
            raise ValueError(f"more than {most_nodes} accounts at depth {level}")
    return found


def upstream(transfers: DataFrame, members: DataFrame) -> DataFrame:
    """(feeder, v, n, share): direct senders to a group from outside it and their share of the gross inflow."""
    own = members.select(F.col("addr").alias("dst"))
    into = transfers.filter("v > 0").join(own, "dst", "left_semi").join(members.select(F.col("addr").alias("frm")), "frm", "left_anti")
    sums = into.groupBy(F.col("frm").alias("feeder")).agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    total = sums.agg(F.sum("v").alias("total"))
    return sums.join(F.broadcast(total)).select("feeder", "v", "n", (F.col("v").cast("double") / F.col("total").cast("double")).alias("share"))


def hub_class(pairs: DataFrame, private: int = 15, facility: int = 1000) -> DataFrame:
    """(addr, fan_out, class): private, grey or facility by the number of distinct recipients."""
    fan = pairs.groupBy(F.col("frm").alias("addr")).agg(F.count("*").alias("fan_out"))
    return fan.withColumn("class", F.when(F.col("fan_out") <= private, "private").when(F.col("fan_out") <= facility, "grey").otherwise("facility"))


def candidate_kinds(transfers: DataFrame, retention_pct: int = 50, bot_tx: int = 5000) -> DataFrame:
    """(addr, inflow, outflow, n_in, n_out, kind): holder by what is kept, bot by turnover or number of transfers, else exited."""
    got = transfers.groupBy(F.col("dst").alias("addr")).agg(F.sum("v").alias("inflow"), F.count("*").alias("n_in"))
    sent = transfers.groupBy(F.col("frm").alias("addr")).agg(F.sum("v").alias("outflow"), F.count("*").alias("n_out"))
    both = got.join(sent, "addr", "left").fillna(0, ["outflow", "n_out"])
    kept = (F.col("inflow") - F.col("outflow")) * 100 >= F.col("inflow") * retention_pct
    turned = (F.col("outflow") >= F.col("inflow")) | (F.col("n_in") + F.col("n_out") >= bot_tx)
    return both.withColumn("kind", F.when(kept, "holder").when(turned, "bot").otherwise("exited"))
