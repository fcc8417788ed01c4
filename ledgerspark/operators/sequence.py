"""Sessions, order fingerprints and co-timing of accounts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerspark.functions.ranges import PART, by_ranges, last_known, ranked, running
from ledgerspark.functions.shared import Scratch, checkpointed
from ledgerspark.operators.setjoin import similar_sets


def sessions(rows: DataFrame, key: str, gap: int) -> DataFrame:
    """Adds ``session`` (from 1) within ``key``: silence of strictly more than ``gap`` seconds starts a new one. (key, ts, seq) is unique."""
    order = ["ts", "seq"]
    before = last_known(by_ranges(rows, key, *order), order, F.col("ts"), "_before", key, strict=True)
    fresh = F.coalesce((F.col("ts") - F.col("_before") > gap).cast("long"), F.lit(1).cast("long"))
    return running(before, order, fresh, "session", key).drop("_before", PART)


def first_actions(batches: DataFrame, batch: list[str], member: str) -> DataFrame:
    """(batch, member, ts, seq, rank): each member's first action in a batch and its place in the batch's order."""
    first = batches.groupBy(*batch, member).agg(F.min(F.struct("ts", "seq")).alias("at"))
    placed = ranked(first.select(F.struct(*batch).alias("_batch"), member, "at.ts", "at.seq"), ["ts", "seq", member], "rank", "_batch")
    return placed.select("_batch.*", member, "ts", "seq", "rank")


def order_matches(actions: DataFrame, batch: str, member: str, least: int = 4) -> DataFrame:
    """(a, b, common, forward, reverse): batches that share at least ``least`` members, and places that agree or mirror among the common ones.

    ``actions``: (batch, member, rank), a member once in a batch. Batches meet through their rare members (``similar_sets``).
    """
    rows = checkpointed(actions.select(batch, member, "rank"))
    pairs = similar_sets(rows.select(F.col(batch).alias("set"), F.col(member).alias("item")), least=least).select("a", "b", "common")
    own = lambda name, rank: rows.select(F.col(batch).alias(name), F.col(member).alias("m"), F.col("rank").alias(rank))
    met = pairs.join(own("a", "ra"), "a").join(own("b", "rb"), ["b", "m"])
    # A pair of batches is one group: as many rows as the smaller of the two has members.
    both = Window.partitionBy("a", "b")
    placed = met.withColumns({"pa": F.row_number().over(both.orderBy("ra")), "pb": F.row_number().over(both.orderBy("rb"))})
    return placed.groupBy("a", "b").agg(F.first("common").alias("common"), F.count_if(F.col("pa") == F.col("pb")).alias("forward"), F.count_if(F.col("pb") == F.col("common") + 1 - F.col("pa")).alias("reverse"))


def p_random(n: Column, matched: Column) -> Column:
    """Upper bound of the probability that ``matched`` of ``n`` places agree by chance: C(n, m) (n - m)! / n! = 1 / m!; 1 / n! if all agree."""
    return 1.0 / F.exp(F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(n, matched), F.lit(1)).cast("int")), F.lit(0.0), lambda acc, k: acc + F.ln(k.cast("double"))))


def spearman(actions: DataFrame, batch: str, member: str, world: DataFrame, least: int = 6) -> DataFrame:
    """(batch, n, d2, rho): rank correlation of a batch's order with the members' order in ``world`` (member, rank)."""
    both = actions.select(batch, member, F.col("rank").alias("_own")).join(world.select(member, F.col("rank").alias("_world")), member)
    placed = ranked(ranked(both, ["_own", member], "p", batch), ["_world", member], "g", batch)
    sums = placed.groupBy(batch).agg(F.count("*").alias("n"), F.sum(((F.col("p") - F.col("g")) * (F.col("p") - F.col("g"))).cast("long")).alias("d2")).filter(F.col("n") >= least)
    return sums.withColumn("rho", 1 - 6.0 * F.col("d2") / (F.col("n") * (F.col("n") * F.col("n") - 1)).cast("double"))


def permutation_test(actions: DataFrame, batch: str, member: str, world: DataFrame, least: int = 6, shuffles: int = 3000, seed: int = 7) -> DataFrame:
    """(batch, n, rho, p): share of seeded random orders with at least the batch's correlation.

    Only the number of members matters to the null distribution, so each task keeps one for
    each size; the seed is the size's, so a task that runs again gives the same numbers.
    """
    found = spearman(actions, batch, member, world, least)
    schema = T.StructType([*found.schema.fields, T.StructField("p", T.DoubleType())])

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, np.ndarray] = {}
        for part in parts:
            values = []
            for n, rho in zip(part["n"], part["rho"], strict=True):
                if n not in known:
                    rng = np.random.default_rng([seed, n])
                    order = np.arange(n)
                    d2 = np.array([((rng.permutation(n) - order) ** 2).sum() for _ in range(shuffles)])
                    known[n] = np.abs(1 - 6.0 * d2 / (n * (n * n - 1)))
                values.append((1 + int((known[n] >= abs(rho) - 1e-12).sum())) / (1 + shuffles))
            yield part.assign(p=values)

    return found.mapInPandas(work, schema)


def co_timed(rows: DataFrame, member: str, *moment: str, least: int = 5) -> DataFrame:
    """(moment, members, n, total): moments at which at least ``least`` different members acted."""
    per = rows.groupBy(*moment, member).agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    return per.groupBy(*moment).agg(F.count("*").alias("members"), F.sum("n").alias("n"), F.sum("v").alias("total")).filter(F.col("members") >= least)


def merged_candidates(candidates: DataFrame, order: str, member: str, least: int = 3) -> DataFrame:
    """(order, group): candidate groups, each joined to the first earlier one that shares max(least, half of its members); a group is named by its first candidate.

    ``candidates``: (order, member), with ``order`` one number a candidate; the order decides. Rounds settle many candidates at once.
    What a candidate joins depends only on earlier ones that have a member of its own, so one settles when all of those have.
    And one that shares enough with the first group of its component settles at once, as no group can come before that; only
    members count that candidates before it have brought. Rounds are thus as many as the longest chain of candidates outside those first groups.
    """
    from ledgerspark.operators.graph import components

    scratch = Scratch(candidates.sparkSession)
    rows = scratch.put(candidates.select(F.col(order).cast("long").alias("c"), F.col(member).alias("m")).distinct())
    top = components(rows.join(rows.groupBy("m").agg(F.min("c").alias("f")), "m").select(F.col("f").alias("frm"), F.col("c").alias("dst")))
    sizes = rows.groupBy("c").agg(F.greatest(F.lit(least), F.floor(F.count("*") / 2)).alias("need")).join(top.select(F.col("addr").alias("c"), "root"), "c", "left")
    sizes = scratch.put(sizes.select("c", "need", F.coalesce("root", "c").alias("root")))
    still, done, held = rows, [], rows.select(F.col("c").alias("g"), "m", F.col("c").alias("by")).limit(0)
    while not still.isEmpty():
        first = still.groupBy("m").agg(F.min("c").alias("f"))
        waits = still.join(first, "m").groupBy("c").agg(F.bool_or(F.col("f") < F.col("c")).alias("waits"))
        share = still.join(held, "m").filter("by < c").groupBy("c", "g").agg(F.count("*").alias("k")).join(sizes, "c").filter("k >= need")
        best = waits.join(share.groupBy("c").agg(F.min("g").alias("g")), "c", "left").join(sizes.select("c", "root"), "c")
        into = scratch.put(best.filter("not waits or g = root").select("c", F.coalesce("g", "c").alias("g")))
        done.append(into)
        brought = still.join(into, "c").select("g", "m", F.col("c").alias("by"))
        held = scratch.put(held.unionByName(brought).groupBy("g", "m").agg(F.min("by").alias("by")))
        still = scratch.put(still.join(into.select("c"), "c", "left_anti"))
    every = rows.select("c", F.col("c").alias("g")).limit(0)
    for into in done:
        every = every.unionByName(into)
    result = checkpointed(every.select(F.col("c").alias(order), F.col("g").alias("group")))
    scratch.clear()
    return result


def hit_windows(tested: DataFrame, p: float = 0.002, rho: float = 0.75) -> DataFrame:
    """Batches of ``permutation_test`` whose order is no chance."""
    return tested.filter((F.col("p") <= p) & (F.abs("rho") >= rho))


def hit_entities(tested: DataFrame, actions: DataFrame, batch: str, member: str, least: int = 6, **limits: float) -> DataFrame:
    """(addr, root): members joined through the hit batches that they share, in groups of at least ``least``."""
    from ledgerspark.operators.graph import components

    hits = actions.join(hit_windows(tested, **limits).select(batch), batch, "left_semi").select(batch, F.col(member).alias("dst"))
    # A star for each batch: its least member with all others.
    centre = hits.groupBy(batch).agg(F.min("dst").alias("frm"))
    roots = components(hits.join(centre, batch).select("frm", "dst"))
    large = roots.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("root")
    return roots.join(large, "root", "left_semi").select("addr", "root")
