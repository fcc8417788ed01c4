"""Reconciliation: duplicates across sources, comparison of providers, and gates that return rows of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.joins import interval_join
from ledgerspark.functions.ranges import by_ranges, running
from ledgerspark.functions.shared import checkpointed
from ledgerspark.operators import ledger
from ledgerspark.sources.adapters import SINKS, ZERO


def deduplicated_strict(rows: DataFrame, key: list[str], payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """One row for each key, and the conflicts (key, copies, payloads); a ledger with conflicts must not be used."""
    return ledger.deduplicated(rows, key), ledger.dedup_conflicts(rows, key, payload)


def run_ranges(rows: DataFrame, run: str, block: str = "block") -> DataFrame:
    """(run, lo, hi, n): blocks that each run covers."""
    return rows.groupBy(run).agg(F.min(block).alias("lo"), F.max(block).alias("hi"), F.count("*").alias("n"))


def overlaps(ranges: DataFrame, run: str) -> DataFrame:
    """(a, b, lo, hi): blocks that two runs share. Of two ranges that meet, one begins within the other."""
    own = ranges.select(F.col(run).alias("_in"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    met = interval_join(ranges.select(F.col(run).alias("_run"), "lo", "hi"), "lo", own, "_lo", "_hi").filter("_run <> _in")
    first = F.col("_run") < F.col("_in")
    return met.select(F.when(first, F.col("_run")).otherwise(F.col("_in")).alias("a"), F.when(first, F.col("_in")).otherwise(F.col("_run")).alias("b"), "lo", F.least("hi", "_hi").alias("hi")).distinct()


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """(lo, hi): the union of closed ranges as disjoint ones. A range opens a new one if it begins after all before it have ended."""
    from pyspark.sql.window import Window

    # Few ranges: one row for each pair of runs.
    before = Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.when(F.col("lo") > F.coalesce(F.max("hi").over(before), F.lit(-1)), 1).otherwise(0)
    numbered = ranges.withColumn("_new", fresh).withColumn("_n", F.sum("_new").over(Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("_n").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_n")


def overlap_dedup(rows: DataFrame, run: str, key: list[str], block: str = "block") -> DataFrame:
    """One row for each key; only rows of blocks that several runs cover are grouped, all others pass as they are."""
    ranges = merged_ranges(overlaps(run_ranges(rows, run, block), run)).withColumnsRenamed({"lo": "_lo", "hi": "_hi"})
    # One row for each covered block; Spark broadcasts it if that is small.
    covered = checkpointed(interval_join(rows.select(block).distinct(), block, ranges, "_lo", "_hi").select(block))
    return rows.join(covered, block, "left_anti").select(*rows.columns).unionByName(ledger.deduplicated(rows.join(covered, block, "left_semi").select(*rows.columns), key))


def transaction_digests(rows: DataFrame, source: str, tx: list[str], content: list[str]) -> DataFrame:
    """(source, tx, n, digest): of each transaction in each source, a digest of its rows in any order.

    The digest adds up hashes of the rows, so a transaction of any size is aggregated before the shuffle.
    """
    value = F.conv(F.substring(F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(source, *tx).agg(F.count("*").alias("n"), F.sum(value).alias("digest"))


def complete_transactions(rows: DataFrame, source: str, tx: list[str], content: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of each transaction from its first source, and the transactions (tx, sources, digests) that sources tell differently."""
    seen = transaction_digests(rows, source, tx, content)
    per = seen.groupBy(*tx).agg(F.min(source).alias("_first"), F.count("*").alias("sources"), F.countDistinct("n", "digest").alias("digests"))
    kept = rows.join(per.select(*tx, F.col("_first").alias(source)), [*tx, source], "left_semi")
    return kept, per.filter("digests > 1").select(*tx, "sources", "digests")


def merge_check(a: DataFrame, b: DataFrame, key: list[str], payload: list[str], block: str = "block") -> DataFrame:
    """One row (lo, hi, only_a, only_b, differing, passes): keys of two sources in the blocks that both cover."""
    ranges = a.agg(F.min(block).alias("alo"), F.max(block).alias("ahi")).join(F.broadcast(b.agg(F.min(block).alias("blo"), F.max(block).alias("bhi"))))
    # One row.
    shared = ranges.select(F.greatest("alo", "blo").alias("lo"), F.least("ahi", "bhi").alias("hi"))
    digest = F.sha2(F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}), 256)
    cut = lambda rows, name: rows.join(F.broadcast(shared), (F.col(block) >= F.col("lo")) & (F.col(block) <= F.col("hi"))).groupBy(*key).agg(F.max(digest).alias(name))
    both = cut(a, "_a").join(cut(b, "_b"), key, "full")
    counts = both.agg(F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"), F.count_if(F.col("_a") != F.col("_b")).alias("differing"))
    return shared.join(F.broadcast(counts)).withColumn("passes", (F.col("only_a") == 0) & (F.col("only_b") == 0) & (F.col("differing") == 0))


def multiset_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (missing, extra, equal): rows of ``a`` that ``b`` lacks and the other way round, counted with repeats."""
    from ledgerspark.operators.gates import multiset_diff

    gap = multiset_diff(a, b)
    out = gap.agg(F.coalesce(F.sum(F.greatest(F.col("in_a") - F.col("in_b"), F.lit(0))), F.lit(0)).alias("missing"), F.coalesce(F.sum(F.greatest(F.col("in_b") - F.col("in_a"), F.lit(0))), F.lit(0)).alias("extra"))
    return out.withColumn("equal", (F.col("missing") == 0) & (F.col("extra") == 0))


def owner_mismatches(replayed: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(addr, replayed, snapshot, gap) of accounts whose balances differ; an absent one has zero."""
    both = replayed.select("addr", F.col("balance").alias("replayed")).join(snapshot.select("addr", F.col("balance").alias("snapshot")), "addr", "full")
    both = both.fillna(0, ["replayed", "snapshot"])
    return both.filter("replayed <> snapshot").withColumn("gap", F.col("replayed") - F.col("snapshot"))


def pairings(deltas: DataFrame, tx: str = "tx") -> DataFrame:
    """(tx, frm, dst, v): the net changes (tx, owner, delta) of each transaction as transfers, largest first on both sides.

    Cumulative sums lay givers and takers of a transaction side by side; where their stretches
    overlap, that much went from one to the other. What is left on either side comes from or goes to ``ZERO``.
    """
    ranged = by_ranges(deltas.filter("delta <> 0").select(F.struct(tx, (F.col("delta") > 0).alias("up")).alias("_g"), F.abs("delta").alias("x"), "owner").withColumn("_down", -F.col("x")), "_g", "_down", "owner")
    ends = running(ranged, ["_down", "owner"], F.col("x"), "hi", "_g").select(F.col(f"_g.{tx}").alias(tx), F.col("_g.up").alias("up"), "owner", (F.col("hi") - F.col("x")).alias("lo"), "hi")
    sums = ends.groupBy(tx).agg(F.coalesce(F.max(F.when(F.col("up"), F.col("hi"))), F.lit(0)).alias("got"), F.coalesce(F.max(F.when(~F.col("up"), F.col("hi"))), F.lit(0)).alias("gave"))
    rest = sums.filter("got <> gave").select(tx, (F.col("gave") > F.col("got")).alias("up"), F.lit(ZERO).alias("owner"), F.least("got", "gave").alias("lo"), F.greatest("got", "gave").alias("hi"))
    every = ends.unionByName(rest)
    a = every.filter("not up").select(tx, F.col("owner").alias("frm"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
    b = every.filter("up").select(tx, F.col("owner").alias("dst"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
    met = a.join(b, tx).filter(F.greatest("alo", "blo") < F.least("ahi", "bhi"))
    return met.select(tx, "frm", "dst", (F.least("ahi", "bhi") - F.greatest("alo", "blo")).alias("v"))


def partition_check(universe: DataFrame, accepted: DataFrame, excluded: DataFrame, key: str = "addr") -> DataFrame:
    """(addr, problem): ``both`` sides hold it, ``neither`` does, or it is ``unknown`` to the universe."""
    all_ = universe.select(key).distinct().withColumn("_u", F.lit(True))
    both = all_.join(accepted.select(key).distinct().withColumn("_a", F.lit(True)), key, "full").join(excluded.select(key).distinct().withColumn("_e", F.lit(True)), key, "full")
    problem = F.when(F.col("_u").isNull(), "unknown").when(F.col("_a") & F.col("_e"), "both").when(F.col("_a").isNull() & F.col("_e").isNull(), "neither")
    return both.select(key, problem.alias("problem")).filter("problem is not null")


def uncovered(required: DataFrame, candidates: DataFrame, key: str = "addr") -> DataFrame:
    """Required keys that are no candidates."""
    return required.select(key).distinct().join(candidates.select(key), key, "left_anti")


def fee_on_transfer(samples: DataFrame) -> DataFrame:
    """(…, gap, verdict) of (value, before, after): what the recipient gained against the value; tolerance max(2, value / 10^6)."""
    gap = F.col("value") - (F.col("after") - F.col("before"))
    allowed = F.greatest(F.lit(2), F.floor(F.col("value") / 1_000_000))
    return samples.withColumn("gap", gap).withColumn("verdict", F.when(F.abs(gap) <= allowed, "OK").when(gap > 0, "FEE").otherwise("GAIN"))


def rebase_drift(before: DataFrame, after: DataFrame, moved: DataFrame, minted: Column, burned: Column) -> DataFrame:
    """One row (supply_drift, quiet, drifted, passes): supply against mint and burn, and balances of accounts without any event in between.

    ``before``, ``after``: (addr, balance); ``moved``: transfers in between.
    """
    both = before.select("addr", F.col("balance").alias("b")).join(after.select("addr", F.col("balance").alias("a")), "addr", "full").fillna(0, ["a", "b"])
    active = moved.select(F.explode(F.array("frm", "dst")).alias("addr")).distinct().withColumn("_m", F.lit(True))
    marked = both.join(active, "addr", "left")
    out = marked.agg(F.coalesce(F.sum(F.col("a") - F.col("b")), F.lit(0)).alias("grown"), F.count_if(F.col("_m").isNull()).alias("quiet"), F.count_if(F.col("_m").isNull() & (F.col("a") != F.col("b"))).alias("drifted"))
    flow = moved.agg(F.coalesce(minted, F.lit(0)).alias("_in"), F.coalesce(burned, F.lit(0)).alias("_out"))
    out = out.join(F.broadcast(flow)).select((F.col("grown") - F.col("_in") + F.col("_out")).alias("supply_drift"), "quiet", "drifted")
    return out.withColumn("passes", (F.col("supply_drift") == 0) & (F.col("drifted") == 0))


def supply_truth(observed: Column, replayed: Column, in_sinks: Column, bps: int = 10) -> Column:
    """MATCH within ``bps`` of the replayed net supply; MATCH_WITH_SINKS if exactly what lies in the sinks is counted, too; else MISMATCH."""
    close = F.abs(observed - replayed) * 10_000 <= replayed * bps
    return F.when(close, "MATCH").when(observed == replayed + in_sinks, "MATCH_WITH_SINKS").otherwise("MISMATCH")


def series_endpoints(series: DataFrame, group: str, shares: DataFrame, points: int = 5) -> DataFrame:
    """(group, last, now, verdict): the last share of each series against a share computed anew, within ``points`` hundredths of a percent point."""
    last = series.groupBy(group).agg(F.max_by("share", "day").alias("last"))
    both = last.join(shares.select(group, F.col("share").alias("now")), group, "full")
    near = F.abs(F.col("last") - F.col("now")) * 10_000 <= points
    return both.withColumn("verdict", F.when(F.col("last").isNull() | F.col("now").isNull(), "MISSING").when(near, "OK").otherwise("DRIFT"))


def series_problems(series: DataFrame, group: str, allowed: list[str]) -> DataFrame:
    """(problem, n): groups that are not allowed, values that are no numbers or out of range, days that come twice, and days whose shares exceed one."""
    odd = F.isnan("share") | F.col("share").isNull()
    rows = series.agg(
        F.count_if(~F.col(group).isin(*allowed)).alias("unknown_group"),
        F.count_if(odd).alias("not_finite"),
        F.count_if(~odd & ((F.col("share") < 0) | (F.col("share") > 1))).alias("out_of_range"),
    )
    twice = series.groupBy(group, "day").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("repeated_day"))
    over = series.groupBy("day").agg(F.sum("share").alias("s")).agg(F.count_if(F.col("s") > 1 + 1e-9).alias("over_one"))
    # Each side is one row.
    one = rows.join(F.broadcast(twice)).join(F.broadcast(over))
    names = ["unknown_group", "not_finite", "out_of_range", "repeated_day", "over_one"]
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("problem"), F.col(n).alias("n")) for n in names])))


def ledger_closure(members: DataFrame, positions: DataFrame, control: DataFrame) -> DataFrame:
    """(entity, problem): the three ledgers of an entity against each other.

    ``members``: (entity, addr); ``positions``: (entity, addr, balance); ``control``: (entity, key, amount).
    """
    twice = members.groupBy("addr").agg(F.count("*").alias("n"), F.min("entity").alias("entity")).filter("n > 1").select("entity", F.lit("member_twice").alias("problem"))
    lost = members.join(positions.select("entity", "addr"), ["entity", "addr"], "left_anti").select("entity", F.lit("member_without_position").alias("problem"))
    alien = positions.join(members.select("entity", "addr"), ["entity", "addr"], "left_anti").select("entity", F.lit("position_without_member").alias("problem"))
    double = control.groupBy("key").agg(F.count("*").alias("n"), F.min("entity").alias("entity")).filter("n > 1").select("entity", F.lit("right_counted_twice").alias("problem"))
    held = positions.groupBy("entity").agg(F.sum("balance").alias("held"))
    owned = control.groupBy("entity").agg(F.sum("amount").alias("owned"))
    short = held.join(owned, "entity", "full").filter("coalesce(owned, 0) < coalesce(held, 0)").select("entity", F.lit("control_below_positions").alias("problem"))
    return twice.unionByName(lost).unionByName(alien).unionByName(double).unionByName(short).distinct()


def adjudication_problems(candidates: DataFrame, decisions: DataFrame, net: DataFrame, big_bps: int = 2000, small_bps: int = 500) -> DataFrame:
    """(addr, problem): candidates and decisions that don't close.

    ``candidates``: (addr, balance, must); ``decisions``: (addr, verdict, reason, entity, tier). A verdict is accepted or
    excluded; the tier of an accepted one must follow from its entity's share of the net supply.
    """
    from ledgerspark.operators.graph import tier

    found = []
    add = lambda rows, problem: found.append(rows.select("addr", F.lit(problem).alias("problem")))
    one = decisions.groupBy("addr").agg(F.count("*").alias("n"))
    add(candidates.filter("must").join(decisions, "addr", "left_anti"), "not_decided")
    add(decisions.join(candidates, "addr", "left_anti"), "not_a_candidate")
    add(one.filter("n > 1"), "decided_twice")
    add(decisions.filter("coalesce(verdict, '') not in ('accepted', 'excluded')"), "unknown_verdict")
    add(decisions.filter("coalesce(reason, '') = ''"), "no_reason")
    add(decisions.filter("verdict = 'accepted' and entity is null"), "no_entity")
    add(decisions.filter("verdict = 'excluded' and entity is not null"), "excluded_with_entity")
    sums = decisions.filter("verdict = 'accepted'").join(candidates.select("addr", "balance"), "addr").groupBy("entity").agg(F.sum("balance").alias("total"))
    graded = sums.join(F.broadcast(net.select("net"))).select("entity", tier(F.col("total"), F.col("net"), big_bps, small_bps).alias("due"))
    add(decisions.filter("verdict = 'accepted'").join(graded, "entity").filter("not (tier <=> due)"), "wrong_tier")
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out.distinct()


def sink_balances(held: DataFrame) -> DataFrame:
    """One row (in_sinks): what lies in the sinks."""
    return held.filter(F.col("addr").isin(*SINKS)).agg(F.coalesce(F.sum("balance"), F.lit(0)).alias("in_sinks"))


