"""Balances, supply, peaks and duplicate checks over canonical transfers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.functions.prefix import prefix_sums
from ledgerspark.functions.shared import checkpointed
from ledgerspark.sources.adapters import SINKS, ZERO


def deltas(transfers: DataFrame, *carry: str) -> DataFrame:
    """(addr, x, *carry): signed changes of balances, from one pass; a mint doesn't debit ``ZERO``."""
    legs = F.array(F.struct(F.col("dst").alias("addr"), F.col("v").alias("x")), F.struct(F.col("frm").alias("addr"), (-F.col("v")).alias("x")))
    legs = F.when(F.col("frm") == ZERO, F.slice(legs, 1, 1)).otherwise(legs)
    return transfers.select(*carry, F.inline(legs))


def balances(transfers: DataFrame) -> DataFrame:
    """(addr, balance)."""
    return deltas(transfers).groupBy("addr").agg(F.sum("x").alias("balance"))


def minted() -> Column:
    return F.sum(F.when(F.col("frm") == ZERO, F.col("v")).otherwise(0))


def burned() -> Column:
    return F.sum(F.when(F.col("dst").isin(*SINKS), F.col("v")).otherwise(0))


def supply(transfers: DataFrame) -> DataFrame:
    """One row (minted, burned, net): lifetime mint and burn, and the current net supply."""
    return transfers.agg(minted().alias("minted"), burned().alias("burned"), (minted() - burned()).alias("net"))


def stats(transfers: DataFrame) -> DataFrame:
    """One row: totals, accounts, negative balances, and whether the balances close to the mint."""
    held = balances(transfers).agg(F.count("*").alias("accounts"), F.sum("balance").alias("sum_balances"), F.count_if(F.col("balance") < 0).alias("negative_accounts"))
    out = transfers.agg(
        F.count("*").alias("transfers"),
        minted().alias("mint_total"),
        burned().alias("burn_total"),
        F.sum(F.when(F.col("frm").isin(*SINKS) & (F.col("frm") != ZERO), F.col("v")).otherwise(0)).alias("sink_outflow"),
    )
    # Both sides are one row.
    return out.crossJoin(F.broadcast(held)).withColumn("closes", F.col("sum_balances") == F.col("mint_total"))


def mint_ledger(transfers: DataFrame) -> DataFrame:
    """(addr, minted, mints) by recipient."""
    return transfers.filter(F.col("frm") == ZERO).groupBy(F.col("dst").alias("addr")).agg(F.sum("v").alias("minted"), F.count("*").alias("mints"))


def first_last(transfers: DataFrame) -> DataFrame:
    """(addr, first_block, last_block); ``ZERO`` has no first block and is last active as a recipient."""
    seen = F.when(F.col("addr") != ZERO, F.col("block"))
    return deltas(transfers, "block").groupBy("addr").agg(F.min(seen).alias("first_block"), F.max("block").alias("last_block"))


def block_peaks(transfers: DataFrame, share: int = 1000) -> DataFrame:
    """(addr, peak, peak_block): highest end-of-block balance and the first block that reaches it.

    Kept if positive and at least ``mint // share``. The ledger is read once, for one row an account and block, of which two bounds
    choose accounts before anything is ordered: a balance can't exceed what came in, nor the sum of the positive nets of blocks.
    """
    mint = F.when(F.col("frm") == ZERO, F.col("v")).otherwise(0)
    legs = F.array(F.struct(F.col("dst").alias("addr"), F.col("v").alias("x"), mint.alias("m")), F.struct(F.col("frm").alias("addr"), (-F.col("v")).alias("x"), (mint * 0).alias("m")))
    legs = F.when(F.col("frm") == ZERO, F.slice(legs, 1, 1)).otherwise(legs)
    nets = transfers.select("block", F.inline(legs)).groupBy("addr", "block").agg(F.sum("x").alias("net"), F.sum(F.greatest("x", F.lit(0))).alias("_in"), F.sum("m").alias("_mint"))
    nets = checkpointed(nets)
    least = nets.agg(F.floor(F.sum("_mint") / share).alias("least"))
    bounds = nets.groupBy("addr").agg(F.sum("_in").alias("_all"), F.sum(F.greatest("net", F.lit(0))).alias("_up"))
    able = bounds.join(F.broadcast(least), (F.col("_all") >= F.col("least")) & (F.col("_up") >= F.col("least"))).select("addr", "least")
    running = prefix_sums(nets.select("addr", "block", "net").join(able, "addr"), "addr", "block", "net", "held")
    best = running.groupBy("addr").agg(F.max("held").alias("peak"), F.max_by("block", F.struct("held", -F.col("block"))).alias("peak_block"), F.first("least").alias("least"))
    return best.filter("peak > 0 and peak >= least").drop("least")


def dedup_conflicts(rows: DataFrame, key: list[str], payload: list[str]) -> DataFrame:
    """(key, copies, payloads): keys that occur with more than one payload."""
    # A digest of the payload keeps the shuffled row short; its columns are hashed with their nulls.
    digest = F.sha2(F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}), 256)
    counted = rows.groupBy(*key, digest.alias("_payload")).agg(F.count("*").alias("n"))
    return counted.groupBy(*key).agg(F.sum("n").alias("copies"), F.count("*").alias("payloads")).filter("payloads > 1")


def deduplicated(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key: the smallest by all its columns, so the choice doesn't depend on the order of rows."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row")).select(*key, "_row.*").select(*rows.columns)


def duplicate_keys(rows: DataFrame, key: list[str], segment: Column) -> DataFrame:
    """(segment, keys, duplicate_keys, extra_rows): proof of uniqueness for each segment of keys."""
    counted = rows.groupBy(segment.alias("segment"), *key).agg(F.count("*").alias("n"))
    return counted.groupBy("segment").agg(F.count("*").alias("keys"), F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.sum(F.col("n") - 1).alias("extra_rows"))


def rejects(rows: DataFrame, valid: Column, inside: Column, key: list[str]) -> DataFrame:
    """One row: source rows, rows with bad fields, rows out of the segment, and rows that deduplication removes."""
    good = F.coalesce(valid, F.lit(False))
    marked = rows.select(*key, good.alias("good"), F.coalesce(inside, F.lit(False)).alias("inside"))
    keys = marked.groupBy(*key).agg(
        F.count("*").alias("n"), F.count_if(~F.col("good")).alias("bad"), F.count_if(F.col("good") & ~F.col("inside")).alias("outside"), F.count_if(F.col("good") & F.col("inside")).alias("kept")
    )
    out = keys.agg(F.sum("n").alias("n_source_rows"), F.sum("bad").alias("n_bad_fields"), F.sum("outside").alias("n_out_of_segment"), F.sum(F.greatest(F.col("kept") - 1, F.lit(0))).alias("n_dedup_removed"))
    return out.withColumn("passes", (F.col("n_bad_fields") == 0) & (F.col("n_out_of_segment") == 0))


def daily_deltas(transfers: DataFrame, day: Column) -> DataFrame:
    """(addr, day, delta, gross_in)."""
    moves = deltas(transfers.withColumn("day", day), "day")
    return moves.groupBy("addr", "day").agg(F.sum("x").alias("delta"), F.sum(F.greatest("x", F.lit(0))).alias("gross_in"))


def daily_bounds(daily: DataFrame) -> DataFrame:
    """(addr, peak_close, peak_day, bound, bound_day, final): daily closes and what a day could have reached at most.

    The bound is the close before the day plus all that came in on it; of equal values the
    earliest day counts.
    """
    closes = prefix_sums(daily, "addr", "day", "delta", "close")
    closes = closes.withColumn("most", F.col("close") - F.col("delta") + F.col("gross_in"))
    return closes.groupBy("addr").agg(
        F.max("close").alias("peak_close"),
        F.max_by("day", F.struct("close", -F.col("day"))).alias("peak_day"),
        F.max("most").alias("bound"),
        F.max_by("day", F.struct("most", -F.col("day"))).alias("bound_day"),
        F.max_by("close", "day").alias("final"),
    )


def needs_block_precision(bounds: DataFrame, levels: list[int]) -> DataFrame:
    """(addr, level): the daily close is below a level that the bound reaches."""
    return bounds.select("addr", "peak_close", "bound", F.explode(F.array(*map(F.lit, levels))).alias("level")).filter("peak_close < level and level <= bound").select("addr", "level")


def supply_daily(transfers: DataFrame, day: Column) -> DataFrame:
    """(day, delta, net): mint less burn of each day and their running sum; one row a day."""
    days = transfers.groupBy(day.alias("day")).agg((minted() - burned()).alias("delta"))
    # The days of a ledger are few, whatever its size.
    return days.withColumn("net", F.sum("delta").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)))


def group_series(daily: DataFrame, members: DataFrame, group: str) -> DataFrame:
    """(day, group, delta, balance) of groups of accounts, on every day on which the group changed."""
    days = daily.join(members, "addr").groupBy(group, "day").agg(F.sum("delta").alias("delta"))
    return days.withColumn("balance", F.sum("delta").over(Window.partitionBy(group).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)))


def group_share(series: DataFrame, net: DataFrame, group: str) -> DataFrame:
    """Adds ``share``, the balance over the net supply of the day; ``net`` has every day of the ledger."""
    held = series.join(net.select("day", "net"), "day")
    return held.withColumn("share", F.when(F.col("net") > 0, F.col("balance").cast("double") / F.col("net").cast("double")))


def negative_gate(daily: DataFrame) -> DataFrame:
    """One row: accounts, how many end below zero, how many ever closed a day below zero, and the verdict."""
    closes = prefix_sums(daily, "addr", "day", "delta", "close").groupBy("addr").agg(F.min("close").alias("least"), F.max_by("close", "day").alias("final"))
    out = closes.agg(F.count("*").alias("accounts"), F.count_if(F.col("final") < 0).alias("negative_final"), F.count_if(F.col("least") < 0).alias("negative_minimum"))
    return out.withColumn("passes", F.col("negative_minimum") == 0)
