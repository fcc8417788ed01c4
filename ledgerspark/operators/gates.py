"""Reconciliation: comparisons and coverage checks that return rows of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.functions.ranges import by_ranges, last_known


def snapshot_diff(old: DataFrame, new: DataFrame, least: int = 1) -> DataFrame:
    """(addr, old, new, delta, kind): accounts whose balance changed by at least ``least``."""
    both = old.select("addr", F.col("balance").alias("old")).join(new.select("addr", F.col("balance").alias("new")), "addr", "full")
    both = both.select("addr", F.coalesce("old", F.lit(0)).alias("old"), F.coalesce("new", F.lit(0)).alias("new")).withColumn("delta", F.col("new") - F.col("old"))
    kind = F.when(F.col("old") == 0, "new").when(F.col("new") == 0, "zeroed").otherwise("changed")
    return both.filter(F.abs("delta") >= least).withColumn("kind", kind)


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side with another count on the other: columns, ``in_a``, ``in_b``. One aggregation, no sort of rows."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = a.withColumns({"in_a": one, "in_b": zero}).unionByName(b.withColumns({"in_a": zero, "in_b": one}))
    return both.groupBy(*a.columns).agg(F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b")).filter("in_a <> in_b")


def holes(points: DataFrame, column: str) -> DataFrame:
    """(lo, hi): ranges ``[lo, hi)`` of whole numbers that no row covers, between the first and the last."""
    seen = by_ranges(points.select(F.col(column).alias("p")).distinct(), "p")
    after = last_known(seen, ["p"], F.col("p"), "next", strict=True, backward=True)
    return after.filter("next > p + 1").select((F.col("p") + 1).alias("lo"), F.col("next").alias("hi"))


def contiguity(channels: DataFrame) -> DataFrame:
    """(tag, lo, hi, next_lo, verdict): whether each channel ``[lo, hi)`` ends where the next begins."""
    after = channels.withColumn("next_lo", F.lead("lo").over(Window.orderBy("lo", "hi", "tag")))
    verdict = F.when(F.col("next_lo").isNull(), "end").when(F.col("next_lo") > F.col("hi"), "hole").when(F.col("next_lo") < F.col("hi"), "overlap").otherwise("ok")
    return after.withColumn("verdict", verdict)


def stratified_sample(rows: DataFrame, strata: list[str], key: Column, most: int) -> DataFrame:
    """``most`` rows of each stratum in the order of a portable hash of their key; the sample is the feature."""
    order = F.md5(key)
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(*strata).orderBy(order, key)))
    return ranked.filter(F.col("_k") <= most).drop("_k")
