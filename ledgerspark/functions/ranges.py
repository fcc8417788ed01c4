"""Ordered work that puts neither a whole table nor a whole key into one task.

Rows are sorted into ranges of about equal numbers of rows; values then pass from range to
range through one small row for each group and range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.functions.shared import checkpointed

PART = "_part"


def by_ranges(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with ``_part``, the number of their range in the order of ``keys``. Keys that tell rows apart also split a hot first key."""
    return checkpointed(rows.repartitionByRange(*keys).withColumn(PART, F.spark_partition_id()))


def _group(group: str | None) -> list[str]:
    return [group] if group else []


def _with_ranges(ranged: DataFrame, per: DataFrame, group: str | None, *columns: str) -> DataFrame:
    """Join what is known of a range to its rows; a group may be null."""
    names = [*_group(group), PART]
    per = per.select(*[F.col(n).alias(f"_r_{n}") for n in names], *columns)
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_r_{n}"))
    return ranged.join(per, same).drop(*[f"_r_{n}" for n in names])


def last_known(ranged: DataFrame, order: list[str], value: Column, out: str, group: str | None = None, strict: bool = False, backward: bool = False) -> DataFrame:
    """Adds ``out``: the last ``value`` that is not null at or before each row in ``order``, within ``group``.

    ``strict``: before the row only; ``backward``: the next one after it instead.
    """
    turn = F.desc if backward else F.asc
    rows = ranged.withColumn("_v", value)
    inside = Window.partitionBy(*_group(group), PART).orderBy(*map(turn, order)).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    at = F.when(F.col("_v").isNotNull(), F.struct(*order))
    ends = rows.groupBy(*_group(group), PART).agg((F.min_by if backward else F.max_by)("_v", at).alias("_end"))
    # One row for each group and range that it reaches into.
    across = Window.partitionBy(*_group(group)).orderBy(turn(PART)).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_from", F.last("_end", ignorenulls=True).over(across))
    own = rows.withColumn("_own", F.last("_v", ignorenulls=True).over(inside))
    return _with_ranges(own, ends, group, "_from").withColumn(out, F.coalesce("_own", "_from")).drop("_v", "_own", "_from")


def running(ranged: DataFrame, order: list[str], value: Column, out: str, group: str | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` up to and including each row in ``order``, within ``group``."""
    rows = ranged.withColumn("_v", value)
    inside = Window.partitionBy(*_group(group), PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy(*_group(group), PART).agg(F.sum("_v").alias("_sum"))
    across = Window.partitionBy(*_group(group)).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_from", F.coalesce(F.sum("_sum").over(across), F.lit(0)))
    own = rows.withColumn("_own", F.sum("_v").over(inside))
    return _with_ranges(own, sums, group, "_from").withColumn(out, F.col("_from") + F.col("_own")).drop("_v", "_own", "_from")


def ranked(rows: DataFrame, order: list[str], out: str, group: str | None = None) -> DataFrame:
    """Adds ``out``: the place, from 1, of each row in ``order`` within ``group``; (group, order) must be unique."""
    return running(by_ranges(rows, *_group(group), *order), order, F.lit(1).cast("long"), out, group).drop(PART)
