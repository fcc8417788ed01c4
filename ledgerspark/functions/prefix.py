"""Running sums that don't put a whole key into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def prefix_sums(df: DataFrame, key: str, order: str, value: str, out: str, width: int = 256) -> DataFrame:
    """Adds ``out``, the sum of ``value`` up to and including ``order`` within ``key``; (key, order) must be unique.

    Two levels: sums of ranges of ``width`` order values first, then the running sum inside
    each range. A key with most of the rows is spread over its ranges, so no task has to
    sort it whole.
    """
    part = F.floor(F.col(order) / width)
    rows = df.withColumn("_part", part)
    totals = rows.groupBy(key, "_part").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(key, "_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(key, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(starts, [key, "_part"]).withColumn(out, F.col("_start") + F.sum(value).over(inside)).drop("_part", "_start")
