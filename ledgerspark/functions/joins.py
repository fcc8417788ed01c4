"""Joins that stay even when one key has most of the rows, and joins of points with ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid_join(a: DataFrame, b: DataFrame, *keys: str, hot: int = 1000, side: int = 8) -> DataFrame:
    """Inner join of ``a`` and ``b`` on ``keys``, of which each side may have many rows.

    Keys with more than a ``hot``-th of the rows of ``a`` are cut into a grid: rows of ``a`` are dealt to ``side`` lines,
    those of ``b`` to as many columns, and each goes to every cell of its own, so that no task has the whole key.
    """
    bound = a.count() // hot
    # Less than ``hot`` keys.
    large = F.broadcast(a.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > bound).select(*keys, F.lit(side).alias("_side")))
    cells = F.sequence(F.lit(0), F.col("_side") - 1)

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.join(large, list(keys), "left").withColumn("_side", F.coalesce("_side", F.lit(1)))
        line = F.pmod(F.xxhash64(*rows.columns[: len(rows.columns) - 1]), F.col("_side")).cast("int")
        return rows.withColumns({own: line, other: F.explode(cells)}).drop("_side")

    return dealt(a, "_line", "_column").join(dealt(b, "_column", "_line"), [*keys, "_line", "_column"]).drop("_line", "_column")


def hub_join(rows: DataFrame, table: DataFrame, key: str, count: str, most: int, hot: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with ``table``, whose keys are unique and whose ``count`` says how many of at most ``most`` rows each has.

    Keys with more than a ``hot``-th of ``most`` rows number less than ``hot``; their part of ``table`` is broadcast, so their
    rows stay where they are. All others are shuffled.
    """
    its = [c for c in table.columns if c not in (key, count)]
    large = F.broadcast(table.filter(F.col(count) * hot > most).select(key, F.struct(*its).alias("_its")))
    met = rows.join(large, key, "left")
    rest = table.filter(F.col(count) * hot <= most).select(key, *its)
    return met.filter("_its is not null").select(*rows.columns, "_its.*").unionByName(met.filter("_its is null").select(*rows.columns).join(rest, key))


def range_cells(low: Column, high: Column) -> Column:
    """Array of (level, cell) of a closed range of longs: the cells of 2^level numbers that it touches, of the largest size that fits in it; at most three. An empty range has none."""
    level = F.floor(F.log2((high - low + 1).cast("double"))).cast("int")
    # Shifts by the row's own level, which SQL takes and the function doesn't.
    cells = F.transform(F.sequence(F.call_function("shiftright", low, level), F.call_function("shiftright", high, level)), lambda c: F.struct(level.alias("level"), c.alias("cell")))
    return F.when(low <= high, cells)


def range_blocks(low: Column, high: Column) -> Column:
    """Array of (level, cell) of a closed range of longs: the aligned cells of 2^level numbers that make it up exactly, at most two of each level. An empty range has none."""
    # One more than needed, as the logarithm is rounded.
    level = F.sequence(F.lit(0), F.floor(F.log2((high - low + 1).cast("double"))).cast("int") + 1)

    def of(k: Column) -> Column:
        shift = lambda x: F.call_function("shiftright", x, k)
        # Cells of this level that lie in the range are those from first to before end; an odd first and an odd end have no place in the level above.
        first, end = -shift(-low), shift(high + 1)
        here = lambda x: F.struct(k.alias("level"), x.alias("cell"))
        odd = lambda x: (x.bitwiseAND(F.lit(1).cast("long")) == 1) & (first < end)
        return F.array_compact(F.array(F.when(odd(first), here(first)), F.when(odd(end), here(end - 1))))

    return F.when(low <= high, F.flatten(F.transform(level, of)))


def interval_join(points: DataFrame, at: str, ranges: DataFrame, low: str, high: str) -> DataFrame:
    """``points`` and ``ranges`` of longs with ``low`` <= ``at`` <= ``high``; column names must differ.

    A range is cut at the borders of cells about its own size, into at most three pieces; a point is in one cell of each size
    that ranges have. Both meet by equality of size and cell, and crowded cells are cut by ``grid_join``. Sizes are powers of
    two, so there are at most 63 and in practice few of them.
    """
    cut = ranges.filter(F.col(low) <= F.col(high)).withColumn("_c", F.explode(range_cells(F.col(low), F.col(high)))).select(*ranges.columns, "_c.level", "_c.cell").withColumnsRenamed({"level": "_level", "cell": "_cell"})
    # At most 63 numbers.
    levels = [r["_level"] for r in cut.select("_level").distinct().collect()]
    placed = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("_cell", F.call_function("shiftright", F.col(at), F.col("_level")))
    both = grid_join(placed, cut, "_level", "_cell")
    return both.filter((F.col(low) <= F.col(at)) & (F.col(at) <= F.col(high))).select(*points.columns, *ranges.columns)
