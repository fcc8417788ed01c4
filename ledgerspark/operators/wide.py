"""Amounts of up to 78 digits: sums over limbs of 18 digits with one carry at the end.

A decimal of 38 digits holds the sum of 10^20 limbs, so no sum of a ledger can overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.sources.adapters import ZERO

LIMB, LIMBS = 18, 5
BASE = 10**LIMB


def limbs(digits: Column) -> list[Column]:
    """The limbs of a text of decimal digits, lowest first."""
    full = F.lpad(digits, LIMB * LIMBS, "0")
    return [F.substring(full, LIMB * (LIMBS - 1 - k) + 1, LIMB).cast("decimal(38,0)") for k in range(LIMBS)]


def _carried(rows: DataFrame, parts: list[str], top: str) -> DataFrame:
    """Limbs ``parts`` brought between 0 and the base, lowest first; ``top`` is what is left above them. One step a limb."""
    base = F.lit(BASE).cast("decimal(19,0)")
    rows = rows.withColumn(top, F.lit(0).cast("decimal(38,0)"))
    for part in parts:
        rows = rows.withColumn(part, (F.col(part) + F.col(top)).cast("decimal(38,0)"))
        rows = rows.withColumn("_rest", F.pmod(part, base).cast("decimal(38,0)"))
        rows = rows.withColumn(top, ((F.col(part) - F.col("_rest")) / base).cast("decimal(38,0)")).withColumn(part, F.col("_rest"))
    return rows.drop("_rest")


def with_digits(rows: DataFrame, sums: list[str], out: str) -> DataFrame:
    """Adds ``out``, the text of the number whose limb sums are given, lowest first; each sum may be negative."""
    sign = _carried(rows.withColumns({f"{n}s": F.col(n) for n in sums}), [f"{n}s" for n in sums], "_sign").drop(*[f"{n}s" for n in sums])
    plain = _carried(sign.withColumns({n: F.when(F.col("_sign") < 0, -F.col(n)).otherwise(F.col(n)).cast("decimal(38,0)") for n in sums}), sums, "_top")
    text = F.concat(*[F.lpad(F.col(n).cast("string"), LIMB, "0") for n in ["_top", *reversed(sums)]])
    number = F.concat(F.when(F.col("_sign") < 0, "-").otherwise(""), F.regexp_replace(text, "^0+(?=[0-9])", ""))
    return plain.withColumn(out, number).drop("_sign", "_top", *sums)


def balances(transfers: DataFrame) -> DataFrame:
    """(addr, balance) as text, of transfers whose amount ``value`` is a text of digits."""
    one, out = limbs(F.col("value")), [f"_l{k}" for k in range(LIMBS)]
    legs = F.array(F.struct(F.col("dst").alias("addr"), *[x.alias(n) for x, n in zip(one, out, strict=True)]), F.struct(F.col("frm").alias("addr"), *[(-x).cast("decimal(38,0)").alias(n) for x, n in zip(one, out, strict=True)]))
    moves = transfers.select(F.inline(F.when(F.col("frm") == ZERO, F.slice(legs, 1, 1)).otherwise(legs)))
    sums = moves.groupBy("addr").agg(*[F.sum(n).cast("decimal(38,0)").alias(n) for n in out])
    return with_digits(sums, out, "balance")


def total(rows: DataFrame, value: str) -> DataFrame:
    """One row (total): the sum of a column of texts of digits."""
    names = [f"_l{k}" for k in range(LIMBS)]
    sums = rows.select(*[x.alias(n) for n, x in zip(names, limbs(F.col(value)), strict=True)]).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("decimal(38,0)").alias(n) for n in names])
    return with_digits(sums, names, "total")
