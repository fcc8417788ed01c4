"""Several rows from one, without a union that would scan the input again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows(names: list[str], *values: tuple[Column, ...]) -> Column:
    """A generator of one row for each tuple, with the given column names."""
    return F.inline(F.array(*[F.struct(*[c.alias(n) for n, c in zip(names, row, strict=True)]) for row in values]))
