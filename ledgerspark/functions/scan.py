"""Scan of small states over ordered rows: each row is a map of the state, and maps compose.

A group's rows lie in ranges; each range is composed to one map, the maps of a group are applied
one after another in a stream of one row a range, and then each range goes on from its own state. So a group with most
of the rows is spread over its ranges, and no task sees more of it than a range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerspark.functions.ranges import PART

Map = tuple[float, ...]


def scanned(ranged: DataFrame, group: str, order: list[str], inputs: list[str], of: Callable[..., Map], then: Callable[[Map, Map], Map], go: Callable[[Map, float], float], before: str, after: str) -> DataFrame:
    """Adds ``before`` and ``after``, the state at each row of ``by_ranges``; it is 0 at the start of a group.

    ``of``: the map of a row from its ``inputs``; ``then``: the first map and after it the second as one; ``go``: a map applied to a state.
    ``ranged`` must keep all rows of a group and range in one partition, as ``by_ranges`` and this function do.
    """
    kind = ranged.schema[group]
    part = T.StructField(PART, T.IntegerType())
    size = len(of(*[0.0] * len(inputs)))
    names = [f"_m{k}" for k in range(size)]
    ordered = ranged.sortWithinPartitions(group, PART, *order)

    def composed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, whole = None, None
        for batch in batches:
            out = []
            for g, p, *x in batch.itertuples(index=False):
                if (g, p) != key:
                    if key is not None:
                        out.append((*key, *whole))
                    key, whole = (g, p), of(*x)
                else:
                    whole = then(whole, of(*x))
            yield pd.DataFrame(out, columns=[group, PART, *names])
        if key is not None:
            yield pd.DataFrame([(*key, *whole)], columns=[group, PART, *names])

    maps = ordered.select(group, PART, *inputs).mapInPandas(composed, T.StructType([kind, part, *[T.StructField(n, T.DoubleType()) for n in names]]))

    def entered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, 0.0
        for batch in batches:
            out = []
            for g, p, *m in batch.itertuples(index=False):
                if g != key:
                    key, state = g, 0.0
                out.append((g, p, state))
                state = go(tuple(m), state)
            yield pd.DataFrame(out, columns=[group, PART, "_enter"])

    enters = maps.repartition(group).sortWithinPartitions(group, PART).mapInPandas(entered, T.StructType([kind, part, T.StructField("_enter", T.DoubleType())]))
    enters = enters.withColumnsRenamed({group: "_g", PART: "_p"})
    rows = ranged.join(enters, (ranged[group] == enters["_g"]) & (ranged[PART] == enters["_p"])).drop("_g", "_p").sortWithinPartitions(group, PART, *order)
    schema = T.StructType([*ranged.schema.fields, T.StructField(before, T.DoubleType()), T.StructField(after, T.DoubleType())])

    def applied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, 0.0
        for batch in batches:
            was, now = [], []
            for g, p, enter, *x in batch[[group, PART, "_enter", *inputs]].itertuples(index=False):
                if (g, p) != key:
                    key, state = (g, p), enter
                was.append(state)
                state = go(of(*x), state)
                now.append(state)
            yield batch.drop(columns="_enter").assign(**{before: was, after: now})

    return rows.mapInPandas(applied, schema)
