"""Streaming forms: transfers as an unbounded table, in Structured Streaming.

Each function takes a streaming DataFrame and returns one; ``followed`` reads a growing folder, ``run`` writes to a folder
with its checkpoint beside it, so a job that stops goes on where it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues


def followed(spark: SparkSession, path: str, schema, files_at_once: int = 1) -> DataFrame:
    """Rows of the Parquet files of a folder as they arrive; the checkpoint of the query remembers which were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def run(stream: DataFrame, path: str, mode: str = "append") -> None:
    """Write what there is to ``path`` and stop. Rows carry the number of their micro-batch; a batch that comes again replaces itself."""

    def write(rows: DataFrame, number: int) -> None:
        rows.withColumn("round", F.lit(number)).write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()


def written(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop("batch")


def latest(spark: SparkSession, path: str, *key: str) -> DataFrame:
    """The last version of each key of a table written in update mode."""
    rows = written(spark, path)
    rest = [c for c in rows.columns if c not in (*key, "round")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "round").alias("_row")).select(*key, "_row.*")


def once(stream: DataFrame, key: list[str], at: str, delay: str) -> DataFrame:
    """Each key once, although sources overlap: copies that come within ``delay`` of each other are dropped, and state older than it is forgotten."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)


def balances(stream: DataFrame) -> DataFrame:
    """(addr, balance) of accounts that changed, for update mode."""
    from ledgerspark.operators.ledger import deltas

    return deltas(stream).groupBy("addr").agg(F.sum("x").alias("balance"))


def sessions(stream: DataFrame, key: str, at: str, gap: str, delay: str) -> DataFrame:
    """(key, first, last, n): sessions that end when nothing came for ``gap``; silence of exactly the gap ends one."""
    window = F.session_window(at, gap)
    return stream.withWatermark(at, delay).groupBy(key, window).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n")).drop("session_window")


def accounts(moves: DataFrame) -> DataFrame:
    """(addr, held, peak, n) of accounts that moved, in update mode. ``moves``: (addr, seq, x); state is three numbers an account.

    Rows of one micro-batch are taken in the order of ``seq``; micro-batches follow the files.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, peak, n = state.get if state.exists else (0, 0, 0)
        rows = pd.concat(list(parts)).sort_values("seq")
        sums = held + rows["x"].cumsum()
        held, peak, n = int(sums.iloc[-1]), max(peak, int(sums.max())), n + len(rows)
        state.update((held, peak, n))
        yield pd.DataFrame([(key[0], held, peak, n)], columns=["addr", "held", "peak", "n"])

    return moves.groupBy("addr").applyInPandasWithState(step, "addr string, held long, peak long, n long", "held long, peak long, n long", "update", GroupStateTimeout.NoTimeout)


def alerts(moves: DataFrame, least: int, width: int) -> DataFrame:
    """(addr, round, total): an account whose outflow reaches ``least`` in two of its rounds running. ``moves``: (addr, ts, seq, v).

    A round is a stretch of ``width`` seconds in which the account sent something; the alert comes as soon as the second one
    reaches the amount, once a round.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, total, before, told = state.get if state.exists else (-1, 0, False, False)
        out = []
        for ts, v in pd.concat(list(parts)).sort_values(["ts", "seq"])[["ts", "v"]].itertuples(index=False):
            if ts // width != at:
                at, total, before, told = int(ts // width), 0, total >= least, False
            total += int(v)
            if before and total >= least and not told:
                told = True
                out.append((key[0], at))
        state.update((at, total, before, told))
        yield pd.DataFrame(out, columns=["addr", "at"])

    return moves.groupBy("addr").applyInPandasWithState(step, "addr string, at long", "at long, total long, before boolean, told boolean", "append", GroupStateTimeout.NoTimeout)


class _Rounds(StatefulProcessor):
    """The last round of an account that reached the amount; it comes with its total when it has ended in event time."""

    def __init__(self, width: int) -> None:
        self._width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, out = self._last.get()[0] if self._last.exists() else None, []
        for at, total in pd.concat(list(rows)).sort_values("round")[["round", "total"]].itertuples(index=False):
            if last == at - 1:
                out.append((key[0], int(at), int(total)))
            last = int(at)
            # What is remembered of the round is of use for the next one only.
            self._handle.registerTimer((last + 2) * self._width * 1000)
        self._last.update((last,))
        yield pd.DataFrame(out, columns=["addr", "at", "total"]).astype({"at": "int64", "total": "int64"})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at = expiredTimerInfo.getExpiryTimeInMs() // 1000 // self._width - 2
        if self._last.exists() and self._last.get()[0] <= at:
            self._last.clear()
        yield pd.DataFrame({"addr": pd.Series(dtype=str), "at": pd.Series(dtype="int64"), "total": pd.Series(dtype="int64")})

    def close(self) -> None:
        pass


def share_alerts(moves: DataFrame, net: int, share_bps: int, width: int, delay: str) -> DataFrame:
    """(addr, at, total): an account that sends at least ``share_bps`` ten-thousandths of ``net``, the declared denominator, in each of two rounds of ``width`` seconds that follow each other.

    ``moves``: (addr, at, ts, seq, v), ``at`` the event time of ``ts``. Rows may come in any order within ``delay``; a round is judged when the
    watermark has passed its end, and rows that come later are left out. A round's total goes when it is judged, and what is remembered of it, by a timer, when
    the next one has been: an account that stops leaves no state. Rounds are added up by a windowed sum, so that only those that reach the amount
    come to the processor. Needs the RocksDB state store, which ``with_timers`` sets.
    """
    least = -(-net * share_bps // 10_000)
    totals = moves.withWatermark("at", delay).groupBy("addr", F.window("at", f"{width} seconds")).agg(F.sum("v").alias("total")).filter(F.col("total") >= least)
    ended = totals.select("addr", F.window_time("window").alias("ended"), F.floor(F.unix_timestamp("window.start") / width).alias("round"), "total")
    return ended.groupBy("addr").transformWithStateInPandas(statefulProcessor=_Rounds(width), outputStructType="addr string, at long, total long", outputMode="Append", timeMode="EventTime")


def with_timers(spark: SparkSession) -> SparkSession:
    """A session beside ``spark``, on the same cluster, whose streams keep their state where timers can."""
    other = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        other.conf.set(key, spark.conf.get(key))
    other.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return other
