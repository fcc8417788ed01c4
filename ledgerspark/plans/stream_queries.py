"""Queries that replay the event flow as a stream of files and end when all are read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.shared import checkpoint_dir
from ledgerspark.plans.registry import longs, register
from ledgerspark.sources.adapters import FLOW_SQL, event_flow
from ledgerspark.streaming import jobs


def _stream(spark: SparkSession, sf_dir: str, twice: bool = False) -> tuple[DataFrame, str]:
    """The event flow as three files in the order of time, the later ones repeating the end of the earlier, and a folder for results."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    rows = event_flow(spark, sf_dir).withColumn("at", F.timestamp_seconds("ts"))
    span = rows.agg(F.min("ts").alias("a"), (F.max("ts") + 1).alias("z"))
    third = rows.join(F.broadcast(span)).withColumn("part", F.floor((F.col("ts") - F.col("a")) * 3 / (F.col("z") - F.col("a")))).drop("a", "z")
    for k in range(3):
        own = third.filter(F.col("part") == k)
        again = third.filter((F.col("part") == k - 1) & (F.col("seq") % 10 == 0)) if twice and k else own.limit(0)
        own.unionByName(again).drop("part").coalesce(1).write.mode("append").parquet(f"{base}/in")
    return jobs.followed(spark, f"{base}/in", rows.schema), f"{base}/out"


@register("SELECT seq, ts, frm, dst, v FROM e", FLOW_SQL)
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that overlap, each event once."""
    stream, out = _stream(spark, sf_dir, twice=True)
    jobs.run(jobs.once(stream, ["seq"], "at", "30 days"), out)
    return jobs.written(spark, out).select("seq", "ts", "frm", "dst", "v")


@register("WITH x AS (SELECT dst AS addr, v AS x FROM e UNION ALL SELECT frm, -v FROM e) SELECT addr, CAST(sum(x) AS BIGINT) AS balance FROM x GROUP BY addr", FLOW_SQL)
def stream_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, out = _stream(spark, sf_dir)
    jobs.run(jobs.balances(stream), out, "update")
    return longs(jobs.latest(spark, out, "addr"), "balance")


@register(
    """WITH s AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY dst ORDER BY ts, seq) < 86400 THEN 0 ELSE 1 END AS fresh FROM e), g AS (SELECT *, sum(fresh) OVER (PARTITION BY dst ORDER BY ts, seq) AS k FROM s)
    SELECT dst, min(ts) AS first, max(ts) AS last, count(*) AS n FROM g GROUP BY dst, k HAVING max(ts) < (SELECT max(ts) FROM e) - 2 * 86400""",
    FLOW_SQL,
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that have certainly ended: two days and more before the last event."""
    stream, out = _stream(spark, sf_dir)
    jobs.run(jobs.sessions(stream, "dst", "at", "86400 seconds", "0 seconds"), out)
    rows = jobs.written(spark, out).select("dst", F.unix_seconds("first").alias("first"), F.unix_seconds("last").alias("last"), "n")
    end = event_flow(spark, sf_dir).agg((F.max("ts") - 2 * 86400).alias("end"))
    return rows.join(F.broadcast(end), F.col("last") < F.col("end")).drop("end")


MOVES_SQL = "mv AS (SELECT dst AS addr, 2 * seq + 1 AS k, v AS x FROM e UNION ALL SELECT frm, 2 * seq, -v FROM e)"


@register(
    "WITH r AS (SELECT addr, k, sum(x) OVER (PARTITION BY addr ORDER BY o, k) AS h FROM (SELECT mv.*, e.ts AS o FROM mv JOIN e ON e.seq = mv.k // 2)) SELECT addr, CAST(arg_max(h, k) AS BIGINT) AS held, count(*) AS n FROM r GROUP BY addr",
    FLOW_SQL,
    MOVES_SQL,
)
def stream_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each account holds in the end, carried from file to file."""
    stream, out = _stream(spark, sf_dir)
    legs = F.array(F.struct(F.col("dst").alias("addr"), (2 * F.col("seq") + 1).alias("seq"), F.col("v").alias("x")), F.struct(F.col("frm").alias("addr"), (2 * F.col("seq")).alias("seq"), (-F.col("v")).alias("x")))
    jobs.run(jobs.accounts(stream.select(F.inline(legs))), out, "update")
    return jobs.latest(spark, out, "addr").select("addr", "held", "n")


@register(
    "WITH h AS (SELECT frm AS addr, ts // 86400 AS day, sum(v) AS total FROM e GROUP BY ALL), w AS (SELECT *, lag(total) OVER (PARTITION BY addr ORDER BY day) AS before FROM h) SELECT addr, day FROM w WHERE total >= 8000 AND before >= 8000",
    FLOW_SQL,
)
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that sent the amount on two of their days running."""
    stream, out = _stream(spark, sf_dir)
    jobs.run(jobs.alerts(stream.select(F.col("frm").alias("addr"), "ts", "seq", "v"), 8000, 86400), out)
    return jobs.written(spark, out).select("addr", F.col("at").alias("day"))


@register(
    """WITH z AS (SELECT CAST(sum(v) AS BIGINT) AS net, max(ts) AS last FROM e), h AS (SELECT frm AS addr, ts // 86400 AS day, sum(v) AS total FROM e GROUP BY ALL), w AS (SELECT *, lag(total) OVER (PARTITION BY addr ORDER BY day) AS before, lag(day) OVER (PARTITION BY addr ORDER BY day) AS was FROM h)
    SELECT addr, day, CAST(total AS BIGINT) AS total FROM w, z WHERE was = day - 1 AND total >= ceil(net * 2 / 10000.0) AND before >= ceil(net * 2 / 10000.0) AND (day + 1) * 86400 <= last - 86400""",
    FLOW_SQL,
)
def stream_share_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that sent two ten-thousandths of all amounts on two days that follow each other, judged by timers when the watermark, a day behind, has passed a day."""
    net = int(event_flow(spark, sf_dir).agg(F.sum("v").cast("long")).first()[0] or 0)
    stream, out = _stream(jobs.with_timers(spark), sf_dir)
    jobs.run(jobs.share_alerts(stream.select(F.col("frm").alias("addr"), "at", "ts", "v"), net, 2, 86400, "1 day"), out)
    return jobs.written(spark, out).select("addr", F.col("at").alias("day"), "total")
