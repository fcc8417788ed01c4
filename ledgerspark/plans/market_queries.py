"""Queries on prices and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import gates, ledger, market
from ledgerspark.plans.registry import longs, register
from ledgerspark.sources.adapters import FLOW_SQL, TRADE_SQL, event_flow, trade_ledger

TICK_SQL = """
tick AS (SELECT ts, arg_max(v, seq) AS price FROM e WHERE kind = (SELECT min(kind) FROM e) GROUP BY ts)
"""


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The amounts of one kind of events stand for prices."""
    rows = event_flow(spark, sf_dir)
    return rows.join(F.broadcast(rows.agg(F.min("kind").alias("kind"))), "kind").groupBy("ts").agg(F.max_by("v", "seq").alias("price"))


@register(
    """SELECT e.seq, e.ts, e.v, coalesce(tick.price, (SELECT arg_min(price, ts) FROM tick)) AS price FROM e ASOF LEFT JOIN tick ON e.ts >= tick.ts""",
    FLOW_SQL,
    TICK_SQL,
)
def asof_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.asof(event_flow(spark, sf_dir).select("seq", "ts", "v"), _ticks(spark, sf_dir))


@register("SELECT ts // 60 * 60 AS bar, arg_max(v, (ts, seq)) AS price, count(*) AS n FROM e GROUP BY ALL", FLOW_SQL)
def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(market.bars(event_flow(spark, sf_dir).withColumnRenamed("v", "price"), 60), "bar")


@register("SELECT ts // 86400 * 86400 AS bar, arg_max(v, (ts, seq)) AS price, count(*) AS n FROM e GROUP BY ALL", FLOW_SQL)
def daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(market.bars(event_flow(spark, sf_dir).withColumnRenamed("v", "price"), 86400), "bar")


@register(
    """WITH a AS (SELECT ts // 3600 * 3600 AS bar, arg_max(v, (ts, seq)) AS a FROM e WHERE seq % 2 = 0 GROUP BY ALL), b AS (SELECT ts // 3600 * 3600 AS bar, arg_max(v, (ts, seq)) AS b FROM e WHERE seq % 2 = 1 GROUP BY ALL)
    SELECT bar, a, b, CASE WHEN a IS NULL OR b IS NULL THEN 'SKIP' WHEN abs(a - b) * 200 > (a + b) * 15 THEN 'FAIL' WHEN abs(a - b) * 200 > (a + b) * 5 THEN 'WARN' ELSE 'OK' END AS verdict FROM a FULL JOIN b USING (bar)""",
    FLOW_SQL,
)
def price_xcheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly prices of even and odd events compared as two sources."""
    ticks = event_flow(spark, sf_dir).withColumnRenamed("v", "price")
    return longs(market.compare(market.bars(ticks.filter("seq % 2 = 0"), 3600), market.bars(ticks.filter("seq % 2 = 1"), 3600)), "bar")


@register(
    """WITH o AS (SELECT addr, sum(x) AS b FROM d WHERE block <= 1000 GROUP BY addr), m2 AS (SELECT addr, coalesce(o.b, 0) AS old, coalesce(bal, 0) AS new FROM bal FULL JOIN o USING (addr))
    SELECT addr, CAST(old AS BIGINT) AS old, CAST(new AS BIGINT) AS new, CAST(new - old AS BIGINT) AS delta, CASE WHEN old = 0 THEN 'new' WHEN new = 0 THEN 'zeroed' ELSE 'changed' END AS kind
    FROM m2 WHERE abs(new - old) >= 10000000""",
    TRADE_SQL,
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trade_ledger(spark, sf_dir)
    return longs(gates.snapshot_diff(ledger.balances(rows.filter("block <= 1000")), ledger.balances(rows), 10_000_000), "old", "new", "delta")


@register(
    """WITH a AS (SELECT frm, dst, q FROM t WHERE block BETWEEN 1 AND 1200), b AS (SELECT frm, dst, q FROM t WHERE block > 1200),
    u AS (SELECT *, 1 AS x, 0 AS y FROM a UNION ALL SELECT *, 0, 1 FROM b)
    SELECT frm, dst, q, CAST(sum(x) AS BIGINT) AS in_a, CAST(sum(y) AS BIGINT) AS in_b FROM u GROUP BY ALL HAVING sum(x) <> sum(y)""",
    TRADE_SQL,
)
def source_multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trade_ledger(spark, sf_dir)
    return gates.multiset_diff(rows.filter("block between 1 and 1200").select("frm", "dst", "q"), rows.filter("block > 1200").select("frm", "dst", "q"))


@register("WITH p AS (SELECT DISTINCT ts AS p FROM e), n AS (SELECT p, lead(p) OVER (ORDER BY p) AS nx FROM p) SELECT p + 1 AS lo, nx AS hi FROM n WHERE nx > p + 1", FLOW_SQL)
def coverage_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.holes(event_flow(spark, sf_dir), "ts")


@register(
    """WITH c AS (SELECT kind AS tag, min(seq) AS lo, max(seq) AS hi, count(*) AS n FROM e GROUP BY kind), n AS (SELECT *, lead(lo) OVER (ORDER BY lo, hi, tag) AS next_lo FROM c)
    SELECT *, CASE WHEN next_lo IS NULL THEN 'end' WHEN next_lo > hi THEN 'hole' WHEN next_lo < hi THEN 'overlap' ELSE 'ok' END AS verdict FROM n""",
    FLOW_SQL,
)
def channel_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.contiguity(event_flow(spark, sf_dir).groupBy(F.col("kind").alias("tag")).agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("*").alias("n")))


@register(
    """WITH k AS (SELECT seq, kind, ts // 604800 AS week, row_number() OVER (PARTITION BY kind, ts // 604800 ORDER BY md5(CAST(seq AS VARCHAR)), CAST(seq AS VARCHAR)) AS r FROM e)
    SELECT seq, kind, week FROM k WHERE r <= 3""",
    FLOW_SQL,
)
def anchor_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three events of each kind and week by a portable hash."""
    rows = event_flow(spark, sf_dir).select("seq", "kind", F.floor(F.col("ts") / 604800).alias("week"))
    return gates.stratified_sample(rows, ["kind", "week"], F.col("seq").cast("string"), 3)


@register("WITH k AS (SELECT addr, bal FROM bal ORDER BY bal DESC, addr LIMIT 25) SELECT addr, bal AS balance FROM k WHERE addr NOT IN ('ZERO', 'DEAD')", TRADE_SQL)
def topn_skip_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 largest balances, without the sinks among them."""
    top = ledger.balances(trade_ledger(spark, sf_dir)).orderBy(F.desc("balance"), "addr").limit(25)
    return longs(top.filter("addr not in ('ZERO', 'DEAD')"), "balance")


@register(
    """WITH i AS (SELECT dst AS addr, sum(v) AS i FROM t WHERE frm <> 'ZERO' GROUP BY dst), o AS (SELECT frm AS addr, sum(v) AS o FROM t WHERE frm <> 'ZERO' GROUP BY frm)
    SELECT addr, CAST(i AS BIGINT) AS inflow, CAST(o AS BIGINT) AS outflow, CAST(least(i, o) * 2 AS BIGINT) AS two_way, CAST(i - o AS BIGINT) AS net FROM i JOIN o USING (addr) WHERE abs(i - o) * 10 <= i + o""",
    TRADE_SQL,
)
def wash_triad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts whose gross flows nearly cancel."""
    moves = ledger.deltas(trade_ledger(spark, sf_dir).filter("frm <> 'ZERO'"))
    flows = moves.groupBy("addr").agg(F.sum(F.greatest("x", F.lit(0))).alias("inflow"), F.sum(F.greatest(-F.col("x"), F.lit(0))).alias("outflow"))
    flows = flows.filter("inflow > 0 and outflow > 0 and abs(inflow - outflow) * 10 <= inflow + outflow")
    return longs(flows.select("addr", "inflow", "outflow", (F.least("inflow", "outflow") * 2).alias("two_way"), (F.col("inflow") - F.col("outflow")).alias("net")), "inflow", "outflow", "two_way", "net")


@register(
    """WITH x AS (SELECT addr, tx, sum(greatest(x, 0)) AS i, sum(greatest(-x, 0)) AS o FROM d WHERE tx >= 0 GROUP BY ALL)
    SELECT addr, CAST(sum(least(i, o)) AS BIGINT) AS transit, CAST(sum(i) AS BIGINT) AS inflow, CAST(sum(least(i, o)) AS DOUBLE) / CAST(sum(i) AS DOUBLE) AS rate, sum(least(i, o)) * 10 > sum(i) * 9 AS flagged
    FROM x GROUP BY addr HAVING sum(i) > 0""",
    TRADE_SQL,
)
def atomic_transit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each account took and sent on within one transaction, its share of all that it took, and whether that is over 90%."""
    moves = ledger.deltas(trade_ledger(spark, sf_dir).filter("tx >= 0"), "tx")
    per = moves.groupBy("addr", "tx").agg(F.sum(F.greatest("x", F.lit(0))).alias("i"), F.sum(F.greatest(-F.col("x"), F.lit(0))).alias("o"))
    sums = longs(per.groupBy("addr").agg(F.sum(F.least("i", "o")).alias("transit"), F.sum("i").alias("inflow")).filter("inflow > 0"), "transit", "inflow")
    return sums.withColumns({"rate": F.col("transit").cast("double") / F.col("inflow").cast("double"), "flagged": F.col("transit") * 10 > F.col("inflow") * 9})
