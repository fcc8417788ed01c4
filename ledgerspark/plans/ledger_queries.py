"""Queries on balances, supply and peaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.operators import ledger
from ledgerspark.plans.registry import longs, register
from ledgerspark.sources.adapters import FLOW_SQL, TRADE_SQL, account, camps, entities, event_flow, exchanges, table, trade_ledger



@register("SELECT addr, bal AS balance FROM bal", TRADE_SQL)
def balances_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(ledger.balances(trade_ledger(spark, sf_dir)), "balance")


@register("SELECT addr, bal AS balance FROM bal ORDER BY bal DESC, addr LIMIT 20", TRADE_SQL)
def top_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = ledger.balances(trade_ledger(spark, sf_dir))
    return longs(held.orderBy(F.desc("balance"), "addr").limit(20), "balance")


@register(
    """WITH b AS (SELECT count(*) AS accounts, CAST(sum(bal) AS BIGINT) AS sum_balances, count(*) FILTER (bal < 0) AS negative_accounts FROM bal),
    s AS (SELECT count(*) AS transfers, CAST(sum(v) FILTER (frm = 'ZERO') AS BIGINT) AS mint_total, CAST(sum(v) FILTER (dst IN ('ZERO', 'DEAD')) AS BIGINT) AS burn_total,
      CAST(coalesce(sum(v) FILTER (frm = 'DEAD'), 0) AS BIGINT) AS sink_outflow FROM t)
    SELECT s.*, b.*, sum_balances = mint_total AS closes FROM s, b""",
    TRADE_SQL,
)
def ledger_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(ledger.stats(trade_ledger(spark, sf_dir)), "mint_total", "burn_total", "sink_outflow", "sum_balances")


@register("SELECT dst AS addr, CAST(sum(v) AS BIGINT) AS minted, count(*) AS mints FROM t WHERE frm = 'ZERO' GROUP BY dst", TRADE_SQL)
def mint_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(ledger.mint_ledger(trade_ledger(spark, sf_dir)), "minted")


@register("SELECT addr, min(block) FILTER (addr <> 'ZERO') AS first_block, max(block) AS last_block FROM d GROUP BY addr", TRADE_SQL)
def first_last_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.first_last(trade_ledger(spark, sf_dir))


@register(
    """WITH nets AS (SELECT addr, block, sum(x) AS x FROM d GROUP BY addr, block),
    c AS (SELECT addr, block, sum(x) OVER (PARTITION BY addr ORDER BY block) AS held FROM nets),
    p AS (SELECT addr, max(held) AS peak FROM c GROUP BY addr)
    SELECT c.addr, CAST(any_value(peak) AS BIGINT) AS peak, min(block) AS peak_block FROM c JOIN p ON c.addr = p.addr AND held = peak
    WHERE peak > 0 AND peak >= (SELECT minted FROM supply) // 1000 GROUP BY c.addr""",
    TRADE_SQL,
)
def block_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(ledger.block_peaks(trade_ledger(spark, sf_dir)), "peak")


@register(
    """SELECT l_orderkey, l_linenumber, count(*) AS copies, count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate)) AS payloads
    FROM lineitem GROUP BY ALL HAVING count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate)) > 1"""
)
def dedup_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line keys that name several different lines."""
    return longs(ledger.dedup_conflicts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]), "copies")


@register(
    """WITH k AS (SELECT l_orderkey // 1000 AS segment, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT segment, count(*) AS keys, count(*) FILTER (n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS extra_rows FROM k GROUP BY segment"""
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(ledger.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], F.floor(F.col("l_orderkey") / 1000)), "extra_rows")


@register(
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity <= 45 AS good, l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-01' AS inside FROM lineitem),
    k AS (SELECT count(*) AS n, count(*) FILTER (NOT good) AS bad, count(*) FILTER (good AND NOT inside) AS outside, count(*) FILTER (good AND inside) AS kept FROM r GROUP BY l_orderkey, l_linenumber)
    SELECT CAST(sum(n) AS BIGINT) AS n_source_rows, CAST(sum(bad) AS BIGINT) AS n_bad_fields, CAST(sum(outside) AS BIGINT) AS n_out_of_segment,
      CAST(sum(greatest(kept - 1, 0)) AS BIGINT) AS n_dedup_removed, sum(bad) = 0 AND sum(outside) = 0 AS passes FROM k"""
)
def reject_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate").cast("timestamp")
    inside = (shipped >= F.to_timestamp(F.lit("1996-01-01"))) & (shipped < F.to_timestamp(F.lit("2001-01-01")))
    return longs(ledger.rejects(table(spark, sf_dir, "lineitem"), F.col("l_quantity") <= 45, inside, ["l_orderkey", "l_linenumber"]), "n_source_rows", "n_bad_fields", "n_out_of_segment", "n_dedup_removed")


@register(
    """WITH x AS (SELECT dst AS addr, ts // 86400 AS day, v AS x FROM e UNION ALL SELECT frm, ts // 86400, -v FROM e)
    SELECT addr, day, CAST(sum(x) AS BIGINT) AS delta, CAST(sum(greatest(x, 0)) AS BIGINT) AS gross_in FROM x GROUP BY ALL""",
    FLOW_SQL,
)
def daily_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(ledger.daily_deltas(event_flow(spark, sf_dir), F.floor(F.col("ts") / 86400)), "delta", "gross_in")


DAILY_SQL = """
dd AS (SELECT addr, block AS day, sum(x) AS delta, sum(greatest(x, 0)) AS gross_in FROM d GROUP BY ALL),
dc AS (SELECT *, sum(delta) OVER w AS close, sum(delta) OVER w - delta + gross_in AS most FROM dd WINDOW w AS (PARTITION BY addr ORDER BY day)),
db AS (SELECT addr, max(close) AS peak_close, max(most) AS bound FROM dc GROUP BY addr)
"""


@register(
    """SELECT db.addr, CAST(any_value(peak_close) AS BIGINT) AS peak_close, min(day) FILTER (close = peak_close) AS peak_day, CAST(any_value(bound) AS BIGINT) AS bound,
      min(day) FILTER (most = bound) AS bound_day, CAST(arg_max(close, day) AS BIGINT) AS final
    FROM db JOIN dc ON db.addr = dc.addr GROUP BY db.addr""",
    TRADE_SQL,
    DAILY_SQL,
)
def daily_peaks_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(ledger.daily_bounds(ledger.daily_deltas(trade_ledger(spark, sf_dir), F.col("block"))), "peak_close", "bound", "final")


LEVELS = list(range(51_000_000, 70_000_000, 1_000_000))


@register(f"SELECT addr, CAST(level AS BIGINT) AS level FROM db, (SELECT unnest({LEVELS}) AS level) WHERE peak_close < level AND level <= bound", TRADE_SQL, DAILY_SQL)
def needs_block_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = ledger.daily_bounds(ledger.daily_deltas(trade_ledger(spark, sf_dir), F.col("block")))
    return longs(ledger.needs_block_precision(bounds, LEVELS), "level")


@register(
    """WITH a AS (SELECT block AS day FROM t WHERE block > 0 GROUP BY block ORDER BY sum(v) DESC, block LIMIT 5)
    SELECT addr, block AS day, CAST(sum(x) AS BIGINT) AS delta FROM d WHERE block IN (SELECT day FROM a) GROUP BY ALL""",
    TRADE_SQL,
)
def trigger_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that moved on the five days of largest turnover."""
    ledger_rows = trade_ledger(spark, sf_dir)
    days = ledger_rows.filter("block > 0").groupBy("block").agg(F.sum("v").alias("v")).orderBy(F.desc("v"), "block").limit(5).select("block")
    moves = ledger.deltas(ledger_rows, "block").join(F.broadcast(days), "block")
    return longs(moves.groupBy("addr", F.col("block").alias("day")).agg(F.sum("x").alias("delta")), "delta")


SUPPLY_SQL = """
sd AS (SELECT block AS day, sum(CASE WHEN frm = 'ZERO' THEN v ELSE 0 END) - sum(CASE WHEN dst IN ('ZERO', 'DEAD') THEN v ELSE 0 END) AS delta FROM t GROUP BY block),
sn AS (SELECT day, delta, sum(delta) OVER (ORDER BY day) AS net FROM sd)
"""


@register("SELECT day, CAST(delta AS BIGINT) AS delta, CAST(net AS BIGINT) AS net FROM sn", TRADE_SQL, SUPPLY_SQL)
def supply_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(ledger.supply_daily(trade_ledger(spark, sf_dir), F.col("block")), "delta", "net")


@register(
    """WITH c AS (SELECT camp, block AS day, sum(x) AS delta FROM d JOIN camp ON d.addr = camp.addr GROUP BY ALL),
    r AS (SELECT *, sum(delta) OVER (PARTITION BY camp ORDER BY day) AS balance FROM c)
    SELECT day, camp, CAST(r.delta AS BIGINT) AS delta, CAST(balance AS BIGINT) AS balance, CAST(net AS BIGINT) AS net, CASE WHEN net > 0 THEN CAST(balance AS DOUBLE) / CAST(net AS DOUBLE) END AS share
    FROM r JOIN sn USING (day)""",
    TRADE_SQL,
    SUPPLY_SQL,
)
def camp_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trade_ledger(spark, sf_dir)
    series = ledger.group_series(ledger.daily_deltas(rows, F.col("block")), camps(spark, sf_dir), "camp")
    return longs(ledger.group_share(series, ledger.supply_daily(rows, F.col("block")), "camp"), "delta", "balance", "net")


@register(
    """WITH c AS (SELECT entity, block AS day, sum(x) AS delta FROM d JOIN entity ON d.addr = entity.addr GROUP BY ALL)
    SELECT day, entity, CAST(delta AS BIGINT) AS delta, CAST(sum(delta) OVER (PARTITION BY entity ORDER BY day) AS BIGINT) AS balance FROM c""",
    TRADE_SQL,
)
def entity_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(ledger.group_series(ledger.daily_deltas(trade_ledger(spark, sf_dir), F.col("block")), entities(spark, sf_dir), "entity"), "delta", "balance")


CEX_SQL = """
cf AS (SELECT t.block AS day, CASE WHEN a.addr IS NOT NULL AND b.addr IS NOT NULL THEN 'internal' WHEN a.addr IS NOT NULL THEN 'out' ELSE 'in' END AS kind, v
  FROM t LEFT JOIN cex a ON t.frm = a.addr LEFT JOIN cex b ON t.dst = b.addr WHERE a.addr IS NOT NULL OR b.addr IS NOT NULL)
"""


def _exchange_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = exchanges(spark, sf_dir)
    rows = trade_ledger(spark, sf_dir).join(hot.withColumn("sends", F.lit(True)).withColumnRenamed("addr", "frm"), "frm", "left")
    rows = rows.join(hot.withColumn("takes", F.lit(True)).withColumnRenamed("addr", "dst"), "dst", "left").filter("sends or takes")
    return rows.select(F.col("block").alias("day"), F.when(F.col("sends") & F.col("takes"), "internal").when(F.col("sends"), "out").otherwise("in").alias("kind"), "v")


@register("SELECT day, kind, count(*) AS n, CAST(sum(v) AS BIGINT) AS amount FROM cf GROUP BY ALL", TRADE_SQL, CEX_SQL)
def cex_daily_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(_exchange_flow(spark, sf_dir).groupBy("day", "kind").agg(F.count("*").alias("n"), F.sum("v").alias("amount")), "amount")


@register(
    """WITH w AS (SELECT DATE '1994-12-31' + CAST(day AS INTEGER) AS d0, kind, v FROM cf)
    SELECT strftime(d0, '%Y-%m') || '-W' || CAST((day(d0) + 6) // 7 AS VARCHAR) AS week, kind, CAST(sum(v) AS BIGINT) AS amount FROM w GROUP BY ALL""",
    TRADE_SQL,
    CEX_SQL,
)
def cex_weekly_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.date_add(F.lit("1994-12-31").cast("date"), F.col("day").cast("int"))
    week = F.concat(F.date_format(at, "yyyy-MM"), F.lit("-W"), F.ceil(F.dayofmonth(at) / 7))
    return longs(_exchange_flow(spark, sf_dir).groupBy(week.alias("week"), "kind").agg(F.sum("v").alias("amount")), "amount")


@register(
    """WITH x AS (SELECT block AS day, sum(v) FILTER (dst = 'S1') AS i, sum(v) FILTER (frm = 'S1') AS o, count(*) FILTER (v >= 5000000) AS large FROM t WHERE dst = 'S1' OR frm = 'S1' GROUP BY block)
    SELECT day, CAST(coalesce(i, 0) AS BIGINT) AS inflow, CAST(coalesce(o, 0) AS BIGINT) AS outflow, large,
      CAST(sum(coalesce(i, 0) - coalesce(o, 0)) OVER (ORDER BY day) AS BIGINT) AS balance FROM x""",
    TRADE_SQL,
)
def treasury_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account's days: in, out, large movements and balance."""
    own = trade_ledger(spark, sf_dir).filter("dst = 'S1' or frm = 'S1'")
    into, out = F.when(F.col("dst") == "S1", F.col("v")).otherwise(0), F.when(F.col("frm") == "S1", F.col("v")).otherwise(0)
    days = own.groupBy(F.col("block").alias("day")).agg(F.sum(into).alias("inflow"), F.sum(out).alias("outflow"), F.count_if(F.col("v") >= 5_000_000).alias("large"))
    return longs(days.withColumn("balance", F.sum(F.col("inflow") - F.col("outflow")).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0))), "inflow", "outflow", "balance")


@register(
    """WITH r AS (SELECT addr, block, sum(x) AS x FROM d WHERE addr IN (SELECT addr FROM bal WHERE addr <> 'ZERO' ORDER BY bal DESC, addr LIMIT 5) GROUP BY ALL),
    g AS (SELECT a.addr, b.day FROM (SELECT DISTINCT addr FROM r) a, (SELECT DISTINCT block AS day FROM t) b),
    j AS (SELECT g.addr, g.day, coalesce(r.x, 0) AS x FROM g LEFT JOIN r ON g.addr = r.addr AND g.day = r.block)
    SELECT addr, day, CAST(sum(x) OVER (PARTITION BY addr ORDER BY day) AS BIGINT) AS balance FROM j""",
    TRADE_SQL,
)
def key_balances_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of the five largest holders on every day of the ledger, carried over quiet days."""
    rows = trade_ledger(spark, sf_dir)
    top = ledger.balances(rows).filter("addr <> 'ZERO'").orderBy(F.desc("balance"), "addr").limit(5).select("addr")
    own = ledger.deltas(rows, "block").join(F.broadcast(top), "addr").groupBy("addr", "block").agg(F.sum("x").alias("x"))
    # Five accounts times the days of the ledger.
    grid = rows.select("block").distinct().crossJoin(F.broadcast(top))
    filled = grid.join(own, ["addr", "block"], "left").withColumn("x", F.coalesce("x", F.lit(0)))
    running = F.sum("x").over(Window.partitionBy("addr").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    return longs(filled.select("addr", F.col("block").alias("day"), running.alias("balance")), "balance")


@register(
    """WITH g AS (SELECT addr, min(close) AS least, arg_max(close, day) AS final FROM dc GROUP BY addr)
    SELECT count(*) AS accounts, count(*) FILTER (final < 0) AS negative_final, count(*) FILTER (least < 0) AS negative_minimum, count(*) FILTER (least < 0) = 0 AS passes FROM g""",
    TRADE_SQL,
    DAILY_SQL,
)
def negative_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.negative_gate(ledger.daily_deltas(trade_ledger(spark, sf_dir), F.col("block")))


@register(
    """WITH p AS (SELECT addr, block, sum(x) AS x FROM d GROUP BY ALL), c AS (SELECT addr, block, x, sum(x) OVER (PARTITION BY addr ORDER BY block) AS held FROM p)
    SELECT addr, block AS day, CAST(-x AS BIGINT) AS dropped, CAST(held AS BIGINT) AS balance FROM c WHERE -x >= 10000000""",
    TRADE_SQL,
)
def holdings_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a holding fell by at least the threshold, from point-wise differences."""
    from ledgerspark.functions.prefix import prefix_sums

    daily = ledger.daily_deltas(trade_ledger(spark, sf_dir), F.col("block"))
    closes = prefix_sums(daily, "addr", "day", "delta", "balance")
    return longs(closes.filter("delta <= -10000000").select("addr", "day", (-F.col("delta")).alias("dropped"), "balance"), "dropped", "balance")
