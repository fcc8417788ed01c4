"""Queries of the mechanical scanners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import graph, ledger, scanners
from ledgerspark.plans.registry import longs, register
from ledgerspark.sources.adapters import FLOW_SQL, TRADE_SQL, event_flow, trade_ledger

WEEK, FORTNIGHT = 7 * 86400, 14 * 86400

SUMMARY_SQL = """
dd AS (SELECT addr, block AS day, sum(x) AS delta FROM d GROUP BY ALL),
dc AS (SELECT addr, day, sum(delta) OVER (PARTITION BY addr ORDER BY day) AS close FROM dd),
dp AS (SELECT addr, max(close) AS peak, min(close) AS least, arg_max(close, day) AS final, max(day) AS last_day FROM dc GROUP BY addr),
su AS (SELECT dp.addr, any_value(peak) AS peak, min(day) FILTER (close = peak) AS peak_day, any_value(least) AS least, any_value(final) AS final, any_value(last_day) AS last_day,
  min(day) FILTER (peak > 0 AND close * 2 >= peak) AS first_day FROM dp JOIN dc USING (addr) GROUP BY dp.addr)
"""


def _daily(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = trade_ledger(spark, sf_dir)
    return rows, ledger.daily_deltas(rows, F.col("block"))


@register("SELECT addr, CAST(peak AS BIGINT) AS peak, peak_day, CAST(least AS BIGINT) AS least, CAST(final AS BIGINT) AS final, last_day, first_day FROM su", TRADE_SQL, SUMMARY_SQL)
def addr_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(scanners.summaries(_daily(spark, sf_dir)[1]), "peak", "least", "final")


@register("SELECT CASE WHEN final * 10 < peak THEN 'cleared' WHEN final * 2 <= peak THEN 'partial' ELSE 'retained' END AS bucket, count(*) AS n, CAST(sum(final) AS BIGINT) AS held FROM su WHERE peak > 0 GROUP BY ALL", TRADE_SQL, SUMMARY_SQL)
def retention_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = scanners.summaries(_daily(spark, sf_dir)[1]).filter("peak > 0")
    bucket = scanners.retention_bucket(F.col("final"), F.col("peak"))
    return longs(summary.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.sum("final").alias("held")), "held")


@register(
    """WITH k AS (SELECT addr FROM su WHERE addr NOT IN ('ZERO', 'DEAD') ORDER BY peak DESC, addr LIMIT 200), z AS (SELECT max(block) AS now FROM t)
    SELECT addr, CAST(peak AS BIGINT) AS peak, CAST(final AS BIGINT) AS final, concat_ws(',', CASE WHEN addr IN (SELECT addr FROM k) THEN 'top' END, CASE WHEN peak * 10000 >= net * 10 THEN 'large' END,
      CASE WHEN (peak - final) * 100 >= peak * 80 THEN 'drawdown' END, CASE WHEN now - last_day >= 30 THEN 'dormant' END) AS reasons
    FROM su, supply, z WHERE addr NOT IN ('ZERO', 'DEAD') AND peak * 10000 >= net * 2""",
    TRADE_SQL,
    SUMMARY_SQL,
)
def scan_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, daily = _daily(spark, sf_dir)
    listed = scanners.universe(scanners.summaries(daily), ledger.supply(rows), rows.agg(F.max("block").alias("last")))
    return longs(listed.withColumn("reasons", F.concat_ws(",", "reasons")), "peak", "final")


@register(
    """WITH c AS (SELECT first_day AS day, count(*) AS n FROM su WHERE first_day IS NOT NULL GROUP BY first_day)
    SELECT day, CAST(sum(n) OVER (ORDER BY day RANGE BETWEEN CURRENT ROW AND 9 FOLLOWING) AS BIGINT) AS members FROM c""",
    TRADE_SQL,
    SUMMARY_SQL,
)
def seed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(scanners.seed_windows(scanners.summaries(_daily(spark, sf_dir)[1]), 10), "members")


@register(
    """WITH g AS (SELECT addr, CAST(substr(addr, 2) AS BIGINT) % 20 AS cohort FROM bal WHERE addr LIKE 'C%'),
    x AS (SELECT cohort, day, sum(delta) AS delta FROM dd JOIN g USING (addr) GROUP BY ALL), c AS (SELECT cohort, day, sum(delta) OVER (PARTITION BY cohort ORDER BY day) AS close FROM x),
    p AS (SELECT cohort, max(close) AS peak FROM c GROUP BY cohort)
    SELECT c.cohort, CAST(any_value(peak) AS BIGINT) AS peak, min(day) FILTER (close = peak) AS peak_day, CAST(arg_max(close, day) AS BIGINT) AS final FROM c JOIN p ON c.cohort = p.cohort GROUP BY c.cohort""",
    TRADE_SQL,
    SUMMARY_SQL,
)
def combined_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peak of the summed balances of twenty groups of customers."""
    rows, daily = _daily(spark, sf_dir)
    members = ledger.balances(rows).filter("addr like 'C%'").select("addr", (F.substring("addr", 2, 20).cast("long") % 20).alias("cohort"))
    return longs(scanners.combined(daily, members, "cohort"), "peak", "final")


@register(
    """WITH p AS (SELECT frm, dst, sum(v) AS v FROM e WHERE v > 0 AND frm <> dst GROUP BY ALL), g AS (SELECT frm, count(*) AS degree FROM p GROUP BY frm),
    m AS (SELECT dst AS addr, arg_max(frm, (v, frm)) AS feeder, max(v) AS v, sum(v) AS total FROM p GROUP BY dst)
    SELECT addr, feeder, CAST(v AS BIGINT) AS v, CAST(total AS BIGINT) AS total, degree FROM m JOIN g ON g.frm = feeder WHERE v * 100 >= total * 5 AND degree <= 60""",
    FLOW_SQL,
)
def feeder_exclusivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(scanners.feeders(graph.edges(event_flow(spark, sf_dir)), 5, 60), "v", "total")


@register(
    """SELECT su.addr, min(day) FILTER (day > peak_day AND close * 100 <= peak * 30) - any_value(peak_day) AS days FROM su JOIN dc ON su.addr = dc.addr WHERE peak > 0 GROUP BY su.addr""",
    TRADE_SQL,
    SUMMARY_SQL,
)
def peak_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir)[1]
    return scanners.peak_to_target(daily, scanners.summaries(daily))


@register(
    """WITH r AS (SELECT q AS amount, frm, dst, block AS day FROM t WHERE q >= 1 AND frm <> dst AND dst NOT IN ('ZERO', 'DEAD')),
    g AS (SELECT amount, count(DISTINCT dst) AS all_recipients, amount * count(*) AS total FROM r GROUP BY amount HAVING count(DISTINCT dst) >= 5),
    u AS (SELECT DISTINCT amount, dst, day FROM r), k AS (SELECT DISTINCT amount, day FROM r),
    w AS (SELECT k.amount, k.day, count(DISTINCT dst) AS recipients FROM k JOIN u ON k.amount = u.amount AND u.day BETWEEN k.day - 89 AND k.day GROUP BY ALL),
    b AS (SELECT amount, max(recipients) AS recipients, arg_max(day, (recipients, -day)) AS window_end FROM w GROUP BY amount),
    s AS (SELECT amount, arg_max(frm, (n, frm)) AS top_sender FROM (SELECT amount, frm, count(DISTINCT dst) AS n FROM r GROUP BY ALL) GROUP BY amount)
    SELECT amount, recipients, window_end, all_recipients, CAST(total AS BIGINT) AS total, top_sender FROM b JOIN g USING (amount) JOIN s USING (amount) WHERE recipients >= 5""",
    TRADE_SQL,
)
def equal_amount_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities that at least five customers received within ninety days."""
    return longs(scanners.equal_amounts(trade_ledger(spark, sf_dir), "q", "block", 90, 5), "recipients", "total")


FLOWS_SQL = """
fl AS (SELECT * FROM e WHERE v > 0 AND frm <> dst),
tot AS (SELECT CAST(sum(v) AS BIGINT) AS grand FROM e)
"""


def _least(rows: DataFrame, permille: int) -> int:
    """A share of all that was ever sent, as a whole number (one row to the driver)."""
    return (rows.agg(F.sum("v")).first()[0] or 0) * permille // 1000


@register(
    f"""WITH k AS (SELECT DISTINCT dst, ts FROM fl),
    w AS (SELECT k.dst, k.ts, sum(v) AS total, count(DISTINCT frm) AS members FROM k JOIN fl ON k.dst = fl.dst AND fl.ts BETWEEN k.ts - {WEEK} AND k.ts GROUP BY ALL),
    b AS (SELECT dst, arg_max((ts, total, members), (total, -ts)) AS x FROM w, tot WHERE w.total >= grand * 4 // 1000 AND members >= 5 GROUP BY dst),
    i AS (SELECT dst AS addr, sum(v) AS got FROM fl GROUP BY dst), o AS (SELECT frm AS addr, sum(v) AS sent FROM fl GROUP BY frm)
    SELECT dst AS addr, x[1] AS window_end, CAST(x[2] AS BIGINT) AS total, x[3] AS members, CAST(got - coalesce(sent, 0) AS BIGINT) AS net_inflow FROM b JOIN i ON i.addr = dst LEFT JOIN o ON o.addr = dst""",
    FLOW_SQL,
    FLOWS_SQL,
)
def sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that took 0.4% of all flow from at least five senders within a week."""
    rows = event_flow(spark, sf_dir)
    return longs(scanners.sinks(rows, "ts", WEEK, _least(rows, 4), 5), "total", "members", "net_inflow")


SPRAY_SQL = """
k AS (SELECT DISTINCT frm, ts FROM {rows}),
w AS (SELECT k.frm, k.ts, sum(v) AS total, count(DISTINCT dst) AS members FROM k JOIN {rows} r ON k.frm = r.frm AND r.ts BETWEEN k.ts - {width} AND k.ts GROUP BY ALL),
b AS (SELECT frm, arg_max((ts, total, members), (total, -ts)) AS x FROM w, tot WHERE w.total >= grand * {permille} // 1000 AND members >= {members} GROUP BY frm)
SELECT frm AS addr, x[1] AS window_end, CAST(x[2] AS BIGINT) AS total, x[3] AS members FROM b
"""


@register("WITH " + SPRAY_SQL.format(rows="fl", width=FORTNIGHT, permille=3, members=5).strip(), FLOW_SQL, FLOWS_SQL)
def sprays_pulse_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_flow(spark, sf_dir)
    return longs(scanners.sprays(rows, "ts", FORTNIGHT, _least(rows, 3), 5), "total", "members")


@register(
    "WITH fr AS (SELECT fl.* FROM fl JOIN (SELECT dst, min(ts) AS ts FROM fl GROUP BY dst) f ON fl.dst = f.dst AND fl.ts = f.ts), " + SPRAY_SQL.format(rows="fr", width=FORTNIGHT, permille=0, members=1).strip(),
    FLOW_SQL,
    FLOWS_SQL,
)
def sprays_pulse_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest fortnight of every sender to accounts that never got any before, of any amount and number of accounts."""
    return longs(scanners.sprays(event_flow(spark, sf_dir), "ts", FORTNIGHT, 0, 1, fresh_only=True), "total", "members")


@register("WITH p AS (SELECT frm, dst, sum(v) AS v FROM fl GROUP BY ALL) SELECT frm AS addr, CAST(sum(v) AS BIGINT) AS total, count(*) AS members FROM p, tot GROUP BY frm, grand HAVING sum(v) >= grand * 6 // 1000 AND count(*) >= 30", FLOW_SQL, FLOWS_SQL)
def sprays_slow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_flow(spark, sf_dir)
    return longs(scanners.slow_sprays(rows, _least(rows, 6), 30), "total")
