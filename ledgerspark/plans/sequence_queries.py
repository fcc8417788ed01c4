"""Queries on sessions, order fingerprints and holder distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.ranges import ranked
from ledgerspark.functions.shared import checkpointed
from ledgerspark.operators import distribution, ledger, sequence
from ledgerspark.operators.setjoin import best_matches
from ledgerspark.plans.registry import longs, register
from ledgerspark.sources.adapters import FLOW_SQL, TRADE_SQL, event_flow, table, trade_ledger

GAP = 2 * 86400
SESSION_SQL = f"""
s1 AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY dst ORDER BY ts, seq) <= {GAP} THEN 0 ELSE 1 END AS fresh FROM e),
se AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY dst ORDER BY ts, seq) AS BIGINT) AS session FROM s1),
fa AS (SELECT dst, session, frm, min(ts) AS ts, arg_min(seq, (ts, seq)) AS seq FROM se GROUP BY ALL),
ra AS (SELECT *, row_number() OVER (PARTITION BY dst, session ORDER BY ts, seq, frm) AS rank FROM fa)
"""


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.sessions(event_flow(spark, sf_dir), "dst", GAP)


@register("SELECT dst, session, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, CAST(sum(v) AS BIGINT) AS total FROM se GROUP BY ALL", FLOW_SQL, SESSION_SQL)
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _sessions(spark, sf_dir).groupBy("dst", "session")
    return longs(found.agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sum("v").alias("total")), "total")


@register("SELECT dst, session, frm, ts, seq, rank FROM ra", FLOW_SQL, SESSION_SQL)
def session_first_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.first_actions(_sessions(spark, sf_dir), ["dst", "session"], "frm")


BATCH_SQL = """
ba AS (SELECT ts // 86400 AS day, frm, min(ts) AS ts, arg_min(seq, (ts, seq)) AS seq FROM e GROUP BY ALL),
bo AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY ts, seq, frm) AS rank FROM ba)
"""


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.first_actions(event_flow(spark, sf_dir).withColumn("day", F.floor(F.col("ts") / 86400)), ["day"], "frm")


@register(
    """WITH p AS (SELECT x.day AS a, y.day AS b, x.frm, row_number() OVER (PARTITION BY x.day, y.day ORDER BY x.rank) AS pa, row_number() OVER (PARTITION BY x.day, y.day ORDER BY y.rank) AS pb,
      count(*) OVER (PARTITION BY x.day, y.day) AS common FROM bo x JOIN bo y ON x.frm = y.frm AND x.day < y.day)
    SELECT a, b, any_value(common) AS common, count(*) FILTER (pa = pb) AS forward, count(*) FILTER (pb = common + 1 - pa) AS reverse FROM p WHERE common >= 4 GROUP BY a, b""",
    FLOW_SQL,
    BATCH_SQL,
)
def cadence_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.order_matches(_days(spark, sf_dir), "day", "frm")


WORLD_SQL = """
wo AS (SELECT frm, row_number() OVER (ORDER BY min(ts), arg_min(seq, (ts, seq)), frm) AS g FROM e GROUP BY frm),
sp AS (SELECT day, row_number() OVER (PARTITION BY day ORDER BY rank) AS p, row_number() OVER (PARTITION BY day ORDER BY g) AS q FROM bo JOIN wo USING (frm))
"""


def _world(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(frm, rank): senders by their first action; the rank may be anything that sorts, here a struct."""
    first = event_flow(spark, sf_dir).groupBy("frm").agg(F.min(F.struct("ts", "seq")).alias("at"))
    return first.select("frm", F.struct("at.ts", "at.seq", "frm").alias("rank"))


@register("SELECT day, count(*) AS n, CAST(sum((p - q) * (p - q)) AS BIGINT) AS d2 FROM sp GROUP BY day HAVING count(*) >= 6", FLOW_SQL, BATCH_SQL, WORLD_SQL)
def spearman_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.spearman(_days(spark, sf_dir), "day", "frm", _world(spark, sf_dir)).select("day", "n", "d2")


@register()
def cadence_rank_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded permutation test of each day's order; no SQL form."""
    return sequence.permutation_test(_days(spark, sf_dir), "day", "frm", _world(spark, sf_dir))


@register()
def cadence_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senders joined through days whose order is unlikely at one in ten; random orders have no SQL form."""
    days = _days(spark, sf_dir)
    tested = sequence.permutation_test(days, "day", "frm", _world(spark, sf_dir))
    return sequence.hit_entities(tested, days, "day", "frm", p=0.1, rho=0.0)


@register("SELECT ts, count(DISTINCT frm) AS members, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM e GROUP BY ts HAVING count(DISTINCT frm) >= 2", FLOW_SQL)
def same_second_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(sequence.co_timed(event_flow(spark, sf_dir), "frm", "ts", least=2), "n", "total")


@register("WITH h AS (SELECT block AS ts, q, frm, v FROM t WHERE q > 0) SELECT ts, q, count(DISTINCT frm) AS members, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM h GROUP BY ALL HAVING count(DISTINCT frm) >= 3", TRADE_SQL)
def same_second_equal_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senders that moved the same quantity in the same block."""
    return longs(sequence.co_timed(trade_ledger(spark, sf_dir).filter("q > 0").withColumnRenamed("block", "ts"), "frm", "ts", "q", least=3), "n", "total")


@register(
    """WITH h AS (SELECT substr(addr, 1, 1) AS kind, CAST(bal AS DOUBLE) AS b FROM bal WHERE bal > 0)
    SELECT kind, count(*) AS n, CAST(round(1000 * stddev_pop(b) / avg(b)) AS BIGINT) AS cv_permille FROM h GROUP BY kind""",
    TRADE_SQL,
)
def holding_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficient of variation of the holdings of each kind of account, in thousandths."""
    held = ledger.balances(trade_ledger(spark, sf_dir)).filter("balance > 0").select(F.substring("addr", 1, 1).alias("kind"), F.col("balance").cast("double").alias("b"))
    return held.groupBy("kind").agg(F.count("*").alias("n"), F.round(1000 * F.stddev_pop("b") / F.avg("b")).cast("long").alias("cv_permille"))


HELD_SQL = "he AS (SELECT addr, bal AS balance FROM bal WHERE bal > 0 AND addr NOT IN ('ZERO', 'DEAD'))"


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.balances(trade_ledger(spark, sf_dir)).filter("balance > 0 and addr not in ('ZERO', 'DEAD')")


@register(
    """WITH r AS (SELECT balance, row_number() OVER (ORDER BY balance DESC, addr) AS k FROM he), z AS (SELECT count(*) AS owners, CAST(sum(balance) AS BIGINT) AS total FROM he)
    SELECT any_value(owners) AS owners, any_value(total) AS total, CAST(round(1000000 * (CAST(sum(balance) FILTER (k <= 1) AS DOUBLE) / CAST(any_value(total) AS DOUBLE))) AS BIGINT) AS top1,
      CAST(round(1000000 * (CAST(sum(balance) FILTER (k <= 3) AS DOUBLE) / CAST(any_value(total) AS DOUBLE))) AS BIGINT) AS top3,
      CAST(round(1000000 * (CAST(sum(balance) FILTER (k <= 5) AS DOUBLE) / CAST(any_value(total) AS DOUBLE))) AS BIGINT) AS top5,
      CAST(round(1000000 * (CAST(sum(balance) FILTER (k <= 10) AS DOUBLE) / CAST(any_value(total) AS DOUBLE))) AS BIGINT) AS top10,
      CAST(round(1000000 * sum(pow(CAST(balance AS DOUBLE) / CAST(total AS DOUBLE), 2))) AS BIGINT) AS hhi,
      CAST(round(1000000 * (CAST(max(balance) FILTER (k = 1) AS DOUBLE) / CAST(max(balance) FILTER (k = 2) AS DOUBLE))) AS BIGINT) AS first_to_second FROM r, z""",
    TRADE_SQL,
    HELD_SQL,
)
def head_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares in millionths."""
    one = distribution.head_concentration(_held(spark, sf_dir))
    return longs(one.withColumns({c: F.round(one[c] * 1_000_000) for c in ("top1", "top3", "top5", "top10", "hhi", "first_to_second")}), "total", "top1", "top3", "top5", "top10", "hhi", "first_to_second")


@register(
    """WITH z AS (SELECT sum(balance) AS total FROM he), b AS (SELECT balance, CAST(balance AS DOUBLE) * 1000000 / CAST(total AS DOUBLE) AS r FROM he, z)
    SELECT CASE WHEN r < 1 THEN 0 ELSE CAST(floor(log2(r) * 2) AS BIGINT) + 1 END AS bin, count(*) AS owners, CAST(sum(balance) AS BIGINT) AS total FROM b GROUP BY ALL""",
    TRADE_SQL,
    HELD_SQL,
)
def size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _held(spark, sf_dir)
    rows = held.join(F.broadcast(held.agg(F.sum("balance").alias("total"))))
    binned = rows.groupBy(distribution.bin_of(F.col("balance"), F.col("total")).alias("bin"))
    return longs(binned.agg(F.count("*").alias("owners"), F.sum("balance").alias("total")), "bin", "total")


@register("SELECT balance, count(*) AS owners, CAST(sum(balance) AS BIGINT) AS total FROM (SELECT bal // 1000000 AS balance FROM bal WHERE bal > 0) GROUP BY balance HAVING count(*) >= 5", TRADE_SQL)
def equal_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances in millions that several owners share."""
    held = ledger.balances(trade_ledger(spark, sf_dir)).filter("balance > 0").select(F.floor(F.col("balance") / 1_000_000).alias("balance"))
    return longs(distribution.equal_balances(held), "total")


@register(
    """SELECT CASE WHEN addr IN ('ZERO', 'DEAD') THEN 'burnt' WHEN addr IN (SELECT addr FROM cex) THEN 'exchange' WHEN addr LIKE 'S%' THEN 'supplier' WHEN bal > 0 THEN 'holder' ELSE 'empty' END AS bucket,
      count(*) AS owners, CAST(sum(bal) AS BIGINT) AS total FROM bal GROUP BY ALL""",
    TRADE_SQL,
)
def holder_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five buckets that cover every account once; their sums add up to the mint."""
    from ledgerspark.sources.adapters import exchanges

    held = ledger.balances(trade_ledger(spark, sf_dir)).join(exchanges(spark, sf_dir).withColumn("hot", F.lit(True)), "addr", "left")
    bucket = F.when(F.col("addr").isin("ZERO", "DEAD"), "burnt").when(F.col("hot"), "exchange").when(F.col("addr").startswith("S"), "supplier").when(F.col("balance") > 0, "holder").otherwise("empty")
    return longs(distribution.partition(held, bucket), "total")


@register()
def distribution_bumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the shape of the holder distribution; the isotonic fit has no SQL form."""
    return distribution.bumps(_held(spark, sf_dir))


@register(
    """WITH p AS (SELECT addr, block, sum(x) AS x FROM d WHERE addr LIKE 'C%' GROUP BY ALL), c AS (SELECT addr, x, sum(x) OVER (PARTITION BY addr ORDER BY block) // 1000000 AS held FROM p)
    SELECT CAST(held AS BIGINT) AS held, count(DISTINCT addr) AS owners, count(DISTINCT x) AS amounts FROM c WHERE x < 0 GROUP BY held HAVING count(DISTINCT addr) >= 2 AND count(DISTINCT x) >= 2""",
    TRADE_SQL,
)
def target_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances (in millions) that several customers reached by selling different amounts."""
    from ledgerspark.functions.prefix import prefix_sums

    daily = ledger.daily_deltas(trade_ledger(spark, sf_dir), F.col("block")).filter("addr like 'C%'")
    sold = prefix_sums(daily, "addr", "day", "delta", "close").filter("delta < 0")
    found = sold.groupBy((F.col("close") / 1_000_000).cast("long").alias("held")).agg(F.countDistinct("addr").alias("owners"), F.countDistinct("delta").alias("amounts"))
    return found.filter("owners >= 2 and amounts >= 2")


@register()
def cadence_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senders of days whose order agrees or mirrors in two places at least, as candidate groups from the best pair of days on, merged in that order; the merging has no SQL form."""
    days = checkpointed(_days(spark, sf_dir))
    pairs = sequence.order_matches(days, "day", "frm").withColumn("less", -F.greatest("forward", "reverse")).filter("less <= -2")
    placed = ranked(pairs.select("less", "a", "b"), ["less", "a", "b"], "number")
    own = lambda name: days.select(F.col("day").alias(name), "frm")
    members = checkpointed(placed.join(own("a"), "a").join(own("b"), ["b", "frm"]).select("number", "frm"))
    merged = sequence.merged_candidates(members, "number", "frm")
    return members.join(merged, "number").groupBy("group").agg(F.countDistinct("number").alias("pairs"), F.countDistinct("frm").alias("members"))


GROUPS_SQL = """
ga AS (SELECT c_nationkey || c_mktsegment AS g, c_custkey AS m FROM customer), gb AS (SELECT CASE WHEN c_custkey % 9 = 0 OR c_nationkey = 3 AND c_custkey % 3 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END || c_mktsegment AS g, c_custkey AS m FROM customer),
gj AS (SELECT a.g AS a, b.g AS b, count(*) AS common FROM ga a JOIN gb b USING (m) GROUP BY ALL), gk AS (SELECT gj.*, x.n + y.n - common AS either FROM gj JOIN (SELECT g, count(*) AS n FROM ga GROUP BY g) x ON x.g = a JOIN (SELECT g, count(*) AS n FROM gb GROUP BY g) y ON y.g = b)
"""


@register("SELECT a, arg_min(b, (-common / either, b)) AS b, arg_min(common, (-common / either, b)) AS common, arg_min(either, (-common / either, b)) AS either FROM gk WHERE common * 100 >= either * 60 GROUP BY a", GROUPS_SQL)
def shifted_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of customers and, of the groups after some have moved, the most alike to each, by a Jaccard share of at least 0.6."""
    rows = table(spark, sf_dir, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    moved = F.when((key % 9 == 0) | ((nation == 3) & (key % 3 == 0)), (nation + 1) % 25).otherwise(nation)
    sets = lambda place: rows.select(F.concat(place.cast("string"), "c_mktsegment").alias("set"), key.alias("item"))
    return best_matches(sets(nation), sets(moved), 60)
