"""Queries on duplicates across sources, comparisons and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import ledger, market, reconcile
from ledgerspark.plans.registry import longs, register
from ledgerspark.sources.adapters import FLOW_SQL, TRADE_SQL, account, camps, event_flow, table, trade_ledger


@register(
    """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT (l_partkey, l_suppkey)) AS p FROM lineitem GROUP BY ALL)
    SELECT count(*) AS kept, count(*) FILTER (p > 1) AS conflicts, count(*) FILTER (p > 1) = 0 AS passes FROM k"""
)
def dedup_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are left for each line key, keys that name different lines, and the verdict on them."""
    kept, bad = reconcile.deduplicated_strict(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])
    out = kept.agg(F.count("*").alias("kept")).join(F.broadcast(bad.agg(F.count("*").alias("conflicts"))))
    return out.withColumn("passes", F.col("conflicts") == 0)


RUNS_SQL = "ru AS (SELECT 0 AS run, t.* FROM t WHERE block < 900 UNION ALL SELECT 1, t.* FROM t WHERE block BETWEEN 800 AND 1600 UNION ALL SELECT 2, t.* FROM t WHERE block > 1550)"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger in three runs that overlap."""
    rows = trade_ledger(spark, sf_dir)
    runs = F.filter(F.array(F.when(F.col("block") < 900, 0), F.when(F.col("block").between(800, 1600), 1), F.when(F.col("block") > 1550, 2)), lambda x: x.isNotNull())
    return rows.withColumn("run", F.explode(runs))


@register("WITH r AS (SELECT run, min(block) AS lo, max(block) AS hi FROM ru GROUP BY run) SELECT a.run AS a, b.run AS b, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi FROM r a JOIN r b ON a.run < b.run AND greatest(a.lo, b.lo) <= least(a.hi, b.hi)", TRADE_SQL, RUNS_SQL)
def run_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.overlaps(reconcile.run_ranges(_runs(spark, sf_dir), "run"), "run")


@register("SELECT block, count(*) AS n, CAST(sum(v) AS BIGINT) AS v FROM t GROUP BY block", TRADE_SQL)
def overlap_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of the ledger after three overlapping runs were made one."""
    rows = reconcile.overlap_dedup(_runs(spark, sf_dir), "run", ["block", "tx", "li"])
    return longs(rows.groupBy("block").agg(F.count("*").alias("n"), F.sum("v").alias("v")), "v")


SOURCES_SQL = "so AS (SELECT 'a' AS source, seq // 10 AS tx, frm, dst, v FROM e UNION ALL SELECT 'b', seq // 10, frm, dst, v + CASE WHEN seq % 170 = 3 THEN 1 ELSE 0 END FROM e WHERE seq // 10 % 3 = 0)"


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of ten events; a second source has a third of them and tells some differently."""
    rows = event_flow(spark, sf_dir).withColumn("tx", F.floor(F.col("seq") / 10))
    a = rows.select(F.lit("a").alias("source"), "tx", "frm", "dst", "v")
    b = rows.filter("tx % 3 = 0").select(F.lit("b").alias("source"), "tx", "frm", "dst", (F.col("v") + (F.col("seq") % 170 == 3).cast("long")).alias("v"))
    return a.unionByName(b)


@register(
    """WITH g AS (SELECT source, tx, string_agg(frm || '|' || dst || '|' || v, ';' ORDER BY frm, dst, v) AS d FROM so GROUP BY ALL)
    SELECT tx, count(*) AS sources, count(DISTINCT d) AS digests FROM g GROUP BY tx HAVING count(DISTINCT d) > 1""",
    FLOW_SQL,
    SOURCES_SQL,
)
def tx_digest_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.complete_transactions(_sources(spark, sf_dir), "source", ["tx"], ["frm", "dst", "v"])[1]


@register("SELECT seq // 10 AS tx, frm, dst, v FROM e", FLOW_SQL)
def tx_digest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each transaction once, whole, from its first source."""
    return reconcile.complete_transactions(_sources(spark, sf_dir), "source", ["tx"], ["frm", "dst", "v"])[0].select("tx", "frm", "dst", "v")


@register(
    """WITH a AS (SELECT * FROM t WHERE block <= 1400), b AS (SELECT block, tx, li, frm, dst, v + CASE WHEN tx % 97 = 5 THEN 1 ELSE 0 END AS v FROM t WHERE block >= 1000 AND tx % 89 <> 7),
    r AS (SELECT greatest((SELECT min(block) FROM a), (SELECT min(block) FROM b)) AS lo, least((SELECT max(block) FROM a), (SELECT max(block) FROM b)) AS hi),
    x AS (SELECT a.* FROM a, r WHERE block BETWEEN lo AND hi), y AS (SELECT b.* FROM b, r WHERE block BETWEEN lo AND hi),
    f AS (SELECT x.v AS xv, y.v AS yv, x.tx AS xt, y.tx AS yt FROM x FULL JOIN y ON x.block = y.block AND x.tx = y.tx AND x.li = y.li)
    SELECT any_value(lo) AS lo, any_value(hi) AS hi, count(*) FILTER (yt IS NULL) AS only_a, count(*) FILTER (xt IS NULL) AS only_b, count(*) FILTER (xv <> yv) AS differing, false AS passes FROM f, r""",
    TRADE_SQL,
)
def overlap_merge_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources in the blocks that both cover; one lacks rows and has other amounts."""
    rows = trade_ledger(spark, sf_dir).select("block", "tx", "li", "frm", "dst", "v")
    other = rows.filter("block >= 1000 and tx % 89 <> 7").withColumn("v", F.col("v") + (F.col("tx") % 97 == 5).cast("long"))
    return reconcile.merge_check(rows.filter("block <= 1400"), other, ["block", "tx", "li"], ["frm", "dst", "v"])


@register(
    """WITH a AS (SELECT frm, dst, count(*) AS n FROM e WHERE seq % 2 = 0 GROUP BY ALL), b AS (SELECT frm, dst, count(*) AS m FROM e WHERE seq % 2 = 1 GROUP BY ALL), f AS (SELECT coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM a FULL JOIN b USING (frm, dst))
    SELECT CAST(sum(greatest(n - m, 0)) AS BIGINT) AS missing, CAST(sum(greatest(m - n, 0)) AS BIGINT) AS extra, sum(abs(n - m)) = 0 AS equal FROM f""",
    FLOW_SQL,
)
def multiset_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_flow(spark, sf_dir)
    return reconcile.multiset_equal(rows.filter("seq % 2 = 0").select("frm", "dst"), rows.filter("seq % 2 = 1").select("frm", "dst"))


@register("SELECT addr, bal AS replayed, CASE WHEN addr LIKE '%7' THEN bal + 5 WHEN addr LIKE '%33' THEN 0 ELSE bal END AS snapshot, bal - CASE WHEN addr LIKE '%7' THEN bal + 5 WHEN addr LIKE '%33' THEN 0 ELSE bal END AS gap FROM bal WHERE addr LIKE '%7' OR (addr LIKE '%33' AND bal <> 0)", TRADE_SQL)
def owner_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances against a snapshot in which some accounts differ and some are absent."""
    held = ledger.balances(trade_ledger(spark, sf_dir))
    snapshot = held.filter("addr not like '%33'").withColumn("balance", F.when(F.col("addr").like("%7"), F.col("balance") + 5).otherwise(F.col("balance")))
    return longs(reconcile.owner_mismatches(held, snapshot), "replayed", "snapshot", "gap")


@register(
    """WITH x AS (SELECT seq // 8 AS tx, frm AS owner, -v AS x FROM e UNION ALL SELECT seq // 8, dst, v FROM e WHERE seq % 8 <> 7), n AS (SELECT tx, owner, CAST(sum(x) AS BIGINT) AS x FROM x GROUP BY ALL HAVING sum(x) <> 0),
    c AS (SELECT tx, x > 0 AS up, owner, sum(abs(x)) OVER (PARTITION BY tx, x > 0 ORDER BY abs(x) DESC, owner) AS hi, abs(x) AS w FROM n),
    s AS (SELECT tx, coalesce(max(hi) FILTER (up), 0) AS got, coalesce(max(hi) FILTER (NOT up), 0) AS gave FROM c GROUP BY tx),
    r AS (SELECT tx, up, owner, hi - w AS lo, hi FROM c UNION ALL SELECT tx, gave > got, 'ZERO', least(got, gave), greatest(got, gave) FROM s WHERE got <> gave)
    SELECT a.tx, a.owner AS frm, b.owner AS dst, CAST(least(a.hi, b.hi) - greatest(a.lo, b.lo) AS BIGINT) AS v FROM r a JOIN r b ON a.tx = b.tx AND NOT a.up AND b.up AND greatest(a.lo, b.lo) < least(a.hi, b.hi)""",
    FLOW_SQL,
)
def delta_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net changes of transactions of eight events, the last of which is burnt, paired into transfers."""
    rows = event_flow(spark, sf_dir).withColumn("tx", F.floor(F.col("seq") / 8))
    legs = F.array(F.struct(F.col("frm").alias("owner"), (-F.col("v")).alias("x")), F.struct(F.when(F.col("seq") % 8 != 7, F.col("dst")).alias("owner"), F.col("v").alias("x")))
    net = rows.select("tx", F.inline(legs)).filter("owner is not null").groupBy("tx", "owner").agg(F.sum("x").alias("delta"))
    return longs(reconcile.pairings(net), "v")


@register(
    """WITH u AS (SELECT addr, CAST(substr(addr, 2) AS BIGINT) AS k FROM bal WHERE addr LIKE 'C%')
    SELECT addr, CASE WHEN k % 10 = 4 THEN 'neither' ELSE 'both' END AS problem FROM u WHERE k % 10 = 4 OR k % 15 = 0 UNION ALL SELECT 'X' || k, 'unknown' FROM u WHERE k % 40 = 1""",
    TRADE_SQL,
)
def adjudication_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and excluded customers against all of them: some are on both sides, some on neither, some unknown."""
    k = F.substring("addr", 2, 20).cast("long")
    all_ = ledger.balances(trade_ledger(spark, sf_dir)).filter("addr like 'C%'").select("addr", k.alias("k"))
    accepted = all_.filter("k % 5 = 0 or k % 15 = 0").unionByName(all_.filter("k % 40 = 1").select(F.concat(F.lit("X"), "k").alias("addr"), "k"))
    excluded = all_.filter("(k % 5 <> 0 and k % 10 <> 4) or k % 15 = 0")
    return reconcile.partition_check(all_, accepted, excluded)


@register("WITH mu AS (SELECT addr FROM bal WHERE addr NOT IN ('ZERO', 'DEAD') AND bal * 1000 >= (SELECT net FROM supply)) SELECT addr FROM mu WHERE addr NOT IN (SELECT addr FROM cex) AND addr NOT LIKE '%1'", TRADE_SQL)
def uncovered_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large holders that no candidate list names."""
    from ledgerspark.sources.adapters import exchanges

    rows = trade_ledger(spark, sf_dir)
    held = ledger.balances(rows)
    must = held.filter("addr not in ('ZERO', 'DEAD')").join(F.broadcast(ledger.supply(rows).select("net")), F.col("balance") * 1000 >= F.col("net"))
    return reconcile.uncovered(must, exchanges(spark, sf_dir).unionByName(held.filter("addr like '%1'").select("addr")))


@register(
    """WITH s AS (SELECT seq, v AS value, seq * 10 AS before, seq * 10 + v - CASE seq % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN v // 100 ELSE -3 END AS after FROM e)
    SELECT seq, value - (after - before) AS gap, CASE WHEN abs(value - (after - before)) <= greatest(2, value // 1000000) THEN 'OK' WHEN value > after - before THEN 'FEE' ELSE 'GAIN' END AS verdict FROM s""",
    FLOW_SQL,
)
def fee_on_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipients' gains against the amounts sent, in four kinds of tokens."""
    kind = F.col("seq") % 4
    loss = F.when(kind == 0, 0).when(kind == 1, 2).when(kind == 2, F.floor(F.col("v") / 100)).otherwise(-3)
    rows = event_flow(spark, sf_dir).select("seq", F.col("v").alias("value"), (F.col("seq") * 10).alias("before"), (F.col("seq") * 10 + F.col("v") - loss).alias("after"))
    return reconcile.fee_on_transfer(rows).select("seq", F.col("gap").cast("long").alias("gap"), "verdict")


@register(
    """WITH b AS (SELECT addr, sum(x) AS b FROM d WHERE block <= 1200 GROUP BY addr), a AS (SELECT addr, bal + CASE WHEN addr LIKE '%5' THEN 1 ELSE 0 END AS a FROM bal), mo AS (SELECT * FROM t WHERE block > 1200),
    f AS (SELECT addr, coalesce(a, 0) AS a, coalesce(b, 0) AS b, addr IN (SELECT frm FROM mo UNION SELECT dst FROM mo) AS moved FROM a FULL JOIN b USING (addr))
    SELECT CAST(sum(a - b) - (SELECT coalesce(sum(v) FILTER (frm = 'ZERO'), 0) FROM mo) AS BIGINT) AS supply_drift, count(*) FILTER (NOT moved) AS quiet, count(*) FILTER (NOT moved AND a <> b) AS drifted, false AS passes FROM f""",
    TRADE_SQL,
)
def rebase_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances at two blocks, of which some grew without an event; sinks keep what is burnt, so burns don't count."""
    rows = trade_ledger(spark, sf_dir)
    later = ledger.balances(rows).withColumn("balance", F.col("balance") + F.col("addr").like("%5").cast("long"))
    return longs(reconcile.rebase_drift(ledger.balances(rows.filter("block <= 1200")), later, rows.filter("block > 1200"), ledger.minted(), F.lit(0)), "supply_drift")


@register(
    """WITH o AS (SELECT unnest([0, 1, 2, 3]) AS n), s AS (SELECT net, coalesce((SELECT sum(bal) FROM bal WHERE addr IN ('ZERO', 'DEAD')), 0) AS k FROM supply),
    x AS (SELECT n, net, k, CASE n WHEN 0 THEN net WHEN 1 THEN net + net // 2000 WHEN 2 THEN net + k ELSE net + k + 1 END AS observed FROM o, s)
    SELECT n, CASE WHEN abs(observed - net) * 10000 <= net * 10 THEN 'MATCH' WHEN observed = net + k THEN 'MATCH_WITH_SINKS' ELSE 'MISMATCH' END AS verdict FROM x""",
    TRADE_SQL,
)
def supply_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four observed supplies against the replayed one."""
    rows = trade_ledger(spark, sf_dir)
    one = ledger.supply(rows).join(F.broadcast(reconcile.sink_balances(ledger.balances(rows))))
    seen = F.array(F.col("net"), F.col("net") + F.floor(F.col("net") / 2000), F.col("net") + F.col("in_sinks"), F.col("net") + F.col("in_sinks") + 1)
    four = one.select("net", "in_sinks", F.posexplode(seen).alias("n", "observed"))
    return four.select("n", reconcile.supply_truth(F.col("observed"), F.col("net"), F.col("in_sinks")).alias("verdict"))


SERIES_SQL = """
sd AS (SELECT block AS day, sum(CASE WHEN frm = 'ZERO' THEN v ELSE 0 END) - sum(CASE WHEN dst IN ('ZERO', 'DEAD') THEN v ELSE 0 END) AS delta FROM t GROUP BY block),
sn AS (SELECT day, sum(delta) OVER (ORDER BY day) AS net FROM sd),
cs AS (SELECT camp, day, CAST(sum(x) OVER (PARTITION BY camp ORDER BY day) AS DOUBLE) / CAST(net AS DOUBLE) AS share FROM (SELECT camp, block AS day, sum(x) AS x FROM d JOIN camp ON d.addr = camp.addr GROUP BY ALL) JOIN sn USING (day))
"""


def _series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = trade_ledger(spark, sf_dir)
    series = ledger.group_series(ledger.daily_deltas(rows, F.col("block")), camps(spark, sf_dir), "camp")
    return rows, ledger.group_share(series, ledger.supply_daily(rows, F.col("block")), "camp").select("camp", "day", "share")


@register(
    """WITH la AS (SELECT camp, arg_max(share, day) AS last FROM cs GROUP BY camp), nw AS (SELECT camp, CAST(sum(bal) AS DOUBLE) / CAST(any_value(net) AS DOUBLE) + CASE WHEN camp = 'ASIA' THEN 0.01 ELSE 0 END AS now FROM bal JOIN camp USING (addr), supply GROUP BY camp)
    SELECT camp, CASE WHEN abs(last - now) * 10000 <= 5 THEN 'OK' ELSE 'DRIFT' END AS verdict FROM la JOIN nw USING (camp)""",
    TRADE_SQL,
    SERIES_SQL,
)
def series_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last points of the camps' series against shares computed anew, one of which is off."""
    rows, series = _series(spark, sf_dir)
    now = ledger.balances(rows).join(camps(spark, sf_dir), "addr").groupBy("camp").agg(F.sum("balance").alias("b")).join(F.broadcast(ledger.supply(rows).select("net")))
    shares = now.select("camp", (F.col("b").cast("double") / F.col("net").cast("double") + F.when(F.col("camp") == "ASIA", 0.01).otherwise(0.0)).alias("share"))
    return reconcile.series_endpoints(series, "camp", shares).select("camp", "verdict")


@register(
    """WITH o AS (SELECT sum(s > 1 + 1e-9) AS n FROM (SELECT day, sum(share) AS s FROM cs GROUP BY day))
    SELECT 'unknown_group' AS problem, count(*) FILTER (camp NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')) AS n FROM cs UNION ALL SELECT 'not_finite', 0 UNION ALL SELECT 'out_of_range', count(*) FILTER (share < 0 OR share > 1) FROM cs
    UNION ALL SELECT 'repeated_day', 0 UNION ALL SELECT 'over_one', CAST(coalesce(n, 0) AS BIGINT) FROM o""",
    TRADE_SQL,
    SERIES_SQL,
)
def series_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.series_problems(_series(spark, sf_dir)[1], "camp", ["AFRICA", "AMERICA", "ASIA", "EUROPE"])


@register(
    """WITH m AS (SELECT 'E' || c_nationkey AS entity, 'C' || c_custkey AS addr FROM customer UNION ALL SELECT 'E99', 'C' || c_custkey FROM customer WHERE c_custkey % 100 = 3),
    p AS (SELECT 'E' || c_nationkey AS entity, 'C' || c_custkey AS addr, c_custkey AS balance FROM customer WHERE c_custkey % 70 <> 5 UNION ALL SELECT 'E98', 'Q', 1),
    k AS (SELECT 'E' || c_nationkey AS entity, 'K' || (c_custkey % 1000000 - CASE WHEN c_custkey % 60 = 7 THEN 1 ELSE 0 END) AS key, CASE WHEN c_nationkey = 4 THEN 0 ELSE c_custkey END AS amount FROM customer)
    SELECT * FROM (SELECT min(entity) AS entity, 'member_twice' AS problem FROM m GROUP BY addr HAVING count(*) > 1) UNION SELECT entity, 'member_without_position' FROM m WHERE (entity, addr) NOT IN (SELECT (entity, addr) FROM p)
    UNION SELECT entity, 'position_without_member' FROM p WHERE (entity, addr) NOT IN (SELECT (entity, addr) FROM m) UNION SELECT min(entity), 'right_counted_twice' FROM k GROUP BY key HAVING count(*) > 1
    UNION SELECT entity, 'control_below_positions' FROM (SELECT entity, sum(balance) AS h FROM p GROUP BY entity) FULL JOIN (SELECT entity, sum(amount) AS o FROM k GROUP BY entity) USING (entity) WHERE coalesce(o, 0) < coalesce(h, 0)"""
)
def ledger_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members, positions and rights of nations, with planted faults of each kind."""
    who = table(spark, sf_dir, "customer").select(F.concat(F.lit("E"), "c_nationkey").alias("entity"), account("C", "c_custkey").alias("addr"), F.col("c_custkey").alias("k"), "c_nationkey")
    members = who.select("entity", "addr").unionByName(who.filter("k % 100 = 3").select(F.lit("E99").alias("entity"), "addr"))
    positions = who.filter("k % 70 <> 5").select("entity", "addr", F.col("k").alias("balance"))
    positions = positions.unionByName(who.agg(F.lit("E98").alias("entity"), F.lit("Q").alias("addr"), F.lit(1).cast("long").alias("balance")))
    right = F.concat(F.lit("K"), F.col("k") - (F.col("k") % 60 == 7).cast("long"))
    control = who.select("entity", right.alias("key"), F.when(F.col("c_nationkey") == 4, 0).otherwise(F.col("k")).alias("amount"))
    return reconcile.ledger_closure(members, positions, control)


@register(
    """WITH c AS (SELECT addr, bal AS balance, addr NOT LIKE '%0' AS must, CAST(substr(addr, 2) AS BIGINT) AS k FROM bal WHERE addr LIKE 'C%'),
    g AS (SELECT addr, CASE WHEN k % 9 = 8 THEN 'maybe' WHEN k % 3 = 0 THEN 'accepted' ELSE 'excluded' END AS verdict, CASE WHEN k % 11 = 1 THEN '' ELSE 'seen' END AS reason, CASE WHEN k % 3 = 0 AND k % 12 <> 9 OR k % 31 = 2 THEN 'E' || k % 7 END AS entity, 'small' AS tier, k FROM c WHERE k % 13 <> 5),
    dd AS (SELECT addr, verdict, reason, entity, tier FROM g UNION ALL SELECT addr, verdict, reason, entity, tier FROM g WHERE k % 50 = 6 UNION ALL SELECT 'Z' || k, verdict, reason, entity, tier FROM g WHERE k % 60 = 12),
    s AS (SELECT entity, sum(balance) AS total FROM dd JOIN c USING (addr) WHERE verdict = 'accepted' GROUP BY entity), u AS (SELECT entity, CASE WHEN total * 10000 >= net * 300 THEN 'big' WHEN total * 10000 >= net * 100 THEN 'small' ELSE 'none' END AS due FROM s, supply)
    SELECT addr, 'not_decided' AS problem FROM c WHERE must AND addr NOT IN (SELECT addr FROM dd) UNION SELECT addr, 'not_a_candidate' FROM dd WHERE addr NOT IN (SELECT addr FROM c)
    UNION SELECT addr, 'decided_twice' FROM dd GROUP BY addr HAVING count(*) > 1 UNION SELECT addr, 'unknown_verdict' FROM dd WHERE verdict = 'maybe' UNION SELECT addr, 'no_reason' FROM dd WHERE reason = ''
    UNION SELECT addr, 'no_entity' FROM dd WHERE verdict = 'accepted' AND entity IS NULL UNION SELECT addr, 'excluded_with_entity' FROM dd WHERE verdict = 'excluded' AND entity IS NOT NULL
    UNION SELECT addr, 'wrong_tier' FROM dd JOIN u USING (entity) WHERE verdict = 'accepted' AND due <> tier""",
    TRADE_SQL,
)
def adjudication_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions on all customers with planted faults of each kind."""
    rows = trade_ledger(spark, sf_dir)
    k = F.substring("addr", 2, 20).cast("long")
    who = ledger.balances(rows).filter("addr like 'C%'").select("addr", "balance", (~F.col("addr").like("%0")).alias("must"), k.alias("k"))
    verdict = F.when(F.col("k") % 9 == 8, "maybe").when(F.col("k") % 3 == 0, "accepted").otherwise("excluded")
    entity = F.when(((F.col("k") % 3 == 0) & (F.col("k") % 12 != 9)) | (F.col("k") % 31 == 2), F.concat(F.lit("E"), F.col("k") % 7))
    made = who.filter("k % 13 <> 5").select("addr", verdict.alias("verdict"), F.when(F.col("k") % 11 == 1, "").otherwise("seen").alias("reason"), entity.alias("entity"), F.lit("small").alias("tier"), "k")
    made = made.unionByName(made.filter("k % 50 = 6")).unionByName(made.filter("k % 60 = 12").withColumn("addr", F.concat(F.lit("Z"), "k"))).drop("k")
    return reconcile.adjudication_problems(who, made, ledger.supply(rows), 300, 100)


ANCHOR_SQL = "an AS (SELECT seq AS block, min(ts) AS ts FROM e WHERE seq % 100 = 50 GROUP BY seq)"


def _anchors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events as blocks, and anchors of known time at every hundredth."""
    rows = event_flow(spark, sf_dir).withColumnRenamed("seq", "block")
    return rows.select("block"), rows.filter("block % 100 = 50").select("block", "ts")


@register(
    """WITH x AS (SELECT seq AS block FROM e), p AS (SELECT x.block, max(a.block) AS b0 FROM x LEFT JOIN an a ON a.block < x.block GROUP BY x.block), q AS (SELECT x.block, min(a.block) AS b1 FROM x LEFT JOIN an a ON a.block >= x.block GROUP BY x.block)
    SELECT x.block, CASE WHEN b0 IS NULL THEN (SELECT arg_min(ts, block) FROM an) WHEN b1 IS NULL THEN (SELECT arg_max(ts, block) FROM an) ELSE l.ts + (h.ts - l.ts) * (x.block - b0) // greatest(b1 - b0, 1) END AS ts
    FROM x JOIN p USING (block) JOIN q USING (block) LEFT JOIN an l ON l.block = b0 LEFT JOIN an h ON h.block = b1""",
    FLOW_SQL,
    ANCHOR_SQL,
)
def interpolated_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, anchors = _anchors(spark, sf_dir)
    return market.interpolated(rows, anchors, "block", "ts")


@register(
    """WITH x AS (SELECT seq AS block FROM e), k AS (SELECT min(block) AS f, max(block) AS l FROM an), s AS (SELECT (SELECT min(block) FROM an, k WHERE block > f) AS f2, (SELECT max(block) FROM an, k WHERE block < l) AS l2),
    g AS (SELECT x.block, CASE WHEN x.block <= f THEN f WHEN x.block > l THEN l2 ELSE (SELECT max(block) FROM an WHERE block < x.block) END AS a, CASE WHEN x.block <= f THEN f2 WHEN x.block > l THEN l ELSE (SELECT min(block) FROM an WHERE block >= x.block) END AS b FROM x, k, s)
    SELECT g.block, CAST(floor(l.ts + floor((h.ts - l.ts) * (g.block - a) / CAST(b - a AS DOUBLE))) AS BIGINT) AS ts FROM g JOIN an l ON l.block = a JOIN an h ON h.block = b""",
    FLOW_SQL,
    ANCHOR_SQL,
)
def calibrated_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times on the lines between anchors and beyond the outermost."""
    rows, anchors = _anchors(spark, sf_dir)
    return market.interpolated(rows, anchors, "block", "ts", extrapolate=True)


@register(
    """WITH b AS (SELECT ts // 3600 * 3600 AS bar, arg_max(v, (ts, seq)) AS price FROM e WHERE seq % 3 = 0 GROUP BY ALL) SELECT seq, ts, ts // 3600 * 3600 AS bar, price FROM e LEFT JOIN b ON ts >= bar AND ts < bar + 3600""",
    FLOW_SQL,
)
def hour_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the price of the hour that covers it."""
    rows = event_flow(spark, sf_dir)
    bars = market.bars(rows.filter("seq % 3 = 0").withColumnRenamed("v", "price"), 3600)
    return longs(market.in_bars(rows.select("seq", "ts"), bars, 3600), "bar")


@register(
    """WITH c AS (SELECT dst, ts, max(v) AS v FROM e GROUP BY ALL), z AS (SELECT max(ts) AS z FROM c), f AS (SELECT dst, CAST(ceil(min(ts) / 86400) AS BIGINT) * 86400 AS b FROM c GROUP BY dst),
    g AS (SELECT dst, unnest(range(b, z + 1, 86400)) AS ts FROM f, z WHERE b <= z) SELECT g.dst, g.ts, c.v FROM g ASOF JOIN c ON g.dst = c.dst AND g.ts >= c.ts""",
    FLOW_SQL,
)
def locf_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last amount that each account received, at every midnight."""
    changes = event_flow(spark, sf_dir).groupBy("dst", "ts").agg(F.max("v").alias("v"))
    return market.on_grid(changes, "dst", "ts", "v", 86400)


