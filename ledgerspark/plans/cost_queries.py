"""Queries on costs, pools and documented methods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.ranges import by_ranges, running
from ledgerspark.operators import cost, graph, ledger, methods, sequence
from ledgerspark.plans.registry import longs, register
from ledgerspark.sources.adapters import FLOW_SQL, TRADE_SQL, camps, event_flow, exchanges, table, trade_ledger


def _whole(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles as whole thousandths, so that sums in another order agree."""
    return df.withColumns({c: F.round(F.col(c) * 1000).cast("long") for c in columns})


@register(
    """WITH k AS (SELECT seq // 6 AS tx, dst AS addr, v AS x FROM e UNION ALL SELECT seq // 6, frm, -v FROM e), n AS (SELECT tx, addr, sum(x) AS x FROM k GROUP BY ALL HAVING sum(x) <> 0),
    s AS (SELECT tx, sum(greatest(x, 0)) AS up, sum(greatest(-x, 0)) AS down FROM n GROUP BY tx), q AS (SELECT seq // 6 AS tx, sum(CASE WHEN seq % 2 = 0 THEN v ELSE 0 END) AS i, sum(CASE WHEN seq % 2 = 1 THEN v ELSE 0 END) AS o FROM e WHERE seq // 6 % 4 <> 3 GROUP BY ALL),
    l AS (SELECT addr, greatest(x, 0) AS b, greatest(-x, 0) AS c, CAST(coalesce(i, 0) AS DOUBLE) AS i, CAST(coalesce(o, 0) AS DOUBLE) AS o, up, down FROM n JOIN s USING (tx) LEFT JOIN q USING (tx)),
    p AS (SELECT addr, sum(CASE WHEN i > 0 THEN b ELSE 0 END) AS bought, sum(CASE WHEN i > 0 AND b > 0 THEN i * CAST(b AS DOUBLE) / CAST(up AS DOUBLE) ELSE 0 END) AS paid, sum(CASE WHEN o > 0 THEN c ELSE 0 END) AS sold,
      sum(CASE WHEN o > 0 AND c > 0 THEN o * CAST(c AS DOUBLE) / CAST(down AS DOUBLE) ELSE 0 END) AS got, sum(CASE WHEN i > 0 THEN 0 ELSE b END) AS unpriced FROM l GROUP BY addr)
    SELECT addr, CAST(bought AS BIGINT) AS bought, CAST(sold AS BIGINT) AS sold, CAST(unpriced AS BIGINT) AS unpriced, CAST(round(paid) AS BIGINT) AS paid, CAST(round(got) AS BIGINT) AS got,
      CAST(round(got - CASE WHEN bought > 0 THEN paid * CAST(least(sold, bought) AS DOUBLE) / CAST(bought AS DOUBLE) ELSE 0 END) AS BIGINT) AS realised FROM p WHERE bought + sold >= 1000""",
    FLOW_SQL,
)
def cost_pnl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs and gains of accounts in transactions of six events, a quarter of which have no quote."""
    rows = event_flow(spark, sf_dir).withColumn("tx", F.floor(F.col("seq") / 6))
    tokens = rows.select("tx", F.inline(F.array(F.struct(F.col("dst").alias("addr"), F.col("v").alias("delta")), F.struct(F.col("frm").alias("addr"), (-F.col("v")).alias("delta")))))
    even = F.col("seq") % 2 == 0
    quotes = rows.filter("tx % 4 <> 3").groupBy("tx").agg(F.sum(F.when(even, F.col("v")).otherwise(0)).alias("into"), F.sum(F.when(even, 0).otherwise(F.col("v"))).alias("out"))
    found = cost.trade_pnl(tokens, quotes, F.lit(1000))
    return longs(found.withColumns({c: F.round(c) for c in ("paid", "got", "realised")}), "bought", "paid", "sold", "got", "unpriced", "realised")


CURVE_SQL = """
tr AS (SELECT ts, seq, frm AS addr, CASE WHEN seq % 5 = 0 THEN -v ELSE v END AS amount FROM e),
cu AS (SELECT *, 1e9 - sum(amount) OVER (ORDER BY ts, seq) AS reserve FROM tr),
co AS (SELECT *, 3e13 / reserve - 3e13 / (reserve + amount) AS cost FROM cu WHERE amount > 0)
"""


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trades on a curve of 10^9 tokens and 30,000 quotes; every fifth is a sale."""
    rows = event_flow(spark, sf_dir)
    return cost.curve_costs(rows.select("ts", "seq", F.col("frm").alias("addr"), F.when(F.col("seq") % 5 == 0, -F.col("v")).otherwise(F.col("v")).alias("amount")), 1e9, 3e4)


@register("SELECT addr, CAST(sum(amount) AS BIGINT) AS tokens, CAST(round(1000 * sum(cost)) AS BIGINT) AS paid, count(*) AS buys, min(ts) AS first, max(ts) AS last FROM co GROUP BY addr", FLOW_SQL, CURVE_SQL)
def curve_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole(cost.buyer_costs(_curve(spark, sf_dir)), "paid")


@register("WITH z AS (SELECT arg_max(reserve, (ts, seq)) AS r FROM co) SELECT CAST(round(r) AS BIGINT) AS reserve, CASE WHEN abs(3e13 / r / r - 0.00004) / 0.00004 * 100 > 20 THEN 'WARN' ELSE 'OK' END AS verdict FROM z", FLOW_SQL, CURVE_SQL)
def curve_graduation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curve's last price against a market price."""
    return longs(cost.graduation(_curve(spark, sf_dir), 1e9, 3e4, F.lit(0.00004)).select(F.round("reserve").alias("reserve"), "verdict"), "reserve")


@register("SELECT CASE WHEN dst = 'U7' THEN frm ELSE dst END AS addr, CAST(sum(CASE WHEN dst = 'U7' THEN v ELSE 0 END) AS BIGINT) AS staked, CAST(sum(CASE WHEN dst = 'U7' THEN 0 ELSE v END) AS BIGINT) AS unstaked, CAST(sum(CASE WHEN dst = 'U7' THEN v ELSE -v END) AS BIGINT) AS net FROM e WHERE (frm = 'U7') <> (dst = 'U7') GROUP BY 1", FLOW_SQL)
def stake_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(cost.stakes(event_flow(spark, sf_dir), "U7"), "staked", "unstaked", "net")


@register("SELECT CAST(sum(CASE WHEN dst = 'U7' THEN v ELSE -v END) AS BIGINT) AS net, CAST(sum(CASE WHEN dst = 'U7' THEN v ELSE -v END) AS BIGINT) + 1 AS balance, true AS passes FROM e WHERE (frm = 'U7') <> (dst = 'U7')", FLOW_SQL)
def stake_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_flow(spark, sf_dir)
    held = ledger.balances(rows).filter("addr = 'U7'").select((F.col("balance") + 1).alias("balance"))
    return longs(cost.stake_closure(cost.stakes(rows, "U7"), held), "net", "balance")


LP_SQL = """
lp AS (SELECT frm AS operator, v % 7 AS lower, v % 7 + 1 + v % 3 AS upper, CASE WHEN v % 4 = 0 THEN 0 ELSE v END AS amount0, CASE WHEN v % 4 = 1 THEN 0 ELSE v * 2 END AS amount1, CASE WHEN seq % 3 = 0 THEN -v ELSE v END AS liquidity FROM e)
"""


def _liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of liquidity in a few price ranges."""
    v = F.col("v")
    return event_flow(spark, sf_dir).select(F.col("frm").alias("operator"), (v % 7).alias("lower"), (v % 7 + 1 + v % 3).alias("upper"), F.when(v % 4 == 0, 0).otherwise(v).alias("amount0"), F.when(v % 4 == 1, 0).otherwise(v * 2).alias("amount1"), F.when(F.col("seq") % 3 == 0, -v).otherwise(v).alias("liquidity"))


@register(
    """SELECT operator, count(*) FILTER (liquidity > 0) AS adds, count(*) FILTER (liquidity < 0) AS removes, CAST(sum(greatest(liquidity, 0)) AS BIGINT) AS added, CAST(sum(greatest(-liquidity, 0)) AS BIGINT) AS removed,
      count(*) FILTER (liquidity > 0 AND (amount0 = 0) <> (amount1 = 0)) AS one_sided FROM lp GROUP BY operator""",
    FLOW_SQL,
    LP_SQL,
)
def lp_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(cost.liquidity(_liquidity(spark, sf_dir)), "added", "removed")


@register(
    """WITH o AS (SELECT lower, upper, operator, count(*) AS n, count(*) FILTER (liquidity > 0) AS a, count(*) FILTER (liquidity > 0 AND (amount0 = 0) <> (amount1 = 0)) AS l, count(*) FILTER (liquidity < 0) AS r FROM lp GROUP BY ALL)
    SELECT lower, upper, upper - lower AS width, CAST(sum(n) AS BIGINT) AS events, CAST(sum(l) AS BIGINT) AS one_sided, count(*) FILTER (a = 0 AND r > 0) AS strangers FROM o GROUP BY lower, upper""",
    FLOW_SQL,
    LP_SQL,
)
def lp_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(cost.liquidity_walls(_liquidity(spark, sf_dir)), "events", "one_sided")


@register("SELECT seq, (v + 1) * (v + 1) AS price FROM e", FLOW_SQL)
def sqrt_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices from square roots in 96-bit fixed point: (v + 1) / 1000 times 2^96, squared."""
    root = (F.col("v") + 1).cast("decimal(38,0)")
    exact = (root * F.lit(str(2**93)).cast("decimal(29,0)")).cast("decimal(38,0)")
    rows = event_flow(spark, sf_dir).select("seq", (exact / F.lit(125).cast("decimal(3,0)")).cast("decimal(38,0)").alias("root"))
    return cost.sqrt_price(rows, "root", 6, 0).select("seq", F.round("price").cast("long").alias("price"))


@register("SELECT seq, CASE WHEN seq % 2 = 0 THEN CAST(v AS VARCHAR) ELSE CAST(v + 1 AS VARCHAR) END AS growth FROM e", FLOW_SQL)
def fee_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of a counter that wraps on every second event."""
    rows = event_flow(spark, sf_dir).select("seq", F.col("v").cast("string").alias("now"), F.when(F.col("seq") % 2 == 0, "0").otherwise(str(2**256 - 1)).alias("then"))
    return rows.select("seq", cost.fee_growth("now", "then").alias("growth"))


@register(
    """WITH s AS (SELECT seq AS swap, v % 50 AS tick, v AS volume FROM e), p AS (SELECT c_custkey AS owner, c_custkey % 40 AS lower, c_custkey % 40 + 5 AS upper, c_custkey + 1 AS liquidity FROM customer),
    f AS (SELECT tick, sum(CAST(ceil(volume * 3000 / 1000000.0) AS BIGINT)) AS fee FROM s GROUP BY tick), i AS (SELECT f.tick, fee, owner, liquidity, sum(liquidity) OVER (PARTITION BY f.tick) AS depth FROM f JOIN p ON lower <= f.tick AND f.tick < upper)
    SELECT owner, CAST(round(1000 * sum(CAST(fee AS DOUBLE) * CAST(liquidity AS DOUBLE) / CAST(depth AS DOUBLE))) AS BIGINT) AS fee FROM i GROUP BY owner""",
    FLOW_SQL,
)
def fee_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fees of swaps shared by the positions in range."""
    swaps = event_flow(spark, sf_dir).select(F.col("seq").alias("swap"), (F.col("v") % 50).alias("tick"), F.col("v").alias("volume"))
    key = F.col("c_custkey")
    positions = table(spark, sf_dir, "customer").select(key.alias("owner"), (key % 40).alias("lower"), (key % 40 + 5).alias("upper"), (key + 1).alias("liquidity"))
    return _whole(cost.fee_shares(swaps, positions, 3000), "fee")


@register(
    """WITH r AS (SELECT dst AS addr, ts, seq, CASE WHEN seq % 3 = 0 THEN -(v % 100) ELSE v % 100 END AS amount, v % 11 AS price FROM e), h AS (SELECT *, sum(amount) OVER (PARTITION BY addr ORDER BY ts, seq) AS held FROM r),
    w AS (SELECT *, CASE WHEN coalesce(lag(held) OVER (PARTITION BY addr ORDER BY ts, seq), 0) <= 0 THEN 1 ELSE 0 END AS fresh FROM h), g AS (SELECT *, sum(fresh) OVER (PARTITION BY addr ORDER BY ts, seq) AS segment FROM w)
    SELECT addr, CAST(segment AS BIGINT) AS segment, CAST(sum(amount) AS BIGINT) AS holding, CAST(sum(amount * price) AS BIGINT) AS net_paid FROM g GROUP BY addr, segment""",
    FLOW_SQL,
)
def net_buy_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net payments of accounts in each stretch between full exits."""
    v = F.col("v")
    rows = event_flow(spark, sf_dir).select(F.col("dst").alias("addr"), "ts", "seq", F.when(F.col("seq") % 3 == 0, -(v % 100)).otherwise(v % 100).alias("amount"), (v % 11).alias("price"))
    return longs(cost.net_buy_cost(rows).drop("cost"), "holding", "net_paid")


@register("WITH i AS (SELECT dst AS addr, sum(CASE WHEN seq % 4 = 0 THEN v ELSE 0 END) AS t FROM e GROUP BY dst), a AS (SELECT dst AS addr FROM e UNION SELECT frm FROM e) SELECT addr, CAST(coalesce(t, 0) AS BIGINT) AS injected, true AS closes FROM a LEFT JOIN i USING (addr)", FLOW_SQL)
def taint_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taint that came into each account, and that what left and what stayed add up to it."""
    legs = F.array(F.struct(F.col("dst").alias("addr"), F.col("v").alias("amount"), F.when(F.col("seq") % 4 == 0, F.col("v")).otherwise(0).alias("taint")), F.struct(F.col("frm").alias("addr"), (-F.col("v")).alias("amount"), F.lit(0).cast("long").alias("taint")))
    found = cost.tainted(event_flow(spark, sf_dir).select("ts", "seq", F.inline(legs)))
    closes = F.abs(F.col("injected") - F.col("passed") - F.col("retained")) <= 1e-6 * F.greatest(F.col("injected"), F.lit(1.0))
    return found.select("addr", F.round("injected").cast("long").alias("injected"), closes.alias("closes"))


@register("SELECT addr, CAST(round(1000 * (CAST(bal AS DOUBLE) * 0.5 / 1e8)) AS BIGINT) AS ratio, CAST(round(1000 * (1e8 * CAST(bal AS DOUBLE) / (2e8 + CAST(bal AS DOUBLE)))) AS BIGINT) AS proceeds FROM bal WHERE bal > 0", TRADE_SQL)
def exit_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdings against a pool of 2 * 10^8 tokens and 10^8 quotes."""
    held = ledger.balances(trade_ledger(spark, sf_dir)).filter("balance > 0")
    return _whole(held.select("addr", *[c.alias(n) for n, c in cost.exit_depth(F.col("balance"), F.lit(0.5), F.lit(2e8), F.lit(1e8)).items()]), "ratio", "proceeds")


@register(
    """WITH p AS (SELECT frm, dst, sum(v) AS v FROM t WHERE v > 0 GROUP BY ALL), g AS (SELECT dst AS addr, sum(v) AS got FROM p WHERE frm NOT IN (SELECT addr FROM cex) AND frm NOT IN ('ZERO', 'DEAD') GROUP BY dst),
    s AS (SELECT frm AS addr, sum(v) AS sold FROM p WHERE dst IN (SELECT addr FROM camp WHERE camp = 'ASIA') GROUP BY frm)
    SELECT addr, CAST(got AS BIGINT) AS got, CAST(sold AS BIGINT) AS sold FROM (SELECT dst AS addr, sum(v) AS got FROM p WHERE frm NOT IN (SELECT addr FROM camp WHERE camp = 'ASIA') AND frm NOT IN ('ZERO', 'DEAD') GROUP BY dst) JOIN s USING (addr) WHERE sold * 100 >= got * 20""",
    TRADE_SQL,
)
def funnel_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that pass on a fifth of what they got to one camp, which stands for markets."""
    markets = camps(spark, sf_dir).filter("camp = 'ASIA'")
    return longs(methods.funnels(graph.edges(trade_ledger(spark, sf_dir)), markets, 20), "got", "sold")


@register(
    """WITH b AS (SELECT *, CASE WHEN ts - lag(ts) OVER (ORDER BY ts, seq) < 900 THEN 0 ELSE 1 END AS fresh FROM e), g AS (SELECT *, CAST(sum(fresh) OVER (ORDER BY ts, seq) AS BIGINT) AS batch FROM b)
    SELECT batch, count(DISTINCT frm) AS members, min(v) AS lowest, max(v) AS highest, min(ts) AS first, max(ts) AS last FROM g GROUP BY batch HAVING count(DISTINCT frm) >= 3 AND min(v) * 100 >= max(v) * 2""",
    FLOW_SQL,
)
def interval_amount_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of events under fifteen minutes apart, by three accounts at least and of amounts within a factor of fifty."""
    rows = event_flow(spark, sf_dir).withColumnRenamed("frm", "addr")
    return methods.interval_groups(rows, 900, 2, 3)


@register(
    "SELECT frm, count(*) FILTER (rank = 1) AS firsts, count(*) AS batches FROM bo GROUP BY frm HAVING count(*) FILTER (rank = 1) >= 1",
    FLOW_SQL,
    "ba AS (SELECT ts // 86400 AS day, frm, min(ts) AS ts, arg_min(seq, (ts, seq)) AS seq FROM e GROUP BY ALL), bo AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY ts, seq, frm) AS rank FROM ba)",
)
def first_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senders that were the first of a day, and the days on which they acted."""
    days = sequence.first_actions(event_flow(spark, sf_dir).withColumn("day", F.floor(F.col("ts") / 86400)), ["day"], "frm")
    return methods.first_movers(days, "day", "frm", 1)


@register(
    """WITH n AS (SELECT day, count(*) AS n FROM bo GROUP BY day), m AS (SELECT frm, count(*) FILTER (rank = 1) AS k, count(*) AS batches, sum(1.0 / n) AS m FROM bo JOIN n USING (day) GROUP BY frm HAVING count(*) FILTER (rank = 1) >= 1)
    SELECT frm, k AS firsts, batches, CAST(round(1000 * CAST(m AS DOUBLE)) AS BIGINT) AS expected, CAST(round(1000 * CASE WHEN k > m THEN exp(k - m - k * ln(k / m)) ELSE 1 END) AS BIGINT) AS chance, CASE WHEN CASE WHEN k > m THEN exp(k - m - k * ln(k / m)) ELSE 1 END <= 0.3 THEN 'fixed' ELSE 'random' END AS "order" FROM m""",
    FLOW_SQL,
    "ba AS (SELECT ts // 86400 AS day, frm, min(ts) AS ts, arg_min(seq, (ts, seq)) AS seq FROM e GROUP BY ALL), bo AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY ts, seq, frm) AS rank FROM ba)",
)
def first_mover_chance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senders that were the first of a day, against a random order; three in ten is a limit that the tables reach."""
    days = sequence.first_actions(event_flow(spark, sf_dir).withColumn("day", F.floor(F.col("ts") / 86400)), ["day"], "frm")
    return _whole(methods.first_mover_chance(days, "day", "frm", 1, 0.3), "expected", "chance")


@register(
    """WITH b AS (SELECT *, CASE WHEN ts - lag(ts) OVER (ORDER BY ts, seq) < 900 THEN 0 ELSE 1 END AS fresh FROM e), g AS (SELECT *, CAST(sum(fresh) OVER (ORDER BY ts, seq) AS BIGINT) AS batch FROM b),
    k AS (SELECT batch FROM g GROUP BY batch HAVING count(DISTINCT frm) >= 2 AND min(v) * 100 >= max(v)), m AS (SELECT DISTINCT batch, frm FROM g WHERE batch IN (SELECT batch FROM k))
    SELECT x.batch AS a, y.batch AS b, count(*) AS common FROM m x JOIN m y ON x.frm = y.frm AND x.batch < y.batch GROUP BY ALL HAVING count(*) >= 2""",
    FLOW_SQL,
)
def repeated_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of events under a quarter of an hour apart, of amounts within a factor of a hundred, that share two accounts at least."""
    return methods.repeated_groups(event_flow(spark, sf_dir).withColumnRenamed("frm", "addr"), 900, 1, 2)


TOKEN_SQL = """
ho AS (SELECT frm AS member, v % 60 AS item, min(ts) AS ts FROM e GROUP BY ALL),
tp AS (SELECT x.member AS a, y.member AS b, count(*) AS common FROM ho x JOIN ho y ON x.item = y.item AND x.member < y.member GROUP BY ALL),
sz AS (SELECT member, count(*) AS n FROM ho GROUP BY member),
pr AS (SELECT a, b, common, p.n + q.n - common AS either FROM tp JOIN sz p ON p.member = a JOIN sz q ON q.member = b WHERE common >= 3 AND common * 100 >= (p.n + q.n - common) * 40)
"""


def _holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senders as members and amounts modulo 60 as the tokens that they touch."""
    return event_flow(spark, sf_dir).groupBy(F.col("frm").alias("member"), (F.col("v") % 60).alias("item")).agg(F.min("ts").alias("ts"))


@register("SELECT a, b, common, either FROM pr", FLOW_SQL, TOKEN_SQL)
def token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return methods.token_pairs(_holdings(spark, sf_dir), 3, 40)


@register("SELECT a AS addr, min(b) AS root FROM tr GROUP BY a", "RECURSIVE " + FLOW_SQL.strip(), TOKEN_SQL, "tb AS (SELECT a, b FROM pr UNION SELECT b, a FROM pr), tr(a, b) AS (SELECT a, a FROM tb UNION SELECT tr.a, tb.b FROM tr JOIN tb ON tr.b = tb.a)")
def token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senders joined through all pairs with alike tokens."""
    return methods.token_groups(methods.token_pairs(_holdings(spark, sf_dir), 3, 40))


TICKS_SQL = "tk AS (SELECT seq, v % 5000 AS tick FROM e), ps AS (SELECT c_custkey AS owner, c_custkey * 37 % 5000 AS lower, c_custkey * 37 % 5000 + CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 9 WHEN 2 THEN 170 ELSE 3000 END AS upper FROM customer)"


@register("SELECT owner, count(*) AS swaps, CAST(sum(tick) AS BIGINT) AS ticks FROM tk JOIN ps ON tick BETWEEN lower AND upper GROUP BY owner", FLOW_SQL, TICKS_SQL)
def swaps_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Swaps within the price range of each position; ranges of one tick up to most of the scale."""
    swaps = event_flow(spark, sf_dir).select("seq", (F.col("v") % 5000).alias("tick"))
    key = F.col("c_custkey").cast("long")
    lower = key * 37 % 5000
    width = F.when(key % 4 == 0, 0).when(key % 4 == 1, 9).when(key % 4 == 2, 170).otherwise(3000)
    positions = table(spark, sf_dir, "customer").select(key.alias("owner"), lower.alias("lower"), (lower + width).alias("upper"))
    found = cost.range_totals(swaps, "tick", positions, "owner", "lower", "upper")
    return longs(found.select("owner", F.col("n").alias("swaps"), F.col("total").alias("ticks")), "ticks")


@register("SELECT pr.a, pr.b, count(*) AS timed FROM pr JOIN ho x ON x.member = pr.a JOIN ho y ON y.member = pr.b AND y.item = x.item WHERE abs(x.ts - y.ts) <= 172800 GROUP BY pr.a, pr.b", FLOW_SQL, TOKEN_SQL)
def token_pairs_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of these, the tokens that both first touched within two days."""
    held = _holdings(spark, sf_dir)
    return methods.co_timed_pairs(methods.token_pairs(held, 3, 40), held, 172_800)


@register(
    """WITH b AS (SELECT ts // 3600 AS bar, arg_max(v, (ts, seq)) AS price, count(*) AS interest FROM e GROUP BY ALL), k AS (SELECT *, lag(price) OVER (ORDER BY bar) AS p, lag(interest) OVER (ORDER BY bar) AS i FROM b)
    SELECT bar, CASE WHEN price > p AND interest > i THEN 'crowding' WHEN price > p THEN 'short_covering' WHEN interest > i THEN 'short_building' ELSE 'unwinding' END AS state FROM k WHERE p IS NOT NULL""",
    FLOW_SQL,
)
def interest_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly prices against the number of events as open interest."""
    bars = event_flow(spark, sf_dir).groupBy(F.floor(F.col("ts") / 3600).alias("bar")).agg(F.max_by("v", F.struct("ts", "seq")).alias("price"), F.count("*").alias("interest"))
    return methods.open_interest(bars)


@register(
    """WITH q AS (SELECT dst AS item, ts // 86400 AS day, sum(v) AS volume FROM e GROUP BY ALL), w AS (SELECT *, coalesce(max(volume) OVER (PARTITION BY item ORDER BY day RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING), 0) AS most, min(day) OVER (PARTITION BY item) AS first FROM q)
    SELECT item, day, CAST(volume AS BIGINT) AS volume FROM w WHERE volume >= 8000 AND most < 4000 AND day - first >= 5""",
    FLOW_SQL,
)
def revivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipients with a large day after five small ones."""
    days = event_flow(spark, sf_dir).groupBy(F.col("dst").alias("item"), F.floor(F.col("ts") / 86400).alias("day")).agg(F.sum("v").alias("volume"))
    return longs(methods.revivals(days, 5, 4000, 8000), "volume")


@register(
    """WITH b AS (SELECT ts // 300 * 300 AS bar, count(*) AS n FROM e GROUP BY ALL), w AS (SELECT *, coalesce(max(n) OVER (ORDER BY bar RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING), 0) AS before FROM b) SELECT * FROM w WHERE before > 0 AND n >= before * 2""",
    FLOW_SQL,
)
def swap_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(methods.bursts(event_flow(spark, sf_dir), 300, 2), "bar", "before")


@register(
    """WITH w AS (SELECT ts // 86400 AS day, v % 7 AS lower, v % 7 + 1 + v % 3 AS upper, CASE WHEN v % 4 = 0 THEN 0 ELSE v END AS a, CASE WHEN v % 4 = 1 THEN 0 ELSE v * 2 END AS b, v % 13 AS price FROM e), c AS (SELECT ts // 86400 AS day, arg_max(v, (ts, seq)) AS close FROM e GROUP BY ALL)
    SELECT day, count(*) FILTER (upper - lower = 1) AS narrow, count(*) FILTER ((a = 0) <> (b = 0)) AS one_sided, CAST(round(1000 * (sum(CAST(a + b AS DOUBLE) * price) / sum(CAST(a + b AS DOUBLE)))) AS BIGINT) AS wall, any_value(close) AS close FROM w JOIN c USING (day) GROUP BY day""",
    FLOW_SQL,
)
def price_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow and one-sided ranges of each day and their mean price beside the close."""
    rows, v = event_flow(spark, sf_dir).withColumn("day", F.floor(F.col("ts") / 86400)), F.col("v")
    walls = rows.select("day", (v % 7).alias("lower"), (v % 7 + 1 + v % 3).alias("upper"), F.when(v % 4 == 0, 0).otherwise(v).alias("amount0"), F.when(v % 4 == 1, 0).otherwise(v * 2).alias("amount1"), (v % 13).alias("price"))
    closes = rows.groupBy("day").agg(F.max_by("v", F.struct("ts", "seq")).alias("close"))
    return _whole(methods.price_walls(walls, closes), "wall")


@register(
    """WITH h AS (SELECT ts // 3600 AS day, arg_max(v, (ts, seq)) AS close, sum(v) AS volume FROM e GROUP BY ALL),
    s AS (SELECT day, close * sum(CASE WHEN volume % 3 = 0 THEN volume ELSE 0 END) OVER (ORDER BY day) AS cap, sum(volume) OVER (ORDER BY day RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS turnover FROM h),
    c AS (SELECT s.day, s.cap - b.cap AS cap_change, s.turnover FROM s JOIN s b ON b.day = s.day - 5)
    SELECT day, CAST(cap_change AS BIGINT) AS cap_change, CAST(turnover AS BIGINT) AS turnover, CASE WHEN turnover > 0 THEN CAST(floor(CAST(abs(cap_change) AS DOUBLE) * 1000 / CAST(turnover AS DOUBLE)) AS BIGINT) END AS leverage FROM c""",
    FLOW_SQL,
)
def pull_leverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of the market cap over five hours against what was traded for it; amounts stand for prices, and every third hour's flow is minted."""
    rows = event_flow(spark, sf_dir)
    hours = rows.groupBy(F.floor(F.col("ts") / 3600).alias("day")).agg(F.max_by("v", F.struct("ts", "seq")).alias("close"), F.sum("v").alias("volume"))
    minted = by_ranges(hours.withColumn("minted", F.when(F.col("volume") % 3 == 0, F.col("volume")).otherwise(0)), "day")
    supplied = running(minted, ["day"], F.col("minted"), "supply")
    return longs(methods.pull_leverage(supplied.select("day", "close", "supply", "volume"), 5), "cap_change", "turnover")


@register(
    """WITH l AS (SELECT block, tx, dst AS addr, v AS x FROM t UNION ALL SELECT block, tx, frm, -v FROM t), nx AS (SELECT camp, block, tx, sum(x) AS x FROM l JOIN camp USING (addr) GROUP BY ALL),
    h AS (SELECT camp, block, tx, sum(x) OVER (PARTITION BY camp ORDER BY block, tx) AS held FROM nx) SELECT camp, CAST(max(held) AS BIGINT) AS peak, arg_max(tx, (held, -block, -tx)) AS peak_tx FROM h GROUP BY camp""",
    TRADE_SQL,
)
def tx_netted_group_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(methods.netted_peak(trade_ledger(spark, sf_dir), camps(spark, sf_dir), "camp"), "peak")


@register(
    """WITH sd AS (SELECT block AS day, sum(CASE WHEN frm = 'ZERO' THEN v ELSE 0 END) - sum(CASE WHEN dst IN ('ZERO', 'DEAD') THEN v ELSE 0 END) AS x FROM t GROUP BY block), sn AS (SELECT day, sum(x) OVER (ORDER BY day) AS net FROM sd),
    h AS (SELECT block AS day, sum(x) AS x FROM d WHERE addr IN (SELECT addr FROM cex) GROUP BY block), p AS (SELECT block AS day, sum(x) AS x FROM d WHERE addr LIKE 'S%' AND addr NOT IN (SELECT addr FROM cex) GROUP BY block),
    j AS (SELECT day, net, sum(coalesce(h.x, 0)) OVER (ORDER BY day) AS held, sum(coalesce(p.x, 0)) OVER (ORDER BY day) AS pool FROM sn LEFT JOIN h USING (day) LEFT JOIN p USING (day))
    SELECT day, CAST(held AS BIGINT) AS held, CAST(round(1000 * (CAST(held AS DOUBLE) / CAST(net AS DOUBLE))) AS BIGINT) AS of_total, CASE WHEN (CAST(net AS DOUBLE) - CAST(pool AS DOUBLE)) * 100 >= CAST(net AS DOUBLE) * 30 THEN CAST(round(1000 * (CAST(held AS DOUBLE) / (CAST(net AS DOUBLE) - CAST(pool AS DOUBLE)))) AS BIGINT) END AS of_float FROM j""",
    TRADE_SQL,
)
def float_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchanges' holdings over the supply and over what other suppliers, as a pool, don't hold."""
    rows = trade_ledger(spark, sf_dir)
    daily = ledger.daily_deltas(rows, F.col("block"))
    hot = exchanges(spark, sf_dir)
    series = lambda accounts: ledger.group_series(daily, accounts.select("addr", F.lit(1).alias("g")), "g")
    pool = ledger.balances(rows).filter("addr like 'S%'").join(hot, "addr", "left_anti")
    found = methods.float_share(series(hot), ledger.supply_daily(rows, F.col("block")), series(pool), 30)
    return longs(_whole(found, "of_total", "of_float"), "held")


@register(
    """WITH f AS (SELECT dst AS addr, min(ts) // 259200 AS win, max(ts) - min(ts) >= 1728000 AS keeps FROM e GROUP BY dst) SELECT win AS "window", count(*) AS members, count(*) FILTER (keeps) AS kept FROM f GROUP BY win""",
    FLOW_SQL,
)
def retention_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipients by the three days of their first receipt, and those still active twenty days later."""
    first = event_flow(spark, sf_dir).groupBy("dst").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    rows = first.select(F.floor(F.col("a") / 259200).alias("window"), (F.col("b") - F.col("a") >= 1_728_000).alias("long_holder"))
    return methods.retention_test(rows).select("window", "members", "kept")


@register()
def retention_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the chance of so many long-holders by a draw; binomials of this size have no SQL form."""
    first = event_flow(spark, sf_dir).groupBy("dst").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return methods.retention_test(first.select(F.floor(F.col("a") / 259200).alias("window"), (F.col("b") - F.col("a") >= 1_728_000).alias("long_holder")))


@register(
    """WITH c AS (SELECT frm AS entity, CASE v % 3 WHEN 0 THEN 'wallet' WHEN 1 THEN 'pool' ELSE 'stake' END AS kind, v % 500 AS rt, v AS amount FROM e), k AS (SELECT rt, arg_min((entity, kind, amount), (-amount, entity, kind)) AS x FROM c GROUP BY rt)
    SELECT x[1] AS entity, x[2] AS kind, CAST(sum(x[3]) AS BIGINT) AS amount FROM k GROUP BY ALL""",
    FLOW_SQL,
)
def economic_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of wallets, pools and stakes, each right counted once."""
    v = F.col("v")
    kind = F.when(v % 3 == 0, "wallet").when(v % 3 == 1, "pool").otherwise("stake")
    return longs(methods.economic_control(event_flow(spark, sf_dir).select(F.col("frm").alias("entity"), kind.alias("kind"), (v % 500).alias("right"), v.alias("amount"))), "amount")


@register(
    """WITH p AS (SELECT frm, dst, sum(v) AS v FROM e WHERE v > 0 GROUP BY ALL) SELECT x.frm AS a, x.dst AS b, CAST(x.v + y.v AS BIGINT) AS gross, CAST(x.v - y.v AS BIGINT) AS net FROM p x JOIN p y ON x.frm = y.dst AND x.dst = y.frm AND x.frm < x.dst""",
    FLOW_SQL,
)
def wash_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(methods.wash_pairs(graph.edges(event_flow(spark, sf_dir))), "gross", "net")
