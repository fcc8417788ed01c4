"""Queries on row rules, ordered choices and classified moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import curve25519, graph, ledger, market, selection, sequence
from ledgerspark.plans.registry import longs, register
from ledgerspark.sources.adapters import FLOW_SQL, TRADE_SQL, camps, event_flow, exchanges, table, trade_ledger


@register("SELECT seq, ts, frm, dst, v FROM e WHERE v * 1000 * 200 >= (SELECT sum(v) FROM e) * 3 * 10", FLOW_SQL)
def pct_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers of at least 0.015% of all flow, by a whole threshold."""
    rows = event_flow(spark, sf_dir)
    least = rows.agg(selection.pct_to_raw(F.sum("v"), 15, 1000).alias("least"))
    return rows.join(F.broadcast(least), F.col("v") >= F.col("least")).select("seq", "ts", "frm", "dst", "v")


@register(
    """WITH x AS (SELECT seq, CASE WHEN seq % 5 = 0 THEN '0' || v WHEN seq % 5 = 1 THEN v || '.0' WHEN seq % 5 = 2 THEN ' ' || v WHEN seq % 5 = 3 THEN '-' || v ELSE CAST(v AS VARCHAR) END AS raw, v FROM e)
    SELECT seq, raw, CASE WHEN regexp_full_match(raw, '0|[1-9][0-9]{0,37}') THEN v END AS value FROM x""",
    FLOW_SQL,
)
def raw_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts written in five ways, of which the strict parser takes one."""
    kind, text = F.col("seq") % 5, F.col("v").cast("string")
    raw = F.when(kind == 0, F.concat(F.lit("0"), text)).when(kind == 1, F.concat(text, F.lit(".0"))).when(kind == 2, F.concat(F.lit(" "), text)).when(kind == 3, F.concat(F.lit("-"), text)).otherwise(text)
    return longs(event_flow(spark, sf_dir).select("seq", raw.alias("raw"), selection.raw_integer(raw).alias("value")), "value")


@register("SELECT seq, CAST(CAST(v AS DECIMAL(38,18)) / 1000000 AS DOUBLE) AS units FROM e", FLOW_SQL)
def scaled_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_flow(spark, sf_dir).select("seq", selection.units(F.col("v"), 6).cast("double").alias("units"))


@register("SELECT a.camp AS frm_camp, b.camp AS dst_camp, count(*) AS n, CAST(sum(v) AS BIGINT) AS v FROM t LEFT JOIN camp a ON frm = a.addr LEFT JOIN camp b ON dst = b.addr WHERE a.camp IS NULL OR b.camp IS NULL OR a.camp <> b.camp GROUP BY ALL", TRADE_SQL)
def cross_entity_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow between camps; flow inside one cancels."""
    own = camps(spark, sf_dir)
    rows = selection.across_entities(trade_ledger(spark, sf_dir), own, "camp")
    rows = rows.join(own.select(F.col("addr").alias("frm"), F.col("camp").alias("frm_camp")), "frm", "left").join(own.select(F.col("addr").alias("dst"), F.col("camp").alias("dst_camp")), "dst", "left")
    return longs(rows.groupBy("frm_camp", "dst_camp").agg(F.count("*").alias("n"), F.sum("v").alias("v")), "v")


@register("SELECT tx, li, frm, dst, v FROM t WHERE frm IN (SELECT addr FROM cex) OR dst IN (SELECT addr FROM cex)", TRADE_SQL)
def touching_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.touching(trade_ledger(spark, sf_dir), exchanges(spark, sf_dir)).select("tx", "li", "frm", "dst", "v")


@register("SELECT dst, CAST(sum(v) AS BIGINT) AS v, count(*) AS n FROM t WHERE frm = 'S1' AND block BETWEEN 500 AND 1500 GROUP BY dst ORDER BY sum(v) DESC, dst LIMIT 10", TRADE_SQL)
def top_outflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest recipients of one account in a window."""
    return longs(selection.top_recipients(trade_ledger(spark, sf_dir).filter("block between 500 and 1500"), "S1", 10), "v")


@register(
    """WITH p AS (SELECT frm, dst, sum(v) AS v FROM t GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY frm ORDER BY v DESC, dst) AS r FROM p)
    SELECT frm, count(*) AS recipients, CAST(sum(v) AS BIGINT) AS top_v FROM k WHERE r <= 20 GROUP BY frm""",
    TRADE_SQL,
)
def recipients_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(selection.recipients_summary(trade_ledger(spark, sf_dir), 20), "top_v")


@register("SELECT block, tx, li, frm, dst, v FROM t WHERE tx >= 0 ORDER BY v DESC, block, tx, li LIMIT 1", TRADE_SQL)
def largest_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.largest(trade_ledger(spark, sf_dir).filter("tx >= 0").select("block", "tx", "li", "frm", "dst", "v"), "v", "block", "tx", "li")


@register(
    """WITH x AS (SELECT seq, ts, frm, dst, v, (SELECT CAST(floor((min(ts) + max(ts)) / 2) AS BIGINT) FROM e) AS m FROM e)
    SELECT * FROM (SELECT 'before' AS side, ts, seq, frm, dst, v FROM x WHERE ts < m ORDER BY ts DESC, seq DESC LIMIT 1) UNION ALL SELECT * FROM (SELECT 'after', ts, seq, frm, dst, v FROM x WHERE ts >= m ORDER BY ts, seq LIMIT 1)""",
    FLOW_SQL,
)
def boundary_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events on either side of the middle of the time covered."""
    rows = event_flow(spark, sf_dir).select("seq", "ts", "frm", "dst", "v")
    middle = rows.agg(F.floor((F.min("ts") + F.max("ts")) / 2).alias("m"))
    return selection.neighbours(rows.join(F.broadcast(middle)), "ts", F.col("m"), "seq").select("side", "ts", "seq", "frm", "dst", "v")


@register("WITH k AS (SELECT seq, ts, row_number() OVER (ORDER BY seq) AS r, count(*) OVER () AS n FROM e) SELECT seq, ts FROM k WHERE r IN (SELECT CAST(round_even(i * (n - 1) / 10.0, 0) AS BIGINT) + 1 FROM range(0, 11) q(i), (SELECT count(*) AS n FROM e))", FLOW_SQL)
def even_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.evenly_spaced(event_flow(spark, sf_dir).select("seq", "ts"), "seq", 11)


@register(
    """WITH l AS (SELECT block, dst AS addr, 'to' AS side FROM t UNION ALL SELECT block, frm, 'from' FROM t), s AS (SELECT block, addr, max(side) AS side FROM l GROUP BY ALL HAVING count(*) = 1)
    SELECT addr, block, side FROM s WHERE addr NOT IN ('ZERO', 'DEAD') ORDER BY block DESC, side DESC, addr LIMIT 30""",
    TRADE_SQL,
)
def clean_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty accounts with a single event in a late block."""
    return selection.clean_samples(trade_ledger(spark, sf_dir), 30)


@register(
    """WITH x AS (SELECT seq // 10 AS tx, frm AS owner, -v AS x FROM e UNION ALL SELECT seq // 10, dst, v FROM e)
    SELECT tx, owner, CAST(sum(x) AS BIGINT) AS delta FROM x GROUP BY ALL HAVING sum(x) <> 0""",
    FLOW_SQL,
)
def owner_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net changes of owners in transactions of ten events, from balances before and after."""
    rows = event_flow(spark, sf_dir).select(F.floor(F.col("seq") / 10).alias("tx"), F.col("frm").alias("pre_owner"), F.col("v").alias("pre"), F.col("dst").alias("post_owner"), F.col("v").alias("post"))
    return longs(selection.owner_deltas(rows), "delta")


@register("SELECT seq, v FROM e WHERE (seq // 10) % 7 NOT IN (0, 1)", FLOW_SQL)
def succeeded_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose transaction has one status without error; every seventh failed, every seventh has two."""
    rows = event_flow(spark, sf_dir).select("seq", "v", F.floor(F.col("seq") / 10).alias("tx"))
    txs = rows.select("tx").distinct()
    status = txs.select("tx", F.when(F.col("tx") % 7 == 0, "failed").alias("err")).unionByName(txs.filter("tx % 7 = 1").select("tx", F.lit(None).cast("string").alias("err")))
    return selection.succeeded(rows, status, "tx").select("seq", "v")


@register(
    """WITH o AS (SELECT CASE WHEN frm = 'C7' THEN dst ELSE frm END AS peer, frm = 'C7' AS sends, v FROM t WHERE (frm = 'C7' OR dst = 'C7') AND frm <> dst)
    SELECT CASE WHEN peer IN (SELECT addr FROM cex) THEN CASE WHEN sends THEN 'sold' ELSE 'bought' END WHEN peer IN ('ZERO', 'DEAD') THEN CASE WHEN sends THEN 'burnt' ELSE 'minted' END
      ELSE CASE WHEN sends THEN 'sent' ELSE 'received' END END AS kind, count(*) AS n, CAST(sum(v) AS BIGINT) AS v FROM o GROUP BY ALL""",
    TRADE_SQL,
)
def window_move_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(selection.window_moves(trade_ledger(spark, sf_dir), "C7", exchanges(spark, sf_dir)), "v")


@register("SELECT frm, dst, CAST(sum(v) AS BIGINT) AS v, count(*) AS n FROM t WHERE frm NOT IN ('ZERO', 'DEAD') AND dst NOT IN ('ZERO', 'DEAD') AND frm NOT IN (SELECT addr FROM cex) AND dst NOT IN (SELECT addr FROM cex) GROUP BY ALL", TRADE_SQL)
def direct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(selection.direct_pairs(trade_ledger(spark, sf_dir), exchanges(spark, sf_dir)), "v")


@register("SELECT dst AS addr, min(ts) AS first FROM e GROUP BY dst HAVING min(ts) <= (SELECT min(ts) FROM e) + 7200", FLOW_SQL)
def sniper_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that first received within two hours of the first event."""
    rows = event_flow(spark, sf_dir)
    return selection.snipers(rows, rows.agg(F.min("ts").alias("at")), 7200)


@register(
    """WITH a AS (SELECT ts // 3600 AS b, arg_max(v, (ts, seq)) AS a FROM e WHERE seq % 2 = 0 GROUP BY ALL), z AS (SELECT ts // 3600 AS b, arg_max(v, (ts, seq)) AS z FROM e WHERE seq % 2 = 1 GROUP BY ALL),
    g AS (SELECT b, CAST(floor(abs(a - z) * 1000000 / abs(z)) AS BIGINT) AS gap FROM a JOIN z USING (b) WHERE z <> 0), k AS (SELECT gap, row_number() OVER (ORDER BY gap, b) AS r, count(*) OVER () AS n FROM g)
    SELECT max(n) AS n, max(gap) FILTER (r = n // 2 + 1) AS median, max(gap) FILTER (r = n * 9 // 10 + 1) AS p90 FROM k""",
    FLOW_SQL,
)
def price_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and ninth decile of the differences of two hourly series, at exact places."""
    ticks = event_flow(spark, sf_dir).withColumnRenamed("v", "price")
    return selection.price_gap(market.bars(ticks.filter("seq % 2 = 0"), 3600), market.bars(ticks.filter("seq % 2 = 1"), 3600))


@register("SELECT camp, 'camp-' || substr(sha256(string_agg(addr, ',' ORDER BY addr)), 1, 12) AS id, count(*) AS members FROM camp GROUP BY camp", TRADE_SQL)
def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable names of the camps from their members."""
    return camps(spark, sf_dir).groupBy("camp").agg(selection.content_id("camp", F.collect_list("addr")).alias("id"), F.count("*").alias("members"))


@register(
    """WITH c AS (SELECT p_partkey AS addr, md5(p_name) AS h, p_brand AS s, CAST(p_retailprice AS BIGINT) AS n FROM part), k AS (SELECT 'K' || addr AS name, h AS kh, s AS ks, n AS kn FROM c WHERE addr % 50 = 0),
    m AS (SELECT addr, 'exact' AS how, name FROM c JOIN k ON h = kh UNION ALL SELECT addr, 'similar', name FROM c JOIN k ON s = ks AND abs(n - kn) * 50 <= greatest(kn, 3200))
    SELECT addr, arg_min(name, (how, name)) AS name, min(how) AS how FROM m GROUP BY addr""",
)
def code_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as contract codes, every fiftieth of which is known."""
    codes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("addr"), F.md5("p_name").alias("hash"), F.col("p_brand").alias("selectors"), F.col("p_retailprice").cast("decimal(18,2)").cast("decimal(18,0)").cast("long").alias("size"))
    codes = codes.withColumn("size", F.round(codes["size"]).cast("long"))
    return selection.code_matches(codes, codes.filter("addr % 50 = 0").select(F.concat(F.lit("K"), "addr").alias("name"), "hash", "selectors", "size"))


@register(
    """WITH x AS (SELECT seq // 5 AS tx, min(seq) OVER (PARTITION BY seq // 5) AS seq, dst AS addr, v AS delta FROM e UNION ALL SELECT seq // 5, min(seq) OVER (PARTITION BY seq // 5), frm, -v FROM e),
    n AS (SELECT tx, min(seq) AS seq, addr, sum(delta) AS delta FROM x GROUP BY tx, addr), f AS (SELECT addr, arg_min(tx, (seq, tx)) AS tx FROM n WHERE delta > 0 GROUP BY addr),
    p AS (SELECT tx, arg_min(addr, (delta, addr)) AS funder FROM n WHERE delta < 0 GROUP BY tx)
    SELECT addr, funder FROM f JOIN p USING (tx) WHERE addr <> funder""",
    FLOW_SQL,
)
def first_funder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funders by the most negative change in the first transaction that credits an account."""
    rows = event_flow(spark, sf_dir).select(F.floor(F.col("seq") / 5).alias("tx"), "seq", "frm", "dst", "v")
    first = rows.groupBy("tx").agg(F.min("seq").alias("seq"))
    legs = rows.select("tx", F.inline(F.array(F.struct(F.col("dst").alias("addr"), F.col("v").alias("delta")), F.struct(F.col("frm").alias("addr"), (-F.col("v")).alias("delta")))))
    return selection.first_funder(legs.groupBy("tx", "addr").agg(F.sum("delta").alias("delta")).join(first, "tx"))


@register(
    """WITH x AS (SELECT addr, block, sum(x) AS x FROM d GROUP BY ALL), c AS (SELECT addr, block, sum(x) OVER (PARTITION BY addr ORDER BY block) AS h FROM x)
    SELECT addr, CAST(max(h) AS BIGINT) AS peak, CAST(arg_max(h, block) AS BIGINT) AS final FROM c WHERE addr NOT IN ('ZERO', 'DEAD') GROUP BY addr HAVING max(h) * 10000 >= (SELECT net FROM supply) * 20""",
    TRADE_SQL,
)
def running_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that ever held 0.2% of the supply."""
    rows = trade_ledger(spark, sf_dir)
    return longs(selection.running_share(ledger.daily_deltas(rows, F.col("block")), ledger.supply(rows), 20), "peak", "final")


@register("SELECT block, tx, li, row_number() OVER (ORDER BY block NULLS FIRST, tx, li) AS place FROM t", TRADE_SQL)
def chain_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.canonical_order(trade_ledger(spark, sf_dir).select("block", "tx", "li"), "block", "tx", "li")


@register(
    """WITH l AS (SELECT ts // 3600 AS hour, dst AS addr, CASE WHEN dst = 'U7' THEN 0 ELSE v END AS x, CASE WHEN frm = 'U7' THEN -v ELSE 0 END AS s FROM e UNION ALL SELECT ts // 3600, frm, CASE WHEN frm = 'U7' THEN 0 ELSE -v END, CASE WHEN dst = 'U7' THEN v ELSE 0 END FROM e),
    m AS (SELECT addr, hour, sum(x) AS x, sum(s) AS s FROM l WHERE addr <> 'U7' GROUP BY ALL),
    h AS (SELECT addr, hour, greatest(sum(x) OVER w, 0) AS held, greatest(sum(s) OVER w, 0) AS staked FROM m WINDOW w AS (PARTITION BY addr ORDER BY hour)),
    p AS (SELECT addr, hour, held - coalesce(lag(held) OVER w, 0) AS dh, staked - coalesce(lag(staked) OVER w, 0) AS ds FROM h WINDOW w AS (PARTITION BY addr ORDER BY hour)),
    g AS (SELECT CAST(substr(addr, 2) AS BIGINT) % 4 AS camp, hour, sum(dh) AS dh, sum(ds) AS ds FROM p GROUP BY ALL)
    SELECT hour, camp, CAST(sum(dh) OVER w AS BIGINT) AS held, CAST(sum(ds) OVER w AS BIGINT) AS staked FROM g WINDOW w AS (PARTITION BY camp ORDER BY hour)""",
    FLOW_SQL,
)
def hourly_camps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly holdings of four groups; one account takes stakes."""
    rows = event_flow(spark, sf_dir)
    names = rows.select(F.explode(F.array("frm", "dst")).alias("addr")).distinct()
    groups = names.withColumn("camp", F.substring("addr", 2, 20).cast("long") % 4)
    return longs(selection.hourly_groups(rows, groups, "camp", F.floor(F.col("ts") / 3600), "U7"), "held", "staked")


@register(
    """WITH p AS (SELECT x.day AS a, y.day AS b, x.frm, row_number() OVER (PARTITION BY x.day, y.day ORDER BY x.rank) AS pa, row_number() OVER (PARTITION BY x.day, y.day ORDER BY y.rank) AS pb,
      count(*) OVER (PARTITION BY x.day, y.day) AS common FROM bo x JOIN bo y ON x.frm = y.frm AND x.day < y.day),
    m AS (SELECT a, b, any_value(common) AS common, greatest(count(*) FILTER (pa = pb), count(*) FILTER (pb = common + 1 - pa)) AS matched FROM p WHERE common >= 4 GROUP BY a, b)
    SELECT a, b, common, matched, CAST(round(1000000 / (SELECT CAST(factorial(CAST(least(matched, 20) AS INTEGER)) AS DOUBLE))) AS BIGINT) AS p_millionths FROM m WHERE matched >= 2""",
    FLOW_SQL,
    "ba AS (SELECT ts // 86400 AS day, frm, min(ts) AS ts, arg_min(seq, (ts, seq)) AS seq FROM e GROUP BY ALL), bo AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY ts, seq, frm) AS rank FROM ba)",
)
def cadence_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch pairs with at least two places alike and the bound of their chance."""
    days = sequence.first_actions(event_flow(spark, sf_dir).withColumn("day", F.floor(F.col("ts") / 86400)), ["day"], "frm")
    found = sequence.order_matches(days, "day", "frm").withColumn("matched", F.greatest("forward", "reverse")).filter("matched >= 2")
    return found.select("a", "b", "common", "matched", F.round(1_000_000 * sequence.p_random(F.col("common"), F.col("matched"))).cast("long").alias("p_millionths"))


@register(
    """WITH w AS (SELECT frm AS addr, ts // 604800 AS week, count(*) AS n, sum(v) AS out FROM e GROUP BY ALL), i AS (SELECT dst AS addr, sum(v) AS inflow, count(*) AS n_in FROM e GROUP BY dst), o AS (SELECT frm AS addr, sum(v) AS outflow, count(*) AS n_out FROM e GROUP BY frm)
    SELECT addr, CAST(inflow AS BIGINT) AS inflow, CAST(coalesce(outflow, 0) AS BIGINT) AS outflow, n_in, coalesce(n_out, 0) AS n_out,
      CASE WHEN (inflow - coalesce(outflow, 0)) * 100 >= inflow * 50 THEN 'holder' WHEN coalesce(outflow, 0) >= inflow OR n_in + coalesce(n_out, 0) >= 5000 THEN 'bot' ELSE 'exited' END AS kind FROM i LEFT JOIN o USING (addr)""",
    FLOW_SQL,
)
def candidate_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention, turnover and kind of each account."""
    return longs(graph.candidate_kinds(event_flow(spark, sf_dir)), "inflow", "outflow")


@register()
def owner_on_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' names as keys of 32 digits in base 58: about half of those of 32 bytes are points of the curve."""
    digits = F.translate(F.concat(F.md5("p_name"), F.substring(F.md5("p_type"), 1, 12)), "0abcdef", "zABCDEF")
    return table(spark, sf_dir, "part").select("p_partkey", curve25519.on_curve(digits).alias("on_curve"))
