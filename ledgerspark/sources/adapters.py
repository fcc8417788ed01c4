"""Ledgers derived from the standard tables, in the canonical columns.

Canonical transfers: ``block`` long, ``tx`` long or string, ``li`` long, ``frm``, ``dst``
string, ``v`` amount (long or decimal(38,0); the operators keep its type). ``ZERO`` mints
and burns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ZERO, DEAD = "ZERO", "DEAD"
SINKS = (ZERO, DEAD)
#: Amount minted to every customer at the start.
GRANT = 50_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def account(prefix: str, key) -> F.Column:
    return F.concat(F.lit(prefix), F.col(key) if isinstance(key, str) else key)


def trade_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as transfers: amount ``v`` in cents, ``q`` in pieces, block = day number from 1995-01-01.

    N lines go from supplier to customer, A lines are burnt, R lines go from customer to
    customer; block 0 mints what suppliers will send and a grant to every customer.
    """
    customers = table(spark, sf_dir, "customer")
    lines = table(spark, sf_dir, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    lines = lines.withColumn("li", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)).cast("long") - 1)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    flag = F.col("l_returnflag")
    buyer = account("C", "o_custkey")
    other = account("C", (F.col("o_custkey") * 7 + F.col("l_partkey")) % F.col("nc"))
    # The number of customers is one row.
    trades = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(F.broadcast(customers.agg(F.count("*").alias("nc")))).select(
        (F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01")) + 1).cast("long").alias("block"),
        F.col("l_orderkey").alias("tx"),
        "li",
        F.when(flag.isin("N", "A"), account("S", "l_suppkey")).otherwise(buyer).alias("frm"),
        F.when(flag == "N", buyer).when(flag == "A", ZERO).otherwise(other).alias("dst"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"),
        F.col("l_quantity").cast("long").alias("q"),
    )
    sent = trades.filter(F.col("frm").startswith("S")).groupBy("frm").agg(F.sum("v").alias("v"))
    start = F.lit(0).cast("long")
    supplied = sent.select(start.alias("block"), F.lit(-1).cast("long").alias("tx"), F.substring("frm", 2, 20).cast("long").alias("li"), F.lit(ZERO).alias("frm"), F.col("frm").alias("dst"), "v", start.alias("q"))
    granted = customers.select(start.alias("block"), F.lit(-2).cast("long").alias("tx"), F.col("c_custkey").alias("li"), F.lit(ZERO).alias("frm"), account("C", "c_custkey").alias("dst"), F.lit(GRANT).cast("long").alias("v"), start.alias("q"))
    return trades.unionByName(supplied).unionByName(granted)


def event_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transfers between users: ``ts`` in seconds, ``v`` in cents, ``seq`` as the exact order."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("ts"),
        account("U", "user_id").alias("frm"),
        F.concat(F.lit("U"), F.regexp_extract("props", "([0-9]+)", 1)).alias("dst"),
        F.round(F.col("value") * 100).cast("long").alias("v"),
        F.col("event_type").alias("kind"),
    )


def camps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(addr, camp): every account belongs to the region of its customer or supplier; camps exclude each other."""
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    place = nation.select("n_nationkey", F.col("r_name").alias("camp"))
    members = table(spark, sf_dir, "customer").select(account("C", "c_custkey").alias("addr"), F.col("c_nationkey").alias("n_nationkey"))
    members = members.unionByName(table(spark, sf_dir, "supplier").select(account("S", "s_suppkey").alias("addr"), F.col("s_nationkey").alias("n_nationkey")))
    return members.join(place, "n_nationkey").select("addr", "camp")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(addr, entity): segments and nations of customers; entities may overlap."""
    customer = table(spark, sf_dir, "customer")
    pair = F.explode(F.array(F.concat(F.lit("seg:"), "c_mktsegment"), F.concat(F.lit("nation:"), F.col("c_nationkey")))).alias("entity")
    return customer.select(account("C", "c_custkey").alias("addr"), pair)


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(addr): suppliers of every fifth nation stand for exchange accounts."""
    return table(spark, sf_dir, "supplier").filter("s_nationkey % 5 = 0").select(account("S", "s_suppkey").alias("addr"))


#: The same derivations for the oracle, as common table expressions.
TRADE_SQL = f"""
n AS (SELECT count(*) AS nc FROM customer),
l0 AS (SELECT l.*, o.o_custkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS li
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
m AS (SELECT date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 1 AS block, l_orderkey AS tx, li,
    CASE WHEN l_returnflag IN ('N', 'A') THEN 'S' || l_suppkey ELSE 'C' || o_custkey END AS frm,
    CASE l_returnflag WHEN 'N' THEN 'C' || o_custkey WHEN 'A' THEN 'ZERO' ELSE 'C' || ((o_custkey * 7 + l_partkey) % nc) END AS dst,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS v, CAST(l_quantity AS BIGINT) AS q
  FROM l0, n),
t AS (SELECT * FROM m
  UNION ALL SELECT 0, -1, CAST(substr(frm, 2) AS BIGINT), 'ZERO', frm, CAST(sum(v) AS BIGINT), 0 FROM m WHERE frm LIKE 'S%' GROUP BY frm
  UNION ALL SELECT 0, -2, c_custkey, 'ZERO', 'C' || c_custkey, {GRANT}, 0 FROM customer),
d AS (SELECT dst AS addr, block, tx, li, v AS x FROM t UNION ALL SELECT frm, block, tx, li, -v FROM t WHERE frm <> 'ZERO'),
bal AS (SELECT addr, CAST(sum(x) AS BIGINT) AS bal FROM d GROUP BY addr),
camp AS (SELECT addr, r_name AS camp FROM (SELECT 'C' || c_custkey AS addr, c_nationkey AS nk FROM customer UNION ALL SELECT 'S' || s_suppkey, s_nationkey FROM supplier)
  JOIN nation ON n_nationkey = nk JOIN region ON r_regionkey = n_regionkey),
entity AS (SELECT 'C' || c_custkey AS addr, unnest(['seg:' || c_mktsegment, 'nation:' || c_nationkey]) AS entity FROM customer),
cex AS (SELECT 'S' || s_suppkey AS addr FROM supplier WHERE s_nationkey % 5 = 0),
supply AS (SELECT CAST(sum(CASE WHEN frm = 'ZERO' THEN v ELSE 0 END) AS BIGINT) AS minted,
  CAST(sum(CASE WHEN frm = 'ZERO' THEN v ELSE 0 END) - sum(CASE WHEN dst IN ('ZERO', 'DEAD') THEN v ELSE 0 END) AS BIGINT) AS net FROM t)
"""
FLOW_SQL = """
e AS (SELECT event_id AS seq, epoch_us(ts) // 1000000 AS ts, 'U' || user_id AS frm, 'U' || regexp_extract(props, '([0-9]+)', 1) AS dst,
  CAST(round(value * 100) AS BIGINT) AS v, event_type AS kind FROM events)
"""
