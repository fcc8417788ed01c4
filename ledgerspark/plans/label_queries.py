"""Queries on label tables, with labels made from customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import labels
from ledgerspark.plans.registry import register
from ledgerspark.sources.adapters import table

#: Every value of the fixed tables, and labels that only suffixes and parts tell.
RAW = [*labels.EXCHANGES, *labels.RISKS, *labels.BRIDGES, *labels.MEV, *labels.INFRA, "burn", *labels.TOKEN, *labels.PROTOCOLS, *labels.IDENTITIES, *[x or "null" for x in labels.DROPPED], *labels.DEFINITIVE, *labels.CANDIDATE, *labels.PRIVACY]
RAW += [f"some{s}" for s in labels.PROTOCOL_SUFFIXES] + "some-exchange my-bridge-two filament-exploit other-hack night-owl".split()
CATEGORY = "cex bridge locker burn whale serial-actor scam-candidate mev".split()
TIER = "exclude identity risk".split()
SOURCE = "dune manual-book tokens curation jup".split()
FLAGS = ["", "mixer", "tornado-user|mixer", "scam-candidate", "odd-flag", "mixer|gambling", "ponzi", "", "risk-candidate", "bybit-exploit", "other-hack", *labels.DEFINITIVE]
NAME = ["Alpha", "", "Token Vesting", "Paymaster One", "unconfirmed desk", "Beta"]
CHAIN = ["eth", "bsc", "sol"]


def _pick(values: list[str], key: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (key % len(values)).cast("int"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows for most addresses."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _pick(CHAIN, k).alias("chain"),
        F.concat(F.lit("a"), k % 90).alias("address"),
        k.alias("arrival"),
        _pick(NAME, F.floor(k / 3)).alias("name"),
        _pick(CATEGORY, F.floor(k / 5)).alias("category"),
        _pick(TIER, F.floor(k / 2)).alias("tier"),
        _pick(SOURCE, F.floor(k / 7)).alias("source"),
        _pick(FLAGS, F.floor(k / 4)).alias("risk_flags"),
        F.when(k % 4 == 0, "seen").otherwise("").alias("evidence"),
        F.when(k % 13 == 0, "no_merge").when(k % 17 == 0, "never").otherwise("").alias("merge_policy"),
        F.when(k % 19 == 0, "bucket").otherwise("").alias("balance_policy"),
        F.when(k % 11 == 0, "historical").otherwise("").alias("status"),
        F.when(k % 6 == 0, "bad").otherwise(F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (k % 200).cast("int")), "yyyy-MM-dd")).alias("verified_at"),
        F.lit("").alias("source_snapshot_at"),
        F.when(k % 9 == 0, "2026-06-30").otherwise("").alias("added_date"),
    )


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _at(values: list[str], key: str) -> str:
    return f"{_list(values)}[({key}) % {len(values)} + 1]"


LABEL_SQL = f"""
lb AS (SELECT {_at(CHAIN, "c_custkey")} AS chain, 'a' || (c_custkey % 90) AS address, c_custkey AS arrival, {_at(NAME, "c_custkey // 3")} AS name, {_at(CATEGORY, "c_custkey // 5")} AS category, {_at(TIER, "c_custkey // 2")} AS tier,
  {_at(SOURCE, "c_custkey // 7")} AS source, {_at(FLAGS, "c_custkey // 4")} AS risk_flags, CASE WHEN c_custkey % 4 = 0 THEN 'seen' ELSE '' END AS evidence, CASE WHEN c_custkey % 13 = 0 THEN 'no_merge' WHEN c_custkey % 17 = 0 THEN 'never' ELSE '' END AS merge_policy,
  CASE WHEN c_custkey % 19 = 0 THEN 'bucket' ELSE '' END AS balance_policy, CASE WHEN c_custkey % 11 = 0 THEN 'historical' ELSE '' END AS status,
  CASE WHEN c_custkey % 6 = 0 THEN 'bad' ELSE CAST(DATE '2026-01-01' + CAST(c_custkey % 200 AS INTEGER) AS VARCHAR) END AS verified_at, CASE WHEN c_custkey % 9 = 0 THEN '2026-06-30' ELSE '' END AS added_date FROM customer),
l1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chain, address ORDER BY arrival DESC) AS rk FROM lb) WHERE rk = 1),
po AS (SELECT *, CASE WHEN merge_policy IN ('allow', 'no_merge') THEN merge_policy WHEN tier = 'exclude' OR category IN {tuple(labels.NO_MERGE)} THEN 'no_merge' ELSE 'allow' END AS "merge",
  CASE WHEN balance_policy IN ('count', 'bucket', 'exclude') THEN balance_policy WHEN tier = 'exclude' THEN 'exclude' WHEN category IN {tuple(labels.BUCKET)} THEN 'bucket' ELSE 'count' END AS balance, category = 'serial-actor' AS serial,
  date_diff('day', greatest(TRY_CAST(verified_at AS DATE), TRY_CAST(added_date AS DATE)), DATE '2026-11-28') AS stale_days FROM l1),
fl AS (SELECT chain, address, unnest(string_split(risk_flags, '|')) AS flag FROM l1 WHERE risk_flags <> ''),
fk AS (SELECT *, CASE WHEN flag = 'tornado-user' THEN 'privacy' WHEN flag IN ('scam-candidate', 'risk-candidate') THEN 'candidate' WHEN flag IN {tuple(labels.DEFINITIVE)} OR flag LIKE '%-exploit' THEN 'definitive' ELSE 'unknown' END AS kind FROM fl)
"""


def _today() -> Column:
    return F.lit("2026-11-28").cast("date")


def _last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each address."""
    return labels.layered(_labels(spark, sf_dir)).drop("arrival")


_IN = lambda values: "(" + ", ".join(f"'{v}'" for v in values) + ")"


@register(
    f"""WITH r AS (SELECT c_custkey, {_at(RAW, "c_custkey")} AS raw FROM customer), k AS (SELECT raw, count(*) AS n, CASE WHEN raw IN {_IN(labels.EXCHANGES)} THEN 'cex' WHEN raw IN {_IN(labels.RISKS)} OR regexp_matches(raw, '-(exploit|hack)$') THEN 'risk'
      WHEN raw IN {_IN(labels.BRIDGES)} THEN 'bridge' WHEN raw IN {_IN(labels.MEV)} THEN 'mev' WHEN raw IN {_IN(labels.INFRA)} THEN 'infra' WHEN raw = 'burn' THEN 'burn' WHEN raw IN {_IN(labels.TOKEN)} THEN 'token-contract' WHEN raw IN {_IN(labels.PROTOCOLS)} THEN 'protocol'
      WHEN raw IN {_IN(labels.IDENTITIES)} THEN 'own' WHEN raw LIKE '%exchange%' THEN 'cex' WHEN raw LIKE '%bridge%' THEN 'bridge' WHEN regexp_matches(raw, '({"|".join(labels.PROTOCOL_SUFFIXES)})$') THEN 'protocol' ELSE 'own' END AS c FROM r WHERE raw NOT IN {_IN(labels.DROPPED)} GROUP BY raw)
    SELECT raw, n, CASE WHEN c IN ('own', 'risk') THEN raw ELSE c END AS category, CASE c WHEN 'own' THEN 'identity' WHEN 'risk' THEN 'risk' ELSE 'exclude' END AS tier FROM k"""
)
def label_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select(_pick(RAW, F.col("c_custkey")).alias("raw"))
    return raw.withColumn("c", labels.label_class(F.col("raw"))).filter("c is not null").groupBy("raw", "c.category", "c.tier").agg(F.count("*").alias("n"))


@register(
    """SELECT chain, address, count(DISTINCT (source, name, category, tier, evidence, merge_policy, balance_policy, status, risk_flags)) AS n, CASE WHEN bool_or(tier <> 'risk') THEN true ELSE false END AS functional, list_aggregate(list_sort(list_distinct(list(source))), 'string_agg', '+') AS sources FROM lb GROUP BY ALL""",
    LABEL_SQL,
)
def label_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged addresses: whether a function stands in the end, and all sources (the fold itself is tested row by row)."""
    rows = _labels(spark, sf_dir)
    found = labels.upserted(rows).select("chain", "address", (F.col("tier") != "risk").alias("functional"), F.array_join(F.array_sort(F.split("source", "\\+")), "+").alias("sources"))
    sizes = rows.groupBy("chain", "address").agg(F.countDistinct("source", "name", "category", "tier", "evidence", "merge_policy", "balance_policy", "status", "risk_flags").alias("n"))
    return found.join(sizes, ["chain", "address"])


@register(
    """WITH f AS (SELECT chain, address, string_agg(DISTINCT flag, '|' ORDER BY flag) AS flags, string_agg(DISTINCT flag, '|' ORDER BY flag) FILTER (flag <> 'tornado-user') AS mild FROM fl GROUP BY ALL), q AS (SELECT l1.*, coalesce(flags, '') AS flags, coalesce(mild, '') AS mild FROM l1 LEFT JOIN f USING (chain, address)),
    a AS (SELECT *, CASE WHEN category = 'burn' THEN '' WHEN tier = 'exclude' THEN mild ELSE flags END AS out, category NOT IN ('scam-candidate') AND name = 'Token Vesting' AS lk FROM q),
    b AS (SELECT *, CASE WHEN lk THEN 'locker' ELSE category END AS c2, CASE WHEN lk THEN 'identity' ELSE tier END AS t2 FROM a), c AS (SELECT *, c2 NOT IN ('scam-candidate', 'serial-actor') AND name = 'Paymaster One' AS aa FROM b),
    g AS (SELECT chain, address, out AS risk_flags, CASE WHEN aa THEN 'infra' ELSE c2 END AS category, CASE WHEN aa THEN 'exclude' ELSE t2 END AS tier FROM c)
    SELECT chain, address, risk_flags, category, CASE WHEN category IN ('cex', 'bridge') AND tier = 'identity' THEN 'exclude' ELSE tier END AS tier FROM g""",
    LABEL_SQL,
)
def label_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.normalised(_last(spark, sf_dir)).select("chain", "address", "risk_flags", "category", "tier")


@register(
    f"""WITH w AS (SELECT DISTINCT c.chain, address FROM lb, (SELECT unnest({_list(CHAIN)}) AS chain) c), x AS (SELECT w.chain, w.address, coalesce(a.address IS NULL, true) AS cross_chain, coalesce(a.arrival, b.arrival) AS arrival FROM w LEFT JOIN po a ON a.chain = w.chain AND a.address = w.address
      LEFT JOIN po b ON b.chain = 'eth' AND b.address = w.address AND w.chain NOT IN ('sol', 'eth'))
    SELECT x.chain, x.address, cross_chain, po."merge", balance, serial, stale_days, coalesce(stale_days > 90, false) AND category IN {tuple(labels.TIME_SENSITIVE)} AS stale_hint, status = 'historical' AS inactive FROM x JOIN po USING (arrival)""",
    LABEL_SQL,
)
def label_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every address on every chain against the labels of its own chain and of the first."""
    rows = _last(spark, sf_dir)
    wanted = rows.select("address").distinct().withColumn("chain", F.explode(F.array(*map(F.lit, CHAIN))))
    found = labels.resolved(wanted, rows, _today())
    return found.select("chain", "address", "cross_chain", "merge", "balance", "serial", F.col("stale_days").cast("long").alias("stale_days"), "stale_hint", "inactive")


@register("SELECT chain, kind, count(*) AS n, count(DISTINCT address) AS addresses FROM fk GROUP BY ALL", LABEL_SQL)
def risk_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = _last(spark, sf_dir).select("chain", "address", F.explode(labels.flags(F.col("risk_flags"))).alias("flag"))
    return each.groupBy("chain", labels.risk_kind(F.col("flag")).alias("kind")).agg(F.count("*").alias("n"), F.countDistinct("address").alias("addresses"))


@register(
    """WITH k AS (SELECT DISTINCT chain, address, CASE kind WHEN 'definitive' THEN 'risk' ELSE kind END AS section FROM fk), s AS (SELECT chain, address, section FROM k UNION SELECT chain, address, 'serial' FROM l1 WHERE category = 'serial-actor' UNION SELECT chain, address, 'exclude' FROM l1 WHERE tier = 'exclude'
      UNION SELECT chain, address, 'identity' FROM l1 WHERE tier = 'identity' AND category NOT IN ('tornado-user', 'scam-candidate', 'serial-actor'))
    SELECT * FROM s UNION SELECT chain, address, 'risk' FROM l1 WHERE tier = 'risk' AND (chain, address) NOT IN (SELECT (chain, address) FROM s)""",
    LABEL_SQL,
)
def label_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.sections(_last(spark, sf_dir))


@register(
    """SELECT chain, address, 'flags_not_canonical' AS problem FROM lb WHERE risk_flags IN ('tornado-user|mixer', 'mixer|gambling') UNION SELECT chain, address, 'burn_with_flags' FROM lb WHERE category = 'burn' AND risk_flags <> ''
    UNION SELECT chain, address, 'facility_with_behaviour' FROM lb WHERE tier = 'exclude' AND risk_flags LIKE '%tornado-user%' UNION SELECT chain, address, 'risk_without_flags' FROM lb WHERE tier = 'risk' AND risk_flags = ''
    UNION SELECT chain, address, 'risk_without_evidence' FROM lb WHERE tier = 'risk' AND evidence = '' UNION SELECT chain, address, 'unknown_flag' FROM lb WHERE risk_flags IN ('odd-flag', 'other-hack') UNION SELECT chain, address, 'unknown_merge_policy' FROM lb WHERE merge_policy = 'never'
    UNION SELECT chain, address, 'serial_without_evidence' FROM lb WHERE category = 'serial-actor' AND evidence = '' UNION SELECT chain, address, 'facility_as_identity' FROM lb WHERE category IN ('cex', 'bridge') AND tier = 'identity'
    UNION SELECT chain, address, 'unconfirmed_excluded' FROM lb WHERE name LIKE 'unconfirmed%' AND tier = 'exclude' UNION SELECT chain, address, 'address_twice' FROM lb GROUP BY ALL HAVING count(*) > 1""",
    LABEL_SQL,
)
def label_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.problems(_labels(spark, sf_dir))


@register(
    """WITH o AS (SELECT * FROM l1 WHERE arrival % 5 <> 0), w AS (SELECT chain, address, name || 'x' AS name, 'whale' AS category, 'identity' AS tier, CASE WHEN arrival % 2 = 0 THEN 'manual-new' ELSE 'jup' END AS source FROM l1 WHERE arrival % 3 <> 0)
    SELECT coalesce(o.chain, w.chain) AS chain, coalesce(o.address, w.address) AS address, CASE WHEN o.address IS NULL THEN w.name WHEN w.address IS NULL THEN o.name WHEN w.source LIKE 'manual%' OR o.name = '' THEN w.name ELSE o.name END AS name,
      CASE WHEN o.address IS NULL THEN w.category WHEN w.source LIKE 'manual%' THEN w.category ELSE o.category END AS category,
      CASE WHEN o.address IS NULL THEN w.source WHEN w.address IS NULL OR contains(o.source, w.source) THEN o.source ELSE o.source || '+' || w.source END AS source FROM o FULL JOIN w ON o.chain = w.chain AND o.address = w.address""",
    LABEL_SQL,
)
def label_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with newer rows merged in, half of them from a trusted source."""
    rows = labels.layered(_labels(spark, sf_dir))
    new = rows.filter("arrival % 3 <> 0").withColumns({"name": F.concat("name", F.lit("x")), "category": F.lit("whale"), "tier": F.lit("identity"), "source": F.when(F.col("arrival") % 2 == 0, "manual-new").otherwise("jup"), "risk_flags": F.lit(""), "evidence": F.lit("")})
    return labels.added(rows.filter("arrival % 5 <> 0"), new).select("chain", "address", "name", "category", "source")


@register(
    """SELECT chain, address, 'missing' AS problem FROM l1 WHERE arrival % 10 = 0 UNION ALL SELECT chain, address, 'changed_tier' FROM l1 WHERE arrival % 10 = 3 AND tier <> 'risk' UNION ALL SELECT chain, address, 'earlier_verified_at' FROM l1 WHERE arrival % 10 = 7 AND verified_at <> 'bad' AND verified_at > '2026-01-01'""",
    LABEL_SQL,
)
def label_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rebuilt table that lacks rows, has other tiers and older dates."""
    rows = labels.layered(_labels(spark, sf_dir))
    n = F.col("arrival") % 10
    new = rows.filter(n != 0).withColumns({"tier": F.when(n == 3, "risk").otherwise(F.col("tier")), "verified_at": F.when((n == 7) & (F.col("verified_at") != "bad"), "2026-01-01").otherwise(F.col("verified_at"))})
    return labels.round_trip(rows, new)


@register(
    f"""WITH c AS (SELECT DISTINCT x.chain, address FROM lb, (SELECT unnest({_list(CHAIN)}) AS chain) x WHERE CAST(substr(address, 2) AS BIGINT) % 4 = 1), g AS (SELECT chain, address FROM l1 WHERE arrival % 7 = 0),
    r AS (SELECT c.chain, c.address, a.address IS NULL AS far, coalesce(a.arrival, b.arrival) AS arrival FROM c LEFT JOIN po a ON a.chain = c.chain AND a.address = c.address LEFT JOIN po b ON b.chain = 'eth' AND b.address = c.address AND c.chain = 'bsc'),
    s AS (SELECT r.chain, r.address, CASE WHEN (r.chain, r.address) IN (SELECT (chain, address) FROM g) THEN 'goldset-infra' WHEN category = 'serial-actor' THEN NULL WHEN NOT far AND category IN {tuple(labels.INFRA_CATEGORIES)} THEN 'primary' WHEN NOT far AND (tier = 'exclude' OR po."merge" = 'no_merge') THEN 'secondary'
      WHEN far AND category IN {tuple(labels.INFRA_CATEGORIES)} THEN 'cross_chain' END AS severity FROM r LEFT JOIN po USING (arrival)) SELECT * FROM s WHERE severity IS NOT NULL""",
    LABEL_SQL,
)
def label_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labels.layered(_labels(spark, sf_dir))
    some = rows.select("address").distinct().filter(F.substring("address", 2, 9).cast("long") % 4 == 1).withColumn("chain", F.explode(F.array(*map(F.lit, CHAIN))))
    return labels.conflicts(some, rows.drop("arrival"), rows.filter("arrival % 7 = 0"), _today())


@register(
    """WITH o AS (SELECT chain, address, source AS cs, min(name) AS e FROM lb GROUP BY ALL) SELECT chain, address, count(*) AS cases, string_agg(cs || ':' || e, '; ' ORDER BY cs, e) AS evidence, count(*) > 1 AS multi_case FROM o GROUP BY ALL""",
    LABEL_SQL,
)
def offender_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actors over all sources as cases."""
    return labels.accumulated(_labels(spark, sf_dir).select("chain", "address", F.col("source").alias("case"), F.col("name").alias("evidence")))


@register(
    """WITH x AS (SELECT chain, address, CASE WHEN tier = 'exclude' THEN 'infrastructure' ELSE 'entity' END AS expected FROM lb), g AS (SELECT chain, address, min(expected) AS expected FROM x GROUP BY ALL HAVING min(expected) = max(expected)),
    s AS (SELECT ['eth', 'bsc', 'sol'][c_custkey % 3 + 1] AS chain, 'a' || (c_custkey % 97) AS address FROM customer), r AS (SELECT chain, address FROM s WHERE (chain, address) NOT IN (SELECT (chain, address) FROM g) GROUP BY ALL HAVING count(*) BETWEEN 1 AND 5),
    k AS (SELECT *, row_number() OVER (PARTITION BY chain ORDER BY sha256(address), address) AS n FROM r) SELECT chain, address FROM k WHERE n <= 10""",
    LABEL_SQL,
)
def goldset_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rarely seen addresses of each chain that the gold set doesn't name."""
    gold = labels.gold_set(_labels(spark, sf_dir).select("chain", "address", F.when(F.col("tier") == "exclude", "infrastructure").otherwise("entity").alias("expected")))
    k = F.col("c_custkey")
    seen = table(spark, sf_dir, "customer").select(_pick(CHAIN, k).alias("chain"), F.concat(F.lit("a"), k % 97).alias("address"))
    return labels.negative_sample(seen, gold, 10)


@register(
    """WITH g AS (SELECT chain, address, CASE WHEN min(tier) = 'exclude' AND max(tier) = 'exclude' THEN 'infrastructure' ELSE 'entity' END AS expected FROM lb GROUP BY ALL HAVING count(*) FILTER (tier = 'exclude') IN (0, count(*)))
    SELECT chain, count(*) FILTER (expected = 'entity') AS entities, count(*) FILTER (expected = 'entity' AND balance = 'exclude' AND status <> 'historical') AS wrong_excludes, count(*) FILTER (expected = 'infrastructure') AS infra,
      count(*) FILTER (expected = 'infrastructure' AND po."merge" = 'no_merge') AS infra_hits, count(*) FILTER (expected = 'entity') < 20 AS weak FROM g JOIN po USING (chain, address) GROUP BY chain""",
    LABEL_SQL,
)
def label_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labels(spark, sf_dir)
    gold = labels.gold_set(rows.select("chain", "address", F.when(F.col("tier") == "exclude", "infrastructure").otherwise("entity").alias("expected")))
    return labels.benchmark(gold, labels.resolved(gold, labels.layered(rows).drop("arrival"), _today()))


@register("SELECT DISTINCT address, chain AS context FROM lb WHERE (address, chain) NOT IN (SELECT (address, chain) FROM lb WHERE arrival % 2 = 0)", LABEL_SQL)
def label_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labels(spark, sf_dir).select("address", F.col("chain").alias("context"), "arrival")
    return labels.misses(rows.filter("arrival % 2 = 0"), rows)
