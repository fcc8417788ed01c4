"""Label tables: classes of raw labels, merging of sources, resolution, policies, risks and invariants.

Label rows: address, chain, name, category, tier, source, added_date, evidence, risk_flags, merge_policy, balance_policy,
source_snapshot_at, verified_at, status. Texts may be null or empty, which means the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.ranges import ranked

# Vocabularies of the label tables.
EXCHANGES = """bitget deribit bilaxy coinbase kraken bybit binance okex okx mexc gate-io gate kucoin htx huobi bitfinex crypto-com gemini bitstamp upbit
bithumb poloniex bittrex hotbit exchange bitmex phemex bingx lbank xt-com whitebit latoken probit coinex ascendex bitmart pionex weex coinw hashkey
backpack nexo celsius-network voyager blockfi genesis-trading wazirx bitrue tokenize coindcx bitso luno paribu btcturk bitpanda swissborg
coincheck bitflyer liquid zaif korbit coinone gopax indodax bitkub maicoin max-exchange bitopro hoo aex zb bkex digifinex cointiger bigone fatbtc""".split()
RISKS = "blocked ofac-sanctions-lists ofac-sanctioned tornado-cash heist gambling phish-hack exploit exploiter scam mixer ponzi plustoken lazarus-group sanctioned".split()
BRIDGES = """bridge multichain wormhole layer-2 arbitrum optimism zksync starknet scroll linea celer synapse hop-protocol across stargate layerzero axelar orbiter
polygon avalanche-bridge ronin harmony anyswap portal debridge base-bridge rainbow-bridge gravity-bridge omni allbridge symbiosis router-protocol squid""".split()
MEV = "mev-bot mev-builder sandwich-bot arbitrage-bot flashbots".split()
INFRA = "erc-4337-bundler pimlico paymaster multicall authereum safe-formerly-gnosis-safe account-abstraction gsn relayer gas-station biconomy disperse multisender".split()
TOKEN = "token-contract bridged-token stablecoin wrapped-token".split()
PROTOCOLS = """sushiswap balancer bancor pancakeswap burgerswap bscswap kyberswap 1inch 0x-protocol dydx morpho euler liquity olympusdao tokemak set-protocol mstable
aave compound lido maker sky synthetix yearn pendle chainlink the-graph curve-finance curve-fi uniswap dex defi vaults staking proxy-contract
old-contract deprecated v1 v2 v3 website-down eigenlayer symbiotic mellow zapper-fi juicebox ondo-finance paraswap cow-protocol metamask rainbow xstocks
real-world-assets yield-farming lending derivatives options insurance oracle ens nft-marketplace opensea blur looksrare x2y2 seaport wyvern""".split()
IDENTITIES = """genesis-address ico-wallets token-sale mining airdrop-hunter sybil-delegate buidlguidl-builders protocol-guild-member endaoment nonprofit charity donate
gitcoin-grants fund maker-vault-owner balancer-vested-shareholders multisig-owner avs-operator contract-deployer proposer-fee-recipient eth2-depositor whale
market-maker otc vc dao-treasury team-wallet advisor influencer""".split()
PROTOCOL_SUFFIXES = "-finance -protocol -swap -dao -fi -network -exchange-contract -vault -pool -router -capital -labs -money -markets -lending".split()
DROPPED = ["take-action", "friend-tech-users", "null", ""]
DEFINITIVE = "ofac-sdn ofac-sanctions-lists ofac-sanctioned sanctioned heist exploit exploiter phish-hack scam blocked gambling mixer ponzi lazarus-group plustoken tornado-cash serial-offender".split()
CANDIDATE = ["scam-candidate", "risk-candidate"]
PRIVACY = ["tornado-user"]
NO_MERGE = ["locker", "airdrop-distributor", "token-sale", "charity", "launchpad", "suspected-cex"]
BUCKET = ["locker", "airdrop-distributor", "launchpad"]
TIME_SENSITIVE = ["cex", "suspected-cex", "infra", "bridge", "bundler", "paymaster", "mev"]
MUST_EXCLUDE = ["cex", "bridge", "router", "mixer", "bot-service"]
INFRA_CATEGORIES = ["cex", "suspected-cex", "infra", "bridge", "dex", "bundler", "paymaster", "mev", "locker"]
INACTIVE = ["deprecated", "rotated", "historical", "stale"]
PROTECTED = ["token-contract", "kol", "smart-money", "tornado-user", "scam-candidate"]
PRIORITY = {"curation": -1, "manual": 0, "addressbook": 0, "serial": 0, "registry": 1, "spellbook": 1, "solprog": 1, "dune": 1, "jup": 2, "dawsbot": 2, "brianleect": 3, "tokens": 4, "gmgn": 5, "kolscan": 5}
SERIAL = "serial-actor"
STALE_DAYS = 90


def _text(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit("")))


def label_class(raw: Column, known: dict[str, tuple[str, str]] | None = None) -> Column:
    """(category, tier) of a raw label; null if it is to be dropped. ``known``: further labels, which come first."""
    label = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    pair = lambda category, tier: F.struct((category if isinstance(category, Column) else F.lit(category)).alias("category"), F.lit(tier).alias("tier"))
    out = F.when(label.isin(DROPPED), None)
    for name, (category, tier) in (known or {}).items():
        out = out.when(label == name, pair(category, tier))
    out = out.when(label.isin(EXCHANGES), pair("cex", "exclude"))
    out = out.when(label.isin(RISKS) | label.endswith("-exploit") | label.endswith("-hack"), pair(label, "risk"))
    for labels, category in ((BRIDGES, "bridge"), (MEV, "mev"), (INFRA, "infra"), (["burn"], "burn"), (TOKEN, "token-contract"), (PROTOCOLS, "protocol")):
        out = out.when(label.isin(labels), pair(category, "exclude"))
    out = out.when(label.isin(IDENTITIES), pair(label, "identity"))
    out = out.when(label.contains("exchange"), pair("cex", "exclude")).when(label.contains("bridge"), pair("bridge", "exclude"))
    suffix = reduce(lambda a, b: a | b, [label.endswith(s) for s in PROTOCOL_SUFFIXES])
    return out.when(suffix, pair("protocol", "exclude")).otherwise(pair(label, "identity"))


def flags(raw: Column) -> Column:
    """The set of flags of a ``|``-joined text, sorted."""
    parts = F.transform(F.split(F.coalesce(raw, F.lit("")), "\\|"), lambda x: F.trim(x))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda x: x != "")))


def merged_flags(*raws: Column) -> Column:
    """The union of flag sets as one text."""
    return F.array_join(F.array_sort(reduce(F.array_union, map(flags, raws))), "|")


def upserted(rows: DataFrame) -> DataFrame:
    """One row for each (chain, address) from rows with an ``arrival`` order, as if they came one after another.

    A source of higher priority than all before it overrides name, policies, evidence and, unless it is mere risk, the class; others
    fill what is empty. Risk never displaces a function, a function displaces risk. Flags and sources add up. Equal rows of one
    source count once, so what one key folds is bounded by its different rows.
    """
    fields = ["name", "category", "tier", "evidence", "merge_policy", "balance_policy", "status"]
    source = F.col("source")
    prio = reduce(lambda a, p: a.when(F.split(source, "-")[0] == p[0], p[1]), PRIORITY.items(), F.when(F.lit(False), 0)).otherwise(9)
    once = rows.groupBy("chain", "address", "source", *[_text(f).alias(f) for f in fields], _text("risk_flags").alias("risk_flags")).agg(F.min("arrival").alias("arrival")).withColumn("p", prio)
    risk = F.when((F.col("tier") == "risk") & (F.col("risk_flags") == ""), F.col("category")).otherwise(F.col("risk_flags"))
    each = F.struct("arrival", "p", "source", *fields, flags(risk).alias("risk"))
    start = F.get("rows", F.lit(0))
    state = F.struct(start["p"].alias("p"), *[start[f].alias(f) for f in fields], F.array(start["source"]).alias("sources"), start["risk"].alias("risk"))

    def step(acc: Column, row: Column) -> Column:
        better, mere = row["p"] < acc["p"], row["tier"] == "risk"
        has = lambda f: row[f] != ""
        take = {f: F.when(has(f) & (better | (acc[f] == "")), row[f]).otherwise(acc[f]) for f in fields if f not in ("category", "tier")}
        moves = ~mere & (better | (acc["tier"] == "risk")) | (mere & better & (acc["tier"] == "risk"))
        for f in ("category", "tier"):
            take[f] = F.when(moves, row[f]).otherwise(acc[f])
        return F.struct(
            F.least(acc["p"], row["p"]).alias("p"),
            *[take[f].alias(f) for f in fields],
            F.when(F.array_contains(acc["sources"], row["source"]), acc["sources"]).otherwise(F.concat(acc["sources"], F.array(row["source"]))).alias("sources"),
            F.array_union(acc["risk"], row["risk"]).alias("risk"),
        )

    grouped = once.groupBy("chain", "address").agg(F.array_sort(F.collect_list(each)).alias("rows"))
    folded = grouped.select("chain", "address", F.aggregate(F.slice("rows", 2, F.size("rows")), state, step).alias("s"))
    return folded.select("chain", "address", *[F.col(f"s.{f}").alias(f) for f in fields], F.array_join("s.sources", "+").alias("source"), F.array_join(F.array_sort("s.risk"), "|").alias("risk_flags"))


def normalised(rows: DataFrame) -> DataFrame:
    """Rows with flags in order and facilities set right: no flags on burns, no behaviour flags on facilities, lockers, account abstraction and public channels by name and category."""
    name, own = F.coalesce(F.col("name"), F.lit("")), flags(F.col("risk_flags"))
    kept = F.when(F.col("category") == "burn", F.array().cast("array<string>")).when(F.col("tier") == "exclude", F.array_except(own, F.array(*map(F.lit, PRIVACY)))).otherwise(own)
    rows = rows.withColumn("risk_flags", F.array_join(kept, "|"))
    lock = ~F.col("category").isin(PROTECTED) & name.rlike("(?i)\\b(locker|vesting|timelock)\\b") & ~name.rlike("\\([A-Za-z0-9$]{1,14}\\)\\s*$")
    rows = rows.withColumns({"category": F.when(lock, "locker").otherwise(F.col("category")), "tier": F.when(lock, "identity").otherwise(F.col("tier"))})
    abstract = ~F.col("category").isin([*PROTECTED, SERIAL, "validator"]) & name.rlike("(?i)\\b(bundler|paymaster|entry ?point)\\b|erc-?4337")
    rows = rows.withColumns({"category": F.when(abstract, "infra").otherwise(F.col("category")), "tier": F.when(abstract, "exclude").otherwise(F.col("tier"))})
    return rows.withColumn("tier", F.when(F.col("category").isin(MUST_EXCLUDE) & (F.col("tier") == "identity"), "exclude").otherwise(F.col("tier")))


def policies(tier: Column, category: Column, merge: Column, balance: Column) -> dict[str, Column]:
    """``merge``, ``balance`` and ``serial`` of a label; a valid value in the row overrides what follows from its class."""
    no_merge = (tier == "exclude") | category.isin(NO_MERGE)
    held = F.when(tier == "exclude", "exclude").when(category.isin(BUCKET), "bucket").otherwise("count")
    return {
        "merge": F.when(merge.isin("allow", "no_merge"), merge).otherwise(F.when(no_merge, "no_merge").otherwise("allow")),
        "balance": F.when(balance.isin("count", "bucket", "exclude"), balance).otherwise(held),
        "serial": category == SERIAL,
    }


def risk_kind(flag: Column) -> Column:
    return F.when(flag.isin(PRIVACY), "privacy").when(flag.isin(CANDIDATE), "candidate").when(flag.isin(DEFINITIVE) | flag.endswith("-exploit"), "definitive").otherwise("unknown")


def stale_days(today: Column, *dates: str) -> Column:
    """Days since the latest of the dates that can be read; null if none can."""
    return F.datediff(today, F.greatest(*[F.substring(_text(d), 1, 10).try_cast("date") for d in dates]) if len(dates) > 1 else F.substring(_text(dates[0]), 1, 10).try_cast("date"))


def resolved(addresses: DataFrame, labels: DataFrame, today: Column, fallback: str = "eth", own_space: tuple[str, ...] = ("sol",)) -> DataFrame:
    """(chain, address, …, cross_chain, merge, balance, serial, stale_days, stale_hint, inactive) of the addresses that have a label.

    A label of the address's own chain, else one of ``fallback`` for the same address, which is a hint and no decision.
    """
    wanted = addresses.select("chain", "address").distinct()
    other = labels.filter(F.col("chain") == fallback).select("address", F.struct(*[c for c in labels.columns if c not in ("address", "chain")]).alias("_far"))
    near = wanted.join(labels.select("chain", "address", F.struct(*[c for c in labels.columns if c not in ("address", "chain")]).alias("_near")), ["chain", "address"], "left")
    both = near.join(other, "address", "left")
    far = F.when(~F.col("chain").isin(*own_space, fallback), F.col("_far"))
    rows = both.select("chain", "address", F.coalesce("_near", far).alias("_row"), F.col("_near").isNull().alias("cross_chain")).filter("_row is not null").select("chain", "address", "cross_chain", "_row.*")
    derived = policies(_text("tier"), _text("category"), _text("merge_policy"), _text("balance_policy"))
    days = stale_days(today, "verified_at", "source_snapshot_at", "added_date")
    return rows.withColumns({**derived, "stale_days": days, "stale_hint": F.coalesce(days > STALE_DAYS, F.lit(False)) & _text("category").isin(TIME_SENSITIVE), "inactive": F.lower(_text("status")).isin(INACTIVE)})


def layered(*layers: DataFrame) -> DataFrame:
    """One row for each (chain, address): that of the last layer which has it; of several in one layer the last to arrive."""
    all_ = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rows.withColumn("_layer", F.lit(k)) for k, rows in enumerate(layers)])
    rest = [c for c in all_.columns if c not in ("chain", "address", "_layer", "arrival")]
    best = all_.groupBy("chain", "address").agg(F.max(F.struct("_layer", "arrival", *rest)).alias("_row"))
    return best.select("chain", "address", "_row.*").drop("_layer")


def sections(rows: DataFrame) -> DataFrame:
    """(chain, address, section): every section that a label belongs to."""
    kinds = F.array_distinct(F.transform(flags(F.col("risk_flags")), risk_kind))
    has = lambda kind: F.array_contains(kinds, kind)
    identity = (F.col("tier") == "identity") & ~F.col("category").isin("tornado-user", "scam-candidate", SERIAL)
    some = F.array_compact(F.array(F.when(F.col("category") == SERIAL, "serial"), F.when(has("definitive"), "risk"), *[F.when(has(k), k) for k in ("candidate", "unknown", "privacy")], F.when(F.col("tier") == "exclude", "exclude"), F.when(identity, "identity")))
    every = F.when((F.size(some) == 0) & (F.col("tier") == "risk"), F.array(F.lit("risk"))).otherwise(some)
    return rows.select("chain", "address", F.explode(every).alias("section"))


def problems(rows: DataFrame) -> DataFrame:
    """(chain, address, problem): every invariant that a label row breaks."""
    own, name, raw = flags(F.col("risk_flags")), F.coalesce(F.col("name"), F.lit("")), F.coalesce(F.col("risk_flags"), F.lit(""))
    tier, category = F.col("tier"), _text("category")
    no_evidence = _text("evidence") == ""
    odd = F.exists(F.split(raw, "\\|"), lambda x: ~F.trim(x).rlike("^[a-z0-9-]*$"))
    unknown = F.exists(own, lambda x: risk_kind(x) == "unknown")
    checks = {
        "address_not_normal": (F.col("chain") != "sol") & (F.lower("address") != F.col("address")),
        "control_characters": F.concat_ws("", *[F.col(c) for c in ("address", "name", "evidence")]).rlike("[\\x00-\\x08\\x0b-\\x1f\\x7f]"),
        "unknown_tier": ~F.coalesce(tier, F.lit("")).isin("exclude", "identity", "risk"),
        "no_category": category == "",
        "flags_not_clean": odd,
        "flags_not_canonical": ~odd & (raw != F.array_join(own, "|")),
        "burn_with_flags": (category == "burn") & (F.size(own) > 0),
        "facility_with_behaviour": (tier == "exclude") & F.arrays_overlap(own, F.array(*map(F.lit, PRIVACY))),
        "risk_without_flags": (tier == "risk") & (F.size(own) == 0),
        "risk_without_evidence": (tier == "risk") & no_evidence,
        "unknown_flag": ~odd & unknown,
        "unknown_merge_policy": ~F.coalesce(F.col("merge_policy"), F.lit("")).isin("", "allow", "no_merge"),
        "unknown_balance_policy": ~F.coalesce(F.col("balance_policy"), F.lit("")).isin("", "count", "bucket", "exclude"),
        "serial_without_evidence": (category == SERIAL) & no_evidence,
        "unknown_status": ~F.coalesce(F.col("status"), F.lit("")).isin("", "historical"),
        "facility_as_identity": category.isin(MUST_EXCLUDE) & (tier == "identity"),
        "unconfirmed_excluded": name.rlike("(?i)unverified|unconfirmed") & (tier == "exclude"),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in checks.items()]))
    single = rows.select("chain", "address", F.explode(found).alias("problem"))
    twice = rows.groupBy("chain", "address").agg(F.count("*").alias("n")).filter("n > 1").select("chain", "address", F.lit("address_twice").alias("problem"))
    return single.unionByName(twice).distinct()


def added(old: DataFrame, new: DataFrame, trusted: tuple[str, ...] = ("curation", "manual", "addressbook", "serial")) -> DataFrame:
    """The table ``old`` with the rows ``new`` (one a key) merged in: a trusted source overrides, others fill name and evidence; flags and sources add up."""
    fields = ["name", "category", "tier", "evidence", "merge_policy", "balance_policy", "status"]
    a = old.select("chain", "address", F.struct(*[_text(c).alias(c) for c in [*fields, "source", "risk_flags"]]).alias("o"))
    b = new.select("chain", "address", F.struct(*[_text(c).alias(c) for c in [*fields, "source", "risk_flags"]]).alias("n"))
    both = a.join(b, ["chain", "address"], "full")
    high = F.split("n.source", "-")[0].isin(*trusted)
    out = {}
    for f in fields:
        o, n = F.col(f"o.{f}"), F.col(f"n.{f}")
        fills = high | (F.lit(f in ("name", "evidence")) & (o == ""))
        out[f] = F.when(F.col("o").isNull(), n).when(F.col("n").isNull(), o).when(fills & (n != ""), n).otherwise(o)
    joined = F.when(F.col("o").isNull(), F.col("n.source")).when(F.col("n").isNull() | F.col("o.source").contains(F.col("n.source")), F.col("o.source")).otherwise(F.concat("o.source", F.lit("+"), "n.source"))
    return both.select("chain", "address", *[c.alias(f) for f, c in out.items()], joined.alias("source"), merged_flags(F.col("o.risk_flags"), F.col("n.risk_flags")).alias("risk_flags"))


def round_trip(old: DataFrame, new: DataFrame, decision: tuple[str, ...] = ("tier", "category", "merge_policy", "balance_policy", "risk_flags"), dates: tuple[str, ...] = ("verified_at",)) -> DataFrame:
    """(chain, address, problem): rows that are missing from ``new``, whose decisions changed, or whose dates went back."""
    a = old.select("chain", "address", F.struct(*[_text(c).alias(c) for c in (*decision, *dates)]).alias("o"))
    b = new.select("chain", "address", F.struct(*[_text(c).alias(c) for c in (*decision, *dates)]).alias("n"))
    both = a.join(b, ["chain", "address"], "left")
    when = lambda side, c: F.substring(F.col(f"{side}.{c}"), 1, 10).try_cast("date")
    changed = [F.when(F.col(f"o.{c}") != F.col(f"n.{c}"), f"changed_{c}") for c in decision]
    back = [F.when(when("n", c) < when("o", c), f"earlier_{c}") for c in dates]
    return both.select("chain", "address", F.explode(F.array_compact(F.array(F.when(F.col("n").isNull(), "missing"), *changed, *back))).alias("problem"))


def conflicts(candidates: DataFrame, labels: DataFrame, gold: DataFrame, today: Column) -> DataFrame:
    """(chain, address, severity): candidate actors that a label or the gold set calls infrastructure.

    ``gold``: (chain, address) of known infrastructure. A label that already calls the address an actor is no conflict.
    """
    known = resolved(candidates, labels, today)
    both = candidates.select("chain", "address").distinct().join(known, ["chain", "address"], "left").join(gold.select("chain", "address", F.lit(True).alias("_gold")).distinct(), ["chain", "address"], "left")
    infra = _text("category").isin(INFRA_CATEGORIES)
    main = F.when(_text("category") == SERIAL, None).when(~F.col("cross_chain") & infra, "primary").when(~F.col("cross_chain") & ((F.col("tier") == "exclude") | (F.col("merge") == "no_merge")), "secondary").when(F.col("cross_chain") & infra, "cross_chain")
    return both.select("chain", "address", F.when(F.col("_gold"), "goldset-infra").otherwise(main).alias("severity")).filter("severity is not null")


def accumulated(cases: DataFrame) -> DataFrame:
    """(chain, address, cases, evidence, multi_case): actors over all cases, with their evidence in the order of cases."""
    once = cases.groupBy("chain", "address", "case").agg(F.min("evidence").alias("evidence"))
    # As many rows as an address has cases.
    out = once.groupBy("chain", "address").agg(F.count("*").alias("cases"), F.array_sort(F.collect_list(F.struct("case", "evidence"))).alias("e"))
    return out.select("chain", "address", "cases", F.array_join(F.transform("e", lambda x: F.concat(x["case"], F.lit(":"), x["evidence"])), "; ").alias("evidence"), (F.col("cases") > 1).alias("multi_case"))


def gold_set(rows: DataFrame) -> DataFrame:
    """(chain, address, expected) on which all sources agree; addresses with several expectations are dropped."""
    per = rows.groupBy("chain", "address").agg(F.min("expected").alias("expected"), F.max("expected").alias("_other"))
    return per.filter("expected = _other").drop("_other")


def negative_sample(seen: DataFrame, gold: DataFrame, most: int, low: int = 1, high: int = 5) -> DataFrame:
    """(chain, address): ``most`` rarely seen addresses of each chain in the order of their SHA-256, none of them in the gold set."""
    rare = seen.groupBy("chain", "address").agg(F.count("*").alias("n")).filter(F.col("n").between(low, high)).select("chain", "address")
    rare = rare.join(gold.select("chain", "address"), ["chain", "address"], "left_anti").withColumn("_h", F.sha2("address", 256))
    return ranked(rare, ["_h", "address"], "_k", "chain").filter(F.col("_k") <= most).select("chain", "address")


def benchmark(gold: DataFrame, known: DataFrame, weak_below: int = 20) -> DataFrame:
    """(chain, entities, wrong_excludes, infra, infra_hits, weak): decisions of resolved labels on the gold set."""
    both = gold.join(known.select("chain", "address", "cross_chain", "merge", "balance", "inactive"), ["chain", "address"], "left")
    direct = F.coalesce(~F.col("cross_chain"), F.lit(False))
    excluded, split = direct & ~F.col("inactive") & (F.col("balance") == "exclude"), direct & (F.col("merge") == "no_merge")
    real, infra = F.col("expected").isin("entity", "random-eoa"), F.col("expected") == "infrastructure"
    out = both.groupBy("chain").agg(F.count_if(real).alias("entities"), F.count_if(real & excluded).alias("wrong_excludes"), F.count_if(infra).alias("infra"), F.count_if(infra & split).alias("infra_hits"))
    return out.withColumn("weak", F.col("entities") < weak_below)


def misses(queue: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` (address, context) rows that the queue lacks, each once."""
    return new.select("address", "context").distinct().join(queue.select("address", "context"), ["address", "context"], "left_anti")

