"""How much of a cluster hangs on single pieces of evidence: bridges, and what falls off when one goes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.shared import checkpointed
from ledgerspark.operators.bridges import bridge_sides
from ledgerspark.operators.graph import components


def bridge_weights(links: DataFrame, held: DataFrame) -> DataFrame:
    """(root, u, v, m, c, _m, _c): bridges of all components of ``links`` (frm, dst), with the positive balance and the accounts of the lighter side and of the component.

    ``held``: (addr, balance).
    """
    pairs = links.select(F.col("frm").alias("u"), F.col("dst").alias("v")).filter("u <> v")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    own = nodes.join(held.select(F.col("addr").alias("node"), "balance"), "node", "left")
    weights = checkpointed(own.select("node", F.greatest(F.coalesce("balance", F.lit(0)), F.lit(0)).alias("m"), F.lit(1).alias("c")))
    sides, roots = bridge_sides(pairs, weights)
    return _lighter(sides, roots.join(weights, "node").groupBy("root").agg(F.sum("m").alias("_m"), F.sum("c").alias("_c")))


def bridges(links: DataFrame, held: DataFrame) -> DataFrame:
    """(root, u, v, share, nodes, sensitive): every bridge, and the share of its component's positive balance on the lighter side. Sensitive: a tenth of it or three accounts fall off."""
    share = F.when(F.col("_m") > 0, F.col("m").cast("double") / F.col("_m").cast("double")).otherwise(0.0)
    found = bridge_weights(links, held).select("root", "u", "v", share.alias("share"), F.col("c").alias("nodes"))
    return found.withColumn("sensitive", (F.col("share") >= 0.1) | (F.col("nodes") >= 3))


def _lighter(sides: DataFrame, sums: DataFrame) -> DataFrame:
    """Of each edge's two sides the lighter one, then the smaller; ``sums``: (root, _m, _c) of whole components."""
    side = F.least(F.struct("m", "c"), F.struct((F.col("_m") - F.col("m")).cast("decimal(38,0)").alias("m"), (F.col("_c") - F.col("c")).alias("c")))
    both = sides.withColumn("m", F.col("m").cast("decimal(38,0)")).join(sums, "root")
    return both.withColumn("_side", side).select("root", "u", "v", F.col("_side.m").alias("m"), F.col("_side.c").alias("c"), "_m", "_c")


def perturbed(members: DataFrame, links: DataFrame, funded: DataFrame, held: DataFrame, facilities: DataFrame, least_share: float = 0.1, least_accounts: int = 3) -> DataFrame:
    """(entity, kind, source, pieces, accounts, worst, most, sensitive): what falls off each entity's main component, or would be drawn in, when one piece of evidence goes.

    ``members``: (entity, addr); ``links``: (frm, dst) evidence of transfers; ``funded``: (addr, funder); ``held``: (addr, balance);
    ``facilities``: (addr, stale). The main component of an entity is the one with the largest positive balance. Kinds: ``edge``, each transfer
    evidence whose ends share no funder; ``group``, all evidence of one funder; ``label``, a stale label of a facility that an
    entity has evidence with: ``accounts`` that aren't members would be drawn in. ``pieces`` fall off with ``accounts``
    together; ``worst`` is the largest balance of one of them, ``most`` the largest number of accounts.

    Edges are read off the bridges of all entities at once. Groups are components of one graph keyed by (group, node) in
    which each group is left out of its entity once; parts that transfers hold together are one node there, and nodes of one
    group only aren't repeated. So what grows is, in each entity, groups times nodes in several groups.
    """
    members = members.select("entity", "addr").distinct()
    node = lambda a: F.concat("entity", F.lit("\x01"), a)
    weights = members.join(held, "addr", "left").select("entity", "addr", node(F.col("addr")).alias("node"), F.greatest(F.coalesce("balance", F.lit(0)), F.lit(0)).cast("decimal(38,0)").alias("m"), F.lit(1).cast("long").alias("c"))
    weights = checkpointed(weights)
    totals = weights.groupBy("entity").agg(F.greatest(F.sum("m"), F.lit(1)).alias("_all"))

    links = checkpointed(links.select("frm", "dst"))
    inside = links.select(F.least("frm", "dst").alias("u"), F.greatest("frm", "dst").alias("v")).filter("u <> v").distinct()
    inside = inside.join(members.select("entity", F.col("addr").alias("u")), "u").join(members.select("entity", F.col("addr").alias("v")), ["entity", "v"])
    inside = checkpointed(inside.select("entity", "u", "v"))
    groups = funded.select("addr", "funder").distinct().join(members, "addr")
    several = groups.groupBy("entity", "funder").agg(F.count("*").alias("_n")).filter("_n > 1").select("entity", "funder")
    groups = checkpointed(groups.join(several, ["entity", "funder"]).select("entity", "funder", "addr"))

    star = F.concat(F.lit("GAS:"), F.col("funder"))
    pairs = inside.select(node(F.col("u")).alias("u"), node(F.col("v")).alias("v")).unionByName(groups.select(node(star).alias("u"), node(F.col("addr")).alias("v")))
    sides, roots = bridge_sides(pairs, weights.select("node", "m", "c"))
    placed = weights.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sums = placed.groupBy("entity", "root").agg(F.sum("m").alias("_m"), F.sum("c").alias("_c"))
    main = checkpointed(sums.groupBy("entity").agg(F.min(F.struct((-F.col("_m")).alias("less"), "root", "_m", "_c")).alias("t")).select("entity", "t.root", "t._m", "t._c"))
    core = checkpointed(placed.join(main.select("root"), "root", "left_semi").select("entity", "addr", "node", "m", "c"))

    # Edges: those that a funder of both ends backs, too, aren't single.
    backed = inside.join(groups.withColumnsRenamed({"addr": "u"}), ["entity", "u"]).join(groups.withColumnsRenamed({"addr": "v"}), ["entity", "funder", "v"]).select("entity", "u", "v").distinct()
    single = inside.join(backed, ["entity", "u", "v"], "left_anti").join(core.select("entity", F.col("addr").alias("u")), ["entity", "u"], "left_semi")
    cut = _lighter(sides, main.select("root", "_m", "_c")).select(F.col("u").alias("_u"), F.col("v").alias("_v"), F.col("m").alias("worst"), F.col("c").alias("most"))
    ends = single.withColumns({"_u": F.least(node(F.col("u")), node(F.col("v"))), "_v": F.greatest(node(F.col("u")), node(F.col("v")))})
    edges = ends.join(cut, ["_u", "_v"], "left").select("entity", F.lit("edge").alias("kind"), F.concat("u", F.lit("~"), "v").alias("source"), F.col("most").isNotNull().cast("long").alias("pieces"), F.coalesce("most", F.lit(0)).alias("accounts"), F.coalesce("worst", F.lit(0)).alias("worst"), F.coalesce("most", F.lit(0)).alias("most"))

    # Groups: what transfers alone hold together is one part.
    alone = components(inside.select(node(F.col("u")).alias("frm"), node(F.col("v")).alias("dst"))).withColumnsRenamed({"addr": "node", "root": "_root"})
    parts = core.join(alone, "node", "left").select("entity", "addr", F.coalesce("_root", "node").alias("part"), "m", "c")
    weight = checkpointed(parts.groupBy("entity", "part").agg(F.sum("m").alias("m"), F.sum("c").alias("c")))
    ties = checkpointed(groups.join(parts.select("entity", "addr", "part"), ["entity", "addr"]).select("entity", "funder", "part").distinct())
    often = ties.groupBy("entity", "part").agg(F.count("*").alias("_n"))
    ties = checkpointed(ties.join(often, ["entity", "part"]).select("entity", "funder", "part", (F.col("_n") > 1).alias("_shared")))
    left_out = ties.groupBy("entity", F.col("funder").alias("source")).agg(F.count("*").alias("_n")).filter("_n > 1").select("entity", "source")
    rest = checkpointed(left_out.join(ties.filter("_shared"), "entity").filter("source <> funder"))
    key = lambda *c: F.concat("entity", F.lit("\x01"), "source", F.lit("\x01"), *c)
    of = components(rest.select(key(F.lit("GAS:"), "funder").alias("frm"), key("part").alias("dst")))
    hung = ties.filter("not _shared").join(weight, ["entity", "part"])
    carried = hung.groupBy("entity", "funder").agg(F.sum("m").alias("m"), F.sum("c").alias("c"))
    own = rest.select("entity", "source", "part").distinct().join(weight, ["entity", "part"]).select("entity", "source", key("part").alias("addr"), "m", "c")
    own = own.unionByName(rest.select("entity", "source", "funder").distinct().join(carried, ["entity", "funder"]).select("entity", "source", key(F.lit("GAS:"), "funder").alias("addr"), "m", "c"))
    pieces = own.join(of, "addr").groupBy("entity", "source", F.col("root").alias("piece")).agg(F.sum("m").alias("m"), F.sum("c").alias("c"))
    pieces = checkpointed(pieces.unionByName(hung.join(left_out.withColumnRenamed("source", "funder"), ["entity", "funder"]).select("entity", F.col("funder").alias("source"), F.col("part").alias("piece"), "m", "c")))
    top = pieces.groupBy("entity", "source").agg(F.max(F.struct("m", "c", "piece")).alias("_top"))
    fallen = pieces.join(top, ["entity", "source"]).filter(F.col("piece") != F.col("_top.piece"))
    fallen = fallen.groupBy("entity", "source").agg(F.count("*").alias("pieces"), F.sum("c").alias("accounts"), F.max("m").alias("worst"), F.max("c").alias("most"), F.max(F.struct("m", "c")).alias("_"))
    every = ties.select("entity", F.col("funder").alias("source")).distinct().join(fallen.drop("_"), ["entity", "source"], "left").fillna(0, ["pieces", "accounts", "most"])
    grouped = every.select("entity", F.lit("group").alias("kind"), "source", "pieces", "accounts", F.coalesce("worst", F.lit(0)).alias("worst"), "most")

    # Labels: neighbours of a facility outside the entity.
    known = facilities.select("addr").distinct()
    sides_ = links.select(F.col("frm").alias("x"), F.col("dst").alias("peer")).unionByName(links.select(F.col("dst").alias("x"), F.col("frm").alias("peer"))).distinct()
    near = checkpointed(sides_.join(facilities.filter("stale").select(F.col("addr").alias("x")).distinct(), "x", "left_semi").join(known.withColumnRenamed("addr", "peer"), "peer", "left_anti"))
    here = near.join(members.withColumnRenamed("addr", "peer"), "peer").groupBy("entity", "x").agg(F.count("*").alias("_in"))
    drawn = here.join(near.groupBy("x").agg(F.count("*").alias("_n")), "x").select("entity", F.lit("label").alias("kind"), F.col("x").alias("source"), F.lit(0).cast("long").alias("pieces"), (F.col("_n") - F.col("_in")).alias("accounts"), F.lit(0).alias("worst"), F.lit(0).cast("long").alias("most"))

    found = edges.unionByName(grouped).unionByName(drawn).withColumn("worst", F.col("worst").cast("decimal(38,0)")).join(totals, "entity")
    share = F.round(F.col("worst").cast("double") / F.col("_all").cast("double"), 4)
    tells = F.when(F.col("kind") == "label", F.col("accounts") > 0).otherwise((F.col("pieces") > 0) & ((share >= least_share) | (F.col("most") >= least_accounts)))
    return found.select("entity", "kind", "source", "pieces", "accounts", "worst", "most", tells.alias("sensitive"))


def regraded(totals: DataFrame, net: DataFrame, big_bps: int, small_bps: int, off_pct: int = 10) -> DataFrame:
    """(cluster, tier, lower, higher, sensitive): grades at thresholds moved down and up. ``totals``: (cluster, total)."""
    from ledgerspark.operators.graph import tier

    rows = totals.join(F.broadcast(net.select("net")))
    at = lambda pct: tier(F.col("total") * 100, F.col("net") * pct, big_bps, small_bps)
    graded = rows.select("cluster", at(100).alias("tier"), at(100 - off_pct).alias("lower"), at(100 + off_pct).alias("higher"))
    return graded.withColumn("sensitive", (F.col("tier") != F.col("lower")) | (F.col("tier") != F.col("higher")))
