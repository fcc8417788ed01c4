"""Spanning forests, sums over the sides of their edges, and bridges, without walking a component in one task.

All three are rounds of joins and sums over edges, whose number grows with the logarithm of the number of
nodes, whatever the shape: a path of a million nodes takes about as many as a bush.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.shared import Scratch, checkpointed

#: What is summed up over nodes: a label by exclusive or, an amount and a count.
SUMS = ("x", "m", "c")


def _looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` joined to ``table``, whose keys are unique; the join is Spark's own, so adaptive execution splits a key with many rows."""
    return rows.join(table, key)


def _plus(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    return {"x": a["x"].bitwiseXOR(b["x"]), "m": (a["m"] + b["m"]).cast("decimal(38,0)"), "c": a["c"] + b["c"]}


def _less(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    return {"x": a["x"].bitwiseXOR(b["x"]), "m": (a["m"] - b["m"]).cast("decimal(38,0)"), "c": a["c"] - b["c"]}


def _of(prefix: str) -> dict[str, Column]:
    return {k: F.col(f"{prefix}{k}") for k in SUMS}


def _named(values: dict[str, Column], prefix: str) -> list[Column]:
    return [v.alias(f"{prefix}{k}") for k, v in values.items()]


def spanning_forest(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, v) of a spanning forest of ``pairs`` (u, v, with u <> v and none twice), and (node, root) of all nodes; a root is its component's least node.

    Borůvka's rounds: each component takes its least edge to another, by a hash that is different for each edge; two
    that took the same edge are a root, all others follow their edges to it by doubling.
    """
    scratch = Scratch(pairs.sparkSession)
    live = scratch.put(pairs.select(F.col("u").alias("a"), F.col("v").alias("b"), F.struct(F.xxhash64("u", "v").alias("h"), "u", "v").alias("e")))
    nodes = live.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = scratch.put(nodes.select("node", F.col("node").alias("root")))
    taken = []
    while not live.isEmpty():
        both = live.select("a", "b", "e").unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b"), "e"))
        least = scratch.put(both.groupBy("a").agg(F.min(F.struct("e", "b")).alias("t")).select("a", F.col("t.b").alias("to"), "t.e"))
        taken.append(least.select("e.u", "e.v").distinct())
        back = least.select(F.col("a").alias("to"), F.col("to").alias("_back"))
        up = scratch.put(_looked_up(least.select("a", "to"), back, "to").select("a", F.when((F.col("_back") == F.col("a")) & (F.col("a") < F.col("to")), F.col("a")).otherwise(F.col("to")).alias("to")))
        while True:
            after = _looked_up(up, up.select(F.col("a").alias("to"), F.col("to").alias("_next")), "to")
            up = scratch.put(after.select("a", F.col("_next").alias("to"), (F.col("to") != F.col("_next")).alias("_moved")))
            if up.filter("_moved").isEmpty():
                break
            up = up.drop("_moved")
        up = up.select("a", "to")
        roots = scratch.put(_looked_up(roots, up.select(F.col("a").alias("root"), F.col("to").alias("_to")), "root").select("node", F.col("_to").alias("root")).unionByName(roots.join(up.select(F.col("a").alias("root")), "root", "left_anti").select("node", "root")))
        at_a = _looked_up(live, up.select("a", F.col("to").alias("_a")), "a")
        at_b = _looked_up(at_a, up.select(F.col("a").alias("b"), F.col("to").alias("_b")), "b").filter("_a <> _b")
        # Of edges between the same two components the least is enough.
        live = scratch.put(at_b.groupBy(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).agg(F.min("e").alias("e")))
    tree = pairs.select("u", "v").limit(0)
    for edges in taken:
        tree = tree.unionByName(edges)
    first = roots.groupBy("root").agg(F.min("node").alias("_first"))
    result = checkpointed(tree.distinct()), checkpointed(_looked_up(roots, first, "root").select("node", F.col("_first").alias("root")))
    scratch.clear()
    return result


def side_sums(tree: DataFrame, nodes: DataFrame) -> DataFrame:
    """(u, v, x, m, c): for each edge (u, v) of a forest the sums of ``nodes`` (node, x, m, c) on one of its two sides.

    The forest is contracted. A leaf's sum is what lies on its side of its edge; it is added to the leaf's neighbour and the
    leaf goes. Of the nodes with two neighbours some that aren't next to each other go, too: their two edges become
    one, which remembers what lay between; original edges keep what lies between them and the new edge's first end.
    """
    scratch = Scratch(tree.sparkSession)
    edges = scratch.put(tree.select("u", "v").withColumn("id", F.monotonically_increasing_id()))
    none = {"x": F.lit(0).cast("long"), "m": F.lit(0).cast("decimal(38,0)"), "c": F.lit(0).cast("long")}
    # Live edges with what lies inside them; original edges with the live edge they are in and what lies before them there.
    live = edges.select("id", F.col("u").alias("a"), F.col("v").alias("b"), *_named(none, "o"))
    parts = edges.select("u", "v", "id", *_named(none, "p"))
    sums = nodes.select("node", F.col("x").cast("long").alias("sx"), F.col("m").cast("decimal(38,0)").alias("sm"), F.col("c").cast("long").alias("sc"))
    known, turn = [], 0
    while not live.isEmpty():
        turn += 1
        ends = _ends(live)
        lone = ends.groupBy("n").agg(F.count("*").alias("d")).filter("d = 1").select("n")
        # An edge both of whose ends are leaves goes by one of them.
        leaves = ends.join(lone, "n", "left_semi").groupBy("id").agg(F.min(F.struct("side", "n", "other", "ox", "om", "oc")).alias("t")).select("id", "t.*")
        leaves = scratch.put(leaves.join(sums.withColumnRenamed("node", "n"), "n"))
        known.append(leaves.select("id", "side", "ox", "om", "oc", "sx", "sm", "sc"))
        more = leaves.groupBy(F.col("other").alias("node")).agg(F.bit_xor(_plus(_of("s"), _of("o"))["x"]).alias("ax"), F.sum(F.col("sm") + F.col("om")).cast("decimal(38,0)").alias("am"), F.sum(F.col("sc") + F.col("oc")).alias("ac"))
        left = sums.join(leaves.select(F.col("n").alias("node")), "node", "left_anti").join(more, "node", "left")
        grown = _plus(_of("s"), {"x": F.coalesce("ax", none["x"]), "m": F.coalesce("am", none["m"]), "c": F.coalesce("ac", none["c"])})
        sums = scratch.put(left.select("node", *_named(grown, "s")))
        live = scratch.put(live.join(leaves.select("id"), "id", "left_anti"))
        picked = scratch.put(_picked(live, sums, turn))
        if picked.isEmpty():
            continue
        f, g = F.col("f"), F.col("g")
        inner = lambda s: {k: s[f"o{k}"] for k in SUMS}
        before_g = _plus(inner(f), _of("s"))
        whole = _plus(before_g, inner(g))
        joined = picked.select(f["id"].alias("id"), f["other"].alias("a"), g["other"].alias("b"), *_named(whole, "o"))
        # What lies before a part is counted from the new first end: parts of an edge that lay the other way round turn.
        to_f = picked.select(f["id"].alias("id"), f["id"].alias("_to"), (f["side"] == 0).alias("_turns"), *_named({k: F.when(f["side"] == 0, v).otherwise(none[k]) for k, v in inner(f).items()}, "b"))
        to_g = picked.select(g["id"].alias("id"), f["id"].alias("_to"), (g["side"] == 1).alias("_turns"), *_named({k: F.when(g["side"] == 1, whole[k]).otherwise(before_g[k]) for k in SUMS}, "b"))
        moves = scratch.put(to_f.unionByName(to_g))
        on, back = _plus(_of("b"), _of("p")), _less(_of("b"), _of("p"))
        moved = _looked_up(parts, moves, "id").select("u", "v", F.col("_to").alias("id"), *_named({k: F.when(F.col("_turns"), back[k]).otherwise(on[k]) for k in SUMS}, "p"))
        parts = scratch.put(moved.unionByName(parts.join(moves.select("id"), "id", "left_anti").select(*moved.columns)))
        live = scratch.put(live.join(moves.select("id"), "id", "left_anti").unionByName(joined))
        sums = scratch.put(sums.join(picked.select("node"), "node", "left_anti"))
    if not known:
        scratch.clear()
        return tree.select("u", "v", *_named(none, ""))
    every = known[0]
    for rows in known[1:]:
        every = every.unionByName(rows)
    from_a, from_b = _plus(_of("s"), _of("p")), _plus(_of("s"), _less(_of("o"), _of("p")))
    result = checkpointed(_looked_up(parts, every, "id").select("u", "v", *_named({k: F.when(F.col("side") == 0, from_a[k]).otherwise(from_b[k]) for k in SUMS}, "")))
    scratch.clear()
    return result


def _ends(live: DataFrame) -> DataFrame:
    """(id, n, other, side, …): each live edge from both of its ends."""
    rest = ["ox", "om", "oc"]
    a = live.select("id", F.col("a").alias("n"), F.col("b").alias("other"), F.lit(0).alias("side"), *rest)
    return a.unionByName(live.select("id", F.col("b").alias("n"), F.col("a").alias("other"), F.lit(1).alias("side"), *rest))


def _picked(live: DataFrame, sums: DataFrame, turn: int) -> DataFrame:
    """(node, f, g, sx, sm, sc): nodes with two edges, no two of them neighbours, with both edges and their own sums."""
    ends = _ends(live)
    two = ends.groupBy("n").agg(F.count("*").alias("d")).filter("d = 2").select("n")
    mine = ends.join(two, "n", "left_semi")
    rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("k"))
    beside = mine.join(two.select(F.col("n").alias("other"), F.lit(True).alias("_two")), "other", "left")
    wins = F.bool_and(F.col("_two").isNull() | (rank("n") > rank("other")))
    edge = F.struct("id", "other", "side", "ox", "om", "oc")
    found = beside.groupBy("n").agg(wins.alias("_wins"), F.min(edge).alias("f"), F.max(edge).alias("g")).filter("_wins")
    return found.select(F.col("n").alias("node"), "f", "g").join(sums, "node")


def bridge_sides(pairs: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, v, m, c, root) of every bridge of ``pairs`` (u, v), with the sums of ``nodes`` (node, m, c) on one side, and (node, root) of all nodes in pairs.

    Each edge outside a spanning forest gets a label of 64 bits, and each node the exclusive or of the labels of its
    edges. On a side of a forest edge the labels of edges that stay inside cancel; what is left are those that cross beside it. So an edge
    is a bridge if its side's labels cancel altogether; that others do so by chance has odds of one to 2^64.
    """
    pairs = checkpointed(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u <> v").distinct())
    tree, roots = spanning_forest(pairs)
    label = F.xxhash64("u", "v", F.lit("label"))
    crossing = pairs.join(tree, ["u", "v"], "left_anti").select(F.explode(F.array("u", "v")).alias("node"), label.alias("l")).groupBy("node").agg(F.bit_xor("l").alias("x"))
    weights = roots.select("node").join(nodes.select("node", "m", "c"), "node", "left").join(crossing, "node", "left")
    zero = F.lit(0).cast("long")
    weights = checkpointed(weights.select("node", F.coalesce("x", zero).alias("x"), F.coalesce("m", F.lit(0)).alias("m"), F.coalesce("c", zero).alias("c")))
    found = side_sums(tree, weights).filter("x = 0")
    return _looked_up(found, roots.withColumnRenamed("node", "u"), "u").select("u", "v", "m", "c", "root"), roots
