"""Joins of ranges and sets, scans, forests and merges against plain versions, also on skewed data."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerspark.functions.joins import grid_join, hub_join, interval_join, range_blocks
from ledgerspark.operators import bridges, cost, graph, labels, methods, reconcile, selection, sensitivity, sequence, setjoin


def _side(edges, start, without):
    seen, todo = {start}, [start]
    while todo:
        x = todo.pop()
        for e in edges:
            if e != without and x in e and (y := e[0] if e[1] == x else e[1]) not in seen:
                seen.add(y)
                todo.append(y)
    return seen


def _graph():
    """A path, a star, a sparse random part, a cycle and an edge alone."""
    rng = random.Random(4)
    edges = {(f"p{k:02}", f"p{k + 1:02}") for k in range(30)} | {("hub", f"s{k:02}") for k in range(25)} | {(f"c{k}", f"c{(k + 1) % 5}") for k in range(5)} | {("x", "y"), ("hub", "p15"), ("p03", "p07")}
    edges |= {tuple(f"r{k:02}" for k in rng.sample(range(22), 2)) for _ in range(20)}
    return sorted({tuple(sorted(e)) for e in edges})


def test_bridges_equal_brute_force(spark):
    edges = _graph()
    weight = {n: hash(n) % 7 * 0 + len(n) + ord(n[-1]) for e in edges for n in e}
    held = spark.createDataFrame([*weight.items(), ("away", 5)], "addr string, balance long")
    found = sensitivity.bridge_weights(spark.createDataFrame(edges + [e[::-1] for e in edges[:9]], "frm string, dst string"), held)
    want = {}
    for e in edges:
        one = _side(edges, e[0], e)
        if e[1] not in one:
            want[e] = min((sum(weight[n] for n in s), len(s)) for s in (one, _side(edges, e[1], e)))
    assert {(r["u"], r["v"]): (int(r["m"]), r["c"]) for r in found.collect()} == want
    assert len(want) > 50


def test_forest_spans_each_component(spark):
    edges = _graph()
    tree, roots = bridges.spanning_forest(spark.createDataFrame(edges, "u string, v string"))
    got = {r["node"]: r["root"] for r in roots.collect()}
    assert got == {n: min(_side(edges, n, None)) for e in edges for n in e}
    taken = [tuple(r) for r in tree.collect()]
    assert len(taken) == len(got) - len(set(got.values())) and all(min(_side(taken, n, None)) == r for n, r in got.items())


def test_interval_join_equals_comparison(spark):
    """Points and ranges of all sizes, among them one point and one range with a third of the rows."""
    rng = random.Random(5)
    points = [(k, rng.randint(-500, 500)) for k in range(300)] + [(k, 77) for k in range(300, 450)]
    ranges = [(k, low, low + rng.choice([-1, 0, 1, 2, 7, 8, 9, 300, 10**6])) for k in range(120) for low in [rng.randint(-500, 500)]] + [(k, 60, 90) for k in range(120, 180)]
    got = interval_join(spark.createDataFrame(points, "p long, at long"), "at", spark.createDataFrame(ranges, "r long, low long, high long"), "low", "high")
    assert sorted((x["p"], x["r"]) for x in got.collect()) == sorted((p, r) for p, at in points for r, low, high in ranges if low <= at <= high)
    assert interval_join(spark.createDataFrame(points, "p long, at long"), "at", spark.createDataFrame([], "r long, low long, high long"), "low", "high").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_totals_equal_all_pairs(spark):
    rng = random.Random(7)
    points = [rng.choice([rng.randint(-50, 50), 7]) for _ in range(400)] + [None] * 3
    ranges = [(k % 50, low, low + rng.choice([-1, 0, 1, 9, 60])) for k in range(90) for low in [rng.randint(-80, 80)]]
    frame = spark.createDataFrame([(p,) for p in points], "p long")
    result = cost.range_totals(frame, "p", spark.createDataFrame(ranges, "r long, low long, high long"), "r", "low", "high")
    want = {}
    for owner, low, high in ranges:
        for p in points:
            if p is not None and low <= p <= high:
                n, total = want.get(owner, (0, 0))
                want[owner] = n + 1, total + p
    assert {r["r"]: (r["n"], int(r["total"])) for r in result.collect()} == want


def test_no_point_meets_a_range_in_swaps_in_range(spark):
    """One row for each swap in a range would be more rows than the tables have."""
    from ledgerspark.plans import catalogue

    plan = catalogue.queries()["swaps_in_range"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "_cell" not in plan and "_line" not in plan


def test_grid_join_of_a_hot_key(spark):
    a = spark.createDataFrame([(k % 3 and 9, k) for k in range(300)], "key long, x long")
    b = spark.createDataFrame([(k % 2 and 9, k) for k in range(40)], "key long, y long")
    assert sorted(map(tuple, grid_join(a, b, "key", hot=3, side=4).collect())) == sorted(map(tuple, a.join(b, "key").collect()))


@pytest.mark.parametrize(("least", "pct"), [(1, 50), (3, 0), (4, 80), (1, 100)])
def test_similar_sets_equal_all_pairs(spark, least, pct):
    """Sets with a frequent item each, repeats and equal sets."""
    rng = random.Random(6)
    sets = {k: {"hot", *(f"i{x}" for x in rng.sample(range(25), rng.randint(0, 8)))} for k in range(60)} | {100 + k: {f"i{x}" for x in range(6)} | {f"own{k}"} for k in range(4)}
    rows = [(k, i) for k, s in sets.items() for i in s]
    frame = spark.createDataFrame(rows + rows[:20], "set long, item string")
    share = lambda a, b: len(a & b) >= least and len(a & b) * 100 >= len(a | b) * pct
    got = {(r["a"], r["b"]): (r["na"], r["nb"], r["common"]) for r in setjoin.similar_sets(frame, least=least, jaccard_pct=pct).collect()}
    assert got == {(a, b): (len(sets[a]), len(sets[b]), len(sets[a] & sets[b])) for a in sets for b in sets if a < b and share(sets[a], sets[b])}
    others = {k: {i for i in s if i != "i3"} | ({"new"} if k % 3 == 0 else set()) for k, s in sets.items()}
    right = spark.createDataFrame([(k, i) for k, s in others.items() for i in s], "set long, item string")
    if least == 1:
        want = {}
        for a, s in sets.items():
            found = [(-len(s & t) / len(s | t), b) for b, t in others.items() if share(s, t)]
            if found:
                want[a] = min(found)[1]
        assert {r["a"]: r["b"] for r in setjoin.best_matches(frame, right, pct).collect()} == want


def _plain_merge(batches, least=3):
    out, where = [], []
    for i, members in enumerate(batches):
        k = next((k for k, (_, other) in enumerate(out) if len(members & other) >= max(least, len(members) // 2)), None)
        if k is None:
            out.append((i, set(members)))
            where.append(i)
        else:
            out[k][1].update(members)
            where.append(out[k][0])
    return where


@pytest.mark.parametrize(("n", "members", "most"), [(20, 12, 6), (30, 40, 5)])
def test_candidates_merge_in_order(spark, n, members, most):
    rng = random.Random(n)
    batches = [set(rng.sample(range(members), rng.randint(1, most))) for _ in range(n)]
    rows = spark.createDataFrame([(i, f"m{m}") for i, b in enumerate(batches) for m in b], "number long, addr string")
    got = {r["number"]: r["group"] for r in sequence.merged_candidates(rows, "number", "addr").collect()}
    assert [got[i] for i in range(n)] == _plain_merge(batches)


def test_taint_by_scan_equals_a_loop(spark):
    """An account with most moves is dealt over ranges."""
    rng = random.Random(7)
    rows = [(rng.choice("aaaaaaabc"), k // 3, k, rng.choice([1, -1]) * rng.randint(0, 50)) for k in range(2000)]
    rows = [(*r, rng.randint(0, r[3]) if r[3] > 0 else 0) for r in rows]
    got = {r["addr"]: (r["injected"], r["passed"], r["retained"]) for r in cost.tainted(spark.createDataFrame(rows, "addr string, ts long, seq long, amount long, taint long").repartition(6)).collect()}
    for addr in "abc":
        held = taint = put = gone = 0.0
        for _, _, _, amount, bad in (r for r in rows if r[0] == addr):
            if amount > 0:
                held, taint, put = held + amount, taint + bad, put + bad
            elif held > 0:
                part = min(taint, -amount * taint / held)
                held, taint, gone = max(0.0, held + amount), taint - part, gone + part
        assert got[addr] == pytest.approx((put, gone, taint), abs=1e-6)


def test_fee_shares_equal_a_loop(spark):
    rng = random.Random(8)
    swaps = [(k, rng.choice([5, 5, 5, *range(40)]), rng.randint(0, 10**6)) for k in range(400)]
    positions = [(k % 70, low, low + rng.randint(0, 15), rng.randint(1, 1000)) for k in range(90) for low in [rng.randint(-5, 40)]]
    got = {r["owner"]: r["fee"] for r in cost.fee_shares(spark.createDataFrame(swaps, "swap long, tick long, volume long"), spark.createDataFrame(positions, "owner long, lower long, upper long, liquidity long"), 3000).collect()}
    want: dict[int, float] = {}
    for _, tick, volume in swaps:
        inside = [p for p in positions if p[1] <= tick < p[2]]
        for p in inside:
            want[p[0]] = want.get(p[0], 0) + -(-volume * 3000 // 1_000_000) * p[3] / sum(q[3] for q in inside)
    assert got == pytest.approx(want)


def test_overlaps_without_nested_loops(spark):
    ranges = spark.createDataFrame([(1, 0, 10), (2, 5, 5), (3, 10, 20), (4, 21, 30), (5, 0, 30), (6, 0, 10)], "run long, lo long, hi long")
    rows = [(r["run"], r["lo"], r["hi"]) for r in ranges.collect()]
    want = sorted((a, b, max(al, bl), min(ah, bh)) for a, al, ah in rows for b, bl, bh in rows if a < b and max(al, bl) <= min(ah, bh))
    assert sorted((r["a"], r["b"], r["lo"], r["hi"]) for r in reconcile.overlaps(ranges, "run").collect()) == want


def test_token_groups_join_all_pairs(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "a string, b string")
    assert {r["addr"]: r["root"] for r in methods.token_groups(pairs).collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}


def test_every_fixed_label_has_its_class(spark):
    """One value after another of all fixed tables, against what each table stands for."""
    own = {v: (v, "identity") for v in labels.IDENTITIES} | {v: (v, "risk") for v in [*labels.RISKS, "bybit-exploit", "some-hack"]}
    for values, category in ((labels.EXCHANGES, "cex"), (labels.BRIDGES, "bridge"), (labels.MEV, "mev"), (labels.INFRA, "infra"), (labels.TOKEN, "token-contract"), (labels.PROTOCOLS, "protocol"), (["burn"], "burn")):
        own |= {v: (category, "exclude") for v in values}
    own |= {"some-exchange": ("cex", "exclude"), "my-bridge-2": ("bridge", "exclude"), "x-finance": ("protocol", "exclude"), "night-owl": ("night-owl", "identity"), "ofac-sdn": ("ofac-sdn", "identity")}
    own |= {f" {v.upper()} ": c for v, c in list(own.items())[:300]} | dict.fromkeys(labels.DROPPED)
    rows = spark.createDataFrame([(v,) for v in own], "raw string")
    got = {r["raw"]: r["c"] and tuple(r["c"]) for r in rows.withColumn("c", labels.label_class(rows["raw"])).collect()}
    assert got == own
    kinds = dict.fromkeys(labels.DEFINITIVE, "definitive") | dict.fromkeys(labels.CANDIDATE, "candidate") | dict.fromkeys(labels.PRIVACY, "privacy") | {"bybit-exploit": "definitive", "some-hack": "unknown", "odd": "unknown"}
    flags = spark.createDataFrame([(v,) for v in kinds], "flag string")
    assert {r["flag"]: r["k"] for r in flags.withColumn("k", labels.risk_kind(flags["flag"])).collect()} == kinds
    assert {"scam", "exploit", "exploiter", "heist", "phish-hack", "blocked"} <= set(labels.DEFINITIVE) & set(labels.RISKS)


def test_hub_join_equals_a_plain_join(spark):
    """Half of the rows are on one key, many keys have one row, some have no match; a null key meets nothing."""
    rows = spark.createDataFrame([("hub", k) for k in range(3000)] + [(f"k{k}", k) for k in range(2000)] + [("away", 1), (None, 2)], "u string, v long")
    sizes = spark.createDataFrame([("hub", 7, 3000)] + [(f"k{k}", k, 1) for k in range(1500)], "u string, m long, n long")
    for hot in (2, 1000, 10**9):
        found = hub_join(rows, sizes, "u", "n", rows.count(), hot)
        assert found.columns == ["u", "v", "m"]
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.join(sizes, "u").select("u", "v", "m").collect()))


def test_components_of_stars(spark):
    """Stars whose middles are the largest, the least and another name, joined by a path, each with most of all edges; repeated and reversed edges count once."""
    edges = [("zz", f"a{k:04}") for k in range(900)] + [("0", f"b{k:04}") for k in range(900)] + [("m", f"{'cy'[k % 2]}{k:04}") for k in range(1800)]
    for extra, roots in (([], 3), ([("a0005", "b0007")], 2), ([("a0005", "b0007"), ("y0001", "p1"), ("p1", "p2"), ("p2", "zz")], 1)):
        own = edges + extra + [e[::-1] for e in edges[::7]] + edges[:50]
        got = {r["addr"]: r["root"] for r in graph.components(spark.createDataFrame(own, "frm string, dst string")).collect()}
        assert len(got) == len({n for e in own for n in e}) and len(set(got.values())) == roots
        assert all(got[a] == got[b] <= min(a, b) for a, b in own) and all(got[r] == r for r in set(got.values()))


def test_bursts_look_back_twelve_bars(spark):
    """A bar is held against the busiest of twelve before it, also across empty ones; the thirteenth before doesn't count, nor does a start without any."""
    counts = {0: 9, 10: 2, 13: 4, 22: 7, 25: 8, 60: 50}
    events = spark.createDataFrame([(bar * 300 + k,) for bar, n in counts.items() for k in range(n)], "ts long")
    found = {r["bar"] // 300: (r["n"], r["before"]) for r in methods.bursts(events, 300, 2).collect()}
    want = {}
    for bar, n in counts.items():
        before = max((m for b, m in counts.items() if bar - 12 <= b < bar), default=0)
        if before and n >= 2 * before:
            want[bar] = (n, before)
    assert found == want and 13 in want and 60 not in want


def test_pull_leverage_on_known_days(spark):
    """A cap that doubles on little turnover; a day without one five days before has none, a span without turnover no leverage."""
    days = [(1, 10, 1000, 5), (3, 10, 1000, 7), (4, 15, 1000, 0), (6, 20, 1000, 8), (8, 5, 1000, 0), (9, 15, 1000, 0), (20, 1, 1, 1), (30, 2, 1000, 0), (35, 4, 1000, 0)]
    found = {r["day"]: (int(r["cap_change"]), int(r["turnover"]), r["leverage"]) for r in methods.pull_leverage(spark.createDataFrame(days, "day long, close long, supply long, volume long"), 5).collect()}
    assert found == {6: (10_000, 15, 666_666), 8: (-5_000, 8, 625_000), 9: (0, 8, 0), 35: (2_000, 0, None)}


def test_range_blocks_make_up_the_range(spark):
    rng = random.Random(8)
    ranges = [(low, low + rng.choice([-1, 0, 1, 2, 3, 7, 8, 31, 100])) for low in (rng.randint(-70, 70) for _ in range(80))]
    got = spark.createDataFrame(ranges, "low long, high long").select("low", "high", range_blocks(F.col("low"), F.col("high")).alias("b")).collect()
    for r in got:
        assert sorted(x for b in r["b"] or [] for x in range(b["cell"] << b["level"], (b["cell"] + 1) << b["level"])) == list(range(r["low"], r["high"] + 1))


def test_codes_match_as_all_pairs_would_and_meet_by_equality(spark):
    rng = random.Random(9)
    some = lambda *x: rng.choice([*x, None])
    codes = [(k, some("h1", "h2", "h3"), some("s1", "s2"), some(rng.randint(-100, 9000), 1000)) for k in range(150)]
    known = [(f"K{k}", some("h1", "h4"), some("s1", "s2", "s3"), some(rng.randint(0, 9000), 936, 1064)) for k in range(12)]
    want = {}
    for addr, h, s, n in codes:
        ways = [("exact", name) for name, kh, _, _ in known if h is not None and h == kh]
        ways += [("similar", name) for name, _, ks, kn in known if None not in (s, n, kn) and s == ks and abs(n - kn) * 50 <= max(kn, 3200)]
        if ways:
            want[addr] = min(ways)
    got = selection.code_matches(spark.createDataFrame(codes, "addr long, hash string, selectors string, size long"), spark.createDataFrame(known, "name string, hash string, selectors string, size long"))
    assert {r["addr"]: (r["how"], r["name"]) for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "* 50" not in plan
