"""Hand-computable cases of the ledger operators."""

from __future__ import annotations

import random
from decimal import Decimal

import duckdb

from ledgerspark.functions.prefix import prefix_sums
from ledgerspark.functions.sliding import best_window, sliding
from ledgerspark.operators import distribution, graph, ledger, scanners, sequence
from ledgerspark.plans import catalogue

LEDGER = "block long, tx long, li long, frm string, dst string, v decimal(38,0)"


def transfers(spark, *rows):
    return spark.createDataFrame([(*r[:5], Decimal(r[5])) for r in rows], LEDGER)


def test_wide_amounts_close(spark):
    rows = transfers(spark, (0, 0, 0, "ZERO", "A", 10**36), (1, 1, 0, "A", "B", 10**35), (2, 2, 0, "B", "DEAD", 5))
    one = ledger.stats(rows).first()
    assert one["closes"] and one["sum_balances"] == 10**36 and one["burn_total"] == 5


def test_negative_then_healed_still_fails(spark):
    rows = transfers(spark, (0, 0, 0, "ZERO", "A", 10), (1, 1, 0, "B", "A", 5), (2, 2, 0, "A", "B", 9))
    one = ledger.negative_gate(ledger.daily_deltas(rows, rows["block"])).first()
    assert (one["negative_final"], one["negative_minimum"], one["passes"]) == (0, 1, False)


def test_intraday_bound(spark):
    rows = transfers(spark, (1, 0, 0, "ZERO", "A", 100), (1, 1, 0, "A", "B", 100), (2, 2, 0, "ZERO", "A", 50))
    bounds = ledger.daily_bounds(ledger.daily_deltas(rows, rows["block"]))
    one = bounds.filter("addr = 'A'").first()
    assert (one["peak_close"], one["bound"], one["bound_day"]) == (50, 100, 1)
    assert [r["level"] for r in ledger.needs_block_precision(bounds.filter("addr = 'A'"), [50, 60, 100, 101]).orderBy("level").collect()] == [60, 100]


def test_prefix_sums_equal_a_plain_loop(spark):
    rng = random.Random(1)
    rows = [(f"k{k}", o, rng.randint(-9, 9)) for k in range(4) for o in rng.sample(range(3000), 300)]
    out = prefix_sums(spark.createDataFrame(rows, "k string, o long, x long"), "k", "o", "x", "s").collect()
    for key in {r[0] for r in rows}:
        total = 0
        for row in sorted((r for r in out if r["k"] == key), key=lambda r: r["o"]):
            total += row["x"]
            assert row["s"] == total


def test_sliding_windows_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randint(0, 400), rng.randint(1, 20), rng.choice("pqrstu")) for _ in range(300)]
    frame = spark.createDataFrame(rows, "k string, t long, v long, m string")
    for row in sliding(frame, "k", "t", "v", "m", 30).collect():
        inside = [r for r in rows if r[0] == row["k"] and row["t"] - 30 <= r[1] <= row["t"]]
        assert row["total"] == sum(r[2] for r in inside) and row["members"] == len({r[3] for r in inside})


def test_dual_threshold_takes_a_smaller_window_with_enough_sources(spark):
    rows = [("S", 0, 500, "x")] + [("S", 1000 + k, 50, f"s{k}") for k in range(5)]
    frame = spark.createDataFrame(rows, "k string, t long, v long, m string")
    one = best_window(sliding(frame, "k", "t", "v", "m", 10), "k", "t", 200, 5).first()
    assert (one["total"], one["members"], one["window_end"]) == (250, 5, 1004)


def test_components_of_a_long_path(spark):
    links = [(f"n{k:03}", f"n{k + 1:03}") for k in range(60)] + [("z1", "z2"), ("z2", "z1")]
    roots = {r["addr"]: r["root"] for r in graph.components(spark.createDataFrame(links, "frm string, dst string")).collect()}
    assert len(roots) == 63 and set(roots.values()) == {"n000", "z1"} and roots["n060"] == "n000"


def test_session_gap_is_strict(spark):
    frame = spark.createDataFrame([("k", 0, 0), ("k", 10, 1), ("k", 21, 2)], "k string, ts long, seq long")
    assert [r["session"] for r in sequence.sessions(frame, "k", 10).orderBy("seq").collect()] == [1, 1, 2]


def test_spray_boundary_is_inclusive(spark):
    flow = lambda n, v: spark.createDataFrame([(k, 10, "A", f"r{k}", v) for k in range(n)], "seq long, ts long, frm string, dst string, v long")
    assert scanners.sprays(flow(20, 10), "ts", 100, 200, 20).count() == 1
    assert scanners.sprays(flow(19, 11), "ts", 100, 200, 20).count() == 0
    assert scanners.sprays(flow(20, 9), "ts", 100, 200, 20).count() == 0


def test_fresh_sprays_list_every_sender_of_a_first_receipt(spark, tmp_path):
    """One cent to one new account is a row, beside a sender of nearly all; refills of known accounts are none. The same from code and SQL."""
    day, rng = 86400, random.Random(4)
    flow = [(0, 1, 101, 0.01), (0, 2, 102, 9000.0), (3 * day, 2, 103, 9000.0), (20 * day, 2, 104, 500.0), (9, 3, 101, 800.0), (9, 3, 102, 800.0), (5, 4, 4, 70.0), (5, 5, 105, 0.0)]
    flow += [(rng.randint(0, 40 * day), rng.randint(10, 30), rng.randint(200, 260), rng.randint(0, 90) / 100) for _ in range(400)]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    con.executemany("INSERT INTO events VALUES (?, make_timestamp(?), ?, 'view', ?, ?)", [(k, t * 1_000_000, f, v, f'{{"k": {d}}}') for k, (t, f, d, v) in enumerate(flow)])
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    real = [(t, f, d, round(v * 100)) for t, f, d, v in flow if v > 0 and f != d]
    first = {d: min(t for t, _, x, _ in real if x == d) for _, _, d, _ in real}
    want = {}
    for f in {f for _, f, _, _ in real}:
        own = [(t, d, v) for t, s, d, v in real if s == f and t == first[d]]
        windows = [[(d, v) for t, d, v in own if end - 14 * day <= t <= end] + [end] for end in sorted({t for t, _, _ in own})]
        if windows:
            best = max(windows, key=lambda w: sum(v for _, v in w[:-1]))
            want[f"U{f}"] = (best[-1], sum(v for _, v in best[:-1]), len({d for d, _ in best[:-1]}))
    assert want["U1"] == (0, 1, 1) and want["U2"] == (3 * day, 1_800_000, 2) and not {"U3", "U4", "U5"} & set(want) and len(want) > 10
    columns = ["addr", "window_end", "total", "members"]
    ours = catalogue.queries()["sprays_pulse_fresh"](spark, str(tmp_path)).select(columns).collect()
    theirs = con.execute(f"SELECT {', '.join(columns)} FROM ({catalogue.oracle_sql()['sprays_pulse_fresh']})").fetchall()
    assert {r[0]: tuple(r[1:]) for r in ours} == want and len(ours) == len(want)
    assert {r[0]: tuple(r[1:]) for r in theirs} == want and len(theirs) == len(want)


def test_fresh_spray_thresholds_are_inclusive_and_pass_over_refills(spark):
    flow = lambda n, v, known=0: spark.createDataFrame([(1, "Z", f"r{k}", 1) for k in range(known)] + [(10, "A", f"r{k}", v) for k in range(n)], "ts long, frm string, dst string, v long")
    found = lambda *a: [r["addr"] for r in scanners.sprays(flow(*a), "ts", 100, 200, 20, fresh_only=True).collect()]
    assert found(20, 10) == ["A"] and found(19, 11) == [] and found(20, 9) == []
    assert found(21, 10, 1) == ["A"] and found(20, 11, 1) == [] and found(20, 100, 20) == []


def test_distribution_shapes(spark):
    smooth = [(f"s{k}", int(10_000_000 * 0.97**k) + k) for k in range(240)]
    held = lambda rows: spark.createDataFrame(rows, "addr string, balance long")
    assert [r["verdict"] for r in distribution.bumps(held(smooth)).collect()] == ["NORMAL"]
    assert "ABNORMAL" in [r["verdict"] for r in distribution.bumps(held(smooth + [(f"b{k}", 1_000_000) for k in range(80)])).collect()]
    assert distribution.bumps(held(smooth[:50])).first()["verdict"] == "NOT_EVALUABLE"


def test_isotonic_and_holm():
    assert distribution.isotonic_down([5, 1, 3, 2]) == [5, 2, 2, 2]
    assert distribution.holm([0.001, 0.02, 0.004]) == [True, False, True]
