"""Scenarios with known answers: files, wide amounts, faults, waves, provenance, pairing and states of labels."""

from __future__ import annotations

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import cost, curve25519, ledger, labels, methods, provenance, reconcile, scanners, waves, wide
from ledgerspark.sources import files

LEDGER = "block long, tx long, li long, frm string, dst string, v decimal(38,0)"


def transfers(spark, rows):
    return spark.createDataFrame([(*r[:5], Decimal(r[5])) for r in rows], LEDGER)


def test_closure_from_both_file_layouts(spark, tmp_path):
    """Random transfers with sinks, self-transfers and zeros: the same balances from CSV and from captured logs, and they close."""
    rng = random.Random(3)
    name = lambda k: "0x" + f"{k:040x}"
    zero, dead = files.ZERO_ADDRESS, files.DEAD_ADDRESS
    rows = [(0, 0, "m", 0, zero, name(1), 10**22)]
    rows += [(b, b * 12, f"t{b}-{k}", k, name(rng.randint(1, 5)), rng.choice([name(rng.randint(1, 5)), zero, dead]), rng.choice([0, rng.randint(1, 10**20)])) for b in range(1, 60) for k in range(3)]
    frame = spark.createDataFrame([(*r[:6], str(r[6]), "") for r in rows], "block long, ts long, tx string, li long, frm string, dst string, value string, block_hash string")
    files.write_csv(frame, str(tmp_path / "a"), legacy=True)
    files.write_csv(frame, str(tmp_path / "b"))
    topic = lambda a: "0x" + "0" * 24 + a[2:].upper()
    logs = [(b, f"h{b}", li, tx, topic(f), topic(d), "0x" + f"{v:064x}" if v else "0x") for b, _, tx, li, f, d, v in rows]
    spark.createDataFrame(logs, "block_number long, block_hash string, log_index long, transaction_hash string, topic1 string, topic2 string, data string").write.parquet(str(tmp_path / "c/run_1/logs.parquet"))
    spark.createDataFrame([(b, hex(b * 12)) for b in range(59)], "number long, timestamp string").write.parquet(str(tmp_path / "c/run_1/blocks.parquet"))
    found = []
    for part in ("a", "b", "c"):
        read = files.read_transfers(spark, str(tmp_path / part))
        own = files.narrow(read)
        one = ledger.stats(own).first()
        assert one["closes"] and one["sum_balances"] == 10**22 and own.count() == len(rows)
        found.append({r["addr"]: r["balance"] for r in ledger.balances(own).collect()})
        if part == "c":
            assert {r["ts"] for r in read.filter("block = 59").collect()} == {None} and files.read_logs(spark, str(tmp_path / part), keep_unknown_time=False).count() == len(rows) - 3
    assert found[0] == found[1] == found[2] and "DEAD" in found[0]


def test_wide_amounts(spark, tmp_path):
    """10^45 and its tenth, from a 32-byte word to a balance; the narrow path refuses them."""
    topic = lambda k: "0x" + f"{k:064x}"
    logs = [(0, 0, "m", topic(0), topic(1), f"0x{10**45:064x}"), (1, 0, "t", topic(1), topic(2), f"0x{10**44:064x}"), (2, 0, "u", topic(2), topic(3), f"0x{2**126:064x}"), (3, 0, "w", topic(3), topic(2), f"0x{2**126 - 1:064x}"), (4, 0, "x", topic(9), topic(2), f"0x{2**255:064x}")]
    spark.createDataFrame(logs, "block_number long, log_index long, transaction_hash string, topic1 string, topic2 string, data string").write.parquet(str(tmp_path / "logs.parquet"))
    rows = files.read_transfers(spark, str(tmp_path))
    assert {r["tx"]: int(r["value"]) for r in rows.collect()} == {"m": 10**45, "t": 10**44, "u": 2**126, "w": 2**126 - 1, "x": 2**255}
    probe = files.width_probe(rows).first()
    assert (probe["wide"], probe["longest"], probe["narrow"]) == (5, 77, False)
    name = lambda k: "0x" + f"{k:040x}"
    from pyspark.sql import functions as F

    held = wide.balances(rows.withColumn("frm", F.when(F.col("frm") == files.ZERO_ADDRESS, "ZERO").otherwise(F.col("frm"))))
    assert {r["addr"]: int(r["balance"]) for r in held.collect()} == {name(1): 9 * 10**44, name(2): 10**44 - 1 + 2**255, name(3): 1, name(9): -(2**255)}
    assert int(wide.total(rows, "value").first()["total"]) == 10**45 + 10**44 + 2**127 - 1 + 2**255
    with pytest.raises(Exception, match="more than 38 digits"):
        files.narrow(rows).collect()


def test_faults(spark):
    rows = [(0, 0, 0, "ZERO", "A", 100), (1, 1, 0, "A", "B", 60), (2, 2, 0, "B", "C", 50)]
    assert ledger.stats(transfers(spark, rows)).first()["negative_accounts"] == 0
    assert ledger.stats(transfers(spark, [rows[0], rows[2]])).first()["negative_accounts"] == 1
    assert not ledger.stats(transfers(spark, rows[1:])).first()["closes"] or ledger.stats(transfers(spark, rows[1:])).first()["negative_accounts"]
    assert ledger.stats(transfers(spark, rows[:2])).first()["closes"]
    kept, bad = reconcile.deduplicated_strict(transfers(spark, [*rows, (2, 2, 0, "B", "C", 51), rows[1]]), ["block", "tx", "li"], ["frm", "dst", "v"])
    assert kept.count() == 3 and [tuple(r)[:3] for r in bad.collect()] == [(2, 2, 0)]


def test_bad_rows_are_counted_and_tolerated(spark, tmp_path):
    (tmp_path / "x.csv").write_text("block,ts,tx,from,to,value_raw,uniqueId\n1,5,a,0xA,0xB,7,a:log:3\n2,6,b,0xA,0xB,1e5,b:log:4\nblock,ts,tx,from,to,value_raw,uniqueId\n3,,c,0xA,0xB,0008,c\n4,6,d,0xA,0xB,1,d:log:x\n")
    rows = files.read_transfers(spark, str(tmp_path / "x.csv"))
    assert sorted((r["block"], r["li"], r["value"], r["valid"], r["frm"]) for r in rows.select("block", "li", "value", "valid", "frm").fillna(-1, ["li"]).fillna("", ["value"]).collect()) == [(1, 3, "7", True, "0xa"), (2, 4, "", False, "0xa"), (3, 0, "8", True, "0xa"), (4, -1, "1", False, "0xa")]
    found = ledger.rejects(rows, rows["valid"], rows["block"] < 4, ["tx", "li"])
    assert not files.tolerated(found, 1).first()["passes"] and files.tolerated(found, 2).first()["passes"]


def test_edge_lines_are_validated(spark, tmp_path):
    good = [1, 2, 3, -1, "a", "b", "5"]
    lines = [good, good[:5], [*good[:6], "05"], [*good[:6], "0"], [1, 2, 3, -2, "a", "b", 5], [*good[:4], "", "b", 5], [1.5, *good[1:]]]
    (tmp_path / "e.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n\nnot json\n")
    rows = files.read_edge_lines(spark, str(tmp_path / "e.jsonl"))
    assert rows.count() == 8 and rows.filter("valid").count() == 1


def wave_ledger():
    """25 accounts of half a percent build up over three days and leave on day 22; a window of 19 and a group without weight stay alone."""
    rows, tx = [], 0
    one = 10**12
    for k in range(25):
        rows += [(100 + k % 3, tx + k, 0, "ZERO", f"w{k}", one // 200), (122, tx + 100 + k, 0, f"w{k}", "OUT", one // 200)]
    rows += [(200 + k % 3, 500 + k, 0, "ZERO", f"n{k}", one // 100) for k in range(19)]
    rows += [(300 + k % 3, 600 + k, 0, "ZERO", f"s{k}", one * 63 // 1000 // 30) for k in range(30)]
    return rows


def test_wave_is_found_once(spark):
    rows = transfers(spark, wave_ledger())
    daily = ledger.daily_deltas(rows, rows["block"])
    summary = scanners.summaries(daily).filter("addr <> 'OUT'")
    found = waves.waves(daily, summary, 10**11, days=10, members=20).collect()
    assert len(found) == 1
    one = found[0]
    assert (one["first_day"] <= 100, one["last_day"] >= 102, one["members"], one["cleared"], int(one["peak"])) == (True, True, 25, 25, 25 * 10**12 // 200)


def test_adjacent_waves_merge_by_their_peak(spark):
    rows = [(10 + k % 2, k, 0, "ZERO", f"a{k}", 1000) for k in range(20)] + [(25 + k % 2, 100 + k, 0, "ZERO", f"b{k}", 1000) for k in range(20)]
    frame = transfers(spark, rows)
    daily = ledger.daily_deltas(frame, frame["block"])
    flows = waves.day_flows(daily, scanners.summaries(daily))
    parts = [(10, 19, (10, 19)), (25, 34, (25, 34))]
    assert [(a, b, p) for a, b, p, _ in waves.merged(flows, parts)] == [(10, 34, 40_000)]
    assert len(waves.merged(flows, parts, gap=5)) == 2 and len(waves.merged(flows, parts, gain_pct=250)) == 2


def traced(spark, rows, members, terminals, exact=True):
    frame = spark.createDataFrame([(*r, exact) for r in rows], "ts long, seq long, frm string, dst string, v long, exact boolean")
    nodes = provenance.subgraphs(frame, spark.createDataFrame(members, "entity string, addr string"), spark.createDataFrame(terminals, "addr string, kind string"))
    found = provenance.simulated(frame, nodes, ["ts", "seq"] if exact else ["ts"], "exact", "seq")
    out = {}
    for r in found.collect():
        out.setdefault((r["entity"], r["policy"]), {})[r["kind"]] = round(r["amount"], 6)
    return out


ENDS = [("ZERO", "MINT"), ("P", "POOL")]


def test_provenance_keeps_the_proportions_of_what_is_left(spark):
    rows = [(1, 1, "ZERO", "M", 100), (2, 2, "M", "Z", 90), (3, 3, "P", "M", 90), (4, 4, "M", "E", 100)]
    assert traced(spark, rows, [("e", "E")], ENDS)["e", "pro_rata"] == {"MINT": 10, "POOL": 90}


def test_provenance_policies_differ(spark):
    rows = [(1, 1, "ZERO", "E", 100), (2, 2, "P", "E", 100), (3, 3, "E", "Z", 100)]
    found = traced(spark, rows, [("e", "E")], ENDS)
    assert [found["e", p] for p in ("fifo", "lifo", "pro_rata")] == [{"POOL": 100}, {"MINT": 100}, {"MINT": 50, "POOL": 50}]


def test_provenance_of_unknown_order_and_of_gaps(spark):
    rows = [(1, 1, "ZERO", "X", 100), (1, 2, "X", "E", 100)]
    assert traced(spark, rows, [("e", "E")], ENDS, exact=False)["e", "pro_rata"] == {provenance.AMBIGUOUS: 100}
    assert traced(spark, rows, [("e", "E")], ENDS)["e", "pro_rata"] == {"MINT": 100}
    assert traced(spark, [(1, 1, "ZERO", "X", 30), (2, 2, "X", "E", 100)], [("e", "E")], ENDS)["e", "lifo"] == {"MINT": 30, provenance.GAP: 70}
    inner = [(1, 1, "ZERO", "E1", 50), (2, 2, "E1", "E2", 50), (3, 3, "E2", "Z", 20)]
    assert traced(spark, inner, [("e", "E1"), ("e", "E2"), ("f", "Z")], ENDS) == {("e", p): {"MINT": 30} for p in provenance.POLICIES} | {("f", p): {"MINT": 20} for p in provenance.POLICIES}


def test_provenance_equals_exact_fractions(spark):
    """Random chains against an account book in fractions."""
    from fractions import Fraction

    rng = random.Random(5)
    names = [f"n{k}" for k in range(6)]
    rows = [(t, t, rng.choice(["ZERO", "P", *names]), rng.choice(names), rng.randint(1, 50)) for t in range(80)]
    books = {}
    for _, _, frm, dst, v in rows:
        if frm == dst:
            continue
        if frm in ("ZERO", "P"):
            parts = {dict(ENDS)[frm]: Fraction(v)}
        else:
            have = books.get(frm, {})
            stock = sum(have.values())
            share = min(Fraction(1), Fraction(v) / stock) if stock else Fraction(0)
            parts = {k: x * share for k, x in have.items()}
            books[frm] = {k: x * (1 - share) for k, x in have.items()}
            if v > stock:
                parts[provenance.GAP] = parts.get(provenance.GAP, 0) + v - stock
        own = books.setdefault(dst, {})
        for k, x in parts.items():
            own[k] = own.get(k, 0) + x
    found = traced(spark, rows, [("e", "n0")], ENDS)
    assert found["e", "pro_rata"] == pytest.approx({k: float(x) for k, x in books["n0"].items() if x})


def test_pairing_is_deterministic(spark):
    rows = [("t", "A", -10), ("t", "B", -10), ("t", "C", 10), ("t", "D", 10), ("u", "A", -7), ("u", "B", 3), ("v", "A", 4)]
    for order in (rows, rows[::-1]):
        got = reconcile.pairings(spark.createDataFrame(order, "tx string, owner string, delta long")).collect()
        assert {(r["tx"], r["frm"], r["dst"], r["v"]) for r in got} == {("t", "A", "C", 10), ("t", "B", "D", 10), ("u", "A", "B", 3), ("u", "A", "ZERO", 4), ("v", "ZERO", "A", 4)}


def test_merged_ranges_pass_over_contained_ones(spark):
    ranges = spark.createDataFrame([(0, 100), (10, 20), (30, 40), (90, 120), (121, 130), (140, 150)], "lo long, hi long")
    assert sorted((r["lo"], r["hi"]) for r in reconcile.merged_ranges(ranges).collect()) == [(0, 120), (121, 130), (140, 150)]


def test_upsert_folds_rows_in_the_order_of_arrival(spark):
    columns = ["name", "category", "tier", "evidence", "merge_policy", "balance_policy", "status", "risk_flags"]
    rows = [
        (1, "tokens", "First", "whale", "identity", "", "", "", "", ""),
        (2, "dune", "", "mixer", "risk", "e1", "", "", "", ""),
        (3, "jup", "Low", "dex", "identity", "e2", "no_merge", "", "", ""),
        (4, "curation", "Top", "cex", "exclude", "", "allow", "", "", "tornado-user"),
        (5, "manual", "Late", "bridge", "exclude", "e3", "no_merge", "bucket", "historical", ""),
    ]
    frame = spark.createDataFrame([("eth", "a", *r) for r in rows], "chain string, address string, arrival long, source string, " + ", ".join(f"{c} string" for c in columns))
    one = labels.upserted(frame).first()
    assert [one[c] for c in ("name", "category", "tier", "evidence", "merge_policy", "balance_policy", "status", "source", "risk_flags")] == ["Top", "cex", "exclude", "e1", "allow", "bucket", "historical", "tokens+dune+jup+curation+manual", "mixer|tornado-user"]


def test_curve_points():
    base = bytes.fromhex("58" + "66" * 31)
    assert curve25519.is_point(base) and curve25519.is_point(b"\0" * 32) and curve25519.is_point(b"x" * 31) is None
    assert curve25519.key_bytes("1" * 32) == b"\0" * 32 and curve25519.key_bytes("0") is None
    on = sum(curve25519.is_point(random.Random(k).randbytes(32)) for k in range(200))
    assert 60 < on < 140


def test_taint_closes(spark):
    rows = [("a", 1, 1, 100, 50), ("a", 2, 2, -40, 0), ("a", 3, 3, 40, 0), ("a", 4, 4, -100, 0), ("b", 1, 1, -5, 0)]
    found = {r["addr"]: tuple(r)[1:] for r in cost.tainted(spark.createDataFrame(rows, "addr string, ts long, seq long, amount long, taint long")).collect()}
    assert found == {"a": (50, 50, 0), "b": (0, 0, 0)}


def test_retention_chance(spark):
    rows = [(1, True)] * 5 + [(2, False)] * 5
    found = {r["window"]: (r["rate"], round(r["p"], 9)) for r in methods.retention_test(spark.createDataFrame(rows, "window int, long_holder boolean")).collect()}
    assert found == {1: (1.0, round(1 / 252, 9)), 2: (0.0, 1.0)}


@pytest.mark.parametrize("policy", provenance.POLICIES)
def test_provenance_of_few_entities_by_shared_ranges_is_that_of_dealt_transfers(spark, monkeypatch, policy):
    """Overlapping subgraphs over many ranges, also of unknown order, and one task for each entity; no transfer is copied for each entity."""
    rng = random.Random(11)
    names = ["ZERO", "P", *(f"A{k}" for k in range(12))]
    rows = [(k // 3, k, rng.choice(names), rng.choice(names), rng.randint(1, 50)) for k in range(900)]
    frame = spark.createDataFrame([(*r, r[0] % 4 > 0) for r in rows], "ts long, seq long, frm string, dst string, v long, exact boolean").withColumn("kind", F.lit("view"))
    members = spark.createDataFrame([(f"e{k}", f"A{k}") for k in range(5)] + [("e0", "A7"), ("e1", "P")], "entity string, addr string")
    nodes = provenance.subgraphs(frame, members, spark.createDataFrame(ENDS, "addr string, kind string"))
    shared = provenance.simulated(frame, nodes, ["ts"], "exact", "seq", (policy,))
    assert shared.rdd.getNumPartitions() == 5
    one = {(r["entity"], r["kind"]): round(r["amount"], 6) for r in shared.collect()}
    monkeypatch.setattr(provenance, "SHARED", 0)
    other = {(r["entity"], r["kind"]): round(r["amount"], 6) for r in provenance.simulated(frame, nodes, ["ts"], "exact", "seq", (policy,)).collect()}
    assert one == other and {k for _, k in one} >= {"MINT", "POOL", provenance.AMBIGUOUS}
