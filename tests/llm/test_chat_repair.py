"""Repair of conversations against a plain search over whole conversations, and its defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import DATA

from ledgerspark.llm import _common, chat_repair
from ledgerspark.llm import queries as llm

SMALL = str(DATA / "sf0.001")
SCHEMA = "conv_id long, turn long, role string, text string, conv string, gone int"
GAPS = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
WANTS = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def plain_edits(rows):
    """Least (cost, edits) over rows of (initial, must go, cut off): the whole strings of all states, from the last row to the first."""
    after = {s: (0, "") if s in ("", "a") else (10**9, "") for s in WANTS}
    for at in range(len(rows), -1, -1):
        now = dict(after) if at == len(rows) else {s: (10**9, "") for s in WANTS}
        if at < len(rows):
            initial, must, cut = rows[at]
            for s in WANTS:
                found = [(after[s][0] + 3, "D" + after[s][1])]
                if not must:
                    c, e = after[WANTS[s][0]]
                    found.append((c + 2 + cut, "R" + e))
                    if (s, initial) in NEXT:
                        c, e = after[NEXT[s, initial]]
                        found.append((c + cut, "K" + e))
                now[s] = min(found)
        for _ in range(4):
            for s in WANTS:
                c, e = now[WANTS[s][0]]
                now[s] = min(now[s], (c + 2, "I" + e))
        after = now
    return after[""]


def plain_repair(talks, damaged=True):
    kept = []
    for conv, turn, role, text in talks:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [] if kind == 0 else [(conv, turn, role, text)] * (1 + (kind == 3))
    digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    first = lambda x: (x is not None, x)
    by = {c: [] for c, *_ in talks}
    for r in sorted(kept, key=lambda r: (first(r[1]), r[2].encode(), digest(r))):
        by[r[0]].append(r[1:])
    out = []
    for conv, rows in by.items():
        seen, faults, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            body = text.strip(GAPS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            faults.append(fault)
        initials = [r[1][:1] for r in rows]
        turns = [t for t, *_ in rows if t is not None]
        cost, edits = plain_edits(tuple((i, f in ("blank", "duplicate"), int(f == "truncated")) for i, f in zip(initials, faults)))
        made, at, state = [], 0, ""
        for e in edits:
            if e in "IR":
                made.append(f"{WANTS[state]}:{rows[at][2] if e == 'R' else ''}")
                state = WANTS[state][0]
            elif e == "K":
                made.append(f"{rows[at][1]}:{rows[at][2]}")
                state = initials[at]
            at += e != "I"
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, *counts.values(), illegal, cost, edits, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_query_by_brute_force(spark):
    talks = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    ours = llm.queries()["op12_chat_repair"](spark, SMALL)
    assert ours.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert rows_of(ours) == plain_repair(talks)


def any_talks(seed, convs, rows):
    rng = random.Random(seed)
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "tool", None, "", "u", "Ätool", "supervisor"]
    texts = ["Yes.", "No", "Why? \n", "", " \t", None, "a.b", "end!", "énd.\x0b", " ", "x"]
    return [(rng.choice(convs), rng.choice([None, 0, 1, 2, 3, 5, 9, -4]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"t{rng.randrange(10**6)}.") for _ in range(rows)]


def test_awkward_rows(spark):
    talks = any_talks(1, [None, *range(40)], 600) + [(77, None, "user", "Only null turns."), (78, 2**62, "user", "x."), (78, -(2**62), "assistant", "y." * 100_000)]
    frame = spark.createDataFrame([(*t, "x", 1) for t in talks], SCHEMA)
    for damaged in (True, False):
        assert rows_of(chat_repair.audit(frame, damaged=damaged)) == plain_repair(talks, damaged)
    assert chat_repair.audit(frame.limit(0), damaged=True).count() == 0


def test_dropped_rows_leave_their_conversation(spark):
    gone = [(c, t) for c in range(300) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    talks = [(c, t, "user", "Hi.") for c, t in gone]
    assert rows_of(chat_repair.audit(spark.createDataFrame(talks, "conv_id long, turn long, role string, text string"), damaged=True)) == plain_repair(talks)


@pytest.mark.parametrize("size", [1, 3, 64])
def test_hot_conversation_in_pieces(spark, monkeypatch, size):
    """A conversation of most rows is solved piece by piece, with the edits of the whole; also with pieces of single rows."""
    talks = [(1, k // 3, *t[2:]) for k, t in enumerate(any_talks(2, [1], 900))] + any_talks(3, range(2, 30), 300)
    frame = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").repartition(4)
    segments = chat_repair._segments

    def small_batches(rows):
        """Segments end where an Arrow batch does."""
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
        try:
            return _common.cut(segments(rows))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

    monkeypatch.setattr(chat_repair, "_segments", small_batches)
    assert rows_of(chat_repair.audit(frame)) == plain_repair(talks, False)
    turns = chat_repair.repair(frame.withColumnRenamed("conv_id", "conv")).turns().filter("conv = 1").orderBy("place", "number").collect()
    joined = "\n".join(f"{r['role']}:{r['text']}" for r in turns)
    assert hashlib.sha256(joined.encode()).hexdigest() == next(r[-1] for r in plain_repair(talks, False) if r[0] == 1)


def test_most_rows_are_equal(spark):
    talks = [(None, None, "user", "Same.")] * 2500 + [(5, k, "user", f"{k}.") for k in range(40)]
    assert rows_of(chat_repair.audit(spark.createDataFrame(talks, "conv_id long, turn long, role string, text string"))) == plain_repair(talks, False)


def test_tensors_by_plain_search():
    rng = np.random.default_rng(4)
    rows = [[(rng.integers(4), rng.integers(4)) for _ in range(rng.integers(0, 40))] for _ in range(400)]
    codes = [np.array([i + 4 * f for i, f in r], np.uint8) for r in rows]
    edits, costs, _ = chat_repair.solve(codes, np.zeros(len(rows), int), chat_repair._ended(len(rows)), np.full(len(rows), True))
    plain = [plain_edits(tuple((" sua"[i], f in (1, 2), int(f == 3)) for i, f in r)) for r in rows]
    assert list(zip(costs.tolist(), edits, strict=True)) == plain
    halves = [chat_repair.matrices([c[: len(c) // 2] for c in codes]), chat_repair.matrices([c[len(c) // 2 :] for c in codes])]
    joined = (halves[0][:, :, :, None] + halves[1][:, None]).min(axis=2)
    assert ((joined + chat_repair._ended(1)).min(axis=2)[:, 0] == costs).all()
