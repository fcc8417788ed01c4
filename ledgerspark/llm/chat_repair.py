"""Repair of the structure of conversations: the cheapest edits after which roles take turns properly.

A repaired conversation is empty or has an optional system turn and then pairs of a user's and an
assistant's turn. Edits are (K)eep at 0, (R)erole to user or assistant at 2, (D)elete at 3
and (I)nsert an empty user or assistant turn at 2; a blank row or a duplicate must be deleted; a
truncated row that stays adds 1. Which role comes next is fixed by a small automaton (nothing
yet, after system, after user, after assistant), so a string of edits says all; of the cheapest ones
the least in ASCII order is taken.

Rows are sorted by ranges of (conversation, turn, role, digest), and each task cuts its batches into
segments: runs of rows of one conversation. Segments are bucketed by length into time-major
tensors; costs of all automaton states of all segments of a bucket go backward together, one row
a step, and are kept; edits are then read off forward, together again.

Nearly every conversation is one segment and is finished where it is (``whole``). One that reaches
over a batch, a task or ``SEGMENT`` rows is in pieces: each piece is reduced to a min-plus matrix of
its four states; the matrices are applied from the end, in a stream, which gives costs at the end of
each piece; a piece then maps states before it to states after it, and the maps, applied
from the start in a stream, give its first state. So the edits are those of the whole
conversation, no task holds more than one piece of it, and of a conversation with most of the rows a
single task streams only a row for each thousand. Two things are one stream by their nature: the
digest of all text of a conversation and its string of edits.

Defined cases: null roles and texts are one space (so such a text is blank); rows are ordered by
turn (nulls first), then role, then digest of role and text; repeated rows are duplicates;
a null conversation id is a conversation; an empty role has no initial; gaps beyond 64 bits are
cut to the largest long; an empty table gives no rows; other columns of whatever names are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm._common import bounded_batches, cut, fresh_path

SEGMENT = 1024
#: Cells (rows of the longest x segments) of one tensor.
CELLS = 1 << 19

START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT, NONE = range(5)
#: The state after an inserted or reroled turn: user's turn, but after a user the assistant's.
STEP = np.array([AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER])
#: The state after a kept row, by state and initial (other, s, u, a).
KEEP = np.full((4, 4), NONE)
KEEP[START, 1] = AFTER_SYSTEM
KEEP[[START, AFTER_SYSTEM, AFTER_ASSISTANT], 2] = AFTER_USER
KEEP[AFTER_USER, 3] = AFTER_ASSISTANT
NAMES = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What is still to insert at the end of a conversation, by state.
TAIL = np.array([0, 2, 1, 0])
FAR = 1 << 40
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)
#: Code of a step after the end of a segment; other codes are initial + 4 x fault.
PAST = 255

_GAP, _NOT_GAP = "[ \\t\\n\\x0B\\f\\r]", "[^ \\t\\n\\x0B\\f\\r]"


def damage(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone): rows damaged by a hash of conversation and turn.

    One in twenty each: dropped (``gone``, so that its conversation is still known), emptied, without
    full stops, repeated, made a user's.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    text, role = F.coalesce(F.col(text_col), blank), F.coalesce(F.col(role_col), blank)
    rows = talks.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("_kind"))
    kind = F.col("_kind")
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    changed = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), (kind == 0).alias("gone"), copies).drop("_copy")


def _rows_in_order(rows: DataFrame) -> DataFrame:
    """Rows sorted by ranges; equal rows have a number of their own, so that ranges split them, too."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select("conv", "turn", role.alias("role"), text.alias("text"), "gone")
    rows = rows.withColumns({"digest": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))), "_row": F.monotonically_increasing_id()})
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "_row"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row").withColumn("place", F.monotonically_increasing_id())


def _segments(rows: DataFrame) -> DataFrame:
    """(conv, place, open, turns, roles, texts, digests): runs of rows; ``open``: the conversation may go on beside it."""
    conv, turn = rows.schema["conv"], rows.schema["turn"]
    lists = [T.StructField("turns", T.ArrayType(turn.dataType)), *[T.StructField(n, T.ArrayType(k)) for n, k in (("roles", T.StringType()), ("texts", T.StringType()), ("digests", T.BinaryType()))]]
    schema = T.StructType([conv, T.StructField("place", T.LongType()), T.StructField("open", T.BooleanType()), *lists])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column("conv")
            # Null and value differ; two nulls don't.
            known = np.asarray(key.is_valid())
            same = np.asarray(pc.fill_null(pc.equal(key.slice(1), key.slice(0, n - 1)), False)) | ~(known[1:] | known[:-1])
            runs = np.concatenate(([0], np.flatnonzero(~same) + 1))
            of = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, n)))
            within = np.arange(n) - runs[of]
            starts = np.flatnonzero(within % SEGMENT == 0)
            run = of[starts]
            opens = (run == 0) | (run == len(runs) - 1) | (np.bincount(run)[run] > 1)
            stays = ~np.asarray(batch.column("gone"))
            offsets = pa.array(np.concatenate(([0], np.cumsum(stays)))[np.append(starts, n)].astype(np.int32))
            columns = [pa.ListArray.from_arrays(offsets, batch.column(c).filter(pa.array(stays))) for c in ("turn", "role", "text", "digest")]
            at = pa.array(starts)
            yield pa.RecordBatch.from_arrays([key.take(at), batch.column("place").take(at), pa.array(opens), *columns], names=schema.names)

    return rows.mapInArrow(work, schema)


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """All values in a row and the number of values of each list."""
    return lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def row_codes(roles: pa.Array, texts: pa.Array, repeated: np.ndarray) -> np.ndarray:
    """Initial (other, s, u, a) + 4 x first fault of each row."""
    initial = pc.index_in(pc.utf8_slice_codeunits(roles, 0, 1), pa.array(["s", "u", "a"]))
    initial = np.asarray(pc.fill_null(initial, -1)).astype(np.int64) + 1
    blank = ~np.asarray(pc.match_substring_regex(texts, _NOT_GAP), dtype=bool)
    ends = np.asarray(pc.match_substring_regex(texts, f"[.!?]{_GAP}*\\z"), dtype=bool)
    return (initial + 4 * np.where(blank, BLANK, np.where(repeated, DUPLICATE, np.where(ends, FINE, CUT_OFF)))).astype(np.uint8)


def _buckets(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of segments of like length, at most ``CELLS`` cells a bucket."""
    order = np.argsort(sizes, kind="stable")[::-1]
    at = 0
    while at < len(order):
        top = max(1, int(sizes[order[at]]))
        like = int(np.searchsorted(-sizes[order[at:]], -(top // 2), side="right"))
        take = max(1, min(like, CELLS // top))
        yield order[at : at + take]
        at += take


def _tensor(codes: list[np.ndarray]) -> np.ndarray:
    """Codes of segments, time-major: [row, segment]."""
    out = np.full((max(map(len, codes), default=0), len(codes)), PAST, np.uint8)
    for k, c in enumerate(codes):
        out[: len(c), k] = c
    return out


def backward(codes: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least costs [row, segment, state, goal] from before each row to the end, where state ``s`` costs ``end[segment, s, goal]``.

    Insertions come before a row, so none are counted after the last.
    """
    steps, n = codes.shape
    cost = np.full((steps + 1, n, 5, end.shape[2]), FAR, np.int64)
    cost[steps, :, :4] = end
    each = np.arange(n)[:, None]
    for t in range(steps - 1, -1, -1):
        after, c = cost[t + 1], codes[t]
        fault = c >> 2
        more = (TRUNCATED * (fault == CUT_OFF))[:, None, None]
        stays = np.minimum(after[each, KEEP[:, c & 3].T], after[:, STEP] + REROLE) + more
        stays[(fault == BLANK) | (fault == DUPLICATE)] = FAR
        base = np.minimum(stays, after[:, :4] + DELETE)
        best = np.minimum(base, np.minimum(base[:, STEP] + INSERT, base[:, STEP[STEP]] + 2 * INSERT))
        past = c == PAST
        best[past] = after[past, :4]
        cost[t, :, :4] = best
    return cost


def forward(codes: np.ndarray, cost: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edits [row, step, segment], last state): the least string of cheapest edits; a row takes at most two insertions and one other edit."""
    steps, n = codes.shape
    edits = np.zeros((steps, 3, n), np.uint8)
    state, each = state.copy(), np.arange(n)
    for t in range(steps):
        c, waits = codes[t], codes[t] != PAST
        fault, now, after = c >> 2, cost[t, :, :, 0], cost[t + 1, :, :, 0]
        stays, more = (fault == FINE) | (fault == CUT_OFF), TRUNCATED * (fault == CUT_OFF)
        for k in range(3):
            if not waits.any():
                break
            best, step, kept = now[each, state], STEP[state], KEEP[state, c & 3]
            deletes = after[each, state] + DELETE == best
            inserts = ~deletes & (now[each, step] + INSERT == best)
            keeps = ~deletes & ~inserts & stays & (after[each, kept] + more == best)
            edit = np.where(deletes, ord("D"), np.where(inserts, ord("I"), np.where(keeps, ord("K"), ord("R"))))
            edits[t, k] = np.where(waits, edit, 0)
            state = np.where(waits & ~deletes, np.where(keeps, kept, step), state)
            waits = waits & inserts
    return edits, state


def solve(codes: list[np.ndarray], before: np.ndarray, end: np.ndarray, last: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(edits, cost, state after) of each segment that begins in state ``before`` and whose states at the end cost ``end``; ``last``: nothing follows."""
    edits: list[str] = [""] * len(codes)
    costs, states = np.zeros(len(codes), np.int64), before.astype(np.int64)
    for some in _buckets(np.array(list(map(len, codes)), np.int64)):
        tensor = _tensor([codes[k] for k in some])
        table = backward(tensor, end[some][:, :, None])
        traced, states[some] = forward(tensor, table, before[some])
        each = np.arange(len(some))
        costs[some] = table[0, each, before[some], 0] - np.where(last[some], 0, end[some, states[some]])
        columns = np.ascontiguousarray(traced.reshape(-1, len(some)).T)
        for row, k in enumerate(some):
            tail = "I" * int(TAIL[states[k]]) if last[k] else ""
            edits[k] = columns[row][columns[row] != 0].tobytes().decode() + tail
    return edits, costs, states


def matrices(codes: list[np.ndarray]) -> np.ndarray:
    """Least cost [segment, state before, state after]."""
    out = np.zeros((len(codes), 4, 4), np.int64)
    goal = np.where(np.eye(4, dtype=bool), 0, FAR)
    for some in _buckets(np.array(list(map(len, codes)), np.int64)):
        tensor = _tensor([codes[k] for k in some])
        out[some] = backward(tensor, np.tile(goal, (len(some), 1, 1)))[0, :, :4]
    return np.minimum(out, FAR)


def applied(edits: str, state: int, roles: list[str], texts: list[str]) -> list[dict[str, str]]:
    """The turns that ``edits`` make of a segment's rows."""
    turns, at = [], 0
    for edit in edits:
        if edit == "I":
            state = int(STEP[state])
            turns.append({"role": NAMES[state], "text": ""})
            continue
        if edit == "K":
            state = int(KEEP[state, " sua".find(roles[at][:1])])
            turns.append({"role": roles[at], "text": texts[at]})
        elif edit == "R":
            state = int(STEP[state])
            turns.append({"role": NAMES[state], "text": texts[at]})
        at += 1
    return turns


#: What is known of a piece besides its rows; turns are those that aren't null.
_FACTS = "rows long, first_turn long, last_turn long, turns_seen long, first_initial int, last_initial int, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_TURNS = "array<struct<role:string,text:string>>"


def _facts(codes: list[np.ndarray], turns: list[list[int | None]]) -> list[list]:
    """The columns of ``_FACTS`` before ``cost``."""
    out: list[list] = [[] for _ in range(10)]
    legal = {(1, 2), (2, 3), (3, 2)}
    for c, t in zip(codes, turns, strict=True):
        known, initial, fault = [x for x in t if x is not None], (c & 3).tolist(), c >> 2
        illegal = sum(p not in legal for p in zip(initial, initial[1:], strict=False))
        row = [len(c), known[0] if known else None, known[-1] if known else None, len(set(known)), initial[0] if initial else None, initial[-1] if initial else None]
        row += [*(int((fault == f).sum()) for f in (BLANK, DUPLICATE, CUT_OFF)), illegal]
        for column, x in zip(out, row, strict=True):
            column.append(x)
    return out


def _ended(n: int) -> np.ndarray:
    """Costs at the end of conversations: what is to be inserted."""
    return np.tile(INSERT * TAIL, (n, 1))


@dataclass
class Repaired:
    """Repaired conversations: (conv, place, facts, audit, repaired), in one row (``whole``) or one row for each piece (``pieces``), whose places are in order."""

    whole: DataFrame
    pieces: DataFrame

    def turns(self) -> DataFrame:
        """(conv, place, number, role, text): all repaired turns; (place, number) is their order within a conversation."""
        both = self.whole.unionByName(self.pieces)
        return both.select("conv", "place", F.posexplode("repaired").alias("number", "turn")).select("conv", "place", "number", "turn.role", "turn.text")

    def summary(self) -> DataFrame:
        """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
        out = T.StructType([self.whole.schema["conv"], *T.StructType.fromDDL("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string").fields])
        ordered = self.pieces.repartition("conv").sortWithinPartitions("conv", "place")
        return self.whole.mapInArrow(lambda b: _summed(b, out.names), out).unionByName(ordered.mapInArrow(lambda b: _summed(b, out.names), out))


def _summed(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its pieces, which come one after the other; only sums, the edits and the state of the digest are kept."""

    def result() -> tuple:
        gaps = min(last - first + 1 - seen, 2**63 - 1) if seen else 0
        return (key, gaps, *sums, "".join(audit), digest.hexdigest())

    begun, key = False, None
    kind = None
    for batch in batches:
        out, kind = [], batch.schema.field("conv").type
        for row in batch.to_pylist():
            if not begun or row["conv"] != key:
                if begun:
                    out.append(result())
                begun, key, sums, audit, digest = True, row["conv"], [0] * 5, [], hashlib.sha256()
                first, last, seen, initial, empty = None, None, 0, None, True
            if row["turns_seen"]:
                seen += row["turns_seen"] - (row["first_turn"] == last)
                first, last = row["first_turn"] if first is None else first, row["last_turn"]
            sums = [x + row[c] for x, c in zip(sums, ("blank", "duplicate", "truncated", "illegal", "cost"), strict=True)]
            if row["rows"]:
                sums[3] += initial is not None and (initial, row["first_initial"]) not in {(1, 2), (2, 3), (3, 2)}
                initial = row["last_initial"]
            audit.append(row["audit"])
            for turn in row["repaired"]:
                digest.update(f"{'' if empty else chr(10)}{turn['role']}:{turn['text']}".encode())
                empty = False
        yield _batch(out, kind, names)
    if begun:
        yield _batch([result()], kind, names)


def _batch(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _solved(batch: pa.RecordBatch, codes: list[np.ndarray], before: np.ndarray, end: np.ndarray, last: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Segments with their facts, edits and repaired turns."""
    edits, costs, _ = solve(codes, before, end, last)
    roles, texts, turns = (batch.column(c).to_pylist() for c in ("roles", "texts", "turns"))
    repaired = [applied(e, int(s), r, t) for e, s, r, t in zip(edits, before, roles, texts, strict=True)]
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()] * 4
    facts = [pa.array(c, k) for c, k in zip(_facts(codes, turns), kinds, strict=True)]
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    return pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("place"), *facts, pa.array(costs), pa.array(edits, pa.string()), pa.array(repaired, turn)], names=names)


def _codes(batch: pa.RecordBatch, repeated: np.ndarray | None = None) -> list[np.ndarray]:
    """Codes of each segment of a batch; ``repeated``: which rows are duplicates, else those of a row of the same segment."""
    (roles, sizes), (texts, _) = _flat(batch.column("roles")), _flat(batch.column("texts"))
    if repeated is None:
        repeated = _repeated(batch)
    return np.split(row_codes(roles, texts, repeated), np.cumsum(sizes)[:-1]) if len(sizes) else []


def _repeated(batch: pa.RecordBatch) -> np.ndarray:
    digests, sizes = _flat(batch.column("digests"))
    return pd.DataFrame({"segment": np.repeat(np.arange(len(sizes)), sizes), "digest": digests.to_pylist()}).duplicated().to_numpy(dtype=bool)


def repair(rows: DataFrame) -> Repaired:
    """Repair conversations of rows (conv, turn, role, text) with, optionally, ``gone``: a row that only says that its conversation exists."""
    spark = rows.sparkSession
    bounded_batches(spark)
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    path = fresh_path(spark, "chat-segments")
    _segments(_rows_in_order(rows)).write.parquet(path)
    segments = spark.read.parquet(path)
    conv = segments.schema["conv"]
    result = T.StructType([conv, T.StructField("place", T.LongType()), *T.StructType.fromDDL(f"{_FACTS}, repaired {_TURNS}").fields])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            yield _solved(batch, _codes(batch), np.full(n, START), _ended(n), np.full(n, True), result.names)

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.frombuffer(x, np.uint8) for x in batch.column("codes").to_pylist()]
            before = batch.column("before").to_numpy(zero_copy_only=False)
            last = np.asarray(batch.column("last"), dtype=bool)
            end = np.array(batch.column("end").to_pylist(), np.int64).reshape(-1, 4)
            yield _solved(batch, codes, before, end, last, result.names)

    whole = segments.filter("not open").mapInArrow(alone, result)
    pieces = segments.filter("open")
    seams = _seams(pieces).select(F.col("place").alias("p"), "codes", "last", "end", "before")
    return Repaired(whole, pieces.join(seams, pieces["place"] == F.col("p")).mapInArrow(piece, result))


def _seams(pieces: DataFrame) -> DataFrame:
    """(conv, place, codes, last, end, before) of each piece: its rows' codes, costs of states at its end, and the state before it."""
    conv = pieces.schema["conv"]
    place, codes, last, end, before = (T.StructField(n, k) for n, k in (("place", T.LongType()), ("codes", T.BinaryType()), ("last", T.BooleanType()), ("end", T.ArrayType(T.LongType())), ("before", T.IntegerType())))
    matrix, passes = T.StructField("matrix", T.ArrayType(T.LongType())), T.StructField("passes", T.ArrayType(T.IntegerType()))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that their piece has no earlier equal of, each by its number, and all codes."""
        for batch in batches:
            repeated = _repeated(batch)
            own = np.split(~repeated, np.cumsum(_flat(batch.column("digests"))[1])[:-1]) if batch.num_rows else []
            coded = [c.tobytes() for c in _codes(batch, repeated)]
            news = [[{"digest": d, "number": k} for k, (d, new) in enumerate(zip(ds, o, strict=True)) if new] for ds, o in zip(batch.column("digests").to_pylist(), own, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("place"), pa.array(coded, pa.binary()), pa.array(news, pa.list_(pa.struct([("digest", pa.binary()), ("number", pa.int32())])))], names=["conv", "place", "codes", "news"])

    news = T.StructField("news", T.ArrayType(T.StructType.fromDDL("digest binary, number int")))
    known = cut(pieces.mapInArrow(local, T.StructType([conv, place, codes, news])))
    each = known.select("conv", "place", F.explode("news").alias("new")).select("conv", "place", "new.*")
    firsts = each.groupBy("conv", "digest").agg(F.min(F.struct("place", "number")).alias("at")).select("at.*")
    # At most ``SEGMENT`` numbers a piece.
    firsts = firsts.groupBy(F.col("place").alias("p")).agg(F.collect_list("number").alias("firsts"))
    known = known.select("conv", "place", "codes").join(firsts, F.col("place") == F.col("p"), "left").drop("p")

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = []
            for raw, first in zip(batch.column("codes").to_pylist(), batch.column("firsts").to_pylist(), strict=True):
                code = np.frombuffer(raw, np.uint8).copy()
                again = np.full(len(code), True)
                again[first or []] = False
                # A blank row stays blank; an earlier equal row is a fault before a cut-off end.
                code[again & (code >> 2 != BLANK)] &= 3
                code[again & (code >> 2 != BLANK)] += 4 * DUPLICATE
                full.append(code)
            found = matrices(full).reshape(-1, 16).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("place"), pa.array([c.tobytes() for c in full], pa.binary()), pa.array(found, pa.list_(pa.int64()))], names=["conv", "place", "codes", "matrix"])

    def from_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Costs at the end of each piece; pieces come from the last to the first."""
        begun, key = False, None
        for batch in batches:
            lasts, ends, to = [], [], []
            for k, m in zip(batch.column("conv").to_pylist(), batch.column("matrix").to_pylist(), strict=True):
                new = not begun or k != key
                if new:
                    begun, key, now = True, k, INSERT * TAIL
                lasts.append(new)
                ends.append(now.tolist())
                table = np.array(m).reshape(4, 4)
                now = (table + now).min(axis=1)
                to.append(table)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv", "place", "codes")], pa.array(lasts, pa.bool_()), pa.array(ends, pa.list_(pa.int64()))], names=["conv", "place", "codes", "last", "end"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state after each piece for every state before it."""
        for batch in batches:
            n = batch.num_rows
            code = [np.frombuffer(x, np.uint8) for x in batch.column("codes").to_pylist()]
            ends = np.array(batch.column("end").to_pylist(), np.int64).reshape(-1, 4)
            last_ = np.asarray(batch.column("last"), dtype=bool)
            after = np.stack([solve(code, np.full(n, s), ends, last_)[2] for s in range(4)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(after.tolist(), pa.list_(pa.int32()))], names=[*batch.schema.names, "passes"])

    def from_start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, key, state = False, None, START
        for batch in batches:
            states = []
            for k, to in zip(batch.column("conv").to_pylist(), batch.column("passes").to_pylist(), strict=True):
                if not begun or k != key:
                    begun, key, state = True, k, START
                states.append(state)
                state = to[state]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(states, pa.int32())], names=[*batch.schema.names[:-1], "before"])

    def streamed(frame: DataFrame, falling: bool) -> DataFrame:
        order = F.col("place").desc() if falling else F.col("place")
        return frame.repartition("conv").sortWithinPartitions("conv", order)

    backed = streamed(known.mapInArrow(reduced, T.StructType([conv, place, codes, matrix])), True).mapInArrow(from_end, T.StructType([conv, place, codes, last, end]))
    passed = backed.mapInArrow(mapped, T.StructType([conv, place, codes, last, end, passes]))
    return streamed(passed, False).mapInArrow(from_start, T.StructType([conv, place, codes, last, end, before]))


def audit(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", damaged: bool = False) -> DataFrame:
    """The summary of the repair of ``talks``, after ``damage`` if so asked."""
    plain: dict[str, Column] = {n: F.col(f"`{c}`") for n, c in zip(("conv", "turn", "role", "text"), (conv_col, turn_col, role_col, text_col), strict=True)}
    rows = talks.select(*[c.alias(n) for n, c in plain.items()])
    rows = damage(rows, *plain) if damaged else rows
    return repair(rows).summary().withColumnRenamed("conv", conv_col)
