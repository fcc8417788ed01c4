"""Chat formatting: a hidden Markov model reads a transcript line by line, then turns are rendered.

Every line of a transcript is one observed symbol, made by SQL functions from its speaker
marker (``User:``, ``### Response`` and the like), its length, whether it asks, holds code or
a list item, and whether it begins a row. A state is a role together with whether
the line opens a turn or goes on with it, so Viterbi finds speakers and turn borders at
once. Emissions and transitions are counted on rows whose role is known (a row's first
line opens, the others go on) and smoothed; recovery reads only the texts.

Input rows may be whole transcripts or turns that are cut already: rows of one conversation
follow each other by turn number. ``fit(..., borders=False)`` leaves the beginnings of rows out of
the symbols, for a model that has to find turns inside rows by markers and line features.

Viterbi runs over whole conversations of any length: lines are numbered within it and cut into
segments of ``SEGMENT`` lines; each segment is reduced to a small max-plus matrix (best path
from each state before it to each state at its end); the matrices of a conversation are streamed, forward
and back, to fix the states at the seams; then each segment is decoded on its own between known ends. The path
found is the best one, as if the conversation had been decoded in one piece.

A found turn gives one canonical block ``<|role|>\\ntext\\n<|end|>`` without its marker. A row
always opens a block; ``role_found`` is the role of its first line.

Defined cases: null texts count as empty, an empty text is one empty line; rows are ordered by
turn number (nulls first), then by a digest of the text; repeated rows of one turn are one turn
of the decoding and one output row each; a null conversation id is a conversation; very long
texts and conversations are cut into segments; roles that are unknown or null don't train;
with no known roles at all all states are alike likely and ties go to the first role; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm._common import bounded_batches, cut, join_spread

ROLES = ("system", "user", "assistant", "tool")
#: States: a role's opening line, then its further lines.
STATES = 2 * len(ROLES)
SEGMENT = 1024

# Markers at the start of a line, by role.
MARKERS = {
    "system": "(?i)^\\s*(#+\\s*)?(<\\|system\\|>|\\[system\\]|system( prompt)?\\s*:)\\s*",
    "user": "(?i)^\\s*(#+\\s*)?(<\\|user\\|>|\\[user\\]|(user|human|customer|instruction|q)\\s*:)\\s*",
    "assistant": "(?i)^\\s*(#+\\s*)?(<\\|assistant\\|>|\\[assistant\\]|(assistant|ai|bot|agent|response|a)\\s*:)\\s*",
    "tool": "(?i)^\\s*(#+\\s*)?(<\\|tool\\|>|\\[tool\\]|(tool|function|observation)\\s*:)\\s*",
}
#: Symbols: marker (5) x length (12) x lines in the row (4) x asks (2) x code or list (3) x first of a row, of a conversation (3).
SYMBOLS = 5 * 12 * 4 * 2 * 3 * 3


def symbol(line: Column, number: Column, of: Column, turn: Column, borders: bool) -> Column:
    """The observed symbol of line ``number`` (from 0) of the ``of`` lines of a row."""
    marker = F.lit(0)
    for k, role in reversed(list(enumerate(ROLES, 1))):
        marker = F.when(line.rlike(MARKERS[role]), k).otherwise(marker)
    length = F.least(F.lit(11), F.ceil(F.log2(F.length(line) + 1)).cast("int"))
    asks = line.rlike("\\?\\s*$").cast("int")
    kind = F.when(line.rlike("^\\s*(```|\\t|    )"), 1).when(line.rlike("^\\s*([-*+]|[0-9]+[.)]) "), 2).otherwise(0)
    begins, lines = F.lit(0), F.lit(0)
    if borders:
        begins = F.when(number > 0, 0).when(turn == 0, 2).otherwise(1)
        lines = F.least(F.lit(3), of - 1)
    return ((((marker * 12 + length) * 4 + lines) * 2 + asks) * 3 + kind) * 3 + begins


@dataclass
class Hmm:
    """Log probabilities: start [state], move [state, state], emit [state, symbol]."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    borders: bool = True

    def matrix(self, symbols: np.ndarray, opening: bool) -> np.ndarray:
        """Best score from each state before the segment to each state at its end."""
        best = np.tile(self.start, (len(self.start), 1)) if opening else self.move.copy()
        best = best + self.emit[:, symbols[0]]
        for s in symbols[1:]:
            best = (best[:, :, None] + self.move[None]).max(axis=1) + self.emit[:, s]
        return best

    def paths(self, symbols: list[np.ndarray], before: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """Best states of each segment after state ``before`` (-1: none) with state ``end`` last (-1: free).

        All segments go forward together, one line a step; the longest come first.
        """
        order = sorted(range(len(symbols)), key=lambda k: -len(symbols[k]))
        size = np.array([len(symbols[k]) for k in order])
        most = int(size[0]) if len(size) else 0
        table = np.zeros((len(order), most), dtype=np.int64)
        for row, k in enumerate(order):
            table[row, : size[row]] = symbols[k]
        before, end = before[order], end[order]
        best = np.where((before < 0)[:, None], self.start, self.move[before]) + self.emit.T[table[:, 0]] if most else np.zeros((0, len(self.start)))
        back = np.zeros((most, len(order), len(self.start)), dtype=np.int8)
        for at in range(1, most):
            live = int(np.searchsorted(-size, -at, side="left"))
            step = best[:live, :, None] + self.move[None]
            back[at, :live] = step.argmax(axis=1)
            best[:live] = step.max(axis=1) + self.emit.T[table[:live, at]]
        state = np.where(end < 0, best.argmax(axis=1), end)
        out = np.zeros((len(order), most), dtype=np.int8)
        for at in range(most - 1, -1, -1):
            live = int(np.searchsorted(-size, -at, side="left"))
            out[:live, at] = state[:live]
            state[:live] = back[at, np.arange(live), state[:live]]
        found: list[np.ndarray] = [out[0][:0]] * len(order)
        for row, k in enumerate(order):
            found[k] = out[row, : size[row]]
        return found

    def path(self, symbols: np.ndarray, before: int = -1, end: int = -1) -> list[int]:
        return self.paths([symbols], np.array([before]), np.array([end]))[0].tolist()


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\r?\n")


def _segments(talks: DataFrame, borders: bool, conv_col: str, turn_col: str, text_col: str) -> DataFrame:
    """(conv, turn, digest, line, symbol, segment): one row per line of every different (conv, turn, text).

    Lines are numbered in two levels: a sort by ranges of (conv, turn, digest, line) gives each its
    place within a range, and the counts of a conversation's earlier ranges are added.
    """
    rows = talks.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest"), _lines(F.col(text_col)).alias("lines"))
    each = rows.select("conv", "turn", "digest", F.size("lines").alias("of"), F.posexplode("lines").alias("line", "text"))
    found = symbol(F.col("text"), F.col("line"), F.col("of"), F.col("turn"), borders).alias("symbol")
    lines = cut(each.select("conv", "turn", "digest", "line", found).distinct())
    # Rows are different in these columns, so a range splits null and repeated turn numbers, too.
    keys = ["conv", "turn", "digest", "line"]
    placed = cut(lines.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}))
    ranges = placed.groupBy("conv", "part").agg(F.min("place").alias("low"), F.count("*").alias("n"))
    # Few rows a conversation: one for each range that it reaches into.
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(F.col("conv").alias("c"), F.col("part").alias("p"), (F.col("low") - earlier).alias("zero"))
    ranked = placed.join(ranges, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return ranked.select(*keys, "symbol", F.floor((F.col("place") - F.col("zero")) / SEGMENT).cast("long").alias("segment"))


def fit(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trains: Column | None = None, borders: bool = True) -> Hmm:
    """Count emissions and transitions on rows with a known role; ``trains`` selects conversations."""
    known = F.when(F.col(role_col).isin(*ROLES), F.col(role_col))
    rows = talks.filter(trains) if trains is not None else talks
    rows = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), known.alias("role"), _lines(F.col(text_col)).alias("lines")).filter("role is not null")
    number = {r: k for k, r in enumerate(ROLES)}
    emit, start = np.full((STATES, SYMBOLS), 0.001), np.full(STATES, 1e-9)
    move = np.full((STATES, STATES), 1e-9)
    for role in range(len(ROLES)):
        opens, goes_on = 2 * role, 2 * role + 1
        start[opens] = 0.05
        for state in (opens, goes_on):
            move[state, goes_on] = 0.05
            move[state, ::2] = 0.05
    # At most states x symbols rows here, and states x states below: bounded by the model, not by the data.
    each = rows.select("role", "turn", F.size("lines").alias("of"), F.posexplode("lines").alias("line", "text"))
    each = each.select("role", (F.col("line") > 0).alias("on"), symbol(F.col("text"), F.col("line"), F.col("of"), F.col("turn"), borders).alias("symbol"))
    for r in each.groupBy("role", "on", "symbol").count().collect():
        emit[2 * number[r["role"]] + r["on"], r["symbol"]] += r["count"]
    sizes = rows.select("conv", "turn", "role", (F.size("lines") - 1).alias("more"))
    for r in sizes.groupBy("role").agg(F.count_if(F.col("more") > 0).alias("some"), F.sum(F.greatest(F.col("more") - 1, F.lit(0))).alias("further")).collect():
        opens = 2 * number[r["role"]]
        move[opens, opens + 1] += r["some"]
        move[opens + 1, opens + 1] += r["further"]
    # Neighbours meet by an equi-join on the turn number, so no conversation is sorted in one task.
    after = rows.select("conv", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next")).distinct()
    pairs = sizes.select("conv", "turn", "role", (F.col("more") > 0).alias("on")).distinct().join(after, ["conv", "turn"]).groupBy("role", "on", "next").count()
    for r in pairs.collect():
        move[2 * number[r["role"]] + r["on"], 2 * number[r["next"]]] += r["count"]
    for r in rows.filter("turn = 0").groupBy("role").count().collect():
        start[2 * number[r["role"]]] += r["count"]
    log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Hmm(log(start), log(move), log(emit), borders)


def recover(talks: DataFrame, model: Hmm, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """(conv, turn, digest, states): the best path's state for every line of every different row, in the order of its lines."""
    spark = talks.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    lines = _segments(talks, model.borders, conv_col, turn_col, text_col)
    conv, turn = lines.schema["conv"], lines.schema["turn"]
    segments = lines.groupBy("conv", "segment").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "line", "symbol"))).alias("lines"))
    count = segments.groupBy(F.col("conv").alias("c")).agg(F.min("segment").alias("opening"), F.count("*").alias("n"))
    segments = segments.join(count, F.col("conv").eqNullSafe(F.col("c"))).drop("c")

    def symbols_of(lines: pa.Array) -> list[np.ndarray]:
        symbols = lines.flatten().field("symbol").to_numpy(zero_copy_only=False)
        return np.split(symbols, np.cumsum(lines.value_lengths().to_numpy(zero_copy_only=False))[:-1])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = np.equal(*[batch.column(c).to_numpy(zero_copy_only=False) for c in ("segment", "opening")])
            found = [shared.value.matrix(s, f).ravel() for s, f in zip(symbols_of(batch.column("lines")), first, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("segment"), pa.array(found, pa.list_(pa.float64()))], names=["conv", "segment", "matrix"])

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Best score in each state after each segment, and the state before it that leads there; segments come in order."""
        begun, key, best = False, None, None
        for batch in batches:
            scores, backs = [], []
            for conv, matrix in zip(batch.column("conv").to_pylist(), batch.column("matrix").to_pylist(), strict=True):
                m = np.array(matrix).reshape(STATES, STATES)
                if not begun or conv != key:
                    begun, key = True, conv
                    best, back = m[0], np.full(STATES, -1)
                else:
                    step = best[:, None] + m
                    best, back = step.max(axis=0), step.argmax(axis=0)
                scores.append(best)
                backs.append(back)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("segment"), pa.array(scores, pa.list_(pa.float64())), pa.array(backs, pa.list_(pa.int32()))], names=["conv", "segment", "scores", "back"])

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """States before and at the end of each segment on the best path; segments come from the last to the first."""
        begun, key, state = False, None, -1
        for batch in batches:
            befores, ends = [], []
            for conv, scores, back in zip(*[batch.column(c).to_pylist() for c in ("conv", "scores", "back")], strict=True):
                if not begun or conv != key:
                    begun, key, state = True, conv, int(np.argmax(scores))
                ends.append(state)
                state = back[state]
                befores.append(state)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("segment"), pa.array(befores, pa.int32()), pa.array(ends, pa.int32())], names=["conv", "segment", "before", "end"])

    long_ = T.LongType()
    # Only conversations of several segments need seams: a row for each thousand lines.
    long = segments.filter("n > 1").select("conv", "segment", "opening", "lines").mapInArrow(reduce, T.StructType([conv, T.StructField("segment", long_), T.StructField("matrix", T.ArrayType(T.DoubleType()))]))
    # Each stream keeps one score or state, however many segments a conversation has.
    ints, doubles = T.IntegerType(), T.ArrayType(T.DoubleType())
    passed = long.repartition("conv").sortWithinPartitions("conv", "segment").mapInArrow(forward, T.StructType([conv, T.StructField("segment", long_), T.StructField("scores", doubles), T.StructField("back", T.ArrayType(ints))]))
    seams = passed.repartition("conv").sortWithinPartitions("conv", F.col("segment").desc()).mapInArrow(backward, T.StructType([conv, T.StructField("segment", long_), T.StructField("before", ints), T.StructField("end", ints)]))
    both = segments["conv"].eqNullSafe(seams["conv"]) & (segments["segment"] == seams["segment"])
    fixed = segments.join(seams, both, "left").select(segments["conv"], "lines", F.coalesce("before", F.lit(-1)).alias("before"), F.coalesce("end", F.lit(-1)).alias("end"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column("lines")
            before, end = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("before", "end"))
            states = shared.value.paths(symbols_of(lines), before, end) if batch.num_rows else []
            flat, owner = lines.flatten(), np.repeat(np.arange(batch.num_rows), lines.value_lengths().to_numpy(zero_copy_only=False))
            found = pa.array(np.concatenate(states) if states else [], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("conv").take(pa.array(owner)), flat.field("turn"), flat.field("digest"), flat.field("line"), found], names=["conv", "turn", "digest", "line", "state"])

    decoded = T.StructType([conv, turn, T.StructField("digest", T.StringType()), T.StructField("line", T.IntegerType()), T.StructField("state", T.IntegerType())])
    # As many states as the row's own text has lines.
    states = F.sort_array(F.collect_list(F.struct("line", "state")))
    return fixed.mapInArrow(decode, decoded).groupBy("conv", "turn", "digest").agg(F.transform(states, lambda x: x["state"]).alias("states"))


def _without_marker(text: Column) -> Column:
    for pattern in MARKERS.values():
        text = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, "")).otherwise(text)
    return F.trim(text)


def _blocks(talks: DataFrame, model: Hmm, conv_col: str, turn_col: str, text_col: str) -> DataFrame:
    """(conv, turn, blocks): each input row with its found turns, an array of (role, text)."""
    # Rows that are equal in all three share their found states; nulls are keys like any other.
    key = F.struct("conv", "turn", "digest")
    found = recover(talks, model, conv_col, turn_col, text_col).select(key.alias("key"), "states")
    rows = talks.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(text_col).alias("text")).withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    rows = rows.withColumn("key", key)
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    # Many equal rows meet their states by broadcast, so that they stay where they are.
    both = join_spread(rows, cut(found.join(counts, "key")), "key", "n", talks.count()).select("conv", "turn", _lines(F.col("text")).alias("lines"), "states")
    opens = F.filter(F.transform("states", lambda s, i: F.when((i == 0) | (s % 2 == 0), i)), lambda x: x.isNotNull())
    both = both.withColumn("opens", opens)
    role = lambda s: F.get(F.array(*map(F.lit, ROLES)), F.floor(s / 2).cast("int"))
    part = lambda at, k: F.slice("lines", at + 1, F.coalesce(F.get("opens", k + 1), F.size("lines")) - at)
    block = lambda at, k: F.struct(role(F.get("states", at)).alias("role"), _without_marker(F.array_join(part(at, k), "\n")).alias("text"))
    return both.select("conv", "turn", F.transform("opens", block).alias("blocks"))


def render(role: Column, text: Column) -> Column:
    """Canonical block of a turn: role tag, text, end tag."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>"))


def parse(transcripts: DataFrame, model: Hmm, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """(conv, turn, number, role_found, text, rendered): one row per turn that was found in a row's text, numbered from 0 within it."""
    turns = _blocks(transcripts, model, conv_col, turn_col, text_col).select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.posexplode("blocks").alias("number", "block"))
    return turns.select(conv_col, turn_col, "number", F.col("block.role").alias("role_found"), F.col("block.text").alias("text"), render(F.col("block.role"), F.col("block.text")).alias("rendered"))


def format_chats(talks: DataFrame, model: Hmm, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """(conv, turn, role_found, n_turns, rendered): one row per input row, with all turns that were found in it."""
    rows = _blocks(talks, model, conv_col, turn_col, text_col)
    rendered = F.array_join(F.transform("blocks", lambda b: render(b["role"], b["text"])), "\n")
    return rows.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.get("blocks", F.lit(0))["role"].alias("role_found"), F.size("blocks").cast("long").alias("n_turns"), rendered.alias("rendered"))
