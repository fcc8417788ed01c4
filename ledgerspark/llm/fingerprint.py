"""Document fingerprints: the k least hashes of a text's shingles, a sketch that can be merged.

A shingle is five consecutive words, lower-cased in A-Z; a text with fewer words is one shingle,
one without any has none. A sketch is the ``SIZE`` least different 63-bit hashes in rising
order, all of them if there are fewer. The sketch of two parts together is the least of both, so
sketches of parts, documents, sources or whole corpora are merged without their texts
(``merged``), and two of them tell how alike their sets are: of the least hashes of the
union, the share that is in both estimates resemblance, with a standard error of about 0.04;
below ``SIZE`` shingles it is exact. The largest hash of a full sketch tells how many
different shingles there are, and both together how much of one set is contained in the other.

``chained`` compares each document with the next by falling id and with its own text after
half of it was replaced by the next one's beginning. Texts move once: bounds of ids are
computed from the ids alone, rows go to their range, and each range also gets the one text that
comes before its first. Ranges are streamed in the order of ids with one text in memory
besides the batch. An id with very many rows has ranges of its own, over which its rows are dealt.

Defined cases: a null text is empty; texts without words have equal, empty fingerprints, alike by
1; such a text and another are alike by 0; of several rows with the next id the one with the least
hash of its text (then any of equal texts) is the next document of all rows of an id; null ids are
one id, below all others; the only id of a table is its own next one; an empty table gives no rows;
further columns of whatever names are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm._common import bounded_batches
from ledgerspark.llm.importance import text_bytes, word_spans

SIZE = 128
WORDS = 5
#: Hashes are below this.
SPACE = 1 << 63

#: Bytes by what they are read as: white space is zero, A-Z lower case; a zero byte is 255, which UTF-8 doesn't have.
_READ = np.arange(256, dtype=np.uint8)
_READ[65:91] += 32
_READ[0] = 255
_READ[[32, *range(9, 14)]] = 0

#: Longer words are hashed one by one.
_LONG = 64
_PRIME = np.uint64(0x100000001B3)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer of 64-bit hashes, so that each bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(read: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; short words advance together, one byte a step."""
    order = np.argsort(np.minimum(lengths, _LONG + 1).astype(np.uint8), kind="stable")[::-1]
    size, at = lengths[order], starts[order]
    now = np.full(len(order), 0xCBF29CE484222325, np.uint64)
    long = int(np.searchsorted(-size.clip(max=_LONG + 1), -_LONG, side="left"))
    for k in range(long):
        now[k] = xxhash.xxh64_intdigest(read[at[k] : at[k] + size[k]].tobytes())
    ends = len(size) - np.cumsum(np.bincount(np.minimum(size, _LONG + 1), minlength=_LONG + 2)) if len(size) else []
    for step in range(_LONG):
        live = int(ends[step]) if len(size) else 0
        if live <= long:
            break
        now[long:live] = (now[long:live] ^ read[at[long:live] + step].astype(np.uint64)) * _PRIME
    out = np.empty_like(now)
    out[order] = _mixed(now)
    return out


def sketches(texts: pa.Array, size: int = SIZE, width: int = WORDS) -> list[np.ndarray]:
    """The sketch of each text."""
    data, bounds = text_bytes(texts)
    read = _READ[data]
    starts, lengths = word_spans(read, bounds)
    words = word_hashes(read, starts, lengths)
    ends = np.searchsorted(starts, bounds)
    powers = [np.uint64(pow(int(_FACTOR), k, 1 << 64)) for k in range(width)]
    full = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        full += words[k : k + len(full)] * powers[k]
    full = _mixed(full + np.uint64(width)) >> np.uint64(1)
    out = []
    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        n = high - low
        if n >= width:
            found = np.unique(full[low : high - width + 1])[:size]
        elif n:
            whole = np.zeros(1, np.uint64)
            for k in range(n):
                whole += words[low + k : low + k + 1] * powers[k]
            found = _mixed(whole + np.uint64(n)) >> np.uint64(1)
        else:
            found = full[:0]
        out.append(found)
    return out


def alike(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated resemblance of the sets that two sketches stand for."""
    both = np.concatenate((a, b))
    both.sort()
    twice = np.flatnonzero(both[1:] == both[:-1])
    # Of the least of the union: a hash in both stands there twice.
    union = len(both) - len(twice)
    if not union:
        return 1.0
    if union <= size:
        return len(twice) / union
    # Place of each doubled hash in the union: its place less the doubled ones before it.
    return int(np.count_nonzero(twice - np.arange(len(twice)) < size)) / size


def printed(sketch: np.ndarray) -> str:
    """A fingerprint: the hashes of a sketch in 16 hexadecimal digits each."""
    return sketch.astype(">u8").tobytes().hex()


def with_sketch(rows: DataFrame, text_col: str = "text", size: int = SIZE, width: int = WORDS, out: str = "sketch") -> DataFrame:
    """``rows`` with the sketch of a text, an array of longs, in place of the text."""
    bounded_batches(rows.sparkSession)
    kept = [f for f in rows.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.LongType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([s.astype(np.int64) for s in sketches(batch.column(text_col), size, width)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], found], names=schema.names)

    return rows.mapInArrow(work, schema)


def least_of(lists: Column, size: int = SIZE) -> Column:
    """The sketch of all parts whose sketches are in an array."""
    return F.slice(F.array_sort(F.array_distinct(F.flatten(lists))), 1, size)


def merged(rows: DataFrame, key: str, sketch: str = "sketch", size: int = SIZE, spread: int = 256) -> DataFrame:
    """(key, sketch) of all rows of each key together.

    Tasks merge what they read first; what is left of a key meets in ``spread`` groups, then in one, so that no
    group holds more than a sketch for each ``spread``-th task.
    """
    kind = rows.schema[key]
    schema = T.StructType([kind, T.StructField("sketch", T.ArrayType(T.LongType()))])

    def partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), batch.schema.field(0).type), pa.array(list(held.values()), pa.list_(pa.int64()))], names=schema.names)

        for batch in batches:
            for k, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new = np.array(s or [], np.int64)
                held[k] = np.union1d(held[k], new)[:size] if k in held else new
            if len(held) > 4096:
                yield out()
                held = {}
        if held:
            yield out()

    parts = rows.select(F.col(f"`{key}`"), F.col(f"`{sketch}`")).mapInArrow(partly, schema).withColumn("_group", F.spark_partition_id() % spread)
    some = parts.groupBy(F.col(f"`{key}`"), "_group").agg(least_of(F.collect_list("sketch"), size).alias("sketch"))
    return some.groupBy(F.col(f"`{key}`")).agg(least_of(F.collect_list("sketch"), size).alias("sketch"))


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of shingles in both among those in either; 1 for two empty sets."""
    least = least_of(F.array(a, b), size)
    both = F.array_intersect(F.array_intersect(least, a), b)
    return F.when(F.size(least) == 0, 1.0).otherwise(F.size(both) / F.size(least))


def distinct_shingles(sketch: Column, size: int = SIZE) -> Column:
    """Estimated number of different shingles; exact below ``size``."""
    return F.when(F.size(sketch) < size, F.size(sketch).cast("double")).otherwise((size - 1) * (float(SPACE) / F.array_max(sketch)))


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has, too; 1 for an empty ``a``."""
    shared = resemblance(a, b, size) * distinct_shingles(least_of(F.array(a, b), size), size)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, size)))


def _passed(values: np.ndarray, x: Column, strictly: bool) -> Column:
    """How many of the rising ``values`` are at most ``x`` (``strictly``: less); looked up among every m-th, then among m."""
    if not len(values):
        return F.lit(0)
    m = max(1, round(len(values) ** 0.5))
    passes = (lambda v: v < x) if strictly else (lambda v: v <= x)
    before = F.greatest(F.size(F.filter(F.lit(values[::m]), passes)) - 1, F.lit(0)) * m
    return before + F.size(F.filter(F.slice(F.lit(values), before + 1, F.lit(m)), passes))


def _deal(docs: DataFrame, id_col: str, n: int) -> tuple[Column, list[tuple[int, int]]]:
    """(slot of an id, (first part, number of parts) of each slot): slots are ranges of ids in order, all null ids first.

    An id that holds more than two shares of ``n`` is a slot of its own with as many parts.
    """
    key = F.col("_id")
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"))
    shares = [k / n for k in range(1, n)]
    found = ids.agg(F.count("*").alias("rows"), F.count_if(key.isNull()).alias("nulls"), F.percentile_approx(key, shares or [0.5], max(10_000, 20 * n)).alias("bounds")).first()
    rows, nulls, bounds = found["rows"], found["nulls"], (found["bounds"] or []) if shares else []
    values, times = np.unique(np.array(bounds, np.int64), return_counts=True)
    widths, ends = [max(1, n * nulls // max(1, rows)), 1], []
    for value, t in zip(values.tolist(), times.tolist(), strict=True):
        widths.append(t)
        if t > 1:
            ends.append(value)
            widths.append(1)
    slot = F.when(key.isNull(), 0).otherwise(1 + _passed(values, key, False) + _passed(np.array(ends, np.int64), key, True))
    firsts = np.cumsum([0, *widths])
    return slot.cast("int"), [(int(f), w) for f, w in zip(firsts, widths, strict=False)]


def chained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, width: int = WORDS) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles) of every document.

    ``near_edited``: resemblance to the text after its last half was replaced by the beginning of the next
    document by falling id (after the last: the first); ``near_next``: to that document; ``n_shingles``: estimated number of different shingles.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles"]
    schema = T.StructType([T.StructField(id_col, kind), *T.StructType.fromDDL("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_shingles double").fields])
    slot, parts = _deal(docs, id_col, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text")).withColumn("_slot", slot)
    # One row for each slot: what its last id is.
    ends = rows.groupBy("_slot").agg(F.max("_id").alias("last")).orderBy("_slot").collect()
    pairs = [(ends[k - 1]["last"], r["_slot"]) for k, r in enumerate(ends)]
    # Of each slot's last id the text that stands for it goes to all parts of the next slot, the last slot's to the first.
    leads = spark.createDataFrame([(i, p) for i, s in pairs for p in range(parts[s][0], sum(parts[s]))], "_last long, _part int")
    ids = F.broadcast(leads.select(F.col("_last").alias("_l")).distinct())
    least = rows.join(ids, F.col("_id").eqNullSafe(F.col("_l"))).groupBy("_id").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    leads = least.join(F.broadcast(leads), F.col("_id").eqNullSafe(F.col("_last"))).select("_part", F.lit(False).alias("_own"), "_id", "_text")
    first, many = F.lit(np.array([p[0] for p in parts], np.int64)), F.lit(np.array([p[1] for p in parts], np.int64))
    part = F.get(first, F.col("_slot")) + F.monotonically_increasing_id() % F.get(many, F.col("_slot"))
    own = rows.select(part.cast("int").alias("_part"), F.lit(True).alias("_own"), "_id", "_text")
    dealt = own.unionByName(leads).repartitionById(sum(parts[-1]), F.col("_part"))
    dealt = dealt.sortWithinPartitions("_part", "_own", F.col("_id").asc_nulls_first(), F.xxhash64("_text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The text that stands for the id at hand, and the one before it, each with its sketch.
        at, here, before = None, None, None
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            found = sketches(batch.column("_text"), size, width)
            kept, edited, nexts = [], [], []
            for k, (p, is_own, key) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("_part", "_own", "_id")], strict=True)):
                if (p, is_own, key) != at:
                    at, before, here = (p, is_own, key), here, (texts[k], found[k])
                if is_own:
                    text, half = texts[k], len(texts[k]) // 2
                    kept.append(k)
                    edited.append(text[: len(text) - half] + before[0][:half])
                    nexts.append(before[1])
            new = sketches(pa.array(edited, pa.string()), size, width)
            old = [found[k] for k in kept]
            columns = [
                batch.column("_id").take(pa.array(kept, pa.int64())).cast(pa_kind),
                pa.array([len(texts[k]) for k in kept], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                pa.array(map(printed, old), pa.string()),
                pa.array(map(printed, new), pa.string()),
                pa.array([alike(a, b, size) for a, b in zip(old, new, strict=True)], pa.float64()),
                pa.array([alike(a, b, size) for a, b in zip(old, nexts, strict=True)], pa.float64()),
                pa.array([float(len(s)) if len(s) < size else (size - 1) * (SPACE / float(s[-1])) for s in old], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    pa_kind = {"int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(kind.simpleString(), pa.int64())
    return dealt.mapInArrow(work, schema)
