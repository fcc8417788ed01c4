"""Target-distribution importance resampling: draw the documents that look most like a target corpus.

A document is a bag of hashed features, all runs of 1 to ``longest`` consecutive words. A
feature's bucket is its CRC-32 modulo ``buckets``. Both corpora are counted once, in full; each
bucket gets a gain, the log ratio of its smoothed shares in target and corpus in whole
thousandths; a document weighs the sum of the gains of its features. The Gumbel top-k trick
draws without replacement: weight plus Gumbel noise that a hash of the id fixes, highest
scores first.

Words are found by a vectorised automaton on the bytes of the Arrow buffers: a table of 256
entries lower-cases A-Z and turns what separates words into zero, borders are the places where
"is zero" changes, and the CRCs of all words advance together, one byte a step. The few words
still going after the others have ended are finished by zlib, from the state that they are in.

A pass over the texts counts, a second one scores. What comes to the driver is one number for
each bucket and, for the ranks, one for each partition. Ranks are places in a sort by ranges.

Defined cases: a null or empty text and one without words have no feature and weigh 0; a null
id hashes as the empty string and comes last among equal scores; repeated rows score alike and
take one rank each; words may be of any length; with an empty target or corpus all counts of
it are 0; an empty table gives no rows; further columns of whatever names are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm._common import bounded_batches, cut, fresh_path

#: Bytes by what they are read as: digits, letters and bytes from 128 on are themselves, A-Z lower case, all others zero.
_READ = np.arange(256, dtype=np.uint8)
_READ[65:91] += 32
_READ[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = 0

#: The CRC-32 of each byte alone, without the final inversion: the reflected polynomial applied eight times.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)
_CRC = _CRC.astype(np.uint32)

#: With fewer words than this still going, zlib takes over.
FEW = 32


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins, with the end of the last; a null text has none."""
    wide = isinstance(texts, pa.LargeStringArray)
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    low, high = int(bounds[0]), int(bounds[-1])
    return np.frombuffer(data, np.uint8)[low:high] if high > low else np.zeros(0, np.uint8), bounds - low


def word_spans(read: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of each run of bytes other than zero; a run ends where a text does."""
    if not len(read):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = read != 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    # Texts meet without a separator: a word may begin and end at the seam.
    seams = bounds[(bounds > 0) & (bounds < len(read))]
    opens[seams] = inside[seams]
    closes[seams - 1] = inside[seams - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1 - starts


def advance(state: np.ndarray, read: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC state moved on over the bytes of its own span; all spans go one byte a step."""
    order = np.argsort(np.minimum(lengths, 65535).astype(np.uint16), kind="stable")[::-1]
    size, at, now = lengths[order], starts[order], state[order]
    # How many spans are longer than each step, from counts of lengths.
    going = len(size) - np.cumsum(np.bincount(np.minimum(size, 65535))) if len(size) else np.zeros(1, np.int64)
    step, live = 0, int(going[0])
    while live >= FEW and step < 65534:
        now[:live] = _CRC[(now[:live] ^ read[at[:live] + step]) & 255] ^ (now[:live] >> 8)
        step += 1
        live = int(going[step]) if step < len(going) else 0
    for k in range(live):
        rest = read[at[k] + step : at[k] + size[k]]
        now[k] = zlib.crc32(rest, int(now[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(state)
    out[order] = now
    return out


def features(texts: pa.Array, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every feature, number of the text that it is in); no order among the features of a text is promised."""
    data, bounds = text_bytes(texts)
    read = _READ[data]
    starts, lengths = word_spans(read, bounds)
    # Words are in the order of texts, so a text's words end where the next text's begin.
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(starts, bounds)))
    state = advance(np.full(len(starts), 0xFFFFFFFF, np.uint32), read, starts, lengths)
    found, owners = [(~state) % np.uint32(buckets)], [owner]
    for more in range(1, longest):
        # A run goes on over a space and the next word, if that is in the same text.
        first = np.flatnonzero(owner[: max(0, len(owner) - more)] == owner[more:])
        spaced = _CRC[(state[first] ^ np.uint32(32)) & 255] ^ (state[first] >> 8)
        state[first] = advance(spaced, read, starts[first + more], lengths[first + more])
        found.append((~state[first]) % np.uint32(buckets))
        owners.append(owner[first])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


def bucket_counts(rows: DataFrame, buckets: int, longest: int, text_col: str) -> np.ndarray:
    """How many features of ``rows`` are in each bucket; a task hands over one row for each bucket that it has met."""
    bounded_batches(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(features(batch.column(0), buckets, longest)[0], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], names=["bucket", "n"])

    counts = rows.select(F.col(f"`{text_col}`")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    # At most ``buckets`` rows, a parameter.
    for row in counts.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: the smoothed log ratio of target to corpus in thousandths, floored."""
    buckets, all_corpus, all_target = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [(float(t) + 1) * (all_corpus + buckets) / ((float(s) + 1) * (all_target + buckets)) for s, t in zip(corpus, target, strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weighed(rows: DataFrame, gain: np.ndarray, longest: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_features, weight) of every row."""
    bounded_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(gain)
    kind = rows.schema[id_col].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, owner = features(batch.column(1), len(shared.value), longest)
            n = np.bincount(owner, minlength=batch.num_rows)
            weight = np.zeros(batch.num_rows, np.int64)
            np.add.at(weight, owner, shared.value[bucket])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(weight, pa.int64())], names=[id_col, "n_features", "weight"])

    return rows.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(weigh, f"`{id_col}` {kind}, n_features long, weight long")


def noise(key, seed: int):
    """Gumbel noise in thousandths, floored, fixed by the SHA-256 of seed and key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    longest: int = 1,
    buckets: int = 10000,
    least: int = 20,
    percent: int = 10,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document.

    Of the documents with at least ``least`` words, ``percent`` hundredths are drawn, rounded down;
    ``rank`` counts them from 1 by falling score, equal scores by rising id; it is null for the others.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, buckets, longest, text_col), bucket_counts(target, buckets, longest, target_col))
    scored = weighed(docs, gain, longest, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col(f"`{id_col}`"), seed))
    # Equal rows get a place of their own, so that a sort by ranges can deal them out.
    path = fresh_path(spark, "importance")
    scored.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    scored = spark.read.parquet(path)
    # A run of w words has w + (w - 1) + ... features, so the number of features says whether there are enough words.
    features_of_least = sum(max(0, least - k) for k in range(longest))
    joins = F.col("n_features") >= features_of_least
    order = [F.col("score").desc(), F.col(f"`{id_col}`").asc_nulls_last(), F.col("_row")]
    sorted_ = scored.filter(joins).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(sorted_.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}))
    # One row for each partition.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_place").alias("low")).orderBy("_part").collect()
    drawn = sum(r["n"] for r in sizes) * percent // 100
    before = np.cumsum([0, *[r["n"] for r in sizes]])
    shifts = [(r["_part"], int(b) + 1 - r["low"]) for r, b in zip(sizes, before, strict=False)]
    parts = spark.createDataFrame(shifts, "_part int, _shift long")
    ranked = placed.join(F.broadcast(parts), "_part").withColumn("rank", F.col("_place") + F.col("_shift"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    columns = [F.col(f"`{id_col}`"), "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").unionByName(scored.filter(~joins).select(*columns, F.lit(None).cast("long").alias("rank")))
