"""LM scoring by cross-entropy difference of two matched n-gram models.

A target model (rows marked as target) and a background model (all rows) have the same
order, the same smoothing and one shared vocabulary: all words of the corpus. A word's
probability is its pair count over its context's count, with the unigram model (one added
to each word) as a Dirichlet prior of weight ``prior``. Each token adds the difference of
its two losses (in nats); a document's score is their mean: the lower, the more it is like
the target.

Every word and every pair of neighbours is counted exactly, whatever their number:

1. each task gathers rows into chunks of about ``CHUNK_BYTES`` of text and counts each
   chunk's distinct words, contexts and pairs;
2. these are dealt by their hash over buckets, whose number grows with the corpus. A
   frequent one comes once a chunk, so no key is hot;
3. a bucket adds up equal words and pairs, compared by their bytes, and answers each
   chunk with the counts of the whole corpus, in the order in which the chunk asked;
4. each chunk meets its answers, takes from them what a row itself added and scores the row.

Nothing is broadcast; the driver gets the number of words and of tokens. Each row is scored
by all other rows: its own counts are left out of both models, so no text is scored by
counts that it added to, and a text that another row repeats is well known to the background.

Defined cases: null and empty texts have no tokens and score 0 with losses 0; rows with a
null id are not targets; of repeated labels for an id the largest counts; repeated rows are
counted and scored each, by the counts of their copies, too; with no other target row the
target model is uniform; very long texts are counted and scored whole; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm._common import bounded_batches, fresh_path

#: Kinds of grams in ``slot_counts``: words lie below this number, contexts at it, pairs above.
WORDS = 1
#: Text of a chunk with so much for each row, and of the corpus for each bucket.
CHUNK_BYTES = 4 << 20
ROW_BYTES = 16
BUCKET_BYTES = 4 << 20


def _pairs(codes: list[np.ndarray], words: int) -> np.ndarray:
    """Every token with the one before it as one number; word 0 is the start of a text."""
    if not codes:
        return np.zeros(0, dtype=np.int64)
    return np.concatenate([np.concatenate(([0], x[:-1])) * words + x if len(x) else x for x in (x.astype(np.int64) for x in codes)])


def _dealt(hashes: np.ndarray, pairs: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each gram of a chunk: its words, its contexts, its distinct pairs."""
    h, words = hashes.astype(np.uint64), max(1, len(hashes))
    a, b = h[pairs // words], h[pairs % words]
    mixed = np.concatenate([h * np.uint64(0x9E3779B97F4A7C15), h * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1), a * np.uint64(0x9E3779B97F4A7C15) + (b + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype="<u4", count=len(words))


def _packed(blobs: list[bytes]) -> list[bytes]:
    """Compressed: sorted grams share their beginnings and most counts are small."""
    return list(map(zstandard.ZstdCompressor(level=3).compress, blobs))


def _unpacked(blobs: list[bytes]) -> list[bytes]:
    return list(map(zstandard.ZstdDecompressor().decompress, blobs))


def _counted(values: list[np.ndarray], size: int) -> np.ndarray:
    return np.bincount(np.concatenate(values), minlength=size) if values else np.zeros(size, dtype=np.int64)


def staged(docs: DataFrame) -> DataFrame:
    """Chunks of (id, is_target, text as bytes), one row each, written to the shared folder.

    ``words`` are the chunk's words in order, a line each; ``codes`` their numbers, text by text.
    """
    parts = "chunk string, tokens long, targets long, goods binary, sizes binary, codes binary, words binary"
    schema = T.StructType([T.StructField("ids", T.ArrayType(docs.schema["id"].dataType)), *T.StructType.fromDDL(parts).fields])

    def chunk(rows: pa.Table) -> pa.RecordBatch:
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        number[b""]
        found = []
        for text in rows["text"]:
            tokens = (text.as_py() or b"").lower().split()
            found.append(np.fromiter(map(number.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
        words = sorted(number)
        rank = np.empty(len(words), dtype="<i4")
        rank[np.fromiter((number[w] for w in words), dtype=np.int64, count=len(words))] = np.arange(len(words))
        goods, sizes = np.array(rows["is_target"].to_pylist(), dtype=bool), np.array([len(x) for x in found], dtype="<i8")
        ids = pa.concat_arrays(rows["id"].chunks)
        values = (uuid.uuid4().hex, int(sizes.sum()), int(sizes[goods].sum()), goods.tobytes(), sizes.tobytes(), rank[np.concatenate(found)].tobytes(), b"\n".join(words))
        kinds = (pa.string(), pa.int64(), pa.int64(), *[pa.binary()] * 4)
        arrays = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([v], k) for v, k in zip(values, kinds, strict=True))]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            # A row has a price of its own, so that many empty texts fill a chunk, too.
            sizes, at = ROW_BYTES + np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), dtype=np.int64), 0
            while at < batch.num_rows:
                upto = at + 1 + int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK_BYTES - size))
                held.append(batch.slice(at, upto - at))
                size, at = size + int(sizes[at:upto].sum()), upto
                if size >= CHUNK_BYTES:
                    yield chunk(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield chunk(pa.Table.from_batches(held))

    return _written(docs.select("id", "is_target", "text").mapInArrow(work, schema), "lm-chunks")


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again; its shuffle files go at once."""
    spark, path, switch = df.sparkSession, fresh_path(df.sparkSession, name), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(switch, None)
    spark.conf.set(switch, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(switch) if before is None else spark.conf.set(switch, before)
    return spark.read.parquet(path)


def _texts(sizes: bytes, codes: bytes) -> list[np.ndarray]:
    return np.split(np.frombuffer(codes, "<i4"), np.cumsum(np.frombuffer(sizes, "<i8"))[:-1])


def asked(chunks: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, grams, target, background): of each chunk and bucket its grams and their counts.

    A word is its bytes, a context has a space behind it, a pair a space between; each ends its line. All three are compressed.
    """
    kinds = pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("grams", pa.binary()), ("target", pa.binary()), ("background", pa.binary())])

    def ask(key: str, goods: bytes, sizes: bytes, codes: bytes, words: bytes) -> pa.RecordBatch:
        words, found = words.split(b"\n"), _texts(sizes, codes)
        good = [x for x, t in zip(found, np.frombuffer(goods, bool), strict=True) if t]
        n = len(words)
        pairs, background = np.unique(_pairs(found, n), return_counts=True)
        target = np.zeros(len(pairs), dtype=np.int64)
        there, count = np.unique(_pairs(good, n), return_counts=True)
        target[np.searchsorted(pairs, there)] = count
        place = _dealt(_hashes(words), pairs, buckets)
        order = np.argsort(place, kind="stable")
        first = np.flatnonzero(np.diff(place[order], prepend=-1))
        ends = np.append(first, len(order))
        columns = []
        for texts, of_pairs in ((good, target), (found, background)):
            contexts = np.bincount(pairs // n, weights=of_pairs, minlength=n).astype(np.int64)
            counts = np.concatenate([_counted(texts, n), contexts, of_pairs]).astype("<u4")[order]
            columns.append(pa.array(_packed([counts[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]), pa.binary()))
        names, space = pa.array(words, pa.binary()), pa.scalar(b" ", pa.binary())
        contexts = pc.binary_join_element_wise(names, pa.scalar(b"", pa.binary()), space)
        both = pc.binary_join_element_wise(names.take(pa.array(pairs // n)), names.take(pa.array(pairs % n)), space)
        grams = pa.concat_arrays([names, contexts, both]).take(pa.array(order))
        blobs = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), grams), pa.scalar(b"\n", pa.binary()))
        blobs = pa.array(_packed(blobs.to_pylist()), pa.binary())
        m = len(first)
        return pa.RecordBatch.from_arrays([pa.array([key] * m, pa.string()), pa.array(place[order][first], pa.int32()), blobs, *columns], schema=kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield ask(*(c[k].as_py() for c in batch.columns))

    return chunks.select("chunk", "goods", "sizes", "codes", "words").mapInArrow(work, "chunk string, bucket int, grams binary, target binary, background binary")


def slot_counts(docs: DataFrame) -> DataFrame:
    """(slot, gram, target, background): exact counts over all rows of (is_target, text as bytes).

    Slots: words first, then contexts (with a space behind), then pairs.
    """
    rows = asked(staged(docs.withColumn("id", F.lit(None).cast("long"))), 1).select("grams", "target", "background")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                grams, target, background = _unpacked(row)
                grams = grams.split(b"\n")
                slot = [0 if b" " not in g else WORDS if g[-1:] == b" " else WORDS + 1 for g in grams]
                yield pd.DataFrame({"slot": slot, "gram": grams, "target": np.frombuffer(target, "<u4"), "background": np.frombuffer(background, "<u4")})

    found = rows.mapInPandas(work, "slot int, gram binary, target long, background long").filter("background > 0")
    return found.groupBy("slot", "gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def answers(requests: DataFrame) -> DataFrame:
    """(chunk, bucket, target, background, words): the counts over all chunks, and the bucket's number of words."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        lines = np.frombuffer(b"\n".join(_unpacked(part["grams"])) + b"\n", np.uint8)
        offsets = np.concatenate(([0], np.flatnonzero(lines == 10) + 1)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(lines)]).dictionary_encode()
        codes, names = coded.indices.to_numpy(), coded.dictionary
        # Neither contexts nor pairs, which have a space, nor the start of a text, which is an empty line.
        words = int(np.sum((pc.count_substring(names, " ").to_numpy() == 0) & (pc.binary_length(names).to_numpy() > 1)))
        counts = {c: _unpacked(part[c]) for c in ("target", "background")}
        sizes = np.array([len(x) // 4 for x in counts["background"]])
        out = {"chunk": part["chunk"], "bucket": part["bucket"]}
        for c, values in counts.items():
            total = np.bincount(codes, weights=np.frombuffer(b"".join(values), "<u4"), minlength=len(names)).astype("<i8")
            out[c] = _packed([x.tobytes() for x in np.split(total[codes], np.cumsum(sizes)[:-1])])
        return pd.DataFrame(out | {"words": words})

    return _written(requests.groupBy("bucket").applyInPandas(add, "chunk string, bucket int, target binary, background binary, words long"), "lm-answers")


def _own(row: np.ndarray, gram: np.ndarray, grams: int) -> np.ndarray:
    """Of each token how often its gram stands in its own row."""
    _, at, count = np.unique(row * grams + gram, return_inverse=True, return_counts=True)
    return count[at]


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", prior: float = 50.0) -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, score) of every row against models of all rows; target rows have a positive label."""
    bounded_batches(docs.sparkSession)
    good = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).groupBy("id").agg((F.max("label") > 0).alias("is_target"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    buckets = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES
    # Labels grow with the corpus, so they are shuffled at every size and never broadcast.
    # A null id has no label; such rows are dealt by their texts, not all to one task.
    spread = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(0)
    good = good.withColumn("spread", F.lit(0).cast("long"))
    marked = rows.withColumn("spread", spread.cast("long")).join(good.hint("merge"), ["id", "spread"], "left").select("id", F.coalesce("is_target", F.lit(False)).alias("is_target"), "text")
    chunks = staged(marked)
    replies = answers(asked(chunks, buckets))
    totals = np.array(chunks.agg(F.coalesce(F.sum("targets"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first(), dtype=np.float64)
    words = max(1, replies.groupBy("bucket").agg(F.max("words").alias("words")).agg(F.sum("words")).first()[0] or 0)
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("n_tokens", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("target_loss", "background_loss", "score")],
    ])

    def score(chunk: pa.Table, replies: pa.Table) -> pa.Table:
        hashes = _hashes(chunk["words"][0].as_py().split(b"\n"))
        codes = _texts(chunk["sizes"][0].as_py(), chunk["codes"][0].as_py())
        pairs, at = np.unique(_pairs(codes, len(hashes)), return_inverse=True)
        order = np.argsort(_dealt(hashes, pairs, buckets), kind="stable")
        replies = replies.sort_by("bucket")
        n, size = len(hashes), np.array([len(x) for x in codes], dtype=np.int64)
        row = np.repeat(np.arange(len(codes)), size)
        # Of each token the places of its word, its context and its pair among the counts.
        grams = ((pairs % n)[at], n + (pairs // n)[at], 2 * n + at)
        own = [_own(row, g, len(order)) for g in grams]
        losses = []
        for c, total, adds in (("target", totals[0], np.frombuffer(chunk["goods"][0].as_py(), bool)), ("background", totals[1], np.ones(len(codes), dtype=bool))):
            counts = np.empty(len(order), dtype=np.int64)
            counts[order] = np.frombuffer(b"".join(_unpacked(replies[c].to_pylist())), "<i8")
            word, context, pair = (counts[g] - o * adds[row] for g, o in zip(grams, own, strict=True))
            unigram = (word + 1.0) / (total - size * adds + words)[row]
            loss = -np.log((pair + prior * unigram) / (context + prior))
            losses.append(np.bincount(row, weights=loss, minlength=len(codes)) / np.maximum(size, 1))
        return pa.table([pc.list_flatten(chunk["ids"]), size, *losses, losses[0] - losses[1]], names=schema.names)

    left = chunks.select("chunk", "words", "ids", "goods", "sizes", "codes")
    right = replies.select("chunk", "bucket", "target", "background")
    return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(score, schema)
