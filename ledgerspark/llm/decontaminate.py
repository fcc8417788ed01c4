"""Benchmark decontamination: BM25 index of test items, block-max pruning, overlap check.

The test items are the indexed side; every training passage is a query. A passage is a
window of words; windows are twice as long as the longest item of their length class and
start every half window, so each item that a text holds lies whole in some window.

Scores are BM25 with each item's own score as the unit: 1.0 means that a passage holds
all of an item's words. This is block-max WAND with a fixed threshold: there is no top-k, so
the threshold never moves and nothing at or above it is lost.

1. List maxima: the largest share that any item gets from each of the window's terms. If
   they add up to less than the least that a block needs, no list is opened.
2. Block maxima: the lists of the window's terms name blocks of a few items, with the largest
   share in the block. Blocks whose sum stays below their need are skipped.
3. The items of the remaining blocks are scored one by one.

Terms of many items are left out of the lists of blocks that need others besides; what an
item gets from them is granted. Windows are worked on a
bounded number at a time, whatever the length of a text.

Every retrieved window is verified. It counts if runs of five words that it shares with the
item cover enough of the item, of its question and of its answer; a text and an item give
one row, that of the verified window with the largest overlap. Items without a column of
answers are verified by their two halves.

The index is broadcast. Its size follows the test items, not the corpus; more than
``index_bytes`` of item text are split into that many indexes, which are applied in turn.

Defined cases: null or empty texts hold nothing; null or empty items are never found;
items of under five words must occur whole; repeated rows are judged each for itself and
ids may be null; repeated items are separate items; very long texts are read whole; of equal
overlaps the larger parts, then the larger score count; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm._common import bounded_batches, cut

#: Words of a shared run.
RUN = 5
#: Windows, and entries of posting lists, that are worked on at once.
WINDOWS = 4096
CELLS = 2_000_000
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-case words; punctuation and spaces separate them."""
    return _WORD.findall((text or "").lower())


class Blocks(NamedTuple):
    """Items of one length class, none longer than ``half`` words, in blocks with their posting lists."""

    half: int
    blocks: list[list[int]]
    first: np.ndarray
    where: np.ndarray
    most: np.ndarray
    top: np.ndarray
    need: np.ndarray


@dataclass
class Index:
    """Inverted index of the test items in blocks of ``block`` items."""

    ids: pa.Array
    words: list[list[str]]
    split: list[int]
    threshold: float
    block: int = 4
    common_share: float = 0.05
    k1: float = 1.2
    b: float = 0.75

    def __post_init__(self) -> None:
        words, self.words = self.words, []
        frequency = Counter(w for own in words for w in set(own))
        mean = max(1.0, sum(map(len, words)) / max(1, len(words)))
        n = len(words)
        self.term = {w: k for k, w in enumerate(sorted(frequency))}
        self.items = [np.array([self.term[w] for w in own], dtype=np.int32) for own in words]
        self.shares: list[tuple[np.ndarray, np.ndarray]] = []
        for own in words:
            norm = self.k1 * (1 - self.b + self.b * len(own) / mean)
            gain = {t: math.log(1 + (n - frequency[t] + 0.5) / (frequency[t] + 0.5)) * tf * (self.k1 + 1) / (tf + norm) for t, tf in Counter(own).items()}
            whole = sum(gain.values())
            self.shares.append((np.array([self.term[t] for t in gain], dtype=np.int32), np.array([g / whole for g in gain.values()])))
        self.common = np.array([frequency[t] > max(4, self.common_share * n) for t in self.term], dtype=bool)
        classes: dict[int, list[int]] = defaultdict(list)
        for i, own in enumerate(words):
            if own:
                classes[max(32, 1 << (len(own) - 1).bit_length())].append(i)
        self.classes = [self._blocks(half, classes[half]) for half in sorted(classes)]

    def _blocks(self, half: int, items: list[int]) -> Blocks:
        """Posting lists with their maxima, and what each block needs from them."""
        blocks = [items[k : k + self.block] for k in range(0, len(items), self.block)]
        lists: dict[int, dict[int, float]] = defaultdict(dict)
        need = np.full(len(blocks), self.threshold)
        for number, block in enumerate(blocks):
            most: dict[int, float] = {}
            own = [dict(zip(*map(np.ndarray.tolist, self.shares[i]), strict=True)) for i in block]
            for shares in own:
                for t, share in shares.items():
                    most[t] = max(share, most.get(t, 0.0))
            # Common terms have no entry; what any item gets from them is granted, but never all that the threshold asks for.
            granted = [0.0] * len(block)
            for t in sorted((t for t in most if self.common[t]), key=lambda t: (most[t], t)):
                more = [x + shares.get(t, 0.0) for x, shares in zip(granted, own, strict=True)]
                if max(more) > 0.95 * self.threshold:
                    break
                granted = more
                del most[t]
            need[number] -= max(granted)
            for t, share in most.items():
                lists[t][number] = share
        first, where, most, top = np.zeros(len(self.term) + 1, dtype=np.int64), [], [], np.zeros(len(self.term))
        for t in range(len(self.term)):
            own = lists.get(t, {})
            where += own.keys()
            most += own.values()
            top[t] = max(own.values(), default=0.0)
            first[t + 1] = len(where)
        return Blocks(half, blocks, first, np.array(where, dtype=np.int64), np.array(most, dtype=np.float64), top, need)

    def retrieve(self, texts: list[np.ndarray]) -> list[dict[int, list[tuple[float, int, int]]]]:
        """For each text, item -> (score, first word, end) of every window at or above the threshold.

        A text is the term numbers of its words, -1 for words that no item has. Texts are
        laid end to end in halves of windows; a window at a seam may see two texts, which
        can only raise its bounds.
        """
        found: list[dict[int, list[tuple[float, int, int]]]] = [defaultdict(list) for _ in texts]
        for part in self.classes:
            begins = np.concatenate(([0], np.cumsum([-(-len(x) // part.half) for x in texts])))
            places, terms = [], []
            for x, begin in zip(texts, begins, strict=False):
                rare = np.flatnonzero((x >= 0) & (part.top[x] > 0))
                places.append(rare + begin * part.half)
                terms.append(x[rare])
            place, term = np.concatenate(places), np.concatenate(terms)
            for low in range(0, int(begins[-1]), WINDOWS):
                high = min(low + WINDOWS, int(begins[-1]))
                # Window w has the halves w and w + 1.
                a, e = np.searchsorted(place, [low * part.half, (high + 1) * part.half])
                last = -1
                for window, number in self._candidates(part, place[a:e] // part.half, term[a:e], low, high):
                    if window != last:
                        last, k = window, int(np.searchsorted(begins, window, side="right")) - 1
                        start = int(window - begins[k]) * part.half
                        end = min(len(texts[k]), start + 2 * part.half)
                        here = set(texts[k][start:end].tolist())
                    for i in part.blocks[number]:
                        score = sum(share for t, share in zip(*map(np.ndarray.tolist, self.shares[i]), strict=True) if t in here)
                        if score >= self.threshold - 1e-9:
                            found[k][i].append((score, start, end))
        return found

    def _candidates(self, part: Blocks, half: np.ndarray, term: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
        """(window, block) whose bounds reach what the block needs, for the windows ``[low, high)``."""
        window = np.concatenate([half, half - 1])
        inside = (window >= low) & (window < high)
        # A word counts once in a window.
        pair = np.unique((window[inside] - low) * len(self.term) + np.tile(term, 2)[inside])
        window, term = pair // len(self.term), pair % len(self.term)
        able = np.bincount(window, weights=part.top[term], minlength=high - low) >= part.need.min() - 1e-9
        window, term = window[able[window]], term[able[window]]
        n, blocks = part.first[term + 1] - part.first[term], len(part.blocks)
        ends = np.cumsum(n)
        at = 0
        while at < len(n):
            # So many whole windows that their lists stay small; one window's lists are bounded by the index.
            stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, side="right"))
            stop = int(np.searchsorted(window, window[stop], side="left")) if stop < len(n) else stop
            stop = stop if stop > at else int(np.searchsorted(window, window[at], side="right"))
            t, m = term[at:stop], n[at:stop]
            slot = np.repeat(part.first[t] - np.cumsum(m) + m, m) + np.arange(m.sum())
            cells, own = np.unique(np.repeat(window[at:stop], m) * blocks + part.where[slot], return_inverse=True)
            bound = np.bincount(own, weights=part.most[slot], minlength=len(cells))
            for c in cells[bound >= part.need[cells % blocks] - 1e-9].tolist():
                yield low + c // blocks, c % blocks
            at = stop

    def overlap(self, i: int, ids: np.ndarray) -> tuple[float, float, float]:
        """Shares of the item, its question and its answer that shared runs of words cover."""
        item = self.items[i]
        step = min(RUN, len(item))
        there = {tuple(x) for x in np.lib.stride_tricks.sliding_window_view(ids, step).tolist()} if len(ids) >= step else set()
        covered = np.zeros(len(item), dtype=bool)
        for k, run in enumerate(np.lib.stride_tricks.sliding_window_view(item, step).tolist()):
            if tuple(run) in there:
                covered[k : k + step] = True
        question, answer = covered[: self.split[i]], covered[self.split[i] :]
        return float(covered.mean()), float(question.mean()) if len(question) else 1.0, float(answer.mean()) if len(answer) else 1.0

    def matches(self, texts: Iterable[str | None], least: float, least_part: float) -> list[list[tuple[int, float, float, float, float]]]:
        """For each whole text, (item, score, overlap, question, answer) of the items that it holds."""
        get = self.term.get
        each = [np.array([get(w, -1) for w in words_of(text)], dtype=np.int32) for text in texts]
        out = []
        for ids, items in zip(each, self.retrieve(each) if self.term and each else [{}] * len(each), strict=True):
            out.append([])
            for i, windows in sorted(items.items()):
                held = ((score, *self.overlap(i, ids[a:e])) for score, a, e in windows)
                # Scores ignore the order of words, so each window is verified; the best verified one is told.
                verified = [x for x in held if x[1] >= least and x[2] >= least_part and x[3] >= least_part]
                if verified:
                    out[-1].append((i, *max(verified, key=lambda x: (x[1:], x[0]))))
        return out


def indexes(benchmark: DataFrame, threshold: float, id_col: str = "item_id", text_col: str = "text", answer_col: str | None = None, index_bytes: int = 8 << 20, distinct: bool = False) -> Iterator[Index]:
    """One index for each part of the test items of at most ``index_bytes``; only items of over half of that can make a part larger, by one item.

    ``distinct``: items with equal texts once, where only it matters that one is held.
    """
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("question"), answer.alias("answer"))
    size = F.coalesce(F.octet_length("question"), F.lit(0)) + F.coalesce(F.octet_length("answer"), F.lit(0))
    if distinct:
        items = items.groupBy("question", "answer").agg(F.min("id").alias("id")).select("id", "question", "answer")
    order = ["id", "question", "answer", "_row"]
    ranged = items.withColumns({"_size": size.cast("long"), "_row": F.monotonically_increasing_id()}).repartitionByRange(*order).sortWithinPartitions(*order)
    # Within a range, by what its items have before them; a cell holds less than half a part, or one item.
    before = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    ranged = cut(ranged.withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}))
    ranged = cut(ranged.withColumn("_cell", F.floor((F.sum("_size").over(before) - F.col("_size")) / max(1, index_bytes // 2))))
    parts, room = [], 0
    # A row for each range and half a part of items.
    for r in ranged.groupBy("_range", "_cell").agg(F.sum("_size").alias("size"), F.min("_place").alias("low"), F.max("_place").alias("high")).orderBy("low").collect():
        if not parts or r["size"] > room:
            parts.append([r["low"], r["high"]])
            room = index_bytes
        parts[-1][1] = r["high"]
        room -= r["size"]
    for low, high in parts:
        rows = ranged.filter(F.col("_place").between(low, high)).orderBy("_place").select("id", "question", "answer").toArrow()
        words, split = [], []
        for question, answer in zip(rows["question"].to_pylist(), rows["answer"].to_pylist(), strict=True):
            q, a = words_of(question), words_of(answer)
            words.append(q + a)
            split.append(len(q) if a else len(q) // 2)
        yield Index(rows["id"].combine_chunks(), words, split, threshold)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, overlap: float = 0.8, part_overlap: float = 0.5, **items) -> DataFrame:
    """(id, item_id, score, overlap, question_overlap, answer_overlap): every item that a row's whole text holds."""
    spark = docs.sparkSession
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("item_id", benchmark.schema[items.get("id_col", "item_id")].dataType),
        *[T.StructField(c, T.DoubleType()) for c in ("score", "overlap", "question_overlap", "answer_overlap")],
    ])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    bounded_batches(spark)
    found = None
    for index in indexes(benchmark, threshold, **items):
        shared = spark.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                held = index.matches(batch.column("text").to_pylist(), overlap, part_overlap)
                out = [(row, *item) for row, items in enumerate(held) for item in items]
                row, item, *numbers = zip(*out, strict=True) if out else [()] * 6
                keys = [batch.column("id").take(pa.array(row, pa.int64())), index.ids.take(pa.array(item, pa.int64()))]
                yield pa.RecordBatch.from_arrays([*keys, *[pa.array(x, pa.float64()) for x in numbers]], names=schema.names)

        part = rows.mapInArrow(work, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def _is_clean(text: Column, shared: Broadcast, overlap: float, part_overlap: float) -> Column:
    @F.pandas_udf(T.BooleanType())
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not items for items in shared.value.matches(texts, overlap, part_overlap)], dtype=bool)

    return clean(text)


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = 0.5, overlap: float = 0.8, part_overlap: float = 0.5, **items) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    bounded_batches(docs.sparkSession)
    for index in indexes(benchmark, threshold, **items, distinct=True):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.filter(_is_clean(F.col(text_col), shared, overlap, part_overlap))
    return docs
