"""Best-fit packing with swap-based local search.

A document is its token ids and an end id. Longer ones than a sequence are cut into
pieces; the first piece takes the remainder, so every later piece fills a sequence alone
and at most one piece of a document has to be packed with others. Pieces are dealt in turn
over groups; each group is packed in one task that streams its full pieces and holds only
the lengths of the others:

1. best fit, longest first, with one stack of bins for each free space;
2. local search over all bins that are not full: move an item, exchange one for one or two
   for one, always so that the sum of squared fills grows, until bins empty and no such
   step is left.

Groups number ``rows / rows_per_group``, so a group's size doesn't depend on the input.
Groups are unconnected, so the sequences lost against one large group are at most one or
so for each group.

Defined cases: a null text counts as empty (one piece: the end id); ids may be null or
repeat; repeated rows are packed each for itself and spread over the groups; an empty table
gives no rows; very long texts are cut into any number of pieces; other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm._common import bounded_batches

#: Texts of these characters alone are split alike by both libraries; others go to the slower one.
_PLAIN = regex.compile(r"[^\t\n\r\x20-\x7e\xa0-ɏ‐-‧€]")


@cache
def encoder(name: str) -> Callable[[str], np.ndarray]:
    """Whole text to token ids of the named vocabulary; the faster library where both agree."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if "<|" in text or _PLAIN.search(text):
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 1024, end_id: int = 2, tokenizer: str = "byte_bpe_50k", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the pieces of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: len(fields) - 1]
    bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            owner, out = [], []
            for row, text in enumerate(batch.column("text")):
                ids = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                first = len(ids) % size or size
                for k, start in enumerate([0, *range(first, len(ids), size)]):
                    part = ids[start : start + (size if k else first)].tobytes()
                    owner.append(row)
                    out.append((k, start, len(part) // 4, zlib.crc32(part), part))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=False)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(owner, pa.int64())), *columns], names=[f.name for f in fields])

    return rows.mapInArrow(work, T.StructType(fields))


class Bins:
    """Bins of one capacity. A bin is a multiset of lengths, ``{length: count}``: items of one length are alike."""

    def __init__(self, capacity: int, bins: Iterable[dict[int, int]] = ()) -> None:
        self.capacity = capacity
        self.held = [dict(b) for b in bins]
        self.fill = [sum(length * n for length, n in b.items()) for b in self.held]

    def best_fit(self, lengths: list[int]) -> None:
        """Longest first, each into the fullest bin that still takes it."""
        stacks: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        open_spaces = 0  # bit f: some bin has f free
        for need in sorted(lengths, reverse=True):
            fits = open_spaces >> need
            if fits:
                free = need + (fits & -fits).bit_length() - 1
                b = stacks[free].pop()
                if not stacks[free]:
                    open_spaces &= ~(1 << free)
            else:
                b, free = len(self.held), self.capacity
                self.held.append({})
                self.fill.append(0)
            self.held[b][need] = self.held[b].get(need, 0) + 1
            self.fill[b] += need
            if left := free - need:
                stacks[left].append(b)
                open_spaces |= 1 << left

    def improve(self) -> None:
        """Moves and exchanges between underfull bins, each of which raises the sum of squared fills, until none is left.

        Every bin that is not full looks up, over all other bins that are not full, what
        fills its free space best: an item, an item for one of its own, or two items of one
        bin for one of its own. When bin ``a`` gains ``d`` from bin ``b`` the sum rises if
        ``fill(b) < fill(a) + d``; of the bins that have what is needed the emptiest gives,
        so that it empties.
        """
        self.offers: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.masks = [0, 0, 0]  # bit s of masks[k]: some bin may offer k items of sum s
        under = [b for b in range(len(self.held)) if 0 < self.fill[b] < self.capacity]
        for b in under:
            self._offer(b)
        waiting, whole = set(under), True
        while waiting:
            changed: set[int] = set()
            for a in sorted(waiting, key=lambda b: (-self.fill[b], b)):
                while 0 < self.fill[a] < self.capacity and (found := self._best(a)):
                    out, b, come = found
                    self._exchange(a, b, out, come)
                    changed |= {a, b}
            # Bins that changed come again at once; when they have settled, all do once more.
            whole = not changed and not whole
            waiting = changed or (set(b for b in range(len(self.held)) if 0 < self.fill[b] < self.capacity) if whole else set())

    def _pairs(self, b: int) -> Iterator[tuple[int, int]]:
        """Two items of a bin. Its lengths differ in less than ``sqrt(2 capacity)`` ways, so pairs are few for any number of items."""
        own = sorted(self.held[b])
        for k, x in enumerate(own):
            if self.held[b][x] > 1:
                yield x, x
            for y in own[k + 1 :]:
                yield x, y

    def _offer(self, b: int) -> None:
        """List what the bin can give, under its present fill; older entries of it no longer count."""
        for come in [*((x,) for x in self.held[b]), *self._pairs(b)]:
            key = len(come), sum(come)
            heappush(self.offers.setdefault(key, []), (self.fill[b], b))
            self.masks[key[0]] |= 1 << key[1]

    def _giver(self, a: int, n: int, total: int, below: int) -> tuple[int, tuple[int, ...]] | None:
        """The emptiest other bin of a fill under ``below`` that holds ``n`` items of sum ``total``, and the items."""
        heap, own, found = self.offers.get((n, total), []), None, None
        while heap:
            fill, b = heap[0]
            come = None
            if self.fill[b] == fill and fill < self.capacity:
                come = ((total,) if total in self.held[b] else None) if n == 1 else next((p for p in self._pairs(b) if sum(p) == total), None)
            if come and b != a:
                found = (b, come) if fill < below else None
                break
            own = heappop(heap) if come else (heappop(heap), own)[1]
        if own:
            heappush(heap, own)
        if not heap:
            self.masks[n] &= ~(1 << total)
        return found

    def _best(self, a: int) -> tuple[tuple[int, ...], int, tuple[int, ...]] | None:
        """(out, b, come) of the largest gain for bin ``a``."""
        free = self.capacity - self.fill[a]
        window = (1 << (free + 1)) - 2
        own = [0, *sorted(self.held[a])]
        gains = 0
        for x in own:
            gains |= self.masks[1] >> x | (self.masks[2] >> x if x else 0)
        gains &= window
        while gains:
            d = gains.bit_length() - 1
            for x in own:
                for n in (1, 2) if x else (1,):
                    if self.masks[n] >> (x + d) & 1 and (found := self._giver(a, n, x + d, self.fill[a] + d)):
                        return ((x,) if x else (), *found)
            gains ^= 1 << d
        return None

    def _exchange(self, a: int, b: int, out: tuple[int, ...], come: tuple[int, ...]) -> None:
        for bin_, drop, take in ((a, out, come), (b, come, out)):
            held = self.held[bin_]
            for x in drop:
                held[x] -= 1
                if not held[x]:
                    del held[x]
            for x in take:
                held[x] = held.get(x, 0) + 1
            self.fill[bin_] += sum(take) - sum(drop)
        self._offer(a)
        self._offer(b)


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of each bin."""
    bins = Bins(capacity)
    bins.best_fit(lengths)
    bins.improve()
    items: dict[int, list[int]] = {}
    for item in range(len(lengths) - 1, -1, -1):
        items.setdefault(lengths[item], []).append(item)
    return [[items[x].pop() for x in sorted(held, reverse=True) for _ in range(held[x])] for held in bins.held if held]


def place(cut: DataFrame, size: int = 1024, groups: int = 1) -> DataFrame:
    """Adds sequence_id and offset to the rows of ``pieces``."""
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def placed(rows: pa.RecordBatch, sequence: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, used, rest = TaskContext.get().partitionId() << 40, 0, []
        for batch in batches:
            whole = pc.equal(batch.column("length"), size)
            full = batch.filter(whole)
            if n := full.num_rows:
                yield placed(full, base + used + np.arange(n), np.zeros(n))
                used += n
            if n < batch.num_rows:
                rest.append(batch.filter(pc.invert(whole)))
        if rest:
            short = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
            lengths = short.column("length").to_pylist()
            sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
            for k, items in enumerate(pack_lengths(lengths, size)):
                at = 0
                for item in items:
                    sequence[item], offset[item] = base + used + k, at
                    at += lengths[item]
            for k in range(0, len(lengths), 10_000):
                yield placed(short.slice(k, 10_000), sequence[k : k + 10_000], offset[k : k + 10_000])

    # Dealt in turn, so that equal rows spread as well; a fixed order makes a task that runs again pack alike.
    dealt = cut.repartition(groups)
    return dealt.sortWithinPartitions(F.desc("length"), "id", "piece", "ids_crc32").mapInArrow(work, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 1024, end_id: int = 2, tokenizer: str = "byte_bpe_50k", rows_per_group: int = 100_000, with_ids: bool = False) -> DataFrame:
    """Pieces of every row with their place: (id, piece, start, length, ids_crc32[, ids], sequence_id, offset).

    With ids a group holds the ids of its short pieces, too: choose ``rows_per_group`` by ``4 * size`` bytes a row.
    """
    groups = max(1, -(-docs.count() // rows_per_group))
    return place(pieces(docs, id_col, text_col, size, end_id, tokenizer, with_ids), size, groups).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences as little-endian unsigned 32-bit ids; needs ``with_ids``."""
    parts = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))
