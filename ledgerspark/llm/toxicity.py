"""Toxicity: averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with word marks) and of itself, hashed into a
fixed table of embeddings; a passage is the mean of its words; a linear softmax turns the
mean into two classes. Table and softmax are trained together, so an unseen misspelling
shares the vectors of the n-grams that it keeps.

A text is read whole, as overlapping windows of words, and scores as its worst window: a
toxic passage in a long text isn't averaged away. Windows of under half the width are
filled up with neutral words, and a word right after itself counts once, so that no single
word makes a passage. Training follows the same rule: after a
start on whole texts each step uses every text's currently worst window.

The model is fitted on the driver on at most ``most_rows`` labelled rows and ``most_bytes``
of their whole texts (a bounded sample by hash of the id, the documented bounds); every row is scored. Its size is fixed by
``buckets`` and ``dim``. Only the text enters a score.

Defined cases: a null text counts as empty and scores as the bias alone; labels that are
null are ignored, of repeated labels for one id the largest counts; labels for unknown ids
are ignored; with labels of one class or none every score is that class's rate (0 for no
labels); repeated rows are each scored; a null id is never held out; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm._common import beside

BUCKETS = 1 << 16
#: Tokens that are hashed at once.
TOKENS_AT_ONCE = 50_000
#: Tokens whose scores a worker remembers before it starts anew.
REMEMBERED = 400_000
_EDGES = ".,;:!?\"'()[]{}<>|#$%&*_~`-"


def hashed(tokens: list[str], buckets: int, shortest: int = 3, longest: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """(token number, bucket) of every character n-gram of the tokens, with word marks, and of each token itself.

    The n-grams of all tokens are hashed together: one polynomial step a length.
    """
    words = [f"<{t.lower().strip(_EDGES)}>" for t in tokens]
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    owner = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    owners = [np.arange(len(words), dtype=np.int32)]
    slots = [np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), dtype=np.int64, count=len(words)) % buckets]
    state = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, longest + 1):
        last = len(codes) - n + 1
        state = state[: max(0, last)] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(1)
        if n >= shortest:
            fits = room[: len(state)] >= n
            mixed = (state[fits] ^ (state[fits] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            owners.append(owner[: len(state)][fits])
            slots.append(((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(slots)


def tokens_of(text: str | None) -> list[str]:
    """Tokens of the whole text; a token right after itself counts once, so a chant is one word."""
    tokens = (text or "").split()
    return tokens[:1] + [b for a, b in zip(tokens, tokens[1:], strict=False) if a != b]


def window_bounds(n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of overlapping windows that cover ``n`` words."""
    if n <= width:
        return np.array([0]), np.array([n])
    first = np.arange(0, n - width // 2, width // 2)
    return first, np.minimum(first + width, n)


@dataclass
class Model:
    """Projected model: one number for each subword bucket (its embedding times the softmax) and a bias."""

    weights: np.ndarray
    bias: float
    width: int
    seen: dict[str, float] = field(default_factory=dict)

    def values(self, tokens: list[str]) -> np.ndarray:
        """Mean weight of the n-grams of each token."""
        owner, slot = hashed(tokens, len(self.weights))
        return np.bincount(owner, weights=self.weights[slot], minlength=len(tokens)) / np.bincount(owner, minlength=len(tokens))

    def scores(self, texts: Iterable[str | None]) -> list[float]:
        """Probability of the toxic class in the worst window of each whole text."""
        out: list[float] = []
        held: list[list[str]] = []
        count = 0
        for text in texts:
            held.append(tokens_of(text))
            count += len(held[-1])
            if count >= TOKENS_AT_ONCE:
                out += self._scored(held)
                held, count = [], 0
        return out + self._scored(held)

    def _scored(self, texts: list[list[str]]) -> list[float]:
        seen = self.seen
        if len(seen) > REMEMBERED:
            seen.clear()
        new = list({t for tokens in texts for t in tokens if t not in seen})
        for k in range(0, len(new), TOKENS_AT_ONCE):
            part = new[k : k + TOKENS_AT_ONCE]
            seen.update(zip(part, self.values(part).tolist(), strict=True))
        out = []
        for tokens in texts:
            sums = np.zeros(len(tokens) + 1)
            np.cumsum(np.fromiter(map(seen.__getitem__, tokens), dtype=np.float64, count=len(tokens)), out=sums[1:])
            first, end = window_bounds(len(tokens), self.width)
            worst = ((sums[end] - sums[first]) / np.maximum(end - first, self.width // 2)).max()
            out.append(float(1 / (1 + np.exp(-np.clip(worst + self.bias, -40, 40)))))
        for t in new:
            if len(t) >= 64:
                del seen[t]
        return out

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def train(texts: list[str | None], labels: list[int], buckets: int = BUCKETS, dim: int = 8, width: int = 32, warm: int = 50, steps: int = 70, rate: float = 0.3, floor: float = 0.01, decay: float = 1e-3, seed: int = 7) -> Model:
    """Joint full-batch training of embeddings and softmax with Adam.

    ``floor``: the part of the largest gradient below which steps shrink with the
    gradient, so n-grams of one or two texts can't learn a wrong label by heart.
    """
    y = np.asarray(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        base = float(y[0]) if len(y) else 0.0
        return Model(np.zeros(buckets), 40.0 if base else -40.0, width)
    # Flat arrays of 32-bit numbers: lists of Python numbers would take ten times the memory of the driver.
    number: dict[str, int] = {}
    flat, lengths = array("i"), []
    for text in texts:
        own = tokens_of(text)
        flat.extend(number.setdefault(t, len(number)) for t in own)
        lengths.append(len(own))
    if not flat:
        return Model(np.zeros(buckets), float(np.log(y.mean() / (1 - y.mean()))), width)
    tokens = np.frombuffer(flat, dtype=np.int32)
    words, grams = list(number), len(number)
    del number
    # Words whose n-grams are worked on at once: a bound on the memory of a step.
    parts = [(k, min(k + TOKENS_AT_ONCE, grams)) for k in range(0, grams, TOKENS_AT_ONCE)]
    gram, size = array("i"), np.empty(grams, dtype=np.int64)
    for p, q in parts:
        owner_of, slot = hashed(words[p:q], buckets)
        gram.frombytes(slot[np.argsort(owner_of, kind="stable")].astype(np.int32).tobytes())
        size[p:q] = np.bincount(owner_of, minlength=q - p)
    gram = np.frombuffer(gram, dtype=np.int32)
    del words
    starts = np.concatenate(([0], np.cumsum(size)))

    begin = np.concatenate(([0], np.cumsum(lengths)))
    bounds = [window_bounds(n, width) for n in lengths]
    owner = np.repeat(np.arange(len(lengths)), [len(b[0]) for b in bounds])
    first = np.concatenate([b[0] for b in bounds]) + begin[owner]
    end = np.concatenate([b[1] for b in bounds]) + begin[owner]
    opening = np.concatenate(([0], np.cumsum([len(b[0]) for b in bounds])))[:-1]

    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (buckets, dim))
    softmax = rng.normal(0, 0.1, (2, dim))
    bias = np.array([0.0, np.log(y.mean() / (1 - y.mean()))])
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (table, softmax, bias)]

    for step in range(1, warm + steps + 1):
        weight = table @ (softmax[1] - softmax[0])
        value = np.concatenate([np.add.reduceat(weight[gram[starts[p] : starts[q]]], starts[p:q] - starts[p]) for p, q in parts]) / size
        sums = np.zeros(len(tokens) + 1)
        np.cumsum(value[tokens], out=sums[1:])
        if step <= warm:
            a, e = begin[:-1], begin[1:]
        else:
            mean = (sums[end] - sums[first]) / np.maximum(end - first, width // 2)
            top = np.maximum.reduceat(mean, opening)
            best = np.full(len(lengths), -1)
            hit = np.flatnonzero(mean == top[owner])[::-1]
            best[owner[hit]] = hit
            a, e = first[best], end[best]
        n = np.maximum(e - a, width // 2)
        logit = (sums[e] - sums[a]) / n + bias[1] - bias[0]
        wrong = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y
        # The softmax is linear in the mean, so the loss reaches each subword as one number.
        share = np.zeros(len(tokens) + 1)
        np.add.at(share, a, wrong / n)
        np.add.at(share, e, -wrong / n)
        by_word = np.bincount(tokens, weights=np.cumsum(share, out=share)[:-1], minlength=grams) / size
        by_gram = sum(np.bincount(gram[starts[p] : starts[q]], weights=np.repeat(by_word[p:q], size[p:q]), minlength=buckets) for p, q in parts) / len(y)
        pull = by_gram @ table
        slope = wrong.mean()
        gradients = (np.outer(by_gram, softmax[1] - softmax[0]) + decay * table / buckets, np.stack([-pull, pull]) + decay * softmax / buckets, np.array([-slope, slope]))
        for parameter, gradient, moment in zip((table, softmax, bias), gradients, moments, strict=True):
            moment[0] += 0.1 * (gradient - moment[0])
            moment[1] += 0.01 * (gradient * gradient - moment[1])
            scale = np.sqrt(moment[1] / (1 - 0.99**step))
            parameter -= rate * (moment[0] / (1 - 0.9**step)) / (scale + floor * scale.max() + 1e-12)
    return Model(table @ (softmax[1] - softmax[0]), float(bias[1] - bias[0]), width)


def held_out(id_col: Column) -> Column:
    """Rows kept from training: CRC-32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, most_rows: int, most_bytes: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list, list]:
    """Whole texts and labels of labelled ids that are not held out, in the order of a hash of the ids.

    One text for each id, that with the least digest; at most ``most_rows`` ids are looked at, and a text that doesn't fit into
    what is left of ``most_bytes`` is passed over. Raises if there are labelled texts and none fits.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter("id is not null and label is not null")
    marked = marked.filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    order = [F.md5(F.col("id").cast("string")), F.col("id")]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    # The chosen ids are bounded by most_rows: safe to broadcast, to sort in one task and to collect at any input size.
    chosen = F.broadcast(marked.orderBy(*order).limit(most_rows))
    body = F.coalesce("text", F.lit(""))
    sizes = texts.join(chosen, "id").groupBy("id", "label").agg(F.min(F.struct(F.md5(body).alias("digest"), F.octet_length(body).cast("long").alias("size"))).alias("own"))
    fits, room = [], most_bytes
    for r in sizes.orderBy(*order).select("id", "label", "own.*").collect():
        if r["size"] <= room:
            fits.append((r["id"], r["label"], r["digest"]))
            room -= r["size"]
        else:
            fits.append(None)
    taken = [x for x in fits if x]
    if fits and not taken:
        raise ValueError(f"no labelled text has at most {most_bytes} bytes")
    if not taken:
        return [], []
    wanted = docs.sparkSession.createDataFrame(taken, T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("label", labels.schema[label_col].dataType), T.StructField("digest", T.StringType())]))
    own = texts.withColumn("digest", F.md5(body)).join(F.broadcast(wanted), ["id", "digest"])
    rows = own.groupBy("id", "label").agg(F.first("text").alias("text")).toArrow()
    keyed = sorted(zip(rows.column("id").to_pylist(), rows.column("text").to_pylist(), rows.column("label").to_pylist(), strict=True), key=lambda r: (hashlib.md5(str(r[0]).encode()).digest(), r[1] or ""))
    return [r[1] for r in keyed], [int(r[2] > 0) for r in keyed]


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 8000, most_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> Model:
    """Fit on a bounded sample of the labelled rows."""
    return train(*sample(docs, labels, most_rows, most_bytes, id_col, text_col, label_col), **options)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = beside(rows, "text", {"score": "double"}, lambda texts: [shared.value.scores(texts)])
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
