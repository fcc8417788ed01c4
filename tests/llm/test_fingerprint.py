"""Fingerprints against plain versions of sketch, order and likeness, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import DATA

from ledgerspark.llm import fingerprint
from ledgerspark.llm import queries as llm

SMALL = str(DATA / "sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MASK = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_word(word):
    raw = word.encode().replace(b"\0", b"\xff")
    if len(raw) > 64:
        return plain_mix(xxhash.xxh64_intdigest(raw))
    h = 0xCBF29CE484222325
    for b in raw:
        h = (h ^ b) * 0x100000001B3 & MASK
    return plain_mix(h)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_hashes(text):
    out = set()
    for s in shingles(text):
        total = sum(plain_word(w) * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k, w in enumerate(s))
        out.add(plain_mix(total + len(s) & MASK) >> 1)
    return sorted(out)


def plain_sketch(text, size=128):
    return plain_hashes(text)[:size]


def plain_alike(a, b, size=128):
    least = sorted(set(a) | set(b))[:size]
    return len(set(least) & set(a) & set(b)) / len(least) if least else 1.0


def plain_chain(docs):
    """Rows of (id, text): as the query returns them."""
    falling = sorted({k for k, _ in docs}, key=lambda k: (k is None, -(k or 0)))
    stands = {k: min((t or "" for i, t in docs if i == k), key=lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)) for k in falling}
    after = {k: stands[falling[(i + 1) % len(falling)]] for i, k in enumerate(falling)}
    cache = {}
    sketch = lambda t: cache[t] if t in cache else cache.setdefault(t, plain_sketch(t))
    out = []
    for key, text in docs:
        text = text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[key][:half]
        a, b, c = sketch(text), sketch(edited), sketch(after[key])
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{h:016x}" for h in a), "".join(f"{h:016x}" for h in b), plain_alike(a, b), plain_alike(a, c)))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r)[:7] for r in frame.collect()), key=repr)


def test_query_by_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    ours = llm.queries()["op11_fingerprints"](spark, SMALL)
    assert rows_of(ours) == plain_chain(docs)
    by = dict(docs)
    for r in ours.collect():
        true = len(shingles(by[r["doc_id"]]))
        assert abs(r["n_shingles"] - true) <= 0.45 * true


def test_estimates_are_near_the_truth(spark):
    """Against exact sets of shingles: errors like those of 128 draws, exact for small sets."""
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in llm.queries()["op11_fingerprints"](spark, str(DATA / "sf0.01")).collect()}
    errors = []
    for (key, text), (_, after) in zip(docs, [docs[-1], *docs[:-1]]):
        half = len(text) // 2
        a, b = shingles(text), shingles(text[: len(text) - half] + after[:half])
        error = got[key]["near_edited"] - (len(a & b) / len(a | b) if a | b else 1)
        assert len(a | b) > 128 or abs(error) < 1e-12
        errors.append(error)
    assert abs(np.mean(errors)) < 0.005 and np.std(errors) < 0.045 and max(map(abs, errors)) < 0.2


def test_awkward_rows(spark):
    rng = random.Random(3)
    docs = [(None, "Null id, a few words more than five"), (None, None), (1, ""), (2, " \t\n"), (3, "x"), (4, "İ ſ 東京都 a\x00b éa " * 40), (5, "w" * 70_000 + " b"), (6, " ".join(f"w{i % 9}" for i in range(50_000)))]
    docs += [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))) for k in rng.choices([*range(-20, 20), 2**62, 2**62 + 1, -(2**63)], k=300)]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, _id string, _slot int")
    assert rows_of(fingerprint.chained(frame)) == plain_chain(docs)
    assert fingerprint.chained(frame.limit(0)).count() == 0
    assert rows_of(fingerprint.chained(frame.limit(1))) == plain_chain(docs[:1])
    ones = frame.filter("doc_id is null").repartition(3)
    assert rows_of(fingerprint.chained(ones)) == plain_chain(docs[:2])


def test_hot_ids_are_dealt_out(spark):
    """An id with most rows, and null ids: the same rows as in one piece, from several parts."""
    docs = [(7, f"seven {k % 3} a b c d e f") for k in range(900)] + [(None, f"none {k % 2}") for k in range(500)] + [(k, f"doc {k} a b c d e") for k in range(-40, 40) if k != 7]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    assert rows_of(fingerprint.chained(frame)) == plain_chain(docs)
    slot, parts = fingerprint._deal(frame, "doc_id", 8)
    widths = [parts[r["slot"]][1] for r in frame.filter("doc_id = 7").select(F.col("doc_id").alias("_id")).select(slot.alias("slot")).distinct().collect()]
    assert widths[0] >= 3 and parts[0][1] >= 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aZé \t東\x00", max_size=90) | st.none(), max_size=10), st.integers(1, 6))
def test_sketch_of_any_batch(texts, size):
    found = fingerprint.sketches(pa.array(texts, pa.string()), size)
    plain = [plain_sketch(t, size) for t in texts]
    assert [f.tolist() for f in found] == plain
    for a, b in zip(plain, plain[1:]):
        assert fingerprint.alike(np.array(a, np.uint64), np.array(b, np.uint64), size) == plain_alike(a, b, size)


def test_merged_parts_and_columns(spark):
    """Sketches of parts merge to the sketch of all, for a key with most rows, too; column forms agree with the plain ones."""
    rng = random.Random(5)
    texts = [(None if k % 50 == 0 else "hot" if k % 3 else f"s{k % 5}", " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(30)))) for k in range(1200)]
    rows = fingerprint.with_sketch(spark.createDataFrame(texts, "source string, text string"), size=64)
    got = {r["source"]: r["sketch"] for r in fingerprint.merged(rows, "source", size=64, spread=3).collect()}
    want = {s: sorted({h for k, t in texts if k == s for h in plain_hashes(t)})[:64] for s in {k for k, _ in texts}}
    assert got == want
    pairs = [(plain_sketch(a[1], 20), plain_sketch(b[1], 20)) for a, b in zip(texts, texts[7:])]
    pairs += [(plain_sketch(f"{a[1]} {b[1]}", 20), plain_sketch(a[1], 20)) for a, b in zip(texts, texts[7:])]
    frame = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    a, b = F.col("a"), F.col("b")
    for r in frame.select("a", "b", fingerprint.resemblance(a, b, 20).alias("r"), fingerprint.containment(b, a, 20).alias("c"), fingerprint.distinct_shingles(a, 20).alias("n")).collect():
        assert r["r"] == plain_alike(r["a"], r["b"], 20) and 0 <= r["c"] <= 1
        assert r["n"] == len(r["a"]) if len(r["a"]) < 20 else r["n"] > 15
        if len(set(r["a"]) | set(r["b"])) < 20:
            assert abs(r["c"] - (len(set(r["a"]) & set(r["b"])) / len(r["b"]) if r["b"] else 1)) < 1e-9
