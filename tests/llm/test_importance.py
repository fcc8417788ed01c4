"""Importance resampling against a brute-force version and on its defined cases."""

from __future__ import annotations

import hashlib
import math
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import DATA

from ledgerspark.llm import importance
from ledgerspark.llm import queries as llm

SMALL = str(DATA / "sf0.001")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_buckets(text, buckets=10000, longest=1):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return [zlib.crc32(r.encode()) % buckets for r in runs], len(words)


def plain_resample(docs, target, buckets=10000, longest=1, least=20, percent=10, seed=2024):
    own = [(k, *plain_buckets(t, buckets, longest)) for k, t in docs]
    s, t = Counter(b for _, f, _ in own for b in f), Counter(b for x in target for b in plain_buckets(x, buckets, longest)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for key, found, words in own:
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append((key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    some = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    n = len(some) * percent // 100
    return sorted([(*r[:4], i if i <= n else None) for i, r in enumerate(some, 1)] + [(*r[:4], None) for r in rows if r[4] < least], key=repr)


def rows_of(frame):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in frame.collect()), key=repr)


def test_query_by_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    ours = llm.queries()["op13_importance_resampling"](spark, SMALL)
    assert [t for _, t in ours.dtypes] == ["bigint"] * 5
    assert rows_of(ours) == plain_resample(docs, target)


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_defined_cases(spark, longest):
    words = " ".join(f"w{i % 7}" for i in range(30))
    docs = [(1, None), (None, ""), (2, " ,.;\t\n"), (3, "x" * 200_000 + " End"), (4, words), (4, words), (None, words), (5, words.upper()), (6, "Été İstanbul ſtraße 東京都の朝 a1b2 " * 9), (7, "a" * 70_000 + "b " + "a" * 70_000 + "c")]
    target = ["w1 w2 w3 End", None, ""]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, score string, _row int")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    ours = importance.resample(frame, goal, longest=longest, buckets=50, least=5, percent=60)
    assert rows_of(ours) == plain_resample(docs, target, 50, longest, 5, 60)
    assert importance.resample(frame.limit(0), goal).count() == 0
    assert {r[4] for r in rows_of(importance.resample(frame, goal.limit(0), percent=0))} == {None}


def test_one_id_with_most_rows(spark):
    """Equal rows are dealt over all tasks of the sort, and each takes a rank of its own."""
    docs = [(9, "a b c d e f g h i j k l m n o p q r s t u")] * 3000 + [(k, f"a b c d e f g h i j k l m n o p q r s t u{k}") for k in range(100)]
    ours = rows_of(importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("u7",)], "text string"), percent=50))
    assert ours == plain_resample(docs, ["u7"], percent=50)
    assert sorted(r[4] for r in ours if r[4]) == list(range(1, 1551))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé0 .-東\x7f\x00", max_size=40) | st.none(), max_size=12), st.integers(1, 3), st.integers(0, 3))
def test_buckets_of_any_batch(texts, longest, offset):
    for kind in (pa.string(), pa.large_string()):
        batch = pa.array([None, "x y", ""][:offset] + texts, kind).slice(offset)
        found, owner = importance.features(batch, 97, longest)
        assert sorted(zip(owner.tolist(), found.tolist())) == sorted((i, b) for i, t in enumerate(texts) for b in plain_buckets(t, 97, longest)[0])


def test_crc_of_long_and_many_words():
    words = [b"a" * n for n in (1, 2, 70_000, 65_535, 65_536)] + [b"%d" % i for i in range(200)] + [b"z" * 66_000] * 40
    data, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)])[:-1]
    state = importance.advance(np.full(len(words), 0xFFFFFFFF, np.uint32), data, starts, np.array(list(map(len, words))))
    assert (~state).tolist() == [zlib.crc32(w) for w in words]
