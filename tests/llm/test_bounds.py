"""Bounds of samples and indexes don't empty them, and the pipeline passes on columns of any type and name."""

from __future__ import annotations

import hashlib
import math
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import DATA

from ledgerspark.llm import chat_format, decontaminate, simhash_dedup, toxicity, url_filter

SMALL = str(DATA / "sf0.001")


def _labelled(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, int(k % 3 == 0)) for k in {d[0] for d in docs}], "doc_id long, toxic int")


def test_hot_id_and_long_text_leave_the_other_rows(spark):
    """An id of 9,000 rows is one text, and a text over the bound is passed over; the others train as before."""
    plain = [(k, f"text {k} of many words") for k in range(200)]
    trains = sorted((k for k in range(200) if zlib.crc32(str(k).encode()) % 5), key=lambda k: hashlib.md5(str(k).encode()).digest())
    whole, marks = toxicity.sample(*_labelled(spark, plain), 8000, 1 << 20)
    assert len(whole) == len(trains) == len(marks)
    first = trains[0]
    hot = [d for d in plain if d[0] != first] + [(first, f"text {first} of many words")] * 9000
    assert toxicity.sample(*_labelled(spark, hot), 8000, 1 << 20) == (whole, marks)
    long = [d for d in plain if d[0] != first] + [(first, "x" * (1 << 20) + "y")]
    found, _ = toxicity.sample(*_labelled(spark, long), 8000, 1 << 20)
    assert found == whole[1:]
    with pytest.raises(ValueError, match="no labelled text"):
        toxicity.sample(*_labelled(spark, plain), 8000, 3)
    assert toxicity.sample(*_labelled(spark, []), 8000, 3) == ([], [])


@pytest.mark.parametrize("size", [100, 400, 4000])
def test_index_parts_keep_their_bound(spark, size):
    """Repeated items are dealt by their bytes; each part has at most its bound, and all items are in one."""
    items = [(k % 3, "equal words in each item " * 2) for k in range(50)] + [(k, f"item {k} has own words") for k in range(40)] + [(99, "one long item " * 40)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    parts = list(decontaminate.indexes(frame, 0.5, index_bytes=size))
    assert sum(len(p.ids) for p in parts) == len(items)
    texts = dict((k, len(t)) for k, t in items if k != 99)
    for part in parts:
        ids = part.ids.to_pylist()
        assert len(ids) == 1 or 99 in ids or sum(texts.get(k, 0) for k in ids if k > 2) + 50 * sum(k <= 2 for k in ids) <= 1.5 * size + 50
    docs = spark.createDataFrame([(1, "equal words in each item equal words in each item"), (2, "nothing of it here at all")], "doc_id long, text string")
    held = decontaminate.contaminated(docs, frame, index_bytes=size)
    assert {(r["doc_id"], r["item_id"]) for r in held.collect()} == {(1, 0), (1, 1), (1, 2)} and held.count() == 50
    assert [r["doc_id"] for r in decontaminate.clean_rows(docs, frame, index_bytes=size).collect()] == [2]


def test_pipeline_stages_with_maps_and_odd_names(spark):
    import corpus_pipeline

    words = " ".join(f"the w{k}" for k in range(200))
    docs = spark.createDataFrame([(k, words + f" the x{k} " * ((k or 0) % 2 * 150), {"a": k or 0}) for k in (1, 1, 2, 3, None)], "doc_id long, text string, tags map<string,int>")
    docs = docs.withColumn("odd`name. x", F.lit(1)).withColumn("nested", F.struct(F.col("tags").alias("m"), F.array(F.col("tags")).alias("l")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert out.count() > 0
    kept = corpus_pipeline.dedup(spark, docs, SMALL).collect()
    assert sorted((r["doc_id"], r["tags"]["a"]) for r in kept) == [(1, 1), (2, 2), (3, 3)]


def test_components_of_hot_fingerprints(spark):
    """Stars around the largest, the least and a middle fingerprint, each with most links; joined by a few more they are fewer components."""
    edges = [(10**6, k) for k in range(1, 900)] + [(-5, 2000 + k) for k in range(900)] + [(5000, 4000 + k) for k in range(2000) if k != 1000]
    for extra, roots in (([], 3), ([(7, 2003)], 2), ([(7, 2003), (4001, 8000), (8000, 9000), (9000, 10**6)], 1)):
        own = edges + extra
        got = {r["node"]: r["root"] for r in simhash_dedup.components(spark.createDataFrame(own + own[:99], "a long, b long")).collect()}
        assert len(got) == len({n for e in own for n in e}) and len(set(got.values())) == roots
        assert all(got[a] == got[b] <= min(a, b) for a, b in own) and all(got[r] == r for r in set(got.values()))


def test_chat_rows_that_repeat(spark):
    """A third of all rows are equal, with null keys or not; each gets its turns, as its single copy would."""
    model = chat_format.fit(spark.createDataFrame([(1, 1, "user", "Hello there?"), (1, 2, "assistant", "Hello. How can I help?"), (1, 3, "user", "Thanks.")], "conv_id long, turn long, role string, text string"))
    plain = [(k, t, f"line {t} of {k}?") for k in range(60) for t in range(1, 6)] + [(None, 1, "one"), (3, None, "two"), (None, None, None)]
    copies = [(None, None, "the same text"), (7, 1, "the same text")]
    frame = lambda rows: spark.createDataFrame(rows, "conv_id long, turn long, text string")
    once = sorted(map(repr, chat_format.format_chats(frame(plain + copies), model).collect()))
    found = chat_format.format_chats(frame(plain + copies * 90), model)
    got = sorted(map(repr, found.collect()))
    assert len(got) == len(plain) + 180 and sorted(set(got)) == sorted(set(once)) and len(once) == len(plain) + 2


def test_url_features_by_brute_force(spark):
    urls = ["https://www.Ads-24.example.co.uk:80/a/b//c.html?x=1&y=22#f?z=3", "http://x", "no host/at all?a=1", "", None, "ftp://a.b/?", "s://-9-.de#?q=1", "h://ünï.com/ä1/2?k", "://?#", "x://y//z://w/1?&&"]
    for row in url_filter.lexical(spark.createDataFrame([(u,) for u in urls], "url string")).collect():
        text = row["url"] or ""
        rest = text.partition("://")[2]
        ends = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:ends].translate({k: k + 32 for k in range(65, 91)})
        path = rest[ends:].split("?")[0].split("#")[0]
        query = text.partition("?")[2].split("#")[0] if "?" in text else ""
        shares = [host.count(c) / len(host) for c in set(host)]
        want = {
            "host": host, "path": path, "suffix": ".".join(host.split(".")[-3:]), "url_length": len(text), "host_length": len(host), "path_length": len(path), "host_depth": len(host.split(".")),
            "path_depth": sum(a == "/" and b != "/" for a, b in zip(path, path[1:])), "digit_ratio": sum(c in "0123456789" for c in text) / len(text) if text else 0, "hyphens": host.count("-"), "parameters": query.count("&") + 1 if query else 0,
        }
        assert {k: row[k] for k in want} == want, text
        assert math.isclose(row["host_entropy"], -sum(p * math.log2(p) for p in shares), abs_tol=1e-9), text
