"""The training-data operators against brute force, round trips and defined cases."""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import DATA, by_duckdb, plain

from ledgerspark.llm import _common, chat_format, decontaminate, lm_scoring, packing, quality_rules, secret_scan, simhash_dedup, token_rollup, toxicity, url_filter
from ledgerspark.llm import queries as llm

SMALL = str(DATA / "sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [
    (1, None, None, None, None, 1),
    (None, "", "en", "x", 0, 2),
    (3, " \n\t ", "en", "x", 4, 3),
    (4, "the cat sat on the mat and looked at the moon " * 3000, "en", "x", 1, 4),
    (5, "same text twice", "en", "x", 1, 5),
    (5, "same text twice", "en", "x", 1, 5),
    (6, "İstanbul ſecret   password=abcdefghijkl12 \x0b x", "en", "x", 1, 6),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)




def test_quality_rules(spark):
    ours = llm.queries()["op9_quality_rules"](spark, SMALL).toPandas()
    assert plain(ours) == plain(by_duckdb(llm.oracle_sql()["op9_quality_rules"], SMALL))


def test_quality_by_brute_force(spark, docs, texts):
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    for key, text in texts:
        words = WORD.findall(text or "")
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        twice = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if twice[g] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        row = got[key]
        assert (row["n_words"], row["word_chars"], row["n_repeat_words"]) == (len(words), sum(map(len, words)), len(covered))
        assert (row["n_symbols"], row["n_dup_lines"]) == (len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)))


def test_quality_awkward(awkward):
    rows = quality_rules.judge(awkward).collect()
    assert len(rows) == len(AWKWARD) and not any(r["kept"] for r in rows if (r["doc_id"] or 0) != 4)
    assert quality_rules.kept_rows(awkward).columns == awkward.columns
    assert quality_rules.kept_rows(awkward.limit(0)).count() == 0


def plain_spans(text):
    kinds = {"assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    found = []
    for order, (kind, pattern) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text, re.ASCII | re.IGNORECASE if kind == "assign" else 0):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def test_secrets_by_brute_force(docs, texts):
    got = {r["doc_id"]: r["base_sha256"] for r in secret_scan.scan(docs).collect()}
    assert all(got[k] == hashlib.sha256(plain_spans(t or "").encode()).hexdigest() for k, t in texts)


def test_secret_checksum_and_mask(awkward):
    body = "Z" * 30
    good = f"x ghp_{body}{secret_scan.base62_crc32(body)} y"
    assert [s[2] for s in secret_scan.find_spans(good)] == ["github"]
    assert secret_scan.find_spans(good.replace(secret_scan.base62_crc32(body), "000000")) == []
    assert secret_scan.redact_text(good) == "x [SECRET] y"
    assert secret_scan.redact_text("a password: abcdefghijkl0 b") == "a [SECRET] b"
    assert secret_scan.scan(awkward).count() == len(AWKWARD)


def plain_print(text):
    words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in WORD.findall(text or "")]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_by_brute_force(docs, texts):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_dedup.near_duplicates(docs).collect()}
    prints = {k: plain_print(t) for k, t in texts}
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {k: (f"{prints[k]:016x}", find(k)) for k in keys}


@pytest.mark.parametrize("pairwise", [2, 8, 4096])
def test_simhash_large_buckets(spark, pairwise):
    """Whatever way a bucket goes, the components are those of all pairs."""
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(-(2**62), 2**62, 6)]
    prints = sorted({b ^ sum(1 << int(i) for i in rng.choice(12, rng.integers(0, 4), replace=False)) for b in base for _ in range(30)})
    edges = simhash_dedup.links(spark.createDataFrame([(x,) for x in prints], "fp long"), pairwise=pairwise)
    roots = {r["node"]: r["root"] for r in simhash_dedup.components(edges).collect()}
    mask = (1 << 64) - 1
    groups = {x: {y for y in prints if ((x ^ y) & mask).bit_count() <= 4} for x in prints}
    for x in prints:
        reach, todo = {x}, [x]
        while todo:
            for y in groups[todo.pop()] - reach:
                reach.add(y)
                todo.append(y)
        assert roots.get(x, x) == min(reach)


def test_simhash_forest_in_every_bit():
    for bit in range(64):
        pair = np.array([3, 3 ^ (1 << bit)], dtype=np.uint64).view(np.int64)
        assert len(simhash_dedup.forest(pair, 1)) == 1 and not simhash_dedup.forest(pair, 0)
    values = np.array([0, 1, 2**63 | 2, 2**63 | 3], dtype=np.uint64).view(np.int64)
    assert len(simhash_dedup.forest(values, 4)) == 3


@pytest.mark.parametrize("pairwise", [2, 4096])
def test_simhash_links_over_the_top_bit(spark, pairwise):
    prints = [simhash_dedup._signed(x) for x in (0, 1, 2**63 | 2, 2**63 | 3)]
    edges = simhash_dedup.links(spark.createDataFrame([(x,) for x in prints], "fp long"), pairwise=pairwise)
    assert {(r["node"], r["root"]) for r in simhash_dedup.components(edges).collect()} == {(x, min(prints)) for x in prints}


def test_simhash_awkward(awkward):
    rows = simhash_dedup.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD) and {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {1}


def check_packing(rows, texts, size=1024):
    from tokenizers import Tokenizer
    import public_tokenizers

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: [*encode.encode(t or "", add_special_tokens=False).ids, 2] for k, t in texts}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for key, parts in by_doc.items():
        at = 0
        for n, r in enumerate(sorted(parts, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at) and (n == 0 or r["length"] == size)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[key][at : at + r["length"]], dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(ids[key])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    return len(by_sequence), -(-sum(map(len, ids.values())) // size)


def test_packing_round_trip(docs, texts):
    used, least = check_packing(packing.pack(docs).collect(), texts)
    assert used <= least + 1


def test_packing_encoder_agrees_with_the_slow_one():
    from tokenizers import Tokenizer
    import public_tokenizers

    slow, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder("byte_bpe_50k")
    for text in ["", " ", "a  b\n\n c\t\td", "don't I'LL we've", "x<|endoftext|>y", " \u0085a\xa0b", "é é ﬁ 12,5€ – “q”", "日本語 🙂", "\x00\x1f\r\n"]:
        assert list(fast(text)) == slow.encode(text, add_special_tokens=False).ids


def test_packing_search_empties_bins():
    bins = packing.Bins(10, [{6: 1}, {6: 1}, {4: 1, 5: 1}, {4: 1, 5: 1}])
    bins.improve()
    assert sum(1 for x in bins.held if x) == 3 and sum((Counter(x) for x in bins.held), Counter()) == Counter({6: 2, 4: 2, 5: 2})


def test_packing_two_for_one():
    """Neither a move nor an exchange of one for one fits: two items of one bin come for one of another."""
    bins = packing.Bins(12, [{7: 1, 2: 1}, {4: 1, 1: 1}])
    bins.improve()
    assert sorted(sorted(x.elements()) for x in map(Counter, bins.held)) == [[1, 4, 7], [2]]


@pytest.mark.parametrize("low, high, gain", [(200, 600, 0.01), (250, 400, 0.03)])
def test_packing_search_gains_over_best_fit(low, high, gain):
    """Lengths without small ones to fill up with: best fit leaves bins that the search empties."""
    rng = np.random.default_rng(2)
    lengths = rng.integers(low, high, 3000).tolist()
    bins = packing.Bins(1024)
    bins.best_fit(lengths)
    before = sum(1 for x in bins.held if x)
    packed = packing.pack_lengths(lengths, 1024)
    assert sorted(i for items in packed for i in items) == list(range(3000)) and max(sum(lengths[i] for i in items) for items in packed) <= 1024
    assert len(packed) <= before * (1 - gain)


def test_packing_search_leaves_no_step():
    """No move and no exchange that would raise the sum of squared fills is left."""
    rng = np.random.default_rng(3)
    bins = packing.Bins(100)
    bins.best_fit(rng.integers(20, 60, 120).tolist())
    bins.improve()
    for a, mine in enumerate(bins.held):
        for b, theirs in enumerate(bins.held):
            if a == b or not mine or not theirs or 100 in (bins.fill[a], bins.fill[b]):
                continue
            pairs = [(x, y) for x in theirs for y in theirs if x < y or (x == y and theirs[x] > 1)]
            for out in [(), *[(x,) for x in mine]]:
                for come in [*[(x,) for x in theirs], *(pairs if out else [])]:
                    d = sum(come) - sum(out)
                    assert not (0 < d <= 100 - bins.fill[a] and bins.fill[b] < bins.fill[a] + d)


def test_decontamination_finds_planted_items(spark):
    item = "what is the boiling point of water at sea level answer one hundred degrees on the centigrade scale"
    docs = spark.createDataFrame([(1, "filler words here " * 400 + item + " and more filler" * 300), (2, item.replace("water", "iron").replace("point", "spot").replace("answer", "reply").replace("degrees", "grades")), (3, None), (4, "clean text " * 50), (5, item[: len(item) // 2])], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()} == {(1, 7)}
    assert {r["doc_id"] for r in decontaminate.clean_rows(docs, bench).collect()} == {2, 3, 4, 5}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_verifies_every_window(spark):
    """Neither scattered words nor a cut copy in an earlier window hide the whole copy further on."""
    item = "what is the boiling point of water at sea level answer one hundred degrees on the centigrade scale"
    words = item.split()
    shuffled = " ".join(words[::2] + words[1::2])
    texts = {
        1: f"{shuffled} {'filler ' * 130}{item}",
        2: f"{item} {'filler ' * 130}{shuffled}",
        3: f"{shuffled} {'filler ' * 130}{shuffled}",
        4: f"{' '.join(words[-8:][::-1])} {'filler ' * 46}{item}{' filler' * 100}",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    rows = decontaminate.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["overlap"]) for r in rows} == {(1, 7, 1.0), (2, 7, 1.0), (4, 7, 1.0)} and len(rows) == 3
    assert {r["doc_id"] for r in decontaminate.clean_rows(docs, bench).collect()} == {3}


def plain_matches(text, bench, threshold=0.5, least=0.8, part=0.5):
    """Every window of every text against every item, without an index."""
    words = decontaminate.words_of(text)
    items = {i: decontaminate.words_of(b) for i, b in bench}
    n, mean = len(items), max(1.0, sum(map(len, items.values())) / max(1, len(items)))
    frequency = Counter(w for own in items.values() for w in set(own))
    found = set()
    for i, own in items.items():
        if not own:
            continue
        norm = 1.2 * (0.25 + 0.75 * len(own) / mean)
        gain = {t: np.log(1 + (n - frequency[t] + 0.5) / (frequency[t] + 0.5)) * tf * 2.2 / (tf + norm) for t, tf in Counter(own).items()}
        half = max(32, 1 << (len(own) - 1).bit_length())
        step = min(5, len(own))
        for start in range(0, len(words), half):
            window = words[start : start + 2 * half]
            if sum(gain[t] for t in set(window) & set(gain)) < (threshold - 1e-9) * sum(gain.values()):
                continue
            runs = {tuple(window[k : k + step]) for k in range(len(window) - step + 1)}
            covered = np.zeros(len(own), dtype=bool)
            for k in range(len(own) - step + 1):
                if tuple(own[k : k + step]) in runs:
                    covered[k : k + step] = True
            halves = [x.mean() if len(x) else 1.0 for x in (covered[: len(own) // 2], covered[len(own) // 2 :])]
            if covered.mean() >= least and min(halves) >= part:
                found.add((i, round(float(covered.mean()), 9)))
    return {(i, max(o for j, o in found if j == i)) for i, _ in found}


def test_decontamination_by_brute_force(spark, docs, texts):
    """The registered query gives exactly the items that a search without an index finds, the verbatim ones among them."""
    bench = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    held = {(k, i) for k, t in texts for i, b in bench if f" {' '.join(decontaminate.words_of(b))} " in f" {' '.join(decontaminate.words_of(t))} "}
    rows = llm.queries()["op10_decontaminate"](spark, SMALL).collect()
    assert held <= {(r["doc_id"], r["item_id"]) for r in rows}
    assert {(r["doc_id"], r["item_id"], round(r["overlap"], 9)) for r in rows} == {(k, i, o) for k, t in texts for i, o in plain_matches(t, bench)}


def test_decontamination_of_long_texts_and_common_words(spark, monkeypatch):
    """Texts and lists are cut into small parts, and every word is in many items: the same rows as without an index."""
    monkeypatch.setattr(decontaminate, "WINDOWS", 3)
    monkeypatch.setattr(decontaminate, "CELLS", 5)
    rng = np.random.default_rng(9)
    bench = [(i, " ".join(f"w{x}" for x in rng.integers(0, 40, rng.integers(3, 50)))) for i in range(60)]
    texts = [" ".join([*(f"w{x}" for x in rng.integers(0, 60, 700)), bench[k][1], *(f"w{x}" for x in rng.integers(0, 60, 300)), bench[k + 1][1]]) for k in range(0, 20, 2)]
    words = [decontaminate.words_of(b) for _, b in bench]
    index = decontaminate.Index(None, words, [len(w) // 2 for w in words], 0.5)
    for text, items in zip(texts, index.matches(texts, 0.8, 0.5), strict=True):
        assert {(i, round(o, 9)) for i, _, o, _, _ in items} == plain_matches(text, bench) and len(items) >= 2


def test_decontamination_defined_cases(spark):
    item = "what is the boiling point of water at sea level answer one hundred degrees on the centigrade scale"
    rows = [(2**62 + 1, item, 1), (2**62 + 1, item, 1), (None, item, 2), (2**62 + 2, None, 3), (5, "", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int").coalesce(1)
    bench = spark.createDataFrame([(7, item), (8, item), (None, item)], "item_id long, text string")
    got = decontaminate.contaminated(docs, bench)
    assert Counter((r["doc_id"], r["item_id"]) for r in got.collect()) == Counter({(k, i): n for k, n in ((2**62 + 1, 2), (None, 1)) for i in (7, 8, None)})
    assert got.columns[:2] == ["doc_id", "item_id"] and decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert [tuple(r) for r in decontaminate.clean_rows(docs, bench).collect()] == rows[3:]
    assert decontaminate.contaminated(docs, bench, index_bytes=100).count() == 9


def test_toxicity_held_out():
    folder = DATA / "sf0.1"
    rows = duckdb.sql(f"SELECT doc_id, text, toxic FROM '{folder}/documents.parquet' JOIN '{folder}/labels.parquet' USING (doc_id) WHERE toxic IS NOT NULL").fetchall()
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    model = toxicity.train([r[1] for r in train], [r[2] for r in train])
    test = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    right = [(s >= 0.5) == (r[2] == 1) for s, r in zip(model.scores([r[1] for r in test]), test, strict=True)]
    assert np.mean(right) > 0.97


def test_toxicity_defined_cases(awkward):
    assert toxicity.train([], []).score("x") == pytest.approx(0, abs=1e-9)
    assert toxicity.train(["a", "b"], [1, 1]).score(None) == pytest.approx(1, abs=1e-9)
    assert toxicity.train([None, ""], [0, 1]).score("") == pytest.approx(0.5)
    model = toxicity.train(["bad word", "good day"], [1, 0])
    assert toxicity.score(awkward, model).count() == len(AWKWARD)
    assert toxicity.score(awkward.limit(0), model).count() == 0
    assert toxicity.score(awkward.withColumn("score", awkward["extra"]), model).columns == ["doc_id", "held_out", "score", "predicted"]


def test_toxicity_query(spark, texts):
    """The registered query against its own rules: the fold, whole texts, labels that are not read, and the model's scores."""
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    got = {r["doc_id"]: r for r in llm.queries()["op3_toxicity"](spark, SMALL).collect()}
    assert set(got) == {k for k, _ in texts}
    known = dict(duckdb.sql(f"SELECT doc_id, max(toxic) FROM '{SMALL}/labels.parquet' GROUP BY doc_id").fetchall())
    own = [(k, t) for k, t in texts if known.get(k) is not None and zlib.crc32(str(k).encode()) % 5]
    sample, marks = toxicity.sample(docs, labels, 8000, 64 << 20)
    assert Counter(zip(sample, marks, strict=True)) == Counter((t, known[k]) for k, t in own)
    fewer, _ = toxicity.sample(docs, labels, 8000, 20_000)
    assert 0 < sum(len((t or "").encode()) for t in fewer) <= 20_000 and len(toxicity.sample(docs, labels, 7, 64 << 20)[0]) == 7
    model = toxicity.train(sample, marks)
    for k, t in texts:
        r = got[k]
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) and r["score"] == pytest.approx(model.score(t)) and r["predicted"] == int(r["score"] >= 0.5)
        # A window by window mean, without running sums.
        tokens = toxicity.tokens_of(t)
        parts = [tokens[a:e] for a, e in zip(*toxicity.window_bounds(len(tokens), model.width), strict=True)]
        worst = max(model.values(p).sum() / max(len(p), model.width // 2) if p else 0.0 for p in parts)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-(worst + model.bias))), rel=1e-6, abs=1e-12)


def test_url_rules_and_parts(spark):
    urls = [(1, "http://A.Example.com/en/7?x"), (2, "https://shop.net/de/1"), (3, "ftp://example.net/de/8#q"), (4, None), (5, "no scheme"), (6, "http://notcom/en/"), (7, "http://x.org/es/")]
    rows = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string"), url_filter.Filter(None, None, 0.0), llm.URL_RULES).collect()}
    assert (rows[1]["host"], rows[1]["path"], rows[1]["rule"], rows[1]["verdict"]) == ("a.example.com", "/en/7", "example.com/en/7", "allow")
    assert [(rows[k]["rule"], rows[k]["verdict"]) for k in (2, 3, 7)] == [("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]
    assert [(rows[k]["host"], rows[k]["path"], rows[k]["rule"]) for k in (4, 5)] == [("", "", None)] * 2 and rows[6]["rule"] is None


def test_url_trees_learn_from_labels(spark):
    """Labels that follow from lexical features; the trees are right on URLs and hosts that they haven't seen."""
    rng = np.random.default_rng(1)
    word = lambda n: "".join(rng.choice(list("abcdefghij"), n))
    urls = []
    for k in range(900):
        bad = k % 3 == 0
        host = f"{word(4)}-{word(3)}-{rng.integers(1000, 9999)}.{word(5)}.com" if bad else f"www.{word(8)}.org"
        urls.append((f"http://{host}/{word(5)}" + ("?a=1&b=2&c=3" if bad else ""), int(bad)))
    labelled = spark.createDataFrame(urls, "url string, label int")
    fitted = url_filter.fit(labelled.filter(~url_filter.held_out(labelled["url"])))
    rows = fitted.blocks(labelled.filter(url_filter.held_out(labelled["url"]))).select("label", "blocked").collect()
    assert len(rows) > 100 and np.mean([r["blocked"] == (r["label"] == 1) for r in rows]) > 0.97


def test_url_query(spark):
    """Hosts, paths and rules of the registered query by brute force, and its verdicts on held-out URLs by their labels."""
    urls = duckdb.sql(f"SELECT page_id, url FROM '{DATA}/sf0.01/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in llm.queries()["op4_url_filter"](spark, str(DATA / "sf0.01")).collect()}
    assert len(got) == len(urls)
    wrong = 0
    for k, url in urls:
        host, path = re.match(r"([^/?#]*)([^?#]*)", (url or "").partition("://")[2]).groups() if "://" in (url or "") else ("", "")
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        fits = [r for r in llm.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.text), default=None)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule and rule.text)
        assert got[k]["verdict"] == (rule.verdict if rule else "block" if got[k]["blocked"] else "allow")
        if zlib.crc32((url or "").encode()) % 5 == 0:
            wrong += got[k]["blocked"] != bool(re.search(r"(^|[.-])(" + "|".join(url_filter.BLOCKED_NAMES) + r")([.-]|$)", host))
    assert wrong <= 1


def test_url_defined_cases(spark):
    rows = [(2**62 + 1, "http://a.com/" + "x" * 100_000, 1), (2**62 + 2, None, 2), (None, "http://a.com/", 3), (None, "http://a.com/", 3), (5, "", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int").coalesce(1)
    fitted = url_filter.fit(spark.createDataFrame([("http://b.com/", None)], "url string, label int"))
    got = url_filter.judge(pages, fitted, [])
    assert Counter(r["page_id"] for r in got.collect()) == Counter(r[0] for r in rows) and {r["verdict"] for r in got.collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), fitted, []).count() == 0


def test_lm_scores_prefer_the_target(spark):
    rows = [(k, ("red green blue " if k % 4 == 0 else "one two three four ") * 30) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(80)], "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in lm_scoring.cross_entropy_difference(docs, labels).collect()}
    assert max(scores[k] for k in scores if k % 4 == 0) < min(scores[k] for k in scores if k % 4)


def test_lm_counts_equal_plain_counts(spark):
    docs = spark.createDataFrame([(True, b"a b a b"), (False, b"b c")], "is_target boolean, text binary").repartition(2)
    counts = lm_scoring.slot_counts(docs).filter(f"slot < {lm_scoring.WORDS}").orderBy("gram").collect()
    assert [(bytes(r["gram"]), r["target"], r["background"]) for r in counts] == [(b"a", 2, 2), (b"b", 2, 3), (b"c", 0, 1)]


def test_lm_scores_tell_copies_apart(spark):
    """A text that stands in the corpus twice is known to the background, so it scores higher than texts that stand there once."""
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 500, 120))) for k in range(120)]
    rows += [(1000 + k, rows[k][1]) for k in range(0, 120, 10)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, k % 3 % 2) for k in range(120)], "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in lm_scoring.cross_entropy_difference(docs, labels).collect()}
    twice = {k for k, _ in rows if k >= 1000 or k % 10 == 0 and k % 3 % 2 == 0}
    ones = {k for k, _ in rows if k < 1000 and k % 10}
    # Copies of a target know that target, so they are left to the brute force.
    copies = {k for k in twice if (k % 1000) % 3 % 2 == 0}
    assert len(copies) > 10 and min(scores[k] for k in copies) > max(scores[k] for k in ones)


def test_lm_scores_by_brute_force(spark, monkeypatch):
    """Exact counts over many more words than any table of fixed slots would hold apart."""
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 50_000)
    monkeypatch.setattr(lm_scoring, "BUCKET_BYTES", 200_000)
    rng = np.random.default_rng(8)
    rows = [(k, " ".join(f"w{int(x)}" for x in rng.zipf(1.2, 400) % 300_000)) for k in range(400)] + [(400, None), (None, "w1 w2 w1"), (2**60 + 1, "w1 w3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(400)], "doc_id long, quality int")
    rows += [(k + 1000, text) for k, text in rows[:5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    good = lambda k: k is not None and k < 400 and k % 3 == 0

    def counts(text):
        tokens = (text or "").split()
        return Counter(tokens), Counter(["", *tokens][:-1] if tokens else []), Counter(zip(["", *tokens], tokens)), Counter(n=len(tokens))

    models = {m: [Counter(), Counter(), Counter(), Counter()] for m in "tb"}
    for k, text in rows:
        for m in "tb" if good(k) else "b":
            for whole, part in zip(models[m], counts(text), strict=True):
                whole.update(part)
    vocabulary = len(models["b"][0])
    assert vocabulary > 10_000

    def loss(k, text, m):
        """Every count of the model less the row's own."""
        word, context, pair, total = ((lambda g, w=w, o=o: w[g] - (o[g] if m == "b" or good(k) else 0)) for w, o in zip(models[m], counts(text), strict=True))
        tokens = text.split()
        return np.mean([-np.log((pair((a, b)) + 50 * (word(b) + 1) / (total("n") + vocabulary)) / (context(a) + 50)) for a, b in zip(["", *tokens], tokens)])

    got = {r["doc_id"]: r for r in lm_scoring.cross_entropy_difference(docs, labels).collect()}
    assert len(got) == len(rows) and (got[400]["n_tokens"], got[400]["score"]) == (0, 0)
    for k, text in rows:
        if text:
            t, b = loss(k, text, "t"), loss(k, text, "b")
            assert (got[k]["target_loss"], got[k]["background_loss"], got[k]["score"]) == pytest.approx((t, b, t - b))
    assert lm_scoring.cross_entropy_difference(docs.limit(0), labels).count() == 0


def random_hmm(seed, symbols):
    rng = np.random.default_rng(seed)
    n = chat_format.STATES
    log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return chat_format.Hmm(log(rng.random(n)), log(rng.random((n, n))), log(rng.random((n, symbols))))


def plain_viterbi(model, symbols):
    best, back = model.start + model.emit[:, symbols[0]], []
    for s in symbols[1:]:
        step = best[:, None] + model.move
        back.append(step.argmax(axis=0))
        best = step.max(axis=0) + model.emit[:, s]
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_chat_segments_give_the_whole_path():
    model = random_hmm(5, 9)
    symbols = np.random.default_rng(5).integers(0, 9, 200)
    parts = [symbols[k : k + 32] for k in range(0, 200, 32)]
    matrices = [model.matrix(p, k == 0) for k, p in enumerate(parts)]
    best, backs = matrices[0][0], []
    for m in matrices[1:]:
        backs.append((best[:, None] + m).argmax(axis=0))
        best = (best[:, None] + m).max(axis=0)
    ends = [int(best.argmax())]
    for back in reversed(backs):
        ends.insert(0, int(back[ends[0]]))
    joined = np.concatenate(model.paths(parts, np.array([-1, *ends[:-1]]), np.array(ends)))
    assert joined.tolist() == model.path(symbols) == plain_viterbi(model, symbols)
    some = [symbols[:k] for k in (3, 50, 1, 50, 7)]
    assert [x.tolist() for x in model.paths(some, np.full(5, -1), np.full(5, -1))] == [plain_viterbi(model, x) for x in some]


def test_chat_segments_have_a_bound(spark):
    """Null and repeated turn numbers and a null conversation are cut into segments, and decoded as one piece."""
    rows = [(None, k, f"User: {k}?" if k % 3 else "### Response: yes") for k in range(3000)]
    rows += [(1, None, f"turn {k} ```" if k % 2 else f"Human: {k}") for k in range(2500)]
    rows += [(2**62 + 1, 7, f"Bot: {k}\n" if k % 5 else f"tool: {k}") for k in range(1500)] + [(3, 0, "q: a?"), (3, 0, "q: a?"), (3, -5, None), (2**62 + 2, 1, "\n".join(f"line {k}" for k in range(2500)))]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    lines = chat_format._segments(talks, True, "conv_id", "turn", "text").collect()
    sizes = Counter((r["conv"], r["segment"]) for r in lines)
    assert len(lines) == sum(len((t or "").split("\n")) for _, _, t in set(rows)) and max(sizes.values()) <= chat_format.SEGMENT
    assert all(n == chat_format.SEGMENT or (c, s + 1) not in sizes for (c, s), n in sizes.items())
    model = random_hmm(6, chat_format.SYMBOLS)
    got = {(r["conv"], r["turn"], r["digest"]): r["states"] for r in chat_format.recover(talks, model).collect()}
    for conv in (None, 1, 2**62 + 1, 2**62 + 2, 3):
        own = sorted((r for r in lines if r["conv"] == conv), key=lambda r: (r["turn"] is not None, r["turn"], r["digest"], r["line"]))
        assert [r["segment"] for r in own] == [k // chat_format.SEGMENT for k in range(len(own))]
        for r, state in zip(own, plain_viterbi(model, np.array([r["symbol"] for r in own])), strict=True):
            assert got[conv, r["turn"], r["digest"]][r["line"]] == state
    assert Counter(r["conv_id"] for r in chat_format.format_chats(talks, model).collect()) == Counter(r[0] for r in rows)
    assert chat_format.format_chats(talks.limit(0), model).count() == 0
    assert chat_format.format_chats(talks.withColumn("role_found", talks["turn"]).withColumn("states", talks["turn"]), model).columns == ["conv_id", "turn", "role_found", "n_turns", "rendered"]


def test_chat_transcripts_are_parsed(spark):
    """Whole transcripts in one row each: speakers and turn borders come from markers and lines alone."""
    rng = np.random.default_rng(11)
    name = {"user": ["User: ", "Human: ", "### Instruction: "], "assistant": ["Assistant: ", "AI: ", "### Response: "], "system": ["System: "]}

    def talk():
        turns = [("system", "follow the rules")] if rng.random() < 0.4 else []
        for _ in range(int(rng.integers(1, 4))):
            turns.append(("user", "\n".join([*["some words here"] * int(rng.integers(0, 3)), "what is it?"])))
            turns.append(("assistant", "\n".join(["it is a long answer with many words"] * int(rng.integers(1, 4)) + ["- a point"] * int(rng.integers(0, 2)))))
        return turns

    known = [talk() for _ in range(60)]
    style = lambda role: str(rng.choice(name[role]))
    rows = [(k, n, role, style(role) + text) for k, turns in enumerate(known) for n, (role, text) in enumerate(turns)]
    model = chat_format.fit(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), borders=False)
    fresh = [talk() for _ in range(40)]
    texts = [(k, 0, "\n".join(style(role) + text for role, text in turns)) for k, turns in enumerate(fresh)]
    found = defaultdict(list)
    for r in chat_format.parse(spark.createDataFrame(texts, "conv_id long, turn long, text string"), model).orderBy("conv_id", "number").collect():
        found[r["conv_id"]].append((r["role_found"], r["text"]))
        assert r["rendered"] == f"<|{r['role_found']}|>\n{r['text']}\n<|end|>"
    assert [found[k] for k in range(40)] == fresh


def test_chat_roles_recovered(spark):
    folder = str(DATA / "sf0.01")
    got = llm.queries()["op7_chat_format"](spark, folder).collect()
    truth = {(k, t): (r, x) for k, t, r, x in duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{folder}/conversations.parquet'").fetchall()}
    assert len(got) == len(truth)
    right = [r["role_found"] == truth[r["conv_id"], r["turn"]][0] for r in got if r["held_out"]]
    assert len(right) > 50 and np.mean(right) > 0.95
    for r in got:
        text = truth[r["conv_id"], r["turn"]][1]
        if r["n_turns"] == 1:
            assert r["rendered"] == f"<|{r['role_found']}|>\n{text.strip(' ')}\n<|end|>"
    assert np.mean([r["n_turns"] == 1 for r in got]) > 0.99


def test_rollup_is_additive_and_idempotent(spark):
    rollup = token_rollup.Rollup(spark, _common.fresh_path(spark, "test-rollup"))
    columns = "source string, lang string, version string, old_tokens long, new_tokens long"
    first = spark.createDataFrame([("a", "en", "v", None, 10), ("a", "en", "v", None, 5), (None, None, "v", None, 7)], columns)
    second = spark.createDataFrame([("a", "en", "v", 10, 12), ("a", "en", "v", 5, None), (None, None, "v", 7, None)], columns)
    third = spark.createDataFrame([("b", None, "v", None, 4), ("a", "en", "v", 12, 9)], columns)
    assert rollup.totals().count() == 0
    assert [rollup.apply(*x) for x in [("1", first), ("1", first), ("2", second), ("2", second)]] == [True, False, True, False]
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v", 1, 12)]
    rollup.compact()
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v", 1, 12)]
    assert [rollup.apply(*x) for x in [("1", first), ("3", third), ("3", third), ("empty", first.limit(0))]] == [False, True, False, True]
    want = {("a", "en", "v", 1, 9), ("b", None, "v", 1, 4)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.compact()
    rollup.vacuum()
    assert {tuple(r) for r in rollup.totals().collect()} == want and not rollup.apply("3", third) and rollup.commits().count() == 4
    # A batch that wrote its delta but no commit doesn't count.
    token_rollup.delta(first).write.parquet(f"{rollup.path}/deltas/folder=lost")
    assert {tuple(r) for r in rollup.totals().collect()} == want


def plain_totals(rows):
    """Documents, tokens and words by source and language, with one row of each text kept for the tokens."""
    from tokenizers import Tokenizer
    import public_tokenizers

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, seen = defaultdict(lambda: [0, 0]), set()
    none = lambda x: (x is None, x or 0 if not isinstance(x, str) else x)
    for _, text, source, lang in sorted(rows, key=lambda r: (none(r[0]), r[2] is None, r[2] or "", r[3] is None, r[3] or "")):
        words = want[source, lang, "words"]
        words[0], words[1] = words[0] + 1, words[1] + len((text or "").encode().split())
        if (text or "") not in seen:
            seen.add(text or "")
            tokens = want[source, lang, "byte_bpe_50k"]
            tokens[0], tokens[1] = tokens[0] + 1, tokens[1] + len(encode.encode(text or "", add_special_tokens=False).ids)
    return {(*k, *v) for k, v in want.items() if v != [0, 0]}


def test_rollup_query_by_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text, source, lang FROM '{SMALL}/documents.parquet'").fetchall()
    got = llm.queries()["op2_token_counts"](spark, SMALL).collect()
    assert {tuple(r[c] for c in ("source", "lang", "version", "docs", "tokens")) for r in got} == plain_totals(rows)


def test_rollup_counts_and_copies(spark):
    """Repeated rows, repeated and null ids, null groups, empty tables and extra columns."""
    rows = [(2**62 + 1, "a b", "x", "en"), (2**62 + 1, "a b", "x", "en"), (2**62 + 2, "a b", "x", "en"), (None, "a b", None, None), (3, None, "x", None), (4, "", "y", "de"), (5, "long " * 5000, "y", "de"), (6, "c", None, "en")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, source string, lang string, tokens int").coalesce(1)
    counts = token_rollup.count_tokens(docs)
    assert Counter(r["id"] for r in counts.collect()) == Counter(r[0] for r in rows)
    gone = Counter()
    for r in token_rollup.surplus(counts).collect():
        gone[r["source"], r["lang"]] += r["rows"]
    assert gone == Counter({("x", "en"): 2, (None, None): 1, ("y", "de"): 1})
    assert token_rollup.count_tokens(docs.limit(0)).count() == 0 and token_rollup.surplus(counts.limit(0)).count() == 0


BIG = [(2**62 + 1, "password: abcdefghijkl0 one two three four five", "en", "x", 1, 1), (2**62 + 2, "", "en", "x", 1, 2), (None, "six seven eight nine ten", None, None, None, 3), (None, None, "en", "x", 1, 4), (2**62 + 1, "long word " * 4000, "en", "x", 1, 5)]


@pytest.mark.parametrize("name", ["secrets", "toxicity", "lm", "simhash", "packing", "quality", "tokens"])
def test_large_ids_beside_nulls_stay_whole(spark, name):
    """Every row comes back under its own 64-bit id, with columns that clash with the operator's own."""
    docs = spark.createDataFrame(BIG, SCHEMA).coalesce(1)
    for c in ("id", "fp", "n", "root", "least", "head", "words", "kept", "score", "piece", "row", "spread", "fold"):
        docs = docs.withColumn(c, docs["extra"])
    labels = spark.createDataFrame([(2**62 + 1, 1, 0), (2**62 + 2, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    run = {
        "secrets": secret_scan.scan,
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "lm": lambda d: lm_scoring.cross_entropy_difference(d, labels),
        "simhash": simhash_dedup.near_duplicates,
        "packing": lambda d: packing.pack(d).filter("piece = 0"),
        "quality": quality_rules.judge,
        "tokens": lambda d: token_rollup.count_tokens(d).withColumnRenamed("id", "doc_id"),
    }[name]
    assert Counter(r["doc_id"] for r in run(docs).collect()) == Counter(r[0] for r in BIG)
    assert run(docs.limit(0)).count() == 0


def test_secret_values_by_brute_force(spark):
    """Counts, digest and spans of the registered query, and random texts of fragments of secrets."""
    rng = np.random.default_rng(12)
    bits = ["password", "Secret", "TOKEN", "api_key", "apikey", "=", ": ", '"', "'", " ", "AKIA", "ABCDEFGHIJ0123456789", "deadbeef0123", "abcdefabcdefabcd", "x", "ß", "İ", "\n", "ghp_", "-_.", "/+"]
    body = "k" * 30
    rows = [(k, "".join(rng.choice(bits, 12))) for k in range(3000)] + [(3000, f"npm_{body}{secret_scan.base62_crc32(body)}"), (3001, f"npm_{body}000000")]
    for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        want = plain_spans(rows[r["doc_id"]][1])
        spans = [x for x in want.split(",") if x]
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x.startswith(k) for x in spans) for k in ("assign", "access", "hex")]
        if r["doc_id"] < 3000:
            assert r["spans"] == want
        else:
            assert r["n_npm"] == (r["doc_id"] == 3000)


@pytest.mark.parametrize("radius, pairwise", [(3, 2), (5, 2), (3, 4096)])
def test_simhash_odd_radius(spark, radius, pairwise):
    rng = np.random.default_rng(13)
    prints = sorted({int(b) ^ sum(1 << int(i) for i in rng.choice(16, rng.integers(0, 5), replace=False)) for b in rng.integers(-(2**62), 2**62, 3) for _ in range(25)})
    edges = simhash_dedup.links(spark.createDataFrame([(x,) for x in prints], "fp long"), radius=radius, blocks=radius + 2, pairwise=pairwise)
    roots = {r["node"]: r["root"] for r in simhash_dedup.components(edges).collect()}
    mask = (1 << 64) - 1
    for x in prints:
        reach, todo = {x}, [x]
        while todo:
            at = todo.pop()
            for y in prints:
                if y not in reach and ((at ^ y) & mask).bit_count() <= radius:
                    reach.add(y)
                    todo.append(y)
        assert roots.get(x, x) == min(reach)


def test_join_spread_equals_a_plain_join(spark):
    rows = spark.createDataFrame([(k, 0 if k % 3 else k) for k in range(3000)] + [(9999, None)], "v long, k long")
    table = rows.groupBy("k").count().withColumnRenamed("count", "n").withColumn("w", rows["k"] * 2)
    for hot in (2, 1000, 100_000):
        got = _common.join_spread(rows, table.select("k", "n", "w"), "k", "n", 3001, hot)
        assert Counter((r["v"], r["k"], r["w"]) for r in got.collect()) == Counter((k, 0 if k % 3 else k, 0 if k % 3 else 2 * k) for k in range(3000))


def test_pipeline_dedup_keeps_one_row_a_group(spark):
    """Null and repeated ids against brute force."""
    import corpus_pipeline

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(x)}" for x in rng.integers(0, 500, 200)) for _ in range(24)]
    rows = []
    for k, text in enumerate(texts):
        near = text + f" w{k}"
        rows += [[(None, text), (None, text), (None, near)], [(None, text), (k, near)], [(5, text), (5, near)], [(k, text), (3, near), (None, text)]][k % 4]
    docs = spark.createDataFrame([(a, b, n) for n, (a, b) in enumerate(rows)], "doc_id long, text string, extra int")
    prints = [plain_print(b) for _, b in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    groups = defaultdict(list)
    for r, (key, text) in zip(root, rows, strict=True):
        groups[r].append((key is None, key or 0, text))
    kept = Counter((None if none else key, text) for none, key, text in map(min, groups.values()))
    assert Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.dedup(spark, docs, SMALL).collect()) == kept
    assert len(groups) >= 24 and corpus_pipeline.dedup(spark, docs, SMALL).columns == docs.columns


def test_pipeline(spark):
    """Every stage against brute force on what the stage before kept."""
    import corpus_pipeline

    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    bench = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    good = {r["doc_id"] for r in llm.queries()["op9_quality_rules"](spark, SMALL).filter("kept").collect()}
    prints = {k: plain_print(texts[k]) for k in good}
    first = set()
    left = set(good)
    while left:
        reach, todo = set(), [min(left)]
        while todo:
            at = todo.pop()
            reach.add(at)
            todo += [k for k in left - reach if k not in todo and (prints[k] ^ prints[at]).bit_count() <= 4]
        first.add(min(reach))
        left -= reach
    clean = {k for k in first if not plain_matches(texts[k], bench)}
    assert len(good) > len(first) > len(clean) > 50
    masked = [(k, secret_scan.redact_text(texts[k])) for k in clean]
    used, least = check_packing(corpus_pipeline.run(spark, SMALL).collect(), masked)
    assert used <= least + 1


@pytest.mark.parametrize("rows", [BIG, []])
def test_pipeline_stages_on_defined_cases(spark, rows):
    import corpus_pipeline

    words = " ".join(f"the w{k}" for k in range(200))
    rows = rows and [*rows, *[(k, words + f" the w{k}", "en", "x", 1, 9) for k in (7, 7, None)]]
    docs = spark.createDataFrame(rows, SCHEMA)
    for c in ("head", "fp", "root", "row", "it", "heads", "kept", "lines", "text_", "id"):
        docs = docs.withColumn(c, docs["extra"])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
            assert Counter(out.select("doc_id").collect()) <= Counter(docs.select("doc_id").collect())
        else:
            assert Counter(r["doc_id"] for r in out.filter("piece = 0").collect()) == Counter(r[0] for r in rows)
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, SMALL)
    assert [r["doc_id"] for r in kept.collect()] == ([7] if rows else [])
