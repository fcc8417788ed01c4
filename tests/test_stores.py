"""Digests that bind order and number, versions with two writers, and rounds judged by timers."""

from __future__ import annotations

import hashlib
import json
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerspark.sources import stores
from ledgerspark.streaming import jobs


def plain_digest(lines, width):
    level = [hashlib.sha256(x.encode()).hexdigest() for x in lines]
    while lines:
        level = [hashlib.sha256("".join(level[k : k + width]).encode()).hexdigest() for k in range(0, len(level), width)]
        if len(level) == 1:
            break
    return hashlib.sha256(f"{len(lines)}:{level[0] if level else ''}".encode()).hexdigest()


@pytest.mark.parametrize(("n", "width"), [(0, 4), (1, 4), (4, 4), (5, 4), (70, 4), (1500, 1024)])
def test_tree_digest_by_plain_tree(spark, n, width):
    lines = [f"line {k * 7 % 13}" for k in range(n)]
    frame = spark.createDataFrame(list(enumerate(lines)), "k long, line string").repartition(5)
    one = stores.tree_digest(frame, ["k"], "line", width).first()
    assert (one["rows"], one["digest"]) == (n, plain_digest(lines, width))


def test_digest_binds_order_number_and_content():
    lines = [f"l{k}" for k in range(9)]
    other = [lines[:8], [*lines, "l8"], [lines[1], lines[0], *lines[2:]], ["x", *lines[1:]]]
    assert len({plain_digest(x, 4) for x in [lines, *other]}) == 5


def test_files_are_read_in_order_of_any_cut(spark, tmp_path):
    rows = spark.range(3000).select("id", F.concat(F.lit("row "), "id").alias("line"))
    want = plain_digest([f"row {k}" for k in range(3000)], 1024)
    stores.write_lines(rows.repartition(7), ["id"], F.col("line"), str(tmp_path / "a"))
    assert stores.file_digest(spark, str(tmp_path / "a")).first()["digest"] == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        assert stores.file_digest(spark, str(tmp_path / "a")).first()["digest"] == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_documents_are_canonical(spark, tmp_path):
    held = spark.createDataFrame([("b", 2), ("a", 10**17), ("c", 0)], "addr string, balance long")
    peaks = spark.createDataFrame([("a", 10**18, 4)], "addr string, peak long, peak_block long")
    seen = spark.createDataFrame([("a", 1, None)], "addr string, first_block long, last_block long")
    minted = spark.createDataFrame([("a", 5)], "addr string, minted long")
    stores.write_ledger_documents(held, peaks, seen, minted, str(tmp_path))
    read = lambda name: [r["value"] for r in spark.read.text(str(tmp_path / name)).collect()]
    assert sorted(read("balances_final")) == ['{"addr":"a","balance":"100000000000000000"}', '{"addr":"b","balance":"2"}']
    assert read("peaks") == ['{"addr":"a","peak":"1000000000000000000","peak_blk":4,"first_blk":1,"last_blk":null}'] and json.loads(read("mint_ledger")[0]) == {"addr": "a", "minted": "5"}


def test_of_two_writers_on_one_version_one_wins(spark, tmp_path, monkeypatch):
    frame = lambda *rows: spark.createDataFrame(rows, "block long, ts long")
    a, b = (stores.AnchorStore(spark, str(tmp_path / "s")) for _ in range(2))
    assert a.version() == 0 and a.load().count() == 0
    assert a.add(frame((3, 30), (1, 10), (1, 11), (None, 5)), 0) == 1
    with pytest.raises(stores.StaleWriter):
        b.add(frame((9, 90)), 0)
    # Both have seen version 1 as the last; the other commits while this one writes.
    monkeypatch.setattr(b, "version", lambda: 1)
    assert a.add(frame((3, 33), (2, 20)), 1) == 2
    with pytest.raises(stores.StaleWriter):
        b.add(frame((7, 70)), 1)
    assert [tuple(r) for r in a.load().orderBy("block").collect()] == [(1, 11), (2, 20), (3, 33)]
    assert sorted(map(tuple, a.load(1).collect())) == [(1, 11), (3, 30)]
    assert len(list((tmp_path / "s" / "data").iterdir())) == 2
    with pytest.raises(ValueError, match="no version"):
        a.load(5)


def test_rounds_are_judged_when_the_watermark_has_passed(spark, tmp_path):
    """Rows in any order within the delay count; a row that comes after its round was judged doesn't; state goes."""
    session = jobs.with_timers(spark)
    schema = "addr string, at timestamp, ts long, v long"
    rows = {"a": {0: 60, 1: 50, 2: 10, 3: 70, 5: 70, 6: 70}, "b": {0: 50, 2: 50}}
    each = [(addr, 1_000_000 + day * 100 + k * 30, v // 2) for addr, days in rows.items() for day, v in days.items() for k in range(2)]
    early, later = [r for r in each if r[1] < 1_000_300], [r for r in each if r[1] >= 1_000_300]
    random.Random(1).shuffle(early)
    # The watermark of a batch drops rows from the next batch on.
    files = [early, later, [("z", 1_001_000, 1)], [("b", 1_000_110, 99), ("z", 1_001_100, 1)], [("z", 1_001_200, 1)]]
    for k, part in enumerate(files):
        frame = spark.createDataFrame([(a, ts, v) for a, ts, v in part], "addr string, ts long, v long").select("addr", F.timestamp_seconds("ts").alias("at"), "ts", "v")
        frame.coalesce(1).write.parquet(str(tmp_path / "in" / f"k={k}"))
    (tmp_path / "flat").mkdir()
    for k in range(len(files)):
        part = next((tmp_path / "in" / f"k={k}").glob("*.parquet"))
        target = tmp_path / "flat" / f"{k}.parquet"
        shutil.copy(part, target)
        os.utime(target, (1_700_000_000 + 10 * k,) * 2)
    stream = jobs.followed(session, str(tmp_path / "flat"), schema)
    jobs.run(jobs.share_alerts(stream, 10_000, 45, 100, "200 seconds"), str(tmp_path / "out"))
    got = sorted((r["addr"], r["at"], r["total"]) for r in jobs.written(session, str(tmp_path / "out")).collect())
    assert got == [("a", 10_001, 50), ("a", 10_006, 70)]


@pytest.mark.parametrize("n", [3, 16, 70])
def test_tree_digest_of_two_levels_is_that_of_its_sql(spark, monkeypatch, n):
    """More lines than two levels hold, as the queries' SQL takes them; with a width of 4."""
    import duckdb

    from ledgerspark.plans import source_queries as q

    lines = [f"line {k * 7 % 13}" for k in range(n)]
    frame = spark.createDataFrame(list(enumerate(lines)), "k long, line string").repartition(5)
    one = stores.tree_digest(frame, ["k"], "line", 4, q.DIGEST_LEVELS).first()
    values = ",".join(f"({k}, 0, 0, '{x}')" for k, x in enumerate(lines))
    sql = f"WITH ln AS (SELECT * FROM (VALUES {values}) x(k1, k2, k3, line)), {q.DIGEST_SQL} {q.DIGEST_OUT}".replace("1024", "4")
    assert tuple(one) == duckdb.sql(sql).fetchall()[0]


@pytest.mark.parametrize("name", ["ledger_digest", "ledger_documents"])
def test_query_digests_have_the_levels_of_their_sql(spark, monkeypatch, name):
    from functools import partial

    from conftest import DATA, by_duckdb
    from ledgerspark.plans import catalogue

    small = str(DATA / "sf0.001")
    monkeypatch.setattr(stores, "tree_digest", partial(stores.tree_digest, width=4))
    assert tuple(catalogue.queries()[name](spark, small).first()) == tuple(by_duckdb(catalogue.oracle_sql()[name].replace("1024", "4"), small).iloc[0])


def test_price_documents_lie_in_files_of_their_own(spark):
    """Groups that are dealt over many tasks meet again in the same parts of a round robin."""
    from conftest import DATA, by_duckdb, plain
    from ledgerspark.plans import catalogue

    small = str(DATA / "sf0.001")
    other = spark.newSession()
    for key, value in {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "50", "spark.sql.session.timeZone": "UTC"}.items():
        other.conf.set(key, value)
    assert plain(catalogue.queries()["price_files"](other, small).toPandas()) == plain(by_duckdb(catalogue.oracle_sql()["price_files"], small))


def test_two_price_documents_in_one_file_raise(spark, tmp_path):
    from ledgerspark.sources import files

    (tmp_path / "a.json").write_text('{"prices": [[1, 2.5], [2, "3"]], "caps": [[1, 7]]}')
    assert sorted(map(tuple, files.read_price_file(spark, str(tmp_path / "a.json")).collect())) == [(1, 2.5), (2, 3.0)]
    (tmp_path / "b.json").write_text("[[1, 2.5]] [[2, 3.5]]")
    with pytest.raises(Exception, match="neither"):
        files.read_price_file(spark, str(tmp_path / "b.json")).collect()


def test_rounds_below_the_amount_are_left_out_before_the_state(spark):
    """Python and its state see what a windowed sum has let through only."""
    session = jobs.with_timers(spark)
    stream = session.readStream.format("rate").load().select(F.col("value").cast("string").alias("addr"), F.col("timestamp").alias("at"), F.unix_timestamp("timestamp").alias("ts"), F.col("value").alias("v"))
    plan = jobs.share_alerts(stream, 10_000, 45, 100, "200 seconds")._jdf.queryExecution().analyzed().toString()
    assert plan.index("TransformWithState") < plan.index("Filter (total") < plan.index("Aggregate")
