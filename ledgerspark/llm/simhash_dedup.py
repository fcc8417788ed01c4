"""SimHash near-duplicates: pigeonhole blocks, bucket joins, Hamming check, components.

Fingerprints: 64 majority bits over the XXH64 (seed 42) of every shingle of four words.
Two fingerprints link if at most ``radius`` bits differ. The 64 bits are cut into
``blocks`` parts; a close pair agrees on at least ``blocks - radius`` of them, so each
fingerprint enters one bucket for every choice of that many parts and a close pair meets
in one of them. No link is lost and nothing is capped:

* equal fingerprints are one vertex, so exact copies cost nothing;
* a bucket of two is one candidate pair, taken from an aggregate;
* a bucket of up to ``PAIRWISE`` vertices is compared in one task, which returns only a
  spanning forest of its links;
* a larger bucket is linked through midpoints: two fingerprints differ in at most four
  bits exactly if some word lies within two bits of both, so each emits the words within
  half the radius on the bits that the bucket leaves free, and those that meet are joined
  to the smallest. That is linear in the bucket. (An odd radius rounds one half up.)

Components come from alternating large-star and small-star steps, each written to the
shared folder. A fingerprint of many rows, a component of many fingerprints and a
fingerprint of many links are joined by broadcast: under a thousand can have a thousandth
of all rows each.

Defined cases: a null text counts as empty and gets fingerprint zero; rows with a null id
take part, but a component's id is its smallest id that is not null (null if there is
none); repeated rows are one vertex and each gets its row; an empty table gives no rows; very
long texts are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm._common import beside, bounded_batches, cut, delete_path, fresh_path, join_spread, named

SEED = 42
#: Largest bucket that one task compares pair by pair; larger ones go by midpoints.
PAIRWISE = 4096


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """Signed 64-bit SimHash of a UTF-8 text: bits set in over half of the shingle hashes."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    else:
        pairs = [(0, len(joined))]
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return beside(rows, "text", {"fp": "long"}, lambda texts: [[fingerprint(x, width) for x in texts]])


def _block_masks(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _close(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between distinct fingerprints."""
    values = np.unique(values)
    bits = values.view(np.uint64)  # numpy counts the bits of a signed number's absolute value
    root = np.arange(len(values))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    edges = []
    for i in range(len(values) - 1):
        for j in i + 1 + np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= radius):
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((int(values[i]), int(values[j])))
    return edges


def links(points: DataFrame, radius: int = 4, blocks: int = 7, pairwise: int = PAIRWISE) -> DataFrame:
    """(a, b): links that connect the same fingerprints as all links do. ``points``: distinct ``fp``."""
    masks = _block_masks(blocks)
    chosen = [_signed(sum(masks[i] for i in c)) for c in combinations(range(blocks), blocks - radius)]
    keyed = points.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in chosen])).alias("choice", "key"))
    buckets = cut(keyed.groupBy("choice", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"))

    twos = buckets.filter("n = 2").filter(_close(F.col("a"), F.col("b"), radius)).select("a", "b")

    crowded = cut(keyed.join(buckets.filter("n > 2").select("choice", "key", "n"), ["choice", "key"]))
    edge = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            edges = [e for fps in batch["fps"] for e in forest(np.asarray(fps, dtype=np.int64), radius)]
            yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    small = crowded.filter(F.col("n") <= pairwise).groupBy("choice", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
    found = twos.unionByName(small.mapInPandas(compare, edge))

    large = crowded.filter(F.col("n") > pairwise)
    if large.isEmpty():
        return found.distinct()
    mids = large.select("choice", "key", "fp", F.inline(_near(F.col("fp"), F.col("choice"), chosen, radius)))
    # At most as many fingerprints meet at a word as lie within half the radius of it, so this window has no hot group.
    least = F.min(F.when(F.col("inner"), F.col("fp"))).over(Window.partitionBy("choice", "key", "mid"))
    stars = mids.withColumn("a", least).filter("fp <> a").select("a", F.col("fp").alias("b"))
    return found.unionByName(stars).distinct()


def _near(fp: Column, choice: Column, chosen: list[int], radius: int) -> Column:
    """Words (mid, inner) around ``fp`` on the bits that the bucket's choice leaves free.

    They lie within half the radius, rounded up; ``inner``: rounded down. Two fingerprints
    within the radius share a word that is inner to one of them.
    """
    tables = []
    for mask in chosen:
        free = [i for i in range(64) if not (mask & ((1 << 64) - 1)) >> i & 1]
        flips = [0, *[_signed(sum(1 << i for i in c)) for k in range(1, (radius + 1) // 2 + 1) for c in combinations(free, k)]]
        tables.append(F.lit(np.array(flips, dtype=np.int64)))
    flips = F.get(F.array(*tables), choice)
    return F.transform(flips, lambda x: F.struct(fp.bitwiseXOR(x).alias("mid"), (F.bit_count(x) <= radius // 2).alias("inner")))


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node of each connected component, for the nodes of ``edges`` (a, b).

    Each step is written to the shared folder and replaces the one before. A node with a large share of all
    links gets its smallest neighbour by broadcast, so its links stay spread.
    """
    spark = edges.sparkSession

    def kept(rows: DataFrame) -> tuple[DataFrame, str]:
        path = fresh_path(spark, "simhash-edges")
        rows.write.parquet(path)
        return spark.read.parquet(path), path

    edges, path = kept(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before, n_edges = None, edges.count()
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n")).filter("n > 0")
        # Every edge has one larger end, so both steps join at most ``n_edges`` rows.
        raised = join_spread(both.filter("v > u"), least, "u", "n", n_edges)
        large, there = kept(raised.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        near = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_spread(large, near, "u", "n", n_edges).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old = path
        edges, path = kept(small.unionByName(near.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        delete_path(spark, old)
        delete_path(spark, there)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, n_edges = state, state[0]
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())


def _placed(prints: DataFrame, radius: int, blocks: int) -> tuple[DataFrame, int]:
    """(fp, n, least, root, linked) of each different fingerprint of (id, fp), and the number of rows.

    ``n``: its rows; ``least``: its smallest id; ``root``: that of its component; ``linked``: whether it has a link.
    """
    points = cut(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("least")))
    roots = components(links(points.select("fp"), radius, blocks))
    placed = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = cut(placed.select("fp", "n", "least", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked")))
    return placed, placed.agg(F.sum("n")).first()[0] or 0


def _with_least(placed: DataFrame, columns: list[str], value: Column, name: str) -> DataFrame:
    """``columns`` of the fingerprints and the least ``value`` of their components; without links one is its own component."""
    linked = placed.filter("linked").withColumn(name, value)
    groups = linked.groupBy("root").agg(F.count("*").alias("_n"), F.min(name).alias(name))
    together = join_spread(linked.drop(name), groups, "root", "_n", linked.count())
    return together.select(*columns, name).unionByName(placed.filter("not linked").select(*columns, value.alias(name)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, width: int = 4, blocks: int = 7) -> DataFrame:
    """(id, fingerprint, component_id): one row per input row, with the smallest id reachable over links."""
    marked = cut(fingerprints(docs, id_col, text_col, width))
    placed, total = _placed(marked, radius, blocks)
    classes = cut(_with_least(placed, ["fp", "n"], F.col("least"), "component_id"))
    rows = join_spread(marked, classes, "fp", "n", total)
    return rows.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, width: int = 4, blocks: int = 7) -> DataFrame:
    """Of each component the row with the smallest (id, text), null ids last, with all its columns.

    A component goes by its root, which is never null, so ids may be null or repeated.
    """

    bounded_batches(docs.sparkSession)

    @F.pandas_udf(T.LongType())
    def print_of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, width) for x in texts], dtype="int64")

    placed, _ = _placed(cut(fingerprints(docs, id_col, text_col, width)), radius, blocks)
    # Only fingerprints that have their component's smallest id can give its row.
    rank = F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"))
    heads = _with_least(placed, ["fp", "root", "least"], rank, "top").filter(rank == F.col("top")).select("fp", "root")
    heads = heads.join(heads.groupBy("root").agg(F.count("*").alias("heads")), "root")

    row = F.struct(*map(named, docs.columns))

    def order(field: Callable[[str], Column]) -> Column:
        # Further columns decide among equal ids and texts; as text, since maps have no order.
        rest = F.struct(*[field(c).alias(c) for c in docs.columns if c != text_col]).cast("string")
        return F.struct(field(id_col).isNull().alias("none"), field(id_col).alias("id"), field(text_col).alias("text"), rest.alias("rest"))

    ranked = docs.select(print_of(F.col(text_col).cast("binary")).alias("fp"), order(named).alias("by"), row.alias("row"))
    # Both uses of the rows need the same columns, so that they share one exchange.
    firsts = ranked.groupBy("fp").agg(F.min_by("row", "by").alias("row")).join(heads, "fp")
    # Several fingerprints share the smallest id only where it is null or repeated.
    several = firsts.filter("heads > 1").groupBy("root").agg(F.min_by("row", order(F.col("row").getField)).alias("row"))
    return firsts.filter("heads = 1").select("row").unionByName(several.select("row")).select("row.*")
