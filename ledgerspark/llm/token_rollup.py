"""Token counts: totals by source, language and tokenizer version, kept by signed deltas.

Changes come as batches of events (source, lang, version, old_tokens, new_tokens[, rows]): an
insert has no old count, a delete has no new one, a revision has both; ``rows`` equal events
may come as one. A batch is reduced to one signed delta per group and written as one
immutable table named by its batch id; totals are the sum of the committed deltas, so
nothing is ever re-read from the corpus.

Commits are idempotent: a batch whose id is committed is not applied again, and a batch
that failed halfway wrote to a folder that no commit names, so its retry starts clean. The
commit itself is one small row written last. ``compact`` folds all committed deltas into one
snapshot of sums that names the batches it holds; readers take the newest snapshot and the
batches committed since. The driver never holds the list of batches.

Defined cases: null source, language or version are groups of their own; null counts on
both sides change nothing; repeated events count each (exactly-once holds per batch); an
empty batch commits and changes nothing; groups whose documents and tokens both return to
zero are not listed; in ``count_tokens`` null and empty texts have no words and no tokens, long
texts are counted whole and extra columns are not read.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm._common import beside, cut, delete_path, path_exists
from ledgerspark.llm.packing import encoder

GROUP = ("source", "lang", "version")
DELTA = "source string, lang string, version string, docs long, tokens long"


def delta(events: DataFrame) -> DataFrame:
    """One signed row per group: documents and tokens that the events add or take away."""
    old, new = F.col("old_tokens"), F.col("new_tokens")
    times = F.col("rows") if "rows" in events.columns else F.lit(1).cast("long")
    changes = events.select(
        *GROUP,
        ((new.isNotNull().cast("long") - old.isNotNull().cast("long")) * times).alias("docs"),
        ((F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0))) * times).cast("long").alias("tokens"),
    )
    return changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """Totals under ``path``: ``deltas/folder=<name>`` tables, a ``commits`` table that names the valid ones, and ``snapshots``.

    A snapshot is a folder ``<number>-<name>`` with ``sums`` and the ``commits`` that they hold. It is
    valid once a row of the table ``log`` names it; there is one row a compaction.
    """

    COMMIT = "batch string, folder string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _snapshot(self) -> tuple[int, str]:
        """Number and folder of the newest snapshot; (0, "") if there is none."""
        top = self._table("log", "number long, folder string").agg(F.max(F.struct("number", "folder")).alias("top")).first()["top"]
        return (top["number"], top["folder"]) if top else (0, "")

    def commits(self) -> DataFrame:
        """(batch, folder) of every batch ever committed. Two writers of one batch wrote the same delta; the first folder by name stands."""
        rows = self._table("commits", self.COMMIT)
        number, folder = self._snapshot()
        if number:
            rows = rows.unionByName(self._table(f"snapshots/{folder}/commits", self.COMMIT))
        return rows.groupBy("batch").agg(F.min("folder").alias("folder"))

    def apply(self, batch: str, events: DataFrame) -> bool:
        """Apply a batch once; False if it was applied before."""
        if not self.commits().filter(F.col("batch") == batch).isEmpty():
            return False
        folder = f"{zlib.crc32(batch.encode()):08x}-{uuid.uuid4().hex}"
        delta(events).write.parquet(f"{self.path}/deltas/folder={folder}")
        self.spark.createDataFrame([(batch, folder)], self.COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return True

    def _open(self) -> DataFrame:
        """Deltas of the batches that are committed but in no snapshot."""
        number, folder = self._snapshot()
        known = self.commits()
        if number:
            known = known.join(self._table(f"snapshots/{folder}/commits", self.COMMIT).select("batch"), "batch", "left_anti")
        return self._table("deltas", DELTA + ", folder string").join(known.select("folder"), "folder", "left_semi").select(*GROUP, "docs", "tokens")

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) over all committed batches."""
        rows = self._open()
        number, folder = self._snapshot()
        if number:
            rows = rows.unionByName(self._table(f"snapshots/{folder}/sums", DELTA))
        return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Fold all committed deltas into one snapshot. A compaction that fails leaves nothing that counts."""
        number, last = self._snapshot()
        folder = f"{number + 1:08}-{uuid.uuid4().hex}"
        # What is committed now; batches committed meanwhile are not in this list and stay open.
        known = cut(self.commits())
        new = known
        if number:
            new = known.join(self._table(f"snapshots/{last}/commits", self.COMMIT).select("batch"), "batch", "left_anti")
        rows = self._table("deltas", DELTA + ", folder string").join(new.select("folder"), "folder", "left_semi").select(*GROUP, "docs", "tokens")
        if number:
            rows = rows.unionByName(self._table(f"snapshots/{last}/sums", DELTA))
        sums = rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")
        sums.write.parquet(f"{self.path}/snapshots/{folder}/sums")
        known.write.parquet(f"{self.path}/snapshots/{folder}/commits")
        self.spark.createDataFrame([(number + 1, folder)], "number long, folder string").coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def vacuum(self) -> None:
        """Delete the deltas that the newest snapshot holds. Only for times without readers of older totals."""
        number, folder = self._snapshot()
        if number:
            for row in self._table(f"snapshots/{folder}/commits", self.COMMIT).toLocalIterator():
                delete_path(self.spark, f"{self.path}/deltas/folder={row['folder']}")


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, source, lang, digest, words, tokens) for every row: words between white space and tokens of the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), "source", "lang", F.md5(text).alias("digest"), text.alias("text"))

    def work(texts: list[str]) -> list[list]:
        encode = encoder(tokenizer)
        return [[len(x.encode().split()) for x in texts], [len(encode(x)) for x in texts]]

    return beside(rows, "text", {"words": "long", "tokens": "long"}, work)


def events(counts: DataFrame, version: str, old: Column | None, new: Column | None, rows: Column | None = None) -> DataFrame:
    """Events of one version from a table of counts; None: no count on that side, or one event a row."""
    none = F.lit(None).cast("long")
    return counts.select(
        "source", "lang", F.lit(version).alias("version"), (none if old is None else old).alias("old_tokens"), (none if new is None else new).alias("new_tokens"), (F.lit(1).cast("long") if rows is None else rows).alias("rows")
    )


def surplus(counts: DataFrame) -> DataFrame:
    """(source, lang, tokens, rows): all rows but one of each digest, the one with the smallest (id, source, lang); nulls come last.

    Copies are added up by digest, source and language first, so a text that many rows share is a few rows here.
    """
    name = F.struct(F.col("id").isNull(), "id", F.col("source").isNull(), "source", F.col("lang").isNull(), "lang")
    per = counts.groupBy("digest", "source", "lang").agg(F.count("*").alias("n"), F.min(name).alias("first"), F.max("tokens").alias("tokens"))
    first = per.groupBy("digest").agg(F.min("first").alias("keeps"), F.sum("n").alias("of")).filter("of > 1")
    left = per.join(first, "digest").withColumn("rows", F.col("n") - F.when(F.col("first") == F.col("keeps"), 1).otherwise(0))
    return left.filter("rows > 0").select("source", "lang", "tokens", "rows")
