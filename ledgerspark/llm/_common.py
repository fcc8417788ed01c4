"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one Arrow batch hands to a Python worker; a longer text is a batch of its own.
BATCH_BYTES = 16 << 20
_BATCH, _UNSET = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

#: Arrow types of result columns by their SQL names.
ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def bounded_batches(spark: SparkSession) -> None:
    """A tighter bound on the bytes of an Arrow batch, in a session that has Spark's own; any other bound stays."""
    if spark.conf.get(_BATCH) == _UNSET:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share.

    The session's ``spark.checkpoint.dir`` decides. Only where it is unset a folder is
    chosen: a temporary one in a single-machine session, else one in the warehouse.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master.startswith("local") and not context.master.startswith("local-cluster"):
            folder = tempfile.mkdtemp(prefix="ledgerspark-")
        else:
            folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_ledgerspark"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for a table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def named(column: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + column.replace("`", "``") + "`")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def beside(rows: DataFrame, text: str, fields: dict[str, str], work: Callable[[list], list[list]]) -> DataFrame:
    """``rows`` with the column ``text`` replaced by ``fields``, which ``work`` computes for a batch of texts.

    All other columns pass as the Arrow arrays they came in, so that 64-bit ids beside nulls
    stay what they are.
    """
    bounded_batches(rows.sparkSession)
    kept = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType([*kept, *T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields.items())).fields])
    kinds = [ARROW[t] for t in fields.values()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pa.array(v, k) for v, k in zip(work(batch.column(text).to_pylist()), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *found], names=schema.names)

    return rows.mapInArrow(task, schema)


def join_spread(rows: DataFrame, table: DataFrame, key: str, count: str, total: int, hot: int = 1000) -> DataFrame:
    """``rows`` inner-joined on ``key`` to ``table``, whose keys are unique and whose ``count`` says how many rows each has.

    Keys with more than a ``hot``-th of all ``total`` rows can number less than ``hot``, so
    they are broadcast and their rows stay where they are; all other keys are shuffled.
    """
    bound = total // hot
    columns = [c for c in table.columns if c not in (key, count)]
    large = table.filter(F.col(count) > bound).select(key, F.struct(*columns).alias("_its"))
    there = rows.join(F.broadcast(large), key, "left")
    near = there.filter("_its is not null").select(*rows.columns, "_its.*")
    far = there.filter("_its is null").select(*rows.columns).join(table.filter(F.col(count) <= bound).select(key, *columns), key)
    return near.unionByName(far)


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z alone; other letters stay as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
