"""The folder that driver and executors share, and checkpoints in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder (one machine) or one in the warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        local = context.master.startswith("local")
        folder = tempfile.mkdtemp(prefix="ledgerspark-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, without its lineage; survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


class Scratch:
    """Tables of the rounds of an iteration, in the shared folder, until ``clear``.

    A table that is read again starts with a plan of its own, while a checkpoint hands on what is known of its
    columns, which grows with every round. As many files at most as a shuffle has parts.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._n = spark, 0
        self._path = f"{checkpoint_dir(spark).rstrip('/')}/rounds-{uuid.uuid4().hex}"

    def put(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self._path}/{self._n}"
        df.coalesce(int(self._spark.conf.get("spark.sql.shuffle.partitions"))).write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        hadoop = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path)
        hadoop.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
