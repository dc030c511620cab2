"""Tables that a step leaves in the shared folder: they cut lineage and outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; in local mode, where none is named, one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder that the executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallymark-"))
    return spark.sparkContext.getCheckpointDir()


#: Spark's setting for removing an execution's shuffle files once it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind; else they stay until the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


class Store:
    """Written tables of one piece of work, below one folder of their own; ``hint`` is what joins are told of later ones."""

    hint: str | None = None

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.written = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", {}

    def put(self, frame: DataFrame) -> DataFrame:
        """``frame`` as written and read again."""
        path = f"{self.folder}/{len(self.written)}"
        with shuffles_removed(self.spark):
            frame.write.option("compression", "zstd").parquet(path)
        stored = self.spark.read.schema(frame.schema).parquet(path)
        stored = stored.hint(self.hint) if self.hint else stored
        self.written[id(stored)] = (path, stored)
        return stored

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for frame in frames:
            path, _ = self.written[id(frame)]
            self.written[id(frame)] = (None, frame)
            if path:
                remove(self.spark, path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder in whatever store holds it; false if nothing stood there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
