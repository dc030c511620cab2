"""Input selection, bounded Arrow batches and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch; with Spark's own byte limit a batch of long texts stays small.
BATCH_ROWS = 512
#: Rows that are worth a file of their own, where a table's rows are known before it is written.
FILE_ROWS = 5_000
#: Bytes of text that one vectorised step handles at once (a single longer text stands alone).
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only the id and the text; any further column, whatever its name, is left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for tables with very long texts, and let workers import this package."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; one of our own only in local mode."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tallymark-")
        sc.setCheckpointDir(base)
    return base


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive lost executors.

    keep() removes all but the tables that a result still reads; those stay until the caller runs release().
    """

    live: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count, self.paths = 0, []
        Scratch.live.append(self)

    def save(self, df: DataFrame, compression: str = "snappy", rows: int | None = None, **options: object) -> DataFrame:
        """``df`` written and read again; ``rows``, if known, are about how many it has or is made from.

        Shuffles can leave far more partitions than so many rows need. A file each would be dear: on Hadoop's local file
        system an executor starts a process (chmod) for every file it creates, which at first shares all its memory.
        """
        self.count += 1
        if rows is not None:
            df = df.coalesce(self.files(rows))
        path = f"{self.base}/{self.count:04d}"
        df.write.options(compression=compression, **options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.paths.append(path)
        return out

    def files(self, rows: int) -> int:
        """Files that so many rows are worth; enough to keep all cores busy in any case."""
        return max(2 * self.spark.sparkContext.defaultParallelism, rows // FILE_ROWS)

    def drop(self, df: DataFrame | None) -> None:
        """Remove a saved table that nothing reads any more."""
        path = getattr(df, "_scratch_path", None)
        if path in self.paths:
            self.paths.remove(path)
            self._delete(path)

    def keep(self, *read: DataFrame) -> None:
        """Remove all saved tables but those that are still read."""
        named = {df._scratch_path for df in read}
        for path in [p for p in self.paths if p not in named]:
            self.paths.remove(path)
            self._delete(path)

    def _delete(self, path: str) -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    @classmethod
    def release(cls, since: int = 0) -> None:
        """Remove the tables of all work begun after the first ``since`` ones, once its results have been written elsewhere."""
        for scratch in cls.live[since:]:
            scratch._delete(scratch.base)
        del cls.live[since:]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows holding about SLICE_BYTES of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
