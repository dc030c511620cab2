"""Incremental ingestion and event windows on Structured Streaming (an extension: the batch engine has neither)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_parquet(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder; the checkpoint remembers those already read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def windowed_counts(events: DataFrame, width: str = "1 hour", slide: str | None = None, lateness: str = "2 hours") -> DataFrame:
    """window_start, event_type, n, total of tumbling or sliding windows; rows later than ``lateness`` are left out."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return timed.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", lateness: str = "2 hours") -> DataFrame:
    """user_id, session_start, session_end, n of runs of events with no gap as long as ``gap``."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return timed.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


#: Folders that the transactions of a target are dealt to by a hash of their id.
BUCKETS = 256


def upsert_ledger(stream: DataFrame, target: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Add each batch's new transactions (by txn_id, the first of a batch) to a Parquet target; replays of a batch add nothing.

    The target is partitioned by a hash of the id, and a batch looks for its ids in the partitions that it touches and in
    no others. A null id is an id. One query may write to a target at a time; ``buckets`` must stay as it was.
    """
    bucket = F.pmod(F.xxhash64("txn_id"), F.lit(buckets)).cast("int")

    def batch(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        # The batch is read twice: for the buckets that it touches, and to be written.
        fresh = rows.dropDuplicates(["txn_id"]).withColumn("bucket", bucket).persist()
        try:
            touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
            known = _known_ids(spark, target, touched)
            if known is not None:
                fresh_ids = known.select(F.col("txn_id").alias("_known"), F.col("bucket").alias("_bucket"))
                same = F.col("txn_id").eqNullSafe(F.col("_known")) & (F.col("bucket") == F.col("_bucket"))
                fresh.join(fresh_ids, same, "left_anti").write.mode("append").partitionBy("bucket").parquet(target)
            elif touched:
                fresh.write.mode("append").partitionBy("bucket").parquet(target)
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _known_ids(spark: SparkSession, target: str, touched: list[int]) -> DataFrame | None:
    """txn_id, bucket of the transactions in some partitions of a target; None if it holds none of them yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [f"{target}/bucket={b}" for b in touched]
    there = [f for f in folders if store.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f))]
    return spark.read.option("basePath", target).parquet(*there).select("txn_id", "bucket") if there else None
