"""Token counts by a separator scan over flat token files.

A flat file is a run of fixed-width ids in which one id ends every document; nothing says where documents begin. Files
are read as blocks of BLOCK ids that ignore document boundaries. Each block is searched for the separator in one
vectorised comparison, and an exclusive prefix maximum of the last separator's position stitches the documents that
cross blocks. The prefix scan has two levels, so no task holds more than SPAN blocks of a file or one row per SPAN blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.bpe import VOCABULARY, codec
from tallymark.llm.common import Scratch, bounded_batches, slices, texts

BLOCK, SPAN = 1 << 16, 1 << 10
#: Bytes of a file that may stand in one row.
LARGEST = 1 << 28
#: Ids up to 65,535; the id that ends a document is the first one the vocabulary leaves free.
DTYPE, SEPARATOR = "<u2", 50_256


def write_blocks(docs: DataFrame, scratch: Scratch, name: str = VOCABULARY) -> DataFrame:
    """Encode every text, end it with the separator and lay all ids of a task out as one flat file, stored in blocks.

    Columns: file, block, data (BLOCK ids, fewer in the last), doc_ids (in file order, those whose separator lies in it).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, file, block, held, ended = codec(name), TaskContext.get().partitionId(), 0, np.zeros(0, DTYPE), []

        def out(n: int):
            nonlocal block, held, ended
            at = np.count_nonzero(held[:n] == SEPARATOR)
            row = pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([held[:n].tobytes()], pa.binary()), pa.array([ended[:at]], pa.list_(pa.int64()))],
                names=["file", "block", "data", "doc_ids"],
            )
            block, held, ended = block + 1, held[n:], ended[at:]
            return row

        for part in slices(batches):
            parts = [held]
            for ids in c.encode([t or "" for t in part.column("text").to_pylist()]):
                parts.append(np.array([*ids, SEPARATOR], DTYPE))
            held = np.concatenate(parts)
            ended += part.column("doc_id").to_pylist()
            while len(held) >= BLOCK:
                yield out(BLOCK)
        if len(held):
            yield out(BLOCK)

    bounded_batches(docs.sparkSession)
    return scratch.save(texts(docs).mapInArrow(run, "file int, block long, data binary, doc_ids array<long>"), compression="zstd")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, length, block) with the bytes of each block, read by range."""
    from pyarrow import fs

    width = np.dtype(DTYPE).itemsize * BLOCK
    for batch in batches:
        for path, length, block in zip(*(batch.column(c).to_pylist() for c in ("file", "length", "block"))):
            store, name = fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
            with store.open_input_file(name) as file:
                data = file.read_at(min(width, length - block * width), block * width)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([block], pa.int64()), pa.array([data], pa.binary())], names=["file", "block", "data"])


def blocks_of_files(spark, path: str) -> DataFrame:
    """Blocks of flat files of any size; no doc_ids are known. Empty files give no blocks.

    Files up to LARGEST bytes are read whole by Spark, from any storage that it reads; larger ones block by block by
    range, from any that pyarrow opens.
    """
    width = np.dtype(DTYPE).itemsize * BLOCK
    files = spark.read.format("binaryFile").load(path).where("length > 0").withColumnRenamed("path", "file")
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / width).cast("long"))).alias("block")
    small = files.where(F.col("length") <= LARGEST).select("file", at, "content")
    small = small.select("file", "block", F.substring("content", (F.col("block") * width + 1).cast("int"), F.lit(width)).alias("data"))
    large = files.where(F.col("length") > LARGEST).select("file", "length", at)
    large = large.repartition("file", "block").mapInArrow(_ranges, "file string, block long, data binary")
    return small.union(large).withColumn("doc_ids", F.lit(None).cast("array<bigint>"))


def separator_scan(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """file, ordinal, doc_id (null if unknown), start, n_tokens, terminated for every document of the blocks.

    start is the document's first position in its file; n_tokens excludes the separator and may be 0. Ids after a
    file's last separator make one more document with terminated = false. Files without ids give no rows.
    """
    kind = dict(blocks.dtypes)["file"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, sizes = [], []
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                ids = np.frombuffer(data.as_buffer(), DTYPE)
                where.append(np.flatnonzero(ids == separator) + block * BLOCK)
                sizes.append(block * BLOCK + len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(where, pa.list_(pa.int64())), batch.column("doc_ids")],
                names=["file", "block", "past", "ends", "doc_ids"],
            )

    found = blocks.select("file", "block", "data", "doc_ids").mapInArrow(run, f"file {kind}, block long, past long, ends array<long>, doc_ids array<long>")
    found = found.withColumn("span", F.floor(F.col("block") / SPAN)).withColumn("last", F.try_element_at("ends", F.lit(-1)))
    before = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inner = found.withColumns({"in_span": F.max("last").over(before), "n_span": F.sum(F.size("ends")).over(before)})
    spans = found.groupBy("file", "span").agg(F.max("last").alias("last"), F.sum(F.size("ends")).alias("n"), F.max("past").alias("past"))
    earlier = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    spans = spans.select("file", "span", F.max("last").over(earlier).alias("carry"), F.sum("n").over(earlier).alias("n_carry"), F.max("last").over(whole).alias("file_last"), F.sum("n").over(whole).alias("file_n"), F.max("past").over(whole).alias("file_past"))
    joined = inner.join(spans, ["file", "span"])
    first = F.coalesce("in_span", "carry", F.lit(-1)) + 1
    starts = F.concat(F.array(first), F.transform("ends", lambda e: e + 1))
    documents = joined.select(
        "file",
        F.coalesce("n_carry", F.lit(0)).alias("base"),
        F.coalesce("n_span", F.lit(0)).alias("more"),
        F.posexplode(F.arrays_zip(F.slice(starts, 1, F.size("ends")).alias("start"), F.col("ends").alias("end"), F.coalesce("doc_ids", F.array().cast("array<bigint>")).alias("doc_id"))).alias("at", "d"),
    )
    documents = documents.select("file", (F.col("base") + F.col("more") + F.col("at")).alias("ordinal"), F.col("d.doc_id").alias("doc_id"), F.col("d.start").alias("start"), (F.col("d.end") - F.col("d.start")).alias("n_tokens"), F.lit(True).alias("terminated"))
    start = F.coalesce("file_last", F.lit(-1)) + 1
    rest = spans.where("span = 0").where(F.col("file_past") > start)
    rest = rest.select("file", F.col("file_n").alias("ordinal"), F.lit(None).cast("long").alias("doc_id"), start.alias("start"), (F.col("file_past") - start).alias("n_tokens"), F.lit(False).alias("terminated"))
    return documents.union(rest)


def token_counts(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, file, ordinal, start, n_tokens, terminated of every row of ``docs``, counted from flat files.

    A null text has no tokens. Null ids, repeated rows and further columns change nothing: each row is one document.
    Very long texts are encoded whole and may span any number of blocks. file, ordinal and start tell where a document
    lies in the files that this run laid out.
    """
    scratch = Scratch(docs.sparkSession, "tokens")
    return separator_scan(write_blocks(docs, scratch, name))
