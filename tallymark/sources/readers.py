"""Discovery, reading and writing of ledgers, documents, templates and artifacts.

All paths go through Spark's readers or Hadoop's file system, so any storage that Spark knows will do.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_COLUMNS = ("txn_id", "account_id", "date", "counterparty", "description", "amount", "currency")
#: A CSV is a ledger if its header holds these.
LEDGER_MARKS = {"txn_id", "account_id", "amount"}
TEXTS, IMAGES = ("txt", "md", "csv", "tsv", "json"), ("png", "jpg", "jpeg", "tif", "tiff", "bmp")
DOCUMENT_SUFFIXES = (*TEXTS, "pdf", *IMAGES)


@dataclass
class Dataset:
    ledger: str
    template: str
    documents: str
    warnings: list[str] = field(default_factory=list)


def _store(spark: SparkSession, path: str):
    """A path and the file system that holds it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listing(spark: SparkSession, root: str, times: bool = False) -> list[tuple]:
    """(path, bytes), and the time of the last change if asked for, of the files below a folder: names only, nothing is read."""
    path, store = _store(spark, root)
    files = store.listFiles(path, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), *([f.getModificationTime()] if times else [])))
    return sorted(out)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder; false if nothing stood there."""
    where, store = _store(spark, path)
    return store.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None."""
    where, store = _store(spark, path)
    if not store.exists(where):
        return None
    row = spark.read.text(path, wholetext=True).first()
    return row["value"] if row else ""


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written aside and renamed, so that it is there as a whole or not at all."""
    where, store = _store(spark, path)
    aside, _ = _store(spark, f"{path}.part")
    out = store.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    store.delete(where, False)
    if not store.rename(aside, where):
        raise OSError(f"{path} could not be written")


def suffix(path: str) -> str:
    return path.rpartition("/")[2].rpartition(".")[2].lower()


def discover(spark: SparkSession, root: str) -> Dataset:
    """Find the ledger (largest CSV with a ledger header), the template (the one JSON of empty answer cells) and the
    folder with most documents (five at least; of equals the shortest path). Answer keys are warned of, never returned."""
    files, warnings = listing(spark, root), []
    ledgers = []
    for path, size in files:
        if suffix(path) == "csv":
            header = {c.lstrip("﻿").strip() for c in spark.read.option("header", True).csv(path).columns}
            if header >= LEDGER_MARKS:
                ledgers.append((size, path))
    if not ledgers:
        raise ValueError("no ledger found")
    if len(ledgers) > 1:
        warnings.append(f"{len(ledgers)} ledgers; the largest is taken")
    templates = []
    for path, _ in files:
        if suffix(path) == "json":
            content = _parsed(spark, path)
            if isinstance(content, dict) and isinstance(content.get("answers"), dict) and any("status" in c for s in content["answers"].values() if isinstance(s, dict) for c in s.values() if isinstance(c, dict)):
                templates.append(path)
            elif isinstance(content, dict) and isinstance(content.get("scenarios"), dict) and any("covenants" in s for s in content["scenarios"].values() if isinstance(s, dict)):
                warnings.append(f"answer key ignored: {path}")
    if len(templates) != 1:
        raise ValueError(f"{len(templates)} templates found")
    folders: dict[str, int] = {}
    for path, _ in files:
        if suffix(path) in DOCUMENT_SUFFIXES and path not in (templates[0], max(ledgers)[1]):
            folders[path.rpartition("/")[0]] = folders.get(path.rpartition("/")[0], 0) + 1
    full = [(-n, len(d), d) for d, n in folders.items() if n >= 5]
    if not full:
        raise ValueError("no folder of documents")
    return Dataset(max(ledgers)[1], templates[0], min(full)[2], warnings)


def _parsed(spark: SparkSession, path: str):
    """A small JSON file's content, or None."""
    row = spark.read.text(path, wholetext=True).first()
    try:
        return json.loads(row["value"].lstrip("﻿")) if row else None
    except ValueError:
        return None


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The raw ledger, all text, trimmed; a byte-order mark and columns beyond the known ones are dropped."""
    raw = spark.read.csv(path, header=True, inferSchema=False, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    named = {c.lstrip("﻿").strip(): c for c in raw.columns}
    return raw.select(*[(F.trim(F.col(f"`{named[c]}`")) if c in named else F.lit(None).cast("string")).alias(c) for c in LEDGER_COLUMNS])


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id (file name), text, method, warnings; files of other kinds come back as failed, with a warning."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.lower(F.element_at(F.split(name, r"\."), -1))
    text = F.when(kind.isin(*TEXTS), F.ltrim(F.decode("content", "utf-8"), F.lit("﻿")))
    method = F.when(kind.isin(*TEXTS), "text").when(kind.isin("pdf", *IMAGES), "needs_extractor").otherwise("failed")
    return files.select(name.alias("doc_id"), text.alias("text"), method.alias("method"), F.when(method == "failed", F.array(F.concat(F.lit("unknown_suffix:"), kind))).otherwise(F.array().cast("array<string>")).alias("warnings"))


ANSWERS = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StructType([T.StructField("status", T.StringType()), T.StructField("actual", T.DoubleType()), T.StructField("evidence_txn_id", T.StringType())])))


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """scenario_id, point, status, actual, evidence_txn_id of a template or submission."""
    schema = T.StructType([T.StructField("answers", ANSWERS)])
    outer = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("answers").alias("scenario_id", "cells"))
    return outer.select("scenario_id", F.explode("cells").alias("point", "cell")).select("scenario_id", "point", "cell.*")


def submission_json(cells: DataFrame, **head: str) -> DataFrame:
    """One row with the submission as JSON, scenarios and points in order; cells are as few as the template's."""
    cell = F.struct("status", "actual", "evidence_txn_id")
    per = cells.groupBy("scenario_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("point", cell.alias("cell"))))).alias("cells"))
    answers = F.map_from_entries(F.sort_array(F.collect_list(F.struct("scenario_id", F.to_json("cells", {"ignoreNullFields": "false"}).alias("cells")))))
    # Cells are JSON already; maps of structs cannot be sorted, so they are spliced in as text.
    whole = per.agg(answers.alias("a")).select(F.array_join(F.transform(F.map_entries("a"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ",").alias("a"))
    top = "".join(f"{json.dumps(k)}:{json.dumps(v, ensure_ascii=False)}," for k, v in head.items())
    return whole.select(F.concat(F.lit("{" + top + '"answers":{'), "a", F.lit("}}")).alias("value"))


def stands(spark: SparkSession, path: str) -> bool:
    """Whether an artifact was written to its end; a write that broke off does not count."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def write_artifact(frame: DataFrame, path: str, partition: str | None = "scenario_id") -> None:
    """A Parquet artifact, partitioned by borrower unless told otherwise; Spark's commit protocol makes it whole or absent."""
    writer = frame.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
