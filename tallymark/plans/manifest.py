"""What each step of a run was made from, and what it made.

A step's recipe is the digest of its name, its parameters, the code and the contents that it reads; its content is a digest
of the rows that it wrote, gathered while they were written, together with the step's own counts. A step whose recipe is
on record and whose table stands is taken over. A step that had to run again but wrote the same rows leaves the recipes of
the steps after it as they were, so these are taken over all the same.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.sources import readers

#: Alarms of a run: step, count, share of the step's rows above which it is raised.
SHARE_ALARMS = (("final", "other", 0.20), ("final", "fallback", 0.05), ("final", "largest_category", 0.60), ("documents", "background", 0.90))


def code_version() -> str:
    """A digest of the library's own sources that steps are made of."""
    root = Path(__file__).resolve().parents[1]
    files = sorted(p for part in ("functions", "operators", "plans", "sources") for p in (root / part).glob("*.py"))
    return hashlib.sha256(b"".join(p.name.encode() + b"\0" + p.read_bytes() for p in files)).hexdigest()


def _digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def _hashable(field: T.StructField) -> Column:
    """Maps have no hash of their own; their JSON has."""
    column = F.col(f"`{field.name}`")
    return F.to_json(column) if "map<" in field.dataType.simpleString() else column


def content_of(frame: DataFrame) -> list[Column]:
    """Aggregates that tell tables apart whatever the order of their rows: their number, and two sums over row hashes."""
    columns = [_hashable(f) for f in frame.schema.fields] or [F.lit(0)]
    return [F.count("*").alias("rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64(F.lit("second"), *columns)).alias("xor")]


class Manifest:
    """The record of a run below its folder; ``ran`` and ``reused`` name the steps of this run."""

    def __init__(self, spark: SparkSession, out: str, force: bool = False, version: str | None = None):
        self.spark, self.out, self.force, self.version = spark, out, force, version or code_version()
        self.contents: dict[str, str] = {}
        self.ran: list[str] = []
        self.reused: list[str] = []
        self.records: dict[str, dict] = {}

    def files(self, name: str, path: str) -> None:
        """A source that is known by its files: their names, lengths and times of change. Nothing is read."""
        self.contents[name] = _digest(name, readers.listing(self.spark, path, times=True))

    def table(self, name: str, frame: DataFrame | None) -> None:
        """A source that is known by its rows, which are read once for it; None is a source, too."""
        self.contents[name] = "none" if frame is None else _digest(frame.schema.json(), frame.agg(*content_of(frame)).first().asDict())

    def step(self, name: str, build: Callable[[], DataFrame], reads: tuple[str, ...], parameters: object = None, counts: Callable[[DataFrame], dict[str, Column]] | None = None) -> DataFrame:
        """The table of a step, worked out only if its recipe has changed. ``counts``: aggregates to record with it."""
        recipe = _digest(self.version, name, parameters, [(r, self.contents[r]) for r in reads])
        path, record = f"{self.out}/{name}", self._recorded(name)
        if not self.force and record and record["recipe"] == recipe and readers.stands(self.spark, path):
            self.reused.append(name)
        else:
            self._forget(name)
            record = {"recipe": recipe} | self._write(build(), path, counts)
            readers.write_text(self.spark, f"{self.out}/manifest/{name}.json", json.dumps(record, sort_keys=True))
            self.ran.append(name)
        self.contents[name], self.records[name] = record["content"], record
        return self.spark.read.parquet(path)

    def _write(self, frame: DataFrame, path: str, counts: Callable[[DataFrame], dict[str, Column]] | None) -> dict:
        seen = Observation()
        own = counts(frame) if counts else {}
        readers.write_artifact(frame.observe(seen, *content_of(frame), *[c.alias(f"n_{k}") for k, c in own.items()]), path, partition=None)
        found = seen.get
        told = {k: found.get(f"n_{k}") for k in own}
        return {"content": _digest(frame.schema.json(), {k: found.get(k) for k in ("rows", "sum", "xor")}), "rows": found.get("rows", 0), "counts": told}

    def _recorded(self, name: str) -> dict | None:
        text = readers.read_text(self.spark, f"{self.out}/manifest/{name}.json")
        try:
            record = json.loads(text) if text else None
        except ValueError:
            return None
        return record if isinstance(record, dict) and {"recipe", "content", "rows", "counts"} <= record.keys() else None

    def _forget(self, name: str) -> None:
        readers.delete(self.spark, f"{self.out}/manifest/{name}.json")

    def alarms(self) -> list[dict]:
        """step, alarm, n, rows, share of every count above its bound (SHARE_ALARMS), from the records alone."""
        found = []
        for step, count, most in SHARE_ALARMS:
            record = self.records.get(step)
            n, rows = (record["counts"].get(count) or 0, record["rows"]) if record else (0, 0)
            if rows and n > most * rows:
                found.append({"step": step, "alarm": count, "n": n, "rows": rows, "share": round(n / rows, 9)})
        return found


def category_counts(categories: tuple[str, ...]) -> Callable[[DataFrame], dict[str, Column]]:
    """Counts of a final ledger: rows by category, the largest of them, rows labelled other, rows that no label was found for."""

    def counts(frame: DataFrame) -> dict[str, Column]:
        by = {f"category_{c}": F.count_if(F.coalesce(F.col("category") == c, F.lit(False))) for c in categories}
        fallback = F.array_contains("origin", "category: none")
        return by | {"largest_category": F.greatest(*by.values()), "other": by["category_other"], "fallback": F.count_if(F.coalesce(fallback, F.lit(False)))}

    return counts


def document_counts(frame: DataFrame) -> dict[str, Column]:
    """Counts of a table of documents: those of no use for figures."""
    return {"background": F.count_if(F.coalesce(F.col("type") == "BACKGROUND", F.lit(False)))}
