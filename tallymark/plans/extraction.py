"""Pluggable extraction: documents go to an extractor in batches, answers are checked, cached and replayed by content."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.text import collapse

#: One answer: a JSON text, or an exception's text.
RESULT = "key string, payload string, error string, attempts int"
Validator = Callable[[dict], list[str]]


@dataclass(frozen=True)
class Extractor:
    """A task: instructions, version, validators, and call(prompt, earlier problems) -> JSON text."""

    name: str
    version: str
    call: Callable[[str, list[str]], str]
    validators: tuple[Validator, ...] = ()
    repairs: int = 2
    retries: int = 5
    #: Seconds before the first repetition after an exception; twice as many before each further one.
    pause: float = 0.0


REGISTRY: dict[str, Extractor] = {}


def register(extractor: Extractor) -> Extractor:
    REGISTRY[extractor.name] = extractor
    return extractor


def request_key(extractor: Extractor, prompt: Column) -> Column:
    """The content address of a request: everything that shapes the answer."""
    return F.sha2(F.to_json(F.struct(F.lit(extractor.name).alias("name"), F.lit(extractor.version).alias("version"), prompt.alias("prompt"))), 256)


def replay(answers: dict[str, str]) -> Callable[[str, list[str]], str]:
    """A call that answers from a table; an unknown prompt is an error, never a guess."""

    def call(prompt: str, found: list[str]) -> str:
        if prompt not in answers:
            raise KeyError(f"no answer for {prompt[:40]!r}")
        return answers[prompt]

    return call


def check(payload: str, validators: tuple[Validator, ...]) -> list[str]:
    """Problems of an answer; a validator that fails is one of them."""
    try:
        parsed = json.loads(payload)
    except (TypeError, ValueError):
        return ["not_json"]
    found: list[str] = []
    for v in validators:
        try:
            found += v(parsed)
        except Exception as e:  # an answer of an unforeseen shape
            found.append(f"validator {type(e).__name__}: {e}")
    return found


def _ask(extractor: Extractor, prompt: str) -> tuple[str | None, str | None, int]:
    """Payload, error and number of calls. Exceptions are tried again ``retries`` times, wrong answers ``repairs`` times."""
    found: list[str] = []
    payload, failed, repaired, calls = None, 0, 0, 0
    while True:
        calls += 1
        try:
            payload = extractor.call(prompt, found)
        except Exception as e:  # the row carries it
            failed += 1
            if failed > extractor.retries:
                return payload, f"{type(e).__name__}: {e}", calls
            time.sleep(extractor.pause * 2 ** (failed - 1))
            continue
        found = check(payload, extractor.validators)
        if not found:
            return payload, None, calls
        repaired += 1
        if repaired > extractor.repairs:
            return payload, ";".join(found), calls


def extract(prompts: DataFrame, extractor: Extractor, cache: DataFrame | None = None) -> DataFrame:
    """key, payload, error, attempts of every distinct prompt (column ``prompt``).

    Equal prompts cost one call. A cached answer that still passes the validators is reused (attempts = 0), any other is
    asked for again. An answer with problems is asked for again with them; what then remains becomes an error on the row
    beside the last answer, and so does an exception, instead of failing the job.
    """
    asked = prompts.select(request_key(extractor, F.col("prompt")).alias("key"), "prompt").dropDuplicates(["key"])
    none = F.lit(None).cast("string")
    if cache is not None:
        stored = cache.where("payload IS NOT NULL").groupBy("key").agg(F.min("payload").alias("stored"))
        asked = asked.join(stored, "key", "left")
    else:
        asked = asked.withColumn("stored", none)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(s, None, 0) if isinstance(s, str) and not check(s, extractor.validators) else _ask(extractor, p) for p, s in zip(batch["prompt"], batch["stored"])]
            yield pd.DataFrame({"key": batch["key"], "payload": [r[0] for r in rows], "error": [r[1] for r in rows], "attempts": [r[2] for r in rows]})

    return asked.select("key", "prompt", "stored").mapInPandas(run, RESULT)


def remember(answers: DataFrame, path: str) -> None:
    """Append the answers that were asked for and are right to a cache table; Spark's commit makes an append whole or absent."""
    answers.where("error IS NULL AND attempts > 0").select("key", "payload").write.mode("append").parquet(path)


def call_log(answers: DataFrame, extractor: Extractor) -> DataFrame:
    """One row a request that cost calls: name, version, key, attempts, error."""
    return answers.where("attempts > 0").select(F.lit(extractor.name).alias("name"), F.lit(extractor.version).alias("version"), "key", "attempts", "error")


def usage(answers: DataFrame) -> DataFrame:
    """One row: requests, cache hits, calls, repeated calls, errors."""
    n = lambda c: F.count_if(c)
    return answers.agg(
        F.count("*").alias("requests"), n(F.col("attempts") == 0).alias("hits"), F.coalesce(F.sum("attempts"), F.lit(0)).alias("calls"), F.coalesce(F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))), F.lit(0)).alias("repeated"), n(F.col("error").isNotNull()).alias("errors")
    )


def _batched(rows: DataFrame, size: int, salt: int) -> DataFrame:
    """Prompts of ``size`` rows (id, text) at most, as JSON lists; rows are dealt into groups by a hash, so no task holds all."""
    n = max(1, rows.count())
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(-(-n // (size * 16)))))
    at = F.row_number().over(Window.partitionBy("group").orderBy("id")) - 1
    batches = dealt.withColumn("batch", F.floor(at / size)).groupBy("group", "batch").agg(F.array_sort(F.collect_list(F.struct("id", "text"))).alias("items"))
    return batches.select(F.to_json("items").alias("prompt"))


def label_batches(rows: DataFrame, extractor: Extractor, vocabulary: tuple[str, ...], size: int = 60, again: int = 15, otherwise: str = "other", cache: DataFrame | None = None) -> DataFrame:
    """id, label, fallback of ``rows`` (id, text), labelled ``size`` to a call.

    An answer is a JSON list of {id, label}. Of a partly wrong one the right items stay: invented ids, repeated ids after
    the first and labels out of the vocabulary go. Rows without a label are asked for once more in smaller batches; what
    is still missing gets ``otherwise``.
    """
    items = rows.select(F.col("id").cast("string").alias("id"), "text").dropDuplicates(["id"])

    def labels(asked: DataFrame, n: int, salt: int) -> DataFrame:
        answers = extract(_batched(asked, n, salt), extractor, cache).where("payload IS NOT NULL")
        listed = answers.select("key", F.posexplode(F.from_json("payload", "array<struct<id:string,label:string>>")).alias("at", "x")).select("key", "at", "x.*")
        right = listed.where(F.col("label").isin(*vocabulary)).join(asked.select("id"), "id", "left_semi")
        return right.groupBy("id").agg(F.min_by("label", F.struct("key", "at")).alias("label"))

    first = labels(items, size, 1)
    second = labels(items.join(first, "id", "left_anti"), again, 2)
    found = items.select("id").join(first.union(second), "id", "left")
    return found.select("id", F.coalesce("label", F.lit(otherwise)).alias("label"), F.col("label").isNull().alias("fallback"))


def extract_documents(docs: DataFrame, extractor: Extractor, schema: str, cache: DataFrame | None = None) -> DataFrame:
    """doc_id, payload, found (the answer by ``schema``), error of ``docs`` (doc_id, text): one request a document.

    An answer whose quotes (any field named quote) do not stand in the text is an error of the row; the last answer stays.
    """
    answers = extract(docs.select(F.col("text").alias("prompt")), extractor, cache)
    out = docs.withColumn("key", request_key(extractor, F.col("text"))).join(answers.select("key", "payload", "error"), "key", "left")
    quotes = F.regexp_extract_all("payload", F.lit(r'"quote"\s*:\s*("(?:[^"\\\\]|\\\\.)*+")'), F.lit(1))
    said = F.transform(quotes, lambda q: F.from_json(F.concat(F.lit('{"q":'), q, F.lit("}")), "q string")["q"])
    foreign = F.exists(said, lambda q: (q != "") & ~F.contains(collapse(F.col("text")), collapse(q)))
    error = F.concat_ws(";", "error", F.when(F.coalesce(foreign, F.lit(False)), "foreign_quote"))
    return out.select("doc_id", "payload", F.from_json("payload", schema).alias("found"), F.nullif(error, F.lit("")).alias("error"))


def fallback_types(docs: DataFrame, extractor: Extractor, alarm: bool, open_type: str = "BACKGROUND", most: int = 220, chars: int = 3000, least: float = 0.6) -> DataFrame:
    """doc_id, type of ``docs`` (doc_id, type, text) after a second look at those that no rule told, if an alarm asks for it.

    The answer is {type, confidence, quote}; it counts with enough confidence and a quote that stands in the text shown.
    At most ``most`` documents are looked at, by id: the price of a fallback is bounded. A rule's type is never changed.
    """
    if not alarm:
        return docs.select("doc_id", "type")
    unsure = docs.where(F.col("type") == open_type).orderBy("doc_id").limit(most).select("doc_id", F.substring("text", 1, chars).alias("text"))
    found = extract_documents(unsure, extractor, "type string, confidence double, quote string")
    sure = found.where((F.col("error").isNull()) & (F.col("found.confidence") >= least) & (F.coalesce("found.quote", F.lit("")) != "")).select("doc_id", F.col("found.type").alias("seen"))
    return docs.join(sure, "doc_id", "left").select("doc_id", F.when(F.col("type") == open_type, F.coalesce("seen", "type")).otherwise(F.col("type")).alias("type"))


def recognise(pages: DataFrame, reader: Callable[[bytes], str], most: int = 40) -> DataFrame:
    """doc_id, page, text, error of ``pages`` (doc_id, page, content): what ``reader`` makes of each page's bytes.

    Pages beyond ``most`` are not read and say so, as a page that the reader fails on does.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, errors = [], []
            for page, content in zip(batch["page"], batch["content"]):
                text, error = None, "beyond_limit" if page > most else None
                if error is None:
                    try:
                        text = reader(bytes(content))
                    except Exception as e:  # the row carries it
                        error = f"{type(e).__name__}: {e}"
                texts.append(text)
                errors.append(error)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "page": batch["page"], "text": texts, "error": errors})

    kind = dict(pages.dtypes)
    return pages.select("doc_id", "page", "content").mapInPandas(run, f"doc_id {kind['doc_id']}, page {kind['page']}, text string, error string")


def label_groups(rows: DataFrame, key: str, extractor: Extractor, cache: DataFrame | None = None, otherwise: str = "other") -> DataFrame:
    """Every row with the label of its group: one call for each distinct key; failures get ``otherwise`` and fallback = true."""
    answers = extract(rows.select(F.col(key).alias("prompt")).distinct(), extractor, cache)
    labelled = answers.select("key", F.when(F.col("error").isNull(), F.get_json_object("payload", "$.label")).alias("label"))
    out = rows.withColumn("key", request_key(extractor, F.col(key))).join(labelled, "key", "left")
    return out.withColumns({"fallback": F.col("label").isNull(), "label": F.coalesce("label", F.lit(otherwise))}).drop("key")
