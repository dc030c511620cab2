"""Toxicity by compression distance between two zstandard dictionaries.

Both dictionaries end in the same part, which zstandard trains on windows of ordinary documents, so that a window of prose
finds the same help in either. The toxic one has passages of toxic text before it: those that cover the byte strings which
significantly more toxic documents hold, each string once, the strongest nearest to the text. (zstandard's own trainer
covers what is frequent, and toxic text is prose for the most part; README has the figures.) A text is compressed window by
window under both, and the differences of the lengths (largest, mean, how many reach each threshold, by number and share)
are calibrated to a probability by logistic regression.

The regression never sees a text whose own passages are in the dictionary: the learning fold is cut into FOLDS, and each is
measured with the dictionaries of the others. All fits use a bounded sample of labelled documents, and the regression
weighs each class by the inverse of its sampling rate; every document is scored over all windows of its whole text.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Scratch, bounded_batches, slices
from tallymark.llm.langid import held_out, sampled

#: Labelled documents of each class that are learned from, windows of them that train the common part, its size.
SAMPLE_DOCS, SAMPLE_WINDOWS, COMMON = 3_000, 20_000, 8_192
#: Bytes of a window, of a string that is counted, of a passage, of all passages; passages that one document offers.
WINDOW, STRING, PASSAGE, TOXIC, OFFERED = 32, 7, 16, 4_096, 20
#: Least documents that hold a string, least significance (log-likelihood ratio) and lift for it to be covered, and how many are.
HELD, SIGNIFICANT, LIFT, STRINGS = 5, 20.0, 2, 50_000
#: Bytes that the toxic dictionary saves, at which windows are counted.
THRESHOLDS = (1, 2, 3, 4, 6)
FEATURES = 4 + 2 * len(THRESHOLDS)
FOLDS = 3

_WORD = re.compile(r"[^\W\d_]+")


def plain(text: str | None) -> bytes:
    """The words of a text, lower-cased, with one space around each."""
    return f" {' '.join(_WORD.findall((text or '').lower()))} ".encode()


def windows(body: bytes) -> list[bytes]:
    return [body[i : i + WINDOW] for i in range(0, len(body), WINDOW)]


@lru_cache(maxsize=2 * FOLDS + 2)
def _compressor(dictionary: bytes):
    """Compression under a dictionary, without headers: fast parameters that look at all of a small dictionary."""
    parameters = zstandard.ZstdCompressionParameters.from_level(9, write_content_size=False, write_checksum=False, write_dict_id=False, min_match=4)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress


def features(text: str | None, toxic: bytes, ordinary: bytes) -> np.ndarray:
    """What the toxic dictionary saves over the windows of a text; zeros without words."""
    body = plain(text)
    if not body.strip():
        return np.zeros(FEATURES)
    by_toxic, by_ordinary = _compressor(toxic), _compressor(ordinary)
    saved = np.array([len(by_ordinary(w)) - len(by_toxic(w)) for w in windows(body)], float)
    over = np.array([(saved >= t).sum() for t in THRESHOLDS])
    return np.array([saved.max(), np.sort(saved)[-3:].mean(), saved.mean(), np.log1p(len(saved)), *np.log1p(over), *over / len(saved)])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(string, toxic, fold): every string of a document, once."""
    for part in slices(batches):
        for text, toxic, fold in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
            body = plain(text)
            found = list({body[i : i + STRING] for i in range(len(body) - STRING + 1)})
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(np.full(len(found), toxic, np.int32)), pa.array(np.full(len(found), fold, np.int32))], names=["string", "toxic", "fold"])


def _gains(counts: list, sizes: dict[tuple[int, int], int], without: int | None) -> dict[bytes, float]:
    """Significance of each string that toxic documents outside a fold hold more often; ``counts``: (string, toxic by fold, ordinary by fold)."""
    kept = [f for f in range(FOLDS) if f != without]
    n1, n0 = (max(1, sum(sizes.get((y, f), 0) for f in kept)) for y in (1, 0))
    a, b = (np.array([[r[k][f] for f in kept] for r in counts], float).reshape(len(counts), len(kept)).sum(axis=1) for k in (1, 2))
    part = lambda x, expected: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(expected, 1e-9)), 0.0)
    t, n = a + b, n0 + n1
    ratio = 2 * (part(a, t * n1 / n) + part(b, t * n0 / n) + part(n1 - a, (n - t) * n1 / n) + part(n0 - b, (n - t) * n0 / n))
    good = (a >= HELD) & (a / n1 > LIFT * (b + 0.5) / n0) & (ratio >= SIGNIFICANT)
    return {counts[i][0]: float(ratio[i]) for i in np.flatnonzero(good)}


def _offers(gains: dict[bytes, float]):
    """An Arrow function: the passages of each text that hold most of ``gains``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            best: dict[bytes, float] = {}
            for text in part.column("text").to_pylist():
                body = plain(text)
                each = np.array([gains.get(body[i : i + STRING], 0.0) for i in range(len(body) - STRING + 1)])
                if each.any():
                    total = np.concatenate(([0.0], np.cumsum(each)))
                    width = min(PASSAGE - STRING + 1, len(each))
                    held = total[width:] - total[:-width]
                    for i in np.argsort(-held, kind="stable")[:OFFERED].tolist():
                        if held[i] > 0:
                            best[body[i : i + PASSAGE]] = float(held[i])
            yield pa.RecordBatch.from_arrays([pa.array(best.keys(), pa.binary()), pa.array(best.values(), pa.float64())], names=["passage", "gain"])

    return run


def _covering(offers: list[tuple[bytes, float]], gains: dict[bytes, float]) -> bytes:
    """Passages that cover most gain in TOXIC bytes, each string counted once, the best ones last (nearest to the text)."""
    strings = lambda p: {p[i : i + STRING] for i in range(len(p) - STRING + 1)}
    heap, covered, taken, used = [(-g, p) for p, g in offers], set(), [], 0
    heapq.heapify(heap)
    while heap and used < TOXIC:
        _, passage = heapq.heappop(heap)
        left = sum(gains.get(s, 0.0) for s in strings(passage) - covered)
        if left <= 0:
            continue
        if heap and -heap[0][0] > left + 1e-9:
            heapq.heappush(heap, (-left, passage))
            continue
        taken.append(passage)
        covered |= strings(passage)
        used += len(passage)
    return b"".join(reversed(taken))


def _all_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        yield pa.RecordBatch.from_arrays([pa.array([w for t in part.column("text").to_pylist() for w in windows(plain(t))], pa.binary())], names=["w"])


def _common(learn: DataFrame) -> bytes:
    """The part that both dictionaries share, trained on windows of ordinary documents; with too little text, some of that text."""
    rows = learn.where("toxic = 0").select("text").mapInArrow(_all_windows, "w binary").where(F.length("w") > 4)
    samples = [bytes(r["w"]) for r in rows.orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WINDOWS).collect()]
    try:
        return zstandard.train_dictionary(COMMON, samples, k=PASSAGE, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-COMMON:] or b" ordinary "


def train_dictionaries(learn: DataFrame) -> list[tuple[bytes, bytes]]:
    """(toxic, ordinary) dictionaries of ``learn`` (text, toxic, fold): without each fold, and last of all folds.

    To the driver come the strings that some leaving-out may call significant, STRINGS of them at most, the strongest
    first, and OFFERED passages of each sampled toxic document.
    """
    sizes = {(r["toxic"], r["fold"]): r["n"] for r in learn.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect()}
    common = _common(learn)
    held = lambda y: F.array(*[F.count_if((F.col("toxic") == y) & (F.col("fold") == f)) for f in range(FOLDS)])
    sums = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y)
    counts = learn.mapInArrow(_strings, "string binary, toxic int, fold int").groupBy("string").agg(held(1).alias("a"), held(0).alias("b")).where(sums("a") >= HELD)
    n1, n0 = (max(1, sum(n for (y, _), n in sizes.items() if y == k)) for k in (1, 0))
    often = counts.where(sums("a") * n0 > sums("b") * n1).orderBy(F.desc(sums("a") / n1 - sums("b") / n0), "string").limit(STRINGS).collect()
    often, out = [(bytes(r["string"]), r["a"], r["b"]) for r in often], []
    for without in (*range(FOLDS), None):
        gains = _gains(often, sizes, without)
        toxic = learn.where("toxic = 1") if without is None else learn.where((F.col("toxic") == 1) & (F.col("fold") != without))
        offers = toxic.select("text").mapInArrow(_offers(gains), "passage binary, gain double").groupBy("passage").agg(F.max("gain").alias("gain")).collect() if gains else []
        out.append((_covering(sorted((bytes(r["passage"]), r["gain"]) for r in offers), gains) + common, common))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, each: np.ndarray | None = None) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression by Newton's method; a lone class gives its base rate.

    ``each``: how many rows a row stands for.
    """
    x = np.column_stack([x, np.ones(len(x))])
    each = np.ones(len(x)) if each is None else each
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (each * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic) are learned from outside the held-out fold only; an id with both labels counts as toxic.
    Null and wordless texts get the score of a text that saves nothing. Without labels every score is the base rate 0.5.
    A null id is never held out; repeated rows are scored alike and learned from once; very long texts are scored over
    all their windows; a score of exactly 0.5 predicts 1; columns of other names are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", held_out(5, 0))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(5, 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    found = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    # A row of a class that is cut stands for more rows, so that the fit sees the classes as frequent as they are.
    stands_for = {c: max(1.0, found.get(c, 0) / SAMPLE_DOCS) for c in (0, 1)}
    share = F.when(F.col("toxic") == 1, F.lit(1 / stands_for[1])).otherwise(F.lit(1 / stands_for[0]))
    known = known.where(F.pmod(F.xxhash64(F.lit("label"), "doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    # At most about twice SAMPLE_DOCS ids: a bounded table. An id may stand on any number of rows, so these are bounded too.
    scratch = Scratch(spark, "toxicity")
    met = scratch.save(frame.where(~F.col("held_out")).join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic"))
    each = sampled(met.where("toxic = 1"), SAMPLE_DOCS).union(sampled(met.where("toxic = 0"), SAMPLE_DOCS))
    learn = scratch.save(each.select("text", "toxic", F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(FOLDS)).cast("int").alias("fold")))
    pairs = train_dictionaries(learn)
    toxic, ordinary = pairs[-1]
    schema = "f array<double>"

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            f = [features(t, *pairs[k]).tolist() for t, k in zip(part.column("text").to_pylist(), part.column("fold").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(f, pa.list_(pa.float64()))], names=["toxic", "f"])

    rows = learn.select("toxic", "text", "fold").mapInArrow(measured, f"toxic int, {schema}").collect()
    y = np.array([r["toxic"] for r in rows], float)
    x = np.array([r["f"] for r in rows], float).reshape(len(rows), FEATURES)
    # A feature that is the same for all says nothing and keeps its size.
    scale = np.where(x.std(axis=0) > 1e-6, x.std(axis=0), 1.0) if len(rows) else 1.0
    # A row stands for the distinct rows of its class that were met, and these for the ids that were left out before.
    met_rows = {r["toxic"]: r["n"] for r in met.select("toxic", "doc_id", F.xxhash64("text").alias("body")).distinct().groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {c: stands_for[c] * met_rows.get(c, 0) / max(1, int((y == c).sum())) for c in (0, 1)}
    each = np.where(y == 1, share[1], share[0])
    weights = fit_logistic(x / scale, y, each=each / each.mean()) if len(rows) else np.zeros(FEATURES + 1)
    weights = np.append(weights[:-1] / scale, weights[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            f = np.array([features(t, toxic, ordinary) for t in part.column("text").to_pylist()]).reshape(part.num_rows, FEATURES)
            score = 1 / (1 + np.exp(-np.clip(f @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return frame.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
