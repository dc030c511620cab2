"""Language identification by words first, backing off to ever shorter character n-grams.

A known word scores each language by its log frequency there. An unseen word is scored by the longest character n-grams
of it that were learned: five characters with word ends marked, then four, down to one. The model is fitted on a bounded
sample of labelled documents (``SAMPLE_DOCS``) and keeps every word, n-gram and language of it, so its size is bounded by
the sample alone; every document is predicted from its whole text.
"""

from __future__ import annotations

import pickle
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bounded_batches, slices

#: Bounds of the fit: labelled documents sampled by a hash of id and text, and bytes of their texts.
SAMPLE_DOCS, SAMPLE_BYTES = 6_000, 1 << 26
LONGEST_GRAM = 5
UNKNOWN = "und"
#: What stands between words: all but letters and the marks that combine with them.
_BETWEEN, _LETTER = r"[^\p{L}\p{M}]+", r"\p{L}"


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-cased words of some texts, and, for each word of each text, its place there and its text."""
    split = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), _BETWEEN, " "))
    coded, owners = split.flatten().dictionary_encode(), np.asarray(pc.list_parent_indices(split))
    distinct, index = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(coded.indices)
    some = np.array([bool(w) for w in distinct], bool)[index] if distinct else np.zeros(0, bool)
    return distinct, index[some], owners[some]


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word whose ends are marked by spaces (single characters without the marks)."""
    marked = word if n == 1 else f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Log frequencies per language, less the best: one row of ``scores`` for each entry of ``words`` and ``grams``."""

    languages: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None

    def _word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of distinct words, and whether the model knows anything of each."""
        rows = np.array([-1 if r is None else r for r in map(self.words.get, words)], np.int64)
        out, known = self.scores[rows], rows >= 0
        unseen, at, found = np.flatnonzero(~known).tolist(), [], []
        for k in unseen:
            for n in range(min(LONGEST_GRAM, len(words[k]) + 2), 0, -1):
                some = [g for g in map(self.grams.get, grams(words[k], n)) if g is not None]
                if some:
                    found += some
                    at += [k] * len(some)
                    break
        out[~known] = 0.0
        if at:
            at, found = np.array(at), np.array(found)
            each = np.bincount(at, minlength=len(words))
            for lang in range(len(self.languages)):
                out[:, lang] += np.bincount(at, self.scores[found, lang], len(words)) / np.maximum(each, 1)
            known |= each > 0
        return out, known

    def predict_all(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Best language of each text and its share of the evidence; (und, 0.0) without letters or without a learned language."""
        n = len(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        distinct, index, owners = words_of(texts)
        rows, known = self._word_scores(distinct)
        lettered = np.asarray(pc.fill_null(pc.match_substring_regex(texts, _LETTER), False)).astype(bool)
        scored = np.bincount(owners, known[index], n)
        total = np.stack([np.bincount(owners, rows[index, k], n) for k in range(len(self.languages))], axis=1)
        evidence = total / np.sqrt(np.maximum(scored, 1))[:, None]
        share = np.exp(evidence - evidence.max(axis=1, keepdims=True))
        best = evidence.argmax(axis=1)
        score = share[np.arange(n), best] / share.sum(axis=1)
        return [self.languages[b] if w else UNKNOWN for b, w in zip(best.tolist(), lettered.tolist())], np.where(lettered, score, 0.0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """predict_all() of one text."""
        found, score = self.predict_all(pa.array([text], pa.string()))
        return found[0], float(score[0])


def level(sizes: list[int], most: int) -> float:
    """How many of each stratum to take, so that strata of the given sizes give ``most`` together, small ones all they have."""
    left, strata = float(most), sorted(sizes)
    for i, n in enumerate(strata):
        if n * (len(strata) - i) >= left:
            return left / (len(strata) - i)
        left -= n
    return float(strata[-1]) if strata else 0.0


def sampled(frame: DataFrame, most: int, by: str | None = None, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """About ``most`` distinct rows of ``frame`` (doc_id, text and others), or all of them, of ``most_bytes`` of text.

    Repeats of a row are folded first, so a row that repeats without end is one row. The values of ``by`` share the
    sample: rare ones keep all their rows, frequent ones are cut to one size by a hash of id and text, and of each the rows
    that fit into its share of the bytes are kept, the shortest one in any case. More values than ``most`` are cut to the
    most frequent ones. Only ids, hashes and lengths of the rows chosen come to the driver; texts stay where they are.
    """
    spark, others = frame.sparkSession, [c for c in frame.columns if c not in ("doc_id", "text")]
    body, stratum = F.xxhash64("text"), F.col(by).cast("string") if by else F.lit("")
    keys = frame.select("doc_id", body.alias("body"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"), stratum.alias("stratum"), *others).distinct()
    sizes = {r["stratum"]: r["n"] for r in keys.groupBy("stratum").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "stratum").limit(most).collect()}
    if not sizes:
        return frame.limit(0)
    each = level(list(sizes.values()), most)
    shares = spark.createDataFrame([(k, int(min(1.0, each / n) * (1 << 30))) for k, n in sizes.items()], "stratum string, share long")
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id"), F.col("body")), F.lit(1 << 30))
    chosen = keys.join(F.broadcast(shares), "stratum").where(place < F.col("share")).select("stratum", place.alias("place"), "bytes", "doc_id", "body", *others)
    kept, strata = [], {}
    for r in chosen.collect():
        strata.setdefault(r["stratum"], []).append(r)
    for rows in strata.values():
        room, first = most_bytes // len(strata), min(rows, key=lambda r: (r["bytes"], r["place"]))
        for r in [first, *sorted((r for r in rows if r is not first), key=lambda r: (r["place"], r["bytes"]))]:
            if r is first or r["bytes"] <= room:
                kept.append(tuple(r)[3:])
                room -= r["bytes"]
    schema = chosen.select("doc_id", "body", *others).schema
    picked = spark.createDataFrame(kept, schema).toDF("_id", "body", *[f"_{c}" for c in others])
    same = frame["doc_id"].eqNullSafe(F.col("_id")) & (body == F.col("body"))
    for c in others:
        same &= frame[c].eqNullSafe(F.col(f"_{c}"))
    met = frame.join(F.broadcast(picked), same)
    return met.groupBy("doc_id", "body", *others).agg(F.first("text").alias("text")).drop("body")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, n, gram, count): n = 0 for words; n-grams weigh as their words' counts.

    A document counts a word as often as it takes to double up to its occurrences, so that one text which repeats a
    word endlessly does not stand for its language.
    """
    for part in slices(batches):
        distinct, index, owners = words_of(part.column("text"))
        places, times = np.unique(owners * len(distinct) + index, return_counts=True)
        langs, words = part.column("lang").to_pylist(), Counter()
        for place, c in zip(places.tolist(), times.tolist()):
            words[langs[place // len(distinct)], distinct[place % len(distinct)]] += c.bit_length()
        # One length of n-gram at a time, so that a slice's counts stay small.
        for n in range(LONGEST_GRAM + 1):
            found: Counter = Counter()
            for (lang, w), c in words.items():
                for g in grams(w, n) if n else (w,):
                    found[lang, g] += c
            if found:
                keys = list(found)
                columns = [pa.array([k[0] for k in keys], pa.string()), pa.array(np.full(len(keys), n, np.int32)), pa.array([k[1] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "gram", "count"])


def fit(labelled: DataFrame) -> Model:
    """A model from ``labelled`` (doc_id, text, lang); rows with a null text or language are left out. No rows: no languages.

    Languages share the sample, so a rare one is learned as well: as soon as one sampled text of it has a letter.
    Repeated rows are learned from once, however often they repeat.
    """
    bounded_batches(labelled.sparkSession)
    rows = sampled(labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang"), SAMPLE_DOCS, "lang")
    counts = rows.select("text", "lang").mapInArrow(_count, "lang string, n int, gram string, count long").groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))
    found = counts.toArrow().combine_chunks().sort_by([("n", "ascending"), ("gram", "ascending"), ("lang", "ascending")])
    model, parts, at = Model(sorted(found.column("lang").unique().to_pylist())), [], 0
    place = {lang: i for i, lang in enumerate(model.languages)}
    for n in range(LONGEST_GRAM + 1):
        mine = found.filter(pc.equal(found.column("n"), n))
        coded = mine.column("gram").combine_chunks().dictionary_encode()
        entries = coded.dictionary.to_pylist()
        seen = np.zeros((len(entries), len(place)))
        where = np.array([place[lang] for lang in mine.column("lang").to_pylist()], np.int64)
        seen[np.asarray(coded.indices), where] = np.asarray(mine.column("count"))
        size = seen.sum(axis=0) + len(entries) + 1
        parts.append(np.log((seen + 1) / size))
        (model.grams if n else model.words).update(zip(entries, range(at, at + len(entries))))
        at += len(entries)
    scores = np.concatenate(parts)
    model.scores = scores - scores.max(axis=1, keepdims=True) if len(place) else scores
    return model


_LOADED: dict[str, Model] = {}


def _loaded(name: str, shared) -> Model:
    """The model of a broadcast, read once by a worker."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = pickle.loads(shared.value)
    return _LOADED[name]


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred and score, from column text alone.

    A null text or one without a letter is ``und`` with score 0. Ties go to the first language by name; a text without
    one learned character, as in an unlearned script, gets that language with a score of 1 / languages. Repeated rows,
    null ids and further columns change nothing; very long texts are read whole.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    name, shared = uuid.uuid4().hex, spark.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(name, shared)
        for part in slices(batches):
            found, score = own.predict_all(part.column("text"))
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(found, pa.string()), pa.array(score, pa.float64())], names=[*keep, "lang_pred", "score"])

    kept = docs.select(*keep, *([] if "text" in keep else ["text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return kept.mapInArrow(run, f"{schema}, lang_pred string, score double")


def held_out(modulus: int, rest: int) -> Column:
    """The held-out fold: crc32 of the id as text, by its remainder. A null id belongs to no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the rows outside the held-out fold."""
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).withColumn("held_out", held_out(4, 2))
    return predict(frame, fit(frame.where(~F.col("held_out"))), "doc_id", "held_out")
