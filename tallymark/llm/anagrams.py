"""Spelling variants by anagram hashing.

A word's key is the sum of the fifth powers of its letters, so anagrams share a key, and adding, removing or exchanging a
letter moves it by one letter's value or by the difference of two. Every key is probed less the value of each of its
letters, and as it stands: keys that meet at a probe differ by one addition, removal or exchange. A probe is met by one
key for each letter of the alphabet at most, however many words share a key.

Letter order is verified on the words of the keys that met, again by equality: a word less a letter that its key met
with leaves a rest, and two words are near if they leave one rest and the letters stood at one place, or if one word is
the rest of the other. Only such pairs, which are links, are ever put together.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import SLICE_BYTES, Scratch, bounded_batches, slices, texts

#: Letters after A-Z have been lower-cased.
LETTERS = "a-z\u00C0-\u00FF"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A word's form occurs at least so many times as often.
OFTENER = 10
#: One run of a document in so many loses a letter.
SPOILT = 31
POWER = 5


def counted_words(docs: DataFrame, spoilt: int = SPOILT) -> DataFrame:
    """(word, n): runs of letters of whole texts, of LEAST_LENGTH letters and LEAST_COUNT occurrences at least.

    A run loses the letter at h % length if ``spoilt`` divides h, the CRC-32 of doc_id (null: nothing), a colon and the run.
    Null and empty texts hold no runs. Repeated rows count again. A very long text is read whole, run by run.
    """
    bounded_batches(docs.sparkSession)
    found = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}").finditer

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            total: Counter[str] = Counter()
            lowered = pc.ascii_lower(pc.fill_null(part.column("text"), ""))
            for doc, text in zip(part.column("doc_id").to_pylist(), lowered.to_pylist()):
                head = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in Counter(map(re.Match.group, found(text))).items():
                    h = zlib.crc32(run.encode(), head)
                    if not h % spoilt:
                        k = h % len(run)
                        run = run[:k] + run[k + 1 :]
                    if len(run) >= LEAST_LENGTH:
                        total[run] += n
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    return texts(docs).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after another, and where each word begins."""
    sizes = np.asarray(pc.utf8_length(words), np.int64)
    return np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32), np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.intp)


def keys_of(words: pa.Array) -> np.ndarray:
    """Anagram key of each (non-empty) word: the sum of its letters' powers in 64 bits."""
    flat, starts = _letters(words)
    return np.add.reduceat(flat.astype(np.uint64) ** np.uint64(POWER), starts).view(np.int64) if len(words) else np.zeros(0, np.int64)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "word"):
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys_of(part.column("word")))], names=["word", "n", "key"])


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(probe, letter, key): each word's key as it stands (letter 0), and less each of its letters."""
    for part in slices(batches, "word"):
        if part.num_rows:
            flat, starts = _letters(part.column("word"))
            keys = np.asarray(part.column("key")).view(np.uint64)
            owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(flat))))
            each = np.unique(owner.astype(np.uint64) << np.uint64(21) | flat)
            owner, letter = (each >> np.uint64(21)).astype(np.intp), each & np.uint64((1 << 21) - 1)
            probe = np.concatenate((keys, keys[owner] - letter ** np.uint64(POWER)))
            letter = np.concatenate((np.zeros(len(keys), np.int32), letter.astype(np.int32)))
            out = [probe.view(np.int64), letter, np.concatenate((keys, keys[owner])).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["probe", "letter", "key"])


RESTS = "rest string, start int, stop int, letter string, n long"


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each word leaves without one letter of those that its key met with, and the word itself if its key was met.

    Any letter of a run of equal ones leaves the same rest, so a row stands for all places from start to stop.
    """
    out, held = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64()))], names=["rest", "start", "stop", "letter", "n"])

    for part in batches:
        for word, n, met in zip(*(part.column(c).to_pylist() for c in ("word", "n", "letters"))):
            met = set(map(chr, met))
            if "\0" in met:
                out.append((word, 0, len(word), "", n))
            start = 0
            while start < len(word):
                letter, stop = word[start], start
                while word[stop + 1 : stop + 2] == letter:
                    stop += 1
                if letter in met:
                    out.append((word[:start] + word[start + 1 :], start, stop, letter, n))
                    held += len(word) + 32
                start = stop + 1
                if held >= SLICE_BYTES:
                    yield batch()
                    out, held = [], 0
    if out:
        yield batch()


def links(words: DataFrame) -> DataFrame:
    """(word, near, near_n): both directions of every pair of ``words`` (word, n, key) one letter apart."""
    # A probe is met once by a letter; a key has a probe for each of its letters: both sets are as small as the alphabet.
    met = words.mapInArrow(_probes, "probe long, letter int, key long").groupBy("probe").agg(F.collect_set(F.struct("letter", "key")).alias("met"))
    met = met.where(F.size("met") > 1).select(F.explode("met").alias("m")).groupBy("m.key").agg(F.collect_set("m.letter").alias("letters"))
    rests = words.join(met, "key").select("word", "n", "letters").mapInArrow(_rests, RESTS)
    a, b = (rests.select("rest", *[F.col(c).alias(f"{s}_{c}") for c in ("start", "stop", "letter", "n")]) for s in "ab")
    apart = (F.col("a_letter") < F.col("b_letter")) & (F.col("a_start") <= F.col("b_stop")) & (F.col("b_start") <= F.col("a_stop"))
    whole = lambda s: F.concat(F.substring("rest", F.lit(1), F.col(f"{s}_start")), F.col(f"{s}_letter"), F.expr(f"substring(rest, {s}_start + 1)"))
    end = lambda s, t: F.struct(whole(s).alias("word"), whole(t).alias("near"), F.col(f"{t}_n").alias("near_n"))
    return a.join(b, "rest").where(apart).select(F.explode(F.array(end("a", "b"), end("b", "a"))).alias("l")).select("l.*")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root, moved) for ``forms`` (word, form), which have no circle: each round doubles the steps taken."""
    current = scratch.save(forms.select("word", F.col("form").alias("root")))
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        doubled = current.select("word", "root").join(further, "root", "left")
        following = scratch.save(doubled.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        scratch.drop(current)
        current = following
        if following.where("moved").isEmpty():
            return following


def variants(words: DataFrame, oftener: int = OFTENER) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n): distinct words with their counts.

    Words are near if one inserted, removed or replaced code point apart; a word's form is its near word of largest n
    (ties: the smallest in code-point order) if that occurs ``oftener`` times as often at least, and its root the last
    of its forms. Null and empty words are left out; no rows give no rows. A word of many letters costs a row of its
    length for each run of equal letters that another key met with.
    """
    scratch = Scratch(words.sparkSession, "anagrams")
    usable = words.select("word", F.col("n").cast("long").alias("n")).where("word <> ''")
    keyed = scratch.save(usable.mapInArrow(_keyed, "word string, n long, key long"))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = links(keyed).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = (-F.col("best.n")) >= oftener * F.col("n")
    named = keyed.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best.word")).alias("form"), F.when(formed, -F.col("best.n")).alias("form_n")
    )
    named = scratch.save(named)
    last = roots(named.where("form IS NOT NULL").select("word", "form"), scratch)
    scratch.keep(named, last)
    return named.join(last.drop("moved"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
