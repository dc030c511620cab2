"""Spelling variants by anagram hashing, against brute force and over odd rows."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from tallymark.llm import anagrams

DOCS = "doc_id long, text string, word string, n long, key long, rest string, letter string, letters string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", "z", "q") for i, t in rows], DOCS)


def brute_words(rows, spoilt=31):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % spoilt == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def apart(a, b):
    """Whether two words differ by exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = {a: [b for b in words if apart(a, b)] for a in words}
    form = {}
    for a in words:
        best = min(near[a], key=lambda b: (-words[b], b), default=None)
        form[a] = best if best and words[best] >= 10 * words[a] else None
    out = {}
    for a in words:
        root = a
        while form[root]:
            root = form[root]
        out[a] = (form[a], root, words[a], len(near[a]), words[form[a]] if form[a] else None)
    return out


def found(frame):
    rows = frame.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_variants_equal_brute_force(spark):
    """A small alphabet makes many anagrams, runs of equal letters and chains of forms."""
    r = random.Random(11)
    words = {}
    for _ in range(700):
        words["".join(r.choice("abé") for _ in range(r.randrange(1, 9)))] = 2 * 10 ** r.randrange(5) + r.randrange(3)
    want = brute_variants(words)
    got = found(anagrams.variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)))
    assert got == want
    assert any(f and root != f for f, root, *_ in want.values())


def test_counts_and_variants_of_texts_equal_brute_force(spark):
    r = random.Random(12)
    pool = ["".join(r.choice("aeionrst\u00e9\u00df") for _ in range(r.randrange(5, 12))) for _ in range(80)]
    rows = [(i, r.choice(" ,-7").join(r.choice(pool[: 1 + i % 80]).title() for _ in range(120))) for i in range(250)]
    words = brute_words(rows)
    assert {x.word: x.n for x in anagrams.counted_words(frame(spark, rows)).collect()} == words
    assert found(anagrams.variants(anagrams.counted_words(frame(spark, rows)))) == brute_variants(words)
    assert sum(1 for w in words if w not in {p.lower() for p in pool}) > 10, "no run lost a letter"


def test_odd_rows(spark):
    rows = [(None, "Letters letters \u00c0BCDEFG"), (1, None), (2, ""), (3, "12345 !!"), (4, "letterz letterz"), (4, "letterz letterz"), (5, "\u00e0bcdefg \u00c0bcdefg"), (6, "x\u0301yzzyxx \U0001f600"), (7, ("ab" * 40_000 + " ") * 2), (8, "a" * 50_000 + " " + "a" * 50_001), (9, "a" * 50_000 + " " + "a" * 50_001)]
    got = found(anagrams.variants(anagrams.counted_words(frame(spark, rows))))
    assert got == brute_variants(brute_words(rows))
    assert anagrams.variants(anagrams.counted_words(frame(spark, rows).where(F.lit(False)))).count() == 0


def test_one_anagram_class_holds_all_words(spark):
    """Words that all share a key are never compared with each other; links to the next keys are all found."""
    r = random.Random(13)
    words = {}
    while len(words) < 400:
        w = r.sample("abcdefgh", 8)
        words["".join(w)] = r.randrange(2, 9)
        if len(words) % 5 == 0:
            words["".join(w[:3] + w[4:])] = 100
            words["".join(w[:3] + ["z"] + w[4:])] = 30
    assert found(anagrams.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute_variants(words)


def test_keys_are_sums_of_powers():
    words = ["abc", "cab", "\u00ff", "\U0001f600a"]
    want = [sum(ord(c) ** 5 for c in w) & (1 << 64) - 1 for w in words]
    assert [int(k) & (1 << 64) - 1 for k in anagrams.keys_of(pa.array(words))] == want
