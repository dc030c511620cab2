"""Mixing to target weights, against brute force and over odd rows."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallymark.llm import mixing

DOCS = "doc_id long, text string, source string, size long, rank long, target string, lot int, u double, weight int, of string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, "x", 3, 0.5, 4, "y") for i, t, s in rows], DOCS)


def brute_targets(sizes, weights, most=3):
    """Stop sources at their limit, share the excess again by weight, until none is above."""
    total, stopped = Fraction(sum(sizes.values())), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in stopped}
        left = total - sum(stopped.values())
        shares = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = {s: Fraction(most * sizes[s]) for s, x in shares.items() if x > most * sizes[s]}
        if not over:
            return {s: float(x) for s, x in (shares | stopped).items()}
        stopped |= over


def check(rows, got, most=3):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    want = brute_targets(sizes, weights, most)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate + 1e-9) <= r.copies <= min(most, int(rate) + 1)
    for s, mine in by.items():
        assert abs(sum(r.size * r.copies for r in mine) - want[s]) <= max(r.size for r in mine)


WEIGH = lambda rank: F.pmod(rank, F.lit(3)) + 1


def test_mix_equals_brute_force_where_small_sources_stop(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), "abcde"[min(4, i % 19)]) for i in range(600)] + [(1000 + i, "v " * 5, None) for i in range(40)]
    rows += [(2000, "one", "Z"), (2001, "two words", "é"), (2002, "", "empty"), (2003, None, "empty")]
    got = mixing.mix(frame(spark, rows), WEIGH).collect()
    check(rows, got)
    assert {r.source for r in got if r.copies == 3} >= {"Z"} and all(r.copies == 0 for r in got if r.source == "empty")
    assert sorted(map(repr, mixing.mix(frame(spark, rows).repartition(7), WEIGH).collect())) == sorted(map(repr, got))


def test_long_documents_do_not_upset_a_source(spark):
    rows = [(i, "w " * (20_000 if i < 6 else 1 + i % 50), "ab"[i % 2]) for i in range(800)]
    check(rows, mixing.mix(frame(spark, rows), WEIGH).collect())


def test_odd_rows(spark):
    rows = [(None, "a b", "s"), (1, None, None), (2, "x " * 200_000, "s"), (2, "x " * 200_000, "s"), (3, "", "t"), (4, "\t\n\x0b\x0c\r ", "t"), (5, "a\u00a0b \u2003c", "t")]
    got = mixing.mix(frame(spark, rows), WEIGH).collect()
    check(rows, got)
    assert {r.doc_id: r.size for r in got} == {None: 2, 1: 0, 2: 200_000, 3: 0, 4: 0, 5: 2}
    assert mixing.report(frame(spark, rows).where("false")).collect() == []
    assert [(r.target, r.taken) for r in mixing.report(frame(spark, [(1, None, "a"), (2, "", "b")])).collect()] == [(0.0, 0)] * 2


def test_emitted_rows_follow_the_copies(spark):
    rows = [(i, "w " * (1 + i % 9), "abc"[i % 3]) for i in range(90)]
    docs = frame(spark, rows)
    mixed = mixing.mix(docs, WEIGH)
    out = mixing.emit(docs, mixed)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({r.doc_id: r.copies for r in mixed.collect() if r.copies})


def test_draws_change_with_the_seed_only(spark):
    """Each seed draws other documents, as many as the fraction says."""
    rows = [(i, "w " * 5, "ab"[i % 4 > 0]) for i in range(400)]
    sets = []
    for seed in ("x", "y", "x"):
        got = mixing.mix(frame(spark, rows), WEIGH, seed=seed).collect()
        check(rows, got)
        sets.append({r.doc_id for r in got if r.source == "b" and r.copies > int(r.target / r.source_size)})
    assert sets[0] == sets[2] != sets[1] and 0 < len(sets[0] & sets[1]) < len(sets[0])
