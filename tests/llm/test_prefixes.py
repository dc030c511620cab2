"""The conversation prefix trie against brute force, over few and many tasks, and over odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallymark.llm import prefixes

ROWS = "conv_id long, turn long, role string, text string, key string, depth int, node int, part string, turns int, base long, head int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, "p", 3, 4, 5) for r in rows], ROWS)


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    trunc = lambda c: c - (c % 100 if c >= 0 else -(-c % 100))
    return {c: own.get(trunc(c), [])[: h(c)] + t[h(c) :] for c, t in own.items()}


def brute_trie(convs):
    """(conv_id, depth) -> parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"""
    members = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = {}

    def walk(p):
        below = [walk(q) for q in children[p]]
        leaves = sum(x[0] for x in below) or 1
        saved = sum(x[1] for x in below) + (len(members[p]) - 1) * len(p[-1][1] if p else "")
        ends = ",".join(map(str, sorted(c for c in members[p] if len(convs[c]) == len(p))))
        out[min(members[p]), len(p)] = (min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
        return leaves, saved

    if convs:
        walk(())
    assert len(out) == len(members)
    return out


def found(nodes):
    rows = nodes.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture
def many_tasks(spark):
    """Ranges stay as many as they are dealt."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def random_turns(seed, convs, turns=3, most=7):
    r = random.Random(seed)
    return [(c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", None]), r.choice(["", "é\U0001f600", "x" * 40, None][:turns])) for c in range(-120, convs) for t in range(r.randrange(most))]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force_over_many_tasks(spark, many_tasks, monkeypatch, seed):
    monkeypatch.setattr(prefixes, "IDS", 3)
    rows = random_turns(seed, 260)
    assert found(prefixes.report(frame(spark, rows).repartition(5))) == brute_trie(brute_rebuilt(rows))


def sequences(spark, convs):
    """Conversations whose turns are taken as they stand."""
    rows = [(c, [(digest("r", x), len(x)) for x in t]) for c, t in convs.items()]
    frame_ = spark.createDataFrame(rows, "conv_id long, turns array<struct<digest:string,size:long>>")
    return found(prefixes.trie(frame_)), brute_trie({c: [("r", x) for x in t] for c, t in convs.items()})


@pytest.mark.parametrize("ids", [2, 1 << 16])
def test_equal_conversations_and_long_paths_cross_tasks(spark, many_tasks, monkeypatch, ids):
    """Most rows are one conversation or go on from it, so that its nodes lie open in most tasks."""
    monkeypatch.setattr(prefixes, "IDS", ids)
    base = [f"t{i}" for i in range(30)]
    convs = {c: base for c in range(0, 400)} | {c: base + ["z"] * (c % 4) for c in range(400, 500)} | {c: base[: c % 31] for c in range(500, 560)} | {c: [] for c in range(560, 580)}
    got, want = sequences(spark, convs)
    assert got == want


@pytest.mark.parametrize("convs", [{}, {5: []}, {5: [], 4: []}, {7: ["a"]}, {7: ["a"], 9: ["a"]}, {3: ["b", "a" * 70_000], 2: ["b"]}, {i: ["x"] * 300 for i in range(3)} | {9: ["x"] * 600}])
def test_small_tries(spark, many_tasks, convs):
    got, want = sequences(spark, convs)
    assert got == want


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (3, None, None, None), (3, 1, "user", "a"), (3, 1, "user", "a"), (3, 0, "", ""), (104, 5, "user", "x" * 300_000), (104, 5, "assistant", "x"), (0, 1, "user", "a"), (0, 0, "system", "s"), (205, 0, "user", "only")]
    assert found(prefixes.report(frame(spark, rows))) == brute_trie(brute_rebuilt(rows))
    assert prefixes.report(frame(spark, rows).where("false")).collect() == []


def test_shared_turns():
    a, b = bytes(range(64)), bytes(range(40)) + bytes(24)
    assert (prefixes.shared(a, a), prefixes.shared(a, a[:32]), prefixes.shared(a, b), prefixes.shared(b"", a)) == (4, 2, 2, 0)
