"""Checks of trees as rows against the checks of one tree."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark.operators import trees as T
from tallymark.plans import metric as M
from tallymark.tables import Store

NODES = "tree int, id string, op string, args array<string>, category string, key string, value double"
CATEGORIES = ("opex", "capex")


def found(spark, trees):
    rows = [(t, n["id"], n.get("op"), n.get("args"), n.get("category"), n.get("key"), n.get("value")) for t, (nodes, _) in trees.items() for n in nodes]
    roots = spark.createDataFrame([(t, r) for t, (_, r) in trees.items()], "tree int, root string")
    return Counter((r.tree, r.code) for r in T.tree_violations(spark.createDataFrame(rows, NODES), roots, CATEGORIES).collect())


def expected(trees):
    out = Counter()
    for t, (nodes, root) in trees.items():
        try:
            tree = M.nest([{k: v for k, v in n.items() if v is not None} for n in nodes], root)
        except M.MetricError as e:
            out[t, {"re": "repeated_node", "mi": "missing_node", "cy": "cycle", "to": "too_deep"}[str(e)[:2]]] += 1
            continue
        # A node is blamed once, however often its tree holds it.
        by, seen, waiting = {n["id"]: n for n in nodes}, {root}, [root]
        while waiting:
            for a in by[waiting.pop()].get("args") or []:
                if a not in seen:
                    seen.add(a), waiting.append(a)
        assert tree
        for i in seen:
            for code in M.problems({k: ([{"op": "CONST", "value": 1}] * len(v) if k == "args" else v) for k, v in by[i].items() if v is not None}, CATEGORIES):
                out[t, code] += 1
    return out


def random_nodes(r):
    n = r.randrange(1, 9)
    ids, nodes = [f"n{i}" for i in range(n)], []
    for i in ids:
        op = r.choice(["AGG", "AGG", "CONST", "DISCLOSED", "ADD", "DIV", "MAX", "ABS", "POW"])
        pool = [j for j in ids if j > i] if r.random() < 0.9 else [*ids, "ghost"]
        args = [r.choice(pool) for _ in range(r.randrange(1, 3))] if pool and op not in ("AGG", "CONST", "DISCLOSED") else None
        leaf = {"category": r.choice(["opex", "gifts"])} if op == "AGG" else {"key": r.choice(["k", "", None])} if op == "DISCLOSED" else {"value": r.choice([1.0, None])} if op == "CONST" else {}
        nodes.append({"id": i, "op": op, "args": args} | leaf)
    if r.random() < 0.1:
        nodes.append(dict(nodes[0]))
    return nodes, ids[0] if r.random() < 0.95 else "nowhere"


def test_random_trees_equal_the_checks_of_one(spark):
    r = random.Random(3)
    trees = {t: random_nodes(r) for t in range(250)}
    want = expected(trees)
    assert {c for _, c in want} >= {"repeated_node", "missing_node", "cycle", "unknown_op", "arity", "unknown_category", "no_key", "no_number"}
    assert found(spark, trees) == want


def chain(n, end):
    return [{"id": f"c{i}", "op": "ABS", "args": [f"c{i + 1}"]} for i in range(n)] + [end | {"id": f"c{n}"}]


def test_deep_and_endless_trees(spark):
    leaf = {"op": "AGG", "category": "opex"}
    trees = {
        0: (chain(11, leaf), "c0"),
        1: (chain(12, leaf), "c0"),
        2: (chain(3000, leaf), "c0"),
        3: (chain(3000, {"op": "ABS", "args": ["c1500"]}), "c0"),
        4: (chain(40, {"op": "ABS", "args": ["gone"]}), "c0"),
        # One way on is deep, the other a circle.
        5: ([{"id": "r", "op": "ADD", "args": ["c0", "x"]}, {"id": "x", "op": "ADD", "args": ["c0", "r"]}, *chain(60, leaf)], "r"),
        # A circle that the root does not reach is no fault of the tree, nor is a missing node there.
        6: ([{"id": "r", **leaf}, {"id": "x", "op": "ABS", "args": ["x"]}, {"id": "y", "op": "ABS", "args": ["gone"]}], "r"),
        7: ([], "r"),
        8: (chain(2, leaf), None),
    }
    got = found(spark, {t: v for t, v in trees.items()})
    assert got == {(1, "too_deep"): 1, (2, "too_deep"): 1, (3, "cycle"): 1, (4, "missing_node"): 1, (5, "cycle"): 1, (7, "missing_node"): 1, (8, "missing_node"): 1}


def test_endless_walks_take_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(T, "_shortened", lambda w, f=T._shortened: (rounds.append(1), f(w))[1])
    waits = spark.range(5000).select(F.lit(1).alias("tree"), F.col("id").cast("string").alias("id"), (F.col("id") + 1).cast("string").alias("arg"))
    assert T.endless(waits, Store(spark, "t")).count() == 0
    assert len(rounds) < 20


@pytest.mark.parametrize("empty", ["nodes", "both"])
def test_no_rows(spark, empty):
    nodes = spark.createDataFrame([], NODES)
    roots = spark.createDataFrame([(1, "r")] if empty == "nodes" else [], "tree int, root string")
    assert [(r.tree, r.code) for r in T.tree_violations(nodes, roots, CATEGORIES).collect()] == ([(1, "missing_node")] if empty == "nodes" else [])


def test_fields_of_covenants(spark):
    rows = [
        (1, "o", "6.1", "2.5", "ratio", "2024-01-01", "2024-12-31", False, None), (2, "o", "6.1", "-1", "ratio", None, None, True, None), (3, "o", "6.2", "5000", "ratio", "2024-13-01", None, True, "t"),
        (4, "p", "6.1", "many", "money", "2024-05-01", "2024-05-01", None, None), (5, "p", "6.2", None, None, "1/2/24", None, None, None), (6, "p", "6.3", " 7 ", "money", None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, "tree int, owner string, point string, threshold string, unit string, start string, end string, conditional boolean, condition string")
    got = {(r.tree, r.code) for r in T.covenant_violations(frame, 1000).collect()}
    assert got == {(1, "repeated_point"), (2, "threshold_not_positive"), (2, "no_condition"), (3, "ratio_too_large"), (3, "bad_period"), (4, "threshold_no_number"), (4, "period_reversed"), (5, "threshold_no_number"), (5, "bad_period")}


def test_small_trees_settle_in_one_shuffle(spark, monkeypatch):
    monkeypatch.setattr(T, "endless", None)
    trees = {0: (chain(11, {"op": "CONST"}), "c0"), 1: ([{"id": "r", "op": "ABS", "args": ["r"]}], "r"), 2: (chain(30, {"op": "ABS", "args": [None]}), "c0"), 3: ([{"id": "r", "op": "CONST"}] * 2, "r")}
    assert found(spark, trees) == {(0, "no_number"): 1, (1, "cycle"): 1, (2, "missing_node"): 1, (3, "repeated_node"): 1}
    rows = spark.range(10).selectExpr("id AS tree", "'r' AS id", "'CONST' AS op", "array('x') AS args", "'' AS category", "'' AS key", "1.0 AS value")
    plan = T.tree_violations(rows, rows.select("tree", F.col("id").alias("root")), CATEGORIES)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan


def test_trees_as_rows_equal_trees_within_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "WHOLE", 4)
    r = random.Random(8)
    trees = {t: random_nodes(r) for t in range(60)}
    assert found(spark, trees) == expected(trees)


def test_many_nodes_are_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(T, "WHOLE", 0)
    monkeypatch.setattr(T, "MANY", 0)
    rows = spark.createDataFrame([(1, "r", "ABS", ["x"], None, None, None), (1, "x", "CONST", None, None, None, None)], NODES)
    frame = T.tree_violations(rows, spark.createDataFrame([(1, "r")], "tree int, root string"), CATEGORIES)
    assert "strategy=merge" in frame._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(v) for v in frame.collect()] == [(1, "x", "no_number")]
