"""Requests and covenants as data, against the compiler of one plan for all."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators import covenant_tables as CT
from tallymark.operators import covenants as C
from tallymark.operators import requests as Q
from tallymark.plans.metric import ARRAY_FOLDS, OPERATORS, Request, postfix, register

DAY = datetime.date(2024, 2, 20)
CATEGORIES = ("revenue", "opex", "capex", "lease")


@pytest.fixture(scope="module")
def ledger(spark):
    r = random.Random(5)
    rows = []
    for i in range(900):
        day = None if i % 40 == 0 else DAY + datetime.timedelta(r.randrange(400))
        category = r.choice([*CATEGORIES, None, "any"])
        rows.append((f"T{i}", r.choice("ABC"), r.choice(["borrower", "group", None]), category, r.choice([None, "related", "other"]), day, r.randrange(-10_000, 10_000) / 100, r.random() < 0.1))
    frame = spark.createDataFrame(rows, "txn_id string, scenario_id string, scope string, category string, party string, date date, amount double, excluded boolean")
    return frame.withColumn("amount", F.col("amount").cast("decimal(18,4)")).cache()


def asked(spark, requests, scenarios="ABC"):
    rows = [(s, q.category, q.scope, q.party, q.start, q.end) for s in scenarios for q in requests]
    frame = spark.createDataFrame(rows, "scenario_id string, category string, scope string, party string, start string, end string")
    return frame.withColumns({c: F.col(c).cast("date") for c in ("start", "end")})


def test_requests_equal_the_one_pass_sums(spark, ledger):
    r = random.Random(6)
    day = lambda: None if r.random() < 0.25 else str(DAY + datetime.timedelta(r.randrange(-30, 430)))
    requests = list({Request(r.choice([*CATEGORIES, "any", "nothing"]), r.choice(["borrower", "group"]), r.choice([None, "related", "nobody"]), day(), day()) for _ in range(150)})
    want = {(x.scenario_id, k): (x.sums[k], x.counts[k]) for x in C.answer(ledger, requests, exact=True).collect() for k in x.sums}
    found = Q.answer_table(ledger, asked(spark, requests).union(asked(spark, requests[:9], "AZ")))
    got = {(x.scenario_id, x.k): (x.total, x.n_rows) for x in found.withColumn("k", Q.request_key(*(F.col(c) for c in Q.KEY[1:]))).collect()}
    assert {k: v for k, v in got.items() if k[0] != "Z"} == want
    # A borrower without rows is answered; periods turned round hold nothing.
    assert len(got) == len(want) + 9 and all(v == (None, 0) for k, v in got.items() if k[0] == "Z")
    assert any(q.start and q.end and q.start > q.end for q in requests)
    assert Q.answer_table(ledger, asked(spark, requests).limit(0)).collect() == []


@pytest.mark.parametrize("first,last", [("2024-01-01", "2024-12-31"), ("2024-03-07", "2024-03-07"), (None, "1999-12-31"), ("9999-12-30", None), ("0001-01-01", "0001-01-02"), ("2024-02-02", "2024-02-01")])
def test_intervals_cover_each_day_once(spark, first, last):
    row = spark.range(1).select(Q.intervals(F.lit(first).cast("date"), F.lit(last).cast("date")).alias("i")).first()
    spans = sorted((p.place << p.size, (p.place + 1 << p.size) - 1) for p in row.i)
    number = lambda d: (datetime.date.fromisoformat(d) - datetime.date(1, 1, 1)).days
    low, high = number(first) if first else 0, number(last) if last else (1 << Q.BITS) - 1
    if low > high:
        assert spans == []
    else:
        assert spans[0][0] == low and spans[-1][1] == high and all(b[0] == a[1] + 1 for a, b in zip(spans, spans[1:])) and len(spans) <= 2 * Q.BITS


def random_tree(r, depth=0):
    if depth == 3 or r.random() < 0.3:
        kind = r.random()
        if kind < 0.7:
            period = r.choice([None, ("2024-06-01", "2024-09-30"), (None, "2024-12-31")])
            return {"op": "AGG", "category": r.choice([*CATEGORIES, "any"]), "scope": r.choice(["borrower", "group", None]), "party": r.choice([None, "related"])} | ({"period": period} if period else {})
        return {"op": "DISCLOSED", "key": r.choice("xyz")} if kind < 0.85 else {"op": "CONST", "value": r.randrange(-3, 4)}
    op = r.choice([*("ADD SUB MUL DIV MAX MIN ABS".split()), *(["POW"] if r.random() < 0.1 else [])])
    n = {"DIV": 2, "ABS": 1}.get(op, r.randrange(1, 4))
    return {"op": op, "args": [random_tree(r, depth + 1) for _ in range(n if r.random() > 0.03 else n + 1)]}


def compare(got, want):
    assert got.keys() == want.keys()
    for k in want:
        a, b = got[k], want[k]
        assert (a.status, a.condition_met, a.missing) == (b.status, b.condition_met, b.missing), (k, a, b)
        assert (a.actual is None) == (b.actual is None) and (a.actual is None or a.actual == pytest.approx(b.actual, rel=1e-9, abs=0.011)), (k, a, b)
        assert {p.split(":")[0] for p in a.problems.split(";")} == {p.split(":")[0] for p in b.problems.split(";")}, (k, a, b)


def test_verdicts_and_evidence_equal_the_compiler(spark, ledger):
    r = random.Random(7)
    disclosed = spark.createDataFrame([("A", "x", -5.5), ("B", "y", 7.0)], "scenario_id string, key string, amount double")
    facts = spark.createDataFrame([("A", "lease", 12.0), ("C", "opex", 3.0)], "scenario_id string, category string, amount double")
    tests = [
        C.Covenant(f"{i}", r.choice(["max", "min"]), r.choice([0.5, 1.0, 100.0, 700.0]), random_tree(r), r.choice([(None, None), ("2024-03-01", "2024-12-31")]), random_tree(r) if i % 4 == 0 else None, r.choice(["max", "min"]), 20.0)
        for i in range(24)
    ]
    table = CT.covenant_table(spark, [(s, t) for s in "ABC" for t in tests])
    by = lambda rows: {(x.scenario_id, x.point): x for x in rows}
    compare(by(CT.verdict_table(ledger, table.union(table), disclosed, facts).collect()), by(C.verdicts(ledger, tests, disclosed, facts).collect()))
    candidates = ledger.where("txn_id RLIKE '[1357]$'").select(
        "scenario_id", "txn_id", F.lit("cutoff").alias("basis"), (F.length("txn_id") % 3).alias("weight"), F.when(F.col("txn_id").like("%13"), "opex").alias("revert_category"),
        F.col("txn_id").like("%23").alias("clears_party"), F.when(F.col("txn_id").like("%33"), "borrower").alias("revert_scope"),
    )
    same = lambda rows: {(x.scenario_id, x.point): tuple(x[2:]) for x in rows}
    want = same(C.decisive_tests(ledger, candidates, tests, disclosed, facts).collect())
    assert len(want) > 3 and same(CT.decisive_table(ledger, candidates, table, disclosed, facts).collect()) == want


def test_the_plan_does_not_grow_with_the_trees(spark, ledger):
    r = random.Random(8)
    size = []
    for n in (2, 60):
        table = CT.covenant_table(spark, [("A", C.Covenant(str(i), "max", 1.0, random_tree(r))) for i in range(n)]).select("*")
        plan = CT.verdict_table(ledger, table)._jdf.queryExecution().analyzed()
        size.append(len([line for line in plan.toString().split("\n") if line.strip()]))
    assert size[0] == size[1]


def test_odd_covenants(spark, ledger):
    leaf = postfix({"op": "AGG", "category": "opex"})
    broken = [
        ("A", "1", None, 1.0, leaf), ("A", "2", "max", None, leaf), ("A", "3", "max", 1.0, None), ("A", "4", "max", 1.0, []), ("A", "5", "max", 1.0, leaf * 2),
        ("A", "6", "max", 1.0, [{"op": "ADD", "n": 2}]), ("A", "7", "max", 1.0, [{"op": None, "n": 0}]), ("Z", "8", "max", 1.0, leaf), ("A", "9", "max", 1.0, [*leaf, {"op": "CONST", "n": 1, "value": 1.0}]),
    ]
    none = {c: None for c in ("category", "scope", "party", "start", "end", "key", "value")}
    rows = [(s, p, d, t, None, None, None if m is None else [none | x for x in m], None, None, None) for s, p, d, t, m in broken]
    got = {x.point: x for x in CT.verdict_table(ledger, spark.createDataFrame(rows, CT.COVENANTS)).collect()}
    assert {p: (x.status, x.problems) for p, x in got.items() if p != "8"} == {
        "1": ("COMPLIANT", "unknown_direction"), "2": ("COMPLIANT", "no_threshold"), "3": ("COMPLIANT", "metric_not_computed: no metric"),
        "4": ("COMPLIANT", "metric_not_computed: not one tree"), "5": ("COMPLIANT", "metric_not_computed: not one tree"),
        "6": ("COMPLIANT", "metric_not_computed: ADD takes 1 to any number of arguments"), "7": ("COMPLIANT", "metric_not_computed: unknown node type none"),
        "9": ("COMPLIANT", "metric_not_computed: CONST takes no arguments"),
    }
    assert (got["8"].actual, got["8"].missing) == (0.0, "opex|borrower|*|*|*")
    assert CT.verdict_table(ledger, spark.createDataFrame([], CT.COVENANTS)).collect() == []


def test_registered_operators_stand_in_tables(spark, ledger):
    register("AVG2", 2, 2, lambda xs: (xs[0] + xs[1]) / 2)
    try:
        test = C.Covenant("1", "max", 1.0, {"op": "AVG2", "args": [{"op": "CONST", "value": 4}, {"op": "CONST", "value": 8}]})
        assert CT.verdict_table(ledger, CT.covenant_table(spark, [("A", test)])).first().actual == 6.0
    finally:
        OPERATORS.pop("AVG2"), ARRAY_FOLDS.pop("AVG2")
