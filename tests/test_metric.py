import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.operators.covenants import Covenant, best_basis, decisive, first_reports, verdicts
from tallymark.plans.metric import Leaves, MetricError, Request, compile_tree, flatten, nest, pretty, problems, register
from tallymark.sources.ledger_view import CATEGORIES

AGG = lambda c, **m: {"op": "AGG", "category": c, **m}
COLUMNS = "txn_id string, scenario_id string, date date, category string, amount decimal(18,4), party string, scope string, excluded boolean"


def rows(spark, *given_):
    import datetime
    from decimal import Decimal

    full = [(t, s, datetime.date.fromisoformat(d), c, Decimal(str(a)), p, sc, x) for t, s, d, c, a, p, sc, x in given_]
    return spark.createDataFrame(full, COLUMNS)


@pytest.fixture(scope="module")
def small(spark):
    return rows(
        spark,
        ("t1", "A", "2025-01-10", "opex", -100, None, "borrower", False),
        ("t2", "A", "2025-02-10", "opex", 30, None, "borrower", False),
        ("t3", "A", "2025-03-10", "opex", -500, None, "borrower", True),
        ("t4", "A", "2025-03-31", "revenue", 140, "related", "borrower", False),
        ("t5", "A", "2025-04-01", "capex", -60, "related", "borrower", False),
        ("t6", "B", "2025-01-01", "revenue", 10, None, "group", False),
    ).cache()


def run(small, *tests, **more):
    return {(r.scenario_id, r.point): r for r in verdicts(small, list(tests), **more).collect()}


def test_refunds_net_and_excluded_rows_do_not_count(small):
    assert run(small, Covenant("1", "max", 70, AGG("opex")))["A", "1"].actual == 70.0


def test_equality_complies_both_ways(small):
    found = run(small, Covenant("1", "max", 70, AGG("opex")), Covenant("2", "min", 70, AGG("opex")), Covenant("3", "max", 69.99, AGG("opex")))
    assert [found["A", p].status for p in "123"] == ["COMPLIANT", "COMPLIANT", "BREACH"]


def test_unknown_direction_raises(small):
    with pytest.raises(ValueError):
        verdicts(small, [Covenant("1", "up", 1, AGG("opex"))])


def test_period_is_inclusive_and_own_period_wins(small):
    quarter = ("2025-01-01", "2025-03-31")
    found = run(small, Covenant("1", "max", 1, AGG("revenue"), quarter), Covenant("2", "max", 1, AGG("capex", period=("2025-04-01", "2025-04-01")), quarter))
    assert (found["A", "1"].actual, found["A", "2"].actual) == (140.0, 60.0)


def test_scope_is_strict_and_any_empty_is_silent(small):
    found = run(small, Covenant("1", "max", 1, AGG("any")), Covenant("2", "max", 1, AGG("revenue", scope="group")))
    assert (found["B", "1"].actual, found["B", "1"].missing) == (0.0, "")
    assert (found["B", "2"].actual, found["A", "2"].missing) == (10.0, "revenue|group|*|*|*")


def test_division_by_zero(small):
    over = lambda a: {"op": "DIV", "args": [a, AGG("lease")]}
    found = run(small, Covenant("1", "max", 3, over(AGG("revenue"))), Covenant("2", "min", 3, over(AGG("revenue"))), Covenant("3", "max", 3, over(AGG("taxes"))))
    assert [(found["A", p].status, found["A", p].actual) for p in "123"] == [("BREACH", None), ("COMPLIANT", None), ("COMPLIANT", 0.0)]


def test_condition_off_reports_value(small):
    found = run(small, Covenant("1", "max", 1, AGG("opex"), condition=AGG("revenue"), condition_threshold=140), Covenant("2", "max", 1, AGG("opex"), condition=AGG("revenue"), condition_threshold=139))
    assert [(found["A", p].status, found["A", p].condition_met, found["A", p].actual) for p in "12"] == [("COMPLIANT", False, 70.0), ("BREACH", True, 70.0)]


def test_disclosed_is_a_magnitude_and_missing_is_zero(spark, small):
    given_ = spark.createDataFrame([("A", "k", -5.0)], "scenario_id string, key string, amount double")
    found = run(small, Covenant("1", "max", 1, {"op": "ADD", "args": [{"op": "DISCLOSED", "key": "k"}, {"op": "CONST", "value": 2}]}), disclosed=given_)
    assert (found["A", "1"].actual, found["B", "1"].actual) == (7.0, 2.0)


def test_first_point_reports_a_hole(small):
    cells = verdicts(small, [Covenant("6.2", "max", 1, AGG("taxes")), Covenant("6.1", "max", 1, AGG("taxes"))])
    assert {(r.scenario_id, r.point) for r in first_reports(cells).collect()} == {("A", "6.1"), ("B", "6.1")}


def test_nest_rejects_bad_lists():
    ok = [{"id": "a", "op": "ADD", "args": ["b"]}, {"id": "b", "op": "CONST", "value": 1}]
    assert nest(ok, "a") == {"op": "ADD", "args": [{"op": "CONST", "value": 1}]}
    for nodes, root in ((ok, "z"), (ok + ok, "a"), ([{"id": "a", "op": "ADD", "args": ["a"]}], "a"), ([{"id": str(i), "op": "ABS", "args": [str(i + 1)]} for i in range(20)], "0")):
        with pytest.raises(MetricError):
            nest(nodes, root)


trees = st.recursive(st.sampled_from([AGG("opex"), {"op": "CONST", "value": 2.5}, {"op": "DISCLOSED", "key": "k"}]), lambda t: st.builds(lambda op, a: {"op": op, "args": a}, st.sampled_from(["ADD", "MUL", "MAX"]), st.lists(t, min_size=1, max_size=3)), max_leaves=8)


@given(trees)
def test_flatten_and_nest_round_trip(tree):
    assert nest(*flatten(tree)) == tree
    assert problems(tree, CATEGORIES) == []
    assert pretty(tree)


def test_problems_and_registration(spark):
    assert problems({"op": "DIV", "args": [AGG("gifts")]}, CATEGORIES) == ["arity", "unknown_category"]
    assert problems({"op": "NEG", "args": [AGG("opex")]}, CATEGORIES) == ["unknown_op"]
    with pytest.raises(MetricError):
        compile_tree({"op": "NEG", "args": []}, Leaves())
    register("NEG", 1, 1, lambda xs: -xs[0])
    assert problems({"op": "NEG", "args": [AGG("opex")]}, CATEGORIES) == []


def test_equal_leaves_are_asked_once():
    leaves = Leaves()
    compile_tree({"op": "ADD", "args": [AGG("opex"), AGG("opex"), AGG("opex", scope="borrower")]}, leaves)
    assert list(leaves.requests) == ["opex|borrower|*|*|*"]


CANDIDATE = "scenario_id string, txn_id string, basis string, weight int, seq int, revert_category string, clears_party boolean"


def test_decisive_row_is_the_one_that_flips(spark, small):
    c = spark.createDataFrame([("A", "t4", "related_party", 2, 1, None, True), ("A", "t5", "related_party", 2, 1, None, True), ("A", "t4", "corrected", 4, 2, None, False)], CANDIDATE)
    best = best_basis(c)
    assert {(r.txn_id, r.basis) for r in best.collect()} == {("t4", "corrected"), ("t5", "related_party")}
    # Related sum is 140 - 60 = 80; without t4 it is 60, without t5 it is 140.
    assert [(r.txn_id, r.n_flips) for r in decisive(small, best, Request("any", party="related"), 100, "max").collect()] == [("t5", 1)]
    assert [(r.txn_id, r.n_flips) for r in decisive(small, best, Request("any", party="related"), 70, "max").collect()] == [("t4", 1)]


def test_revert_to_another_category_counts_there(spark, small):
    c = spark.createDataFrame([("A", "t5", "reclassified", 5, 1, "opex", False)], CANDIDATE)
    assert [r.txn_id for r in decisive(small, c, Request("opex"), 100, "max").collect()] == ["t5"]
    assert decisive(small, c, Request("opex"), 200, "max").count() == 0


def test_empty_ledger(spark, small):
    assert verdicts(small.where(F.lit(False)), [Covenant("1", "max", 1, AGG("opex"))]).count() == 0
