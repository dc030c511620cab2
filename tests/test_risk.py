"""Signals of a run's cells."""

from tallymark.operators import review as R
from tallymark.operators import risk as K


def test_every_signal_of_a_run(spark):
    make = spark.createDataFrame
    points = ["fell", "empty", "far", "near", "close", "amplified", "odd", "derived", "related", "plain"]
    submission = make([("A", p, p == "fell", None) for p in points] + [("B", "gap", False, None), ("B", "other", False, "t")], "scenario_id string, point string, fallback boolean, evidence_txn_id string")
    value = {"far": 600.0, "near": 104.0, "close": 91.0}
    cells = [("A", p, "COMPLIANT", value.get(p, 150.0), 100.0, {"empty": "opex|borrower|*|*|*", "derived": "capex|group|*|*|*"}.get(p, "")) for p in points if p != "fell"]
    cells += [("B", "gap", "BREACH", 150.0, 100.0, "capex|group|*|*|*"), ("B", "other", "BREACH", 150.0, 100.0, "")]
    cells = make(cells, "scenario_id string, point string, status string, actual double, threshold double, missing string")
    evidence = make([("A", "related", "related_party"), ("A", "plain", "cutoff")], "scenario_id string, point string, basis string")
    facts = [("A", p, p in ("amplified", "plain"), [10.0, 9.0] if p == "amplified" else [10.0, 4.9], p == "derived", ["lease"] if p == "odd" else ["opex"]) for p in points if p != "fell"]
    facts = make(facts, "scenario_id string, point string, ratio boolean, sums array<double>, derived boolean, categories array<string>")
    outliers = make([("A", "lease"), ("B", "opex")], "scenario_id string, category string")
    missed, unknown = make([("B", 2)], "scenario_id string, addressing_miss long"), make([("B", 1)], "scenario_id string, unknown_data long")
    got = {(r.scenario_id, r.point): (r.signals, r.risk, r.place) for r in K.ranked_cells(submission, cells, evidence, facts, outliers, missed, unknown).collect()}
    b = ["addressing_miss", "addressing_miss", "unknown_data"]
    want = {
        "fell": ["fallback", "no_value"], "empty": ["empty_sum"], "far": ["far"], "near": ["near"], "close": ["close"], "amplified": ["amplified"], "odd": ["outlier"],
        "derived": ["group_derived"], "related": ["related_evidence"], "plain": [],
    }
    assert {p: got["A", p][0] for p in points} == want
    assert got["B", "gap"][0] == ["empty_sum", "no_evidence", *b] and got["B", "other"][0] == ["group_gap", *b]
    assert all(r == round(sum(R.WEIGHTS[s] for s in names), 4) for names, r, _ in got.values())
    assert got["B", "gap"][2] == 1 and got["A", "plain"][2] == 12


def test_notes_that_found_no_row(spark):
    notes = spark.createDataFrame([("n1", "A", "cutoff", "applied", None), ("n2", "A", "cutoff", "rejected", None), ("n3", "A", "reclassification", "applied", None), ("n4", "A", "reclassification", "applied", "opex"), ("n5", "A", "cutoff", "applied", None)], "note_id string, scenario_id string, kind string, status string, to_category string")
    addressed = spark.createDataFrame([("n5", "t")], "note_id string, txn_id string")
    assert [tuple(r) for r in K.misses(notes, addressed).collect()] == [("A", 2)]
