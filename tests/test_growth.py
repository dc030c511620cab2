"""What keeps disk and the driver's memory in bounds as tables grow."""

import re
import time

import pytest
from pyspark.sql import functions as F

from tallymark.operators import tagging as T
from tallymark.plans import covenant_queries, ledger_queries, run, run_queries
from tallymark.sources.ledger_view import ledger
from tallymark.tables import Store

SMALL = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_sieve_keeps_all_partners_and_few_others(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("s"), F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    asked = rows.where("b % 100 = 0").union(spark.createDataFrame([(None, 1), ("s0", None)], "a string, b long"))
    kept = {tuple(r) for r in T.sieve(rows, asked, "a", "b").collect()}
    partners = {tuple(r) for r in rows.where("b % 100 = 0").collect()}
    assert partners <= kept and len(kept) < len(partners) + 100
    assert T.sieve(rows, asked.limit(0), "a", "b").isEmpty() and T.sieve(rows, asked, "a", "b").columns == rows.columns


def test_addresses_shuffle_only_rows_that_a_note_may_mean(spark):
    rows = ledger(spark, SMALL)
    assert "_marks" in plan(T.address_notes(ledger_queries._notes(rows), rows))


def test_orders_meet_their_customers_before_their_lines(spark):
    joins = [line for line in plan(ledger(spark, SMALL)).splitlines() if "Join Inner" in line and "o_custkey" in line]
    lines = [line for line in plan(ledger(spark, SMALL)).splitlines() if "Join Inner" in line and "l_orderkey" in line]
    depth = lambda line: line.index("Join")
    assert len(joins) == len(lines) == 1 and depth(joins[0]) > depth(lines[0])


def test_reclassification_works_the_ledger_out_once(spark):
    assert "l_orderkey" not in plan(ledger_queries.reclass_and_cutoff(spark, SMALL))


@pytest.mark.parametrize("scoped", [False, True])
def test_inputs_of_a_run_work_the_ledger_out_once(spark, scoped):
    inputs = run_queries._inputs(spark, SMALL, scoped)
    assert all("l_orderkey" not in plan(t) for t in (inputs.ledger, inputs.categories, inputs.notes))
    assert ("scope" in inputs.categories.columns) == scoped


def test_stored_tables_leave_no_shuffle_files(spark):
    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return set(re.findall(r"shuffle_(\d+)_\d+_\d+\.data", found))

    before = shuffled()
    stored = Store(spark, "t").put(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and stored.count() == 7


def test_notes_are_addressed_without_the_tags(spark):
    clean = spark.createDataFrame([("A", "t1", "X LLP", 5.0, "d")], "scenario_id string, txn_id string, counterparty string, amount double, description string")
    categories = spark.range(77).select(F.concat(F.lit("t"), "id").alias("txn_id"), F.lit("opex").alias("category"))
    entities = spark.createDataFrame([], "scenario_id string, name string, pos int, is_related boolean, unrestricted boolean")
    fields = "note_id string, scenario_id string, target_txn_id string, target_counterparty string, value double, status string, kind string, to_category string, pos int"
    final = T.final_ledger(clean, categories, entities, spark.createDataFrame([("n", "A", None, "X LLP", 5.0, "applied", "cutoff", None, 1)], fields))
    assert plan(final).count("Range (0, 77") == 1
    assert [(r.txn_id, r.category, r.excluded) for r in final.collect()] == [("t1", "opex", True)]


def test_evidence_shuffles_only_rows_that_may_decide(spark):
    outcome = run.settle(covenant_queries._own_inputs(spark, SMALL))
    assert set(outcome.final.columns) == set(run.READ)
    # Rows of noted ids, candidates' rows and asked cells are each sieved before they are shuffled.
    assert plan(outcome.evidence).count("bit_or") >= 3


def test_tags_come_to_their_rows_by_transaction_only(spark):
    rows = [("A", "t1", "X LLP", 5.0), ("A", "t1", "Y LLP", 5.0), ("B", "t1", "X LLP", 5.0), ("A", "t2", "X  llp", 5.0), ("A", "t3", None, 5.0)]
    clean = spark.createDataFrame(rows, "scenario_id string, txn_id string, counterparty string, amount double")
    categories = spark.createDataFrame([("t1", "opex", "group"), ("t2", "opex", None), ("t2", "opex", "borrower")], "txn_id string, category string, scope string")
    entities = spark.createDataFrame([("A", "X LLP", 1, True, True), ("B", "X LLP", 1, False, True)], "scenario_id string, name string, pos int, is_related boolean, unrestricted boolean")
    fields = "note_id string, scenario_id string, target_txn_id string, target_counterparty string, value double, status string, kind string, to_category string, pos int"
    final = T.final_ledger(clean, categories, entities, spark.createDataFrame([], fields))
    got = sorted((r.scenario_id, r.txn_id, r.counterparty or "", r.party, r.scope, r.category, r.problem) for r in final.collect())
    twice = ("A", "t2", "X  llp", "related", "borrower", "opex", "party_conflict")
    assert got == [("A", "t1", "X LLP", "related", "group", "opex", "party_conflict"), ("A", "t1", "Y LLP", None, "group", "opex", None), twice, twice, ("A", "t3", "", None, None, "other", "no_category"), ("B", "t1", "X LLP", "unrestricted_subsidiary", "group", "opex", None)]
    # Nothing of the whole ledger is joined by anything but the transaction.
    assert all("txn_id" in line for line in plan(final).splitlines() if "Join LeftOuter" in line and "amount" in line)
