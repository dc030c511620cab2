import json

import pytest
from pyspark.sql import functions as F

from tallymark.functions import text as X
from tallymark.operators import review as R
from tallymark.operators import tagging as T
from tallymark.plans.extraction import Extractor, extract, label_groups, replay, request_key
from tallymark.sources import readers
from tallymark.streaming.ingest import stream_parquet, upsert_ledger, windowed_counts


def test_parse_and_scenario(spark):
    rows = spark.createDataFrame([("TXN-P1-7", " 5.5 "), ("TXN-7", ""), ("x", "nan"), (None, "1_0")], "i string, a string")
    got = rows.select(T.scenario_of(F.col("i")), T.parse_amount(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [("P1", 5.5), ("", None), ("", None), ("", None)]


def test_amounts_come_from_any_mention_of_the_whole_id(spark):
    gap = " and so on" * 40
    ledger = spark.createDataFrame([(f"TXN-P1-{i}", "P1") for i in (1, 2, 3, 4)], "txn_id string, scenario_id string").withColumn("amount", F.lit(None).cast("decimal(18,2)"))
    memos = [
        ("a", "P1", f"TXN-P1-10 came to $77.00.{gap} Index: TXN-P1-1, TXN-P1-2.{gap} TXN-P1-2 came to $20.00.{gap} TXN-P1-1 came to $10.00.{gap} TXN-P1-1 came to $11.00."),
        ("b", "P1", f"TXN-P1-2 came to $21.00.{gap} TXN-P1-3-9 came to $30.00, XTXN-P1-3 to $31.00.{gap} TXN-P1-4\n" + " " * 400 + "came to $40.00 (line\nbreak)"),
    ]
    got = T.recover_amounts(ledger, spark.createDataFrame(memos, "doc_id string, scenario_id string, text string")).collect()
    assert {(r.txn_id, r.amount and float(r.amount), r.evidence) for r in got} == {("TXN-P1-1", 10.0, "a"), ("TXN-P1-2", 20.0, "a"), ("TXN-P1-3", None, None), ("TXN-P1-4", 40.0, "b")}


def test_the_first_word_of_direction_decides(spark):
    said = [
        "фактическая сумма операции составляет $884,204.16 (расход)", "отражено $5.00, фактическую сумму $7.50 списано, поступление позже", "поступление $3.00, затем расход",
        "an inflow, not an expense, of $4.00", "payment of $6.00", "income, though a payment, of $8.00", "it was $9.00",
    ]
    ledger = spark.createDataFrame([(f"TXN-P1-{i}", "P1") for i in range(len(said))], "txn_id string, scenario_id string").withColumn("amount", F.lit(None).cast("decimal(18,2)"))
    memos = [("a", "P1", f"TXN-P1-{i}: {t}." + " x" * 200) for i, t in enumerate(said)]
    got = T.recover_amounts(ledger, spark.createDataFrame(memos, "doc_id string, scenario_id string, text string")).collect()
    assert {r.txn_id: (float(r.amount), r.sign_unknown) for r in got} == {
        f"TXN-P1-{i}": v for i, v in enumerate([(-884204.16, False), (-7.5, False), (3.0, False), (4.0, False), (-6.0, False), (8.0, False), (9.0, True)])
    }


def test_layouts_before_names_go(spark):
    names = ["Организация Port Services JSC,", "За  Кредитора\nPort LLP.", "31 Декабря Port LLP", "ООО Ромашка", "Port Организация LLP", "", None]
    got = [r.n for r in spark.createDataFrame([(n,) for n in names], "n string").select(X.without_layout(F.col("n")).alias("n")).collect()]
    assert got == ["Port Services JSC", "Port LLP", "31 Декабря Port LLP", "ООО Ромашка", "Port Организация LLP", "", None]


def test_names_match_in_two_levels(spark):
    entities = spark.createDataFrame([("A", "Orion LLP", 1), ("A", "Vega JSC", 2), ("A", "Vega LLC", 3)], "scenario_id string, name string, pos int")
    rows = spark.createDataFrame([("A", "«Orion» L.L.P."), ("A", "ORION JSC"), ("A", "Vega Ltd"), ("A", "Vega (Holding) JSC,"), ("B", "Orion LLP")], "scenario_id string, counterparty string")
    got = {(r.scenario_id, r.counterparty): r.entity for r in T.match_entities(rows, entities).collect()}
    assert got == {("A", "«Orion» L.L.P."): "Orion LLP", ("A", "ORION JSC"): "Orion LLP", ("A", "Vega Ltd"): None, ("A", "Vega (Holding) JSC,"): "Vega JSC", ("B", "Orion LLP"): None}


def test_ambiguous_amount_is_not_addressed(spark):
    ledger = spark.createDataFrame([("A", "t1", "X", -5.0), ("A", "t2", "Y", 5.0), ("A", "t3", "Z", 7.0)], "scenario_id string, txn_id string, counterparty string, amount double")
    notes = spark.createDataFrame([("n1", "A", None, None, 5.0), ("n2", "A", None, None, 7.004), ("n3", "A", "t1", "Z", 7.0), ("n4", "A", None, "X", 9.0)], "note_id string, scenario_id string, target_txn_id string, target_counterparty string, value double")
    assert {tuple(r) for r in T.address_notes(notes, ledger).collect()} == {("n2", "t3", 4), ("n3", "t1", 1), ("n4", "t1", 3)}


def test_last_note_wins_and_cut_rows_stay(spark):
    ledger = spark.createDataFrame([("t1", "opex", False), ("t2", "opex", False)], "txn_id string, category string, excluded boolean")
    notes = spark.createDataFrame([("a", 1, "reclassification", "applied", "capex"), ("b", 2, "reclassification", "applied", "taxes"), ("c", 3, "reclassification", "rejected", "lease"), ("d", 4, "cutoff", "applied", None)], "note_id string, pos int, kind string, status string, to_category string")
    at = spark.createDataFrame([("a", "t1"), ("b", "t1"), ("c", "t1"), ("d", "t2")], "note_id string, txn_id string")
    assert sorted(tuple(r) for r in T.apply_notes(ledger, notes, at).select("txn_id", "category", "excluded").collect()) == [("t1", "taxes", False), ("t2", "opex", True)]


def test_related_and_immaterial(spark):
    r = spark.range(1).select(T.is_related(F.lit(20.0), F.lit(20.0), F.lit(None)), T.is_related(F.lit(None).cast("double"), F.lit(20.0), F.lit(None)), T.is_related(F.lit(1.0), F.lit(None).cast("double"), F.lit("board")), T.immaterial(F.lit("ebitda_adjustment"), F.lit("applied"), F.lit(10.0), F.lit(10.0)), T.immaterial(F.lit("ebitda_adjustment"), F.lit("applied"), F.lit(None).cast("double"), F.lit(10.0))).first()
    assert tuple(r) == (True, False, True, False, True)


def test_scoring(spark):
    key = spark.createDataFrame([("A", "1", "BREACH", 100.0, "t1"), ("A", "2", "COMPLIANT", 0.0, None), ("A", "3", "BREACH", 10.0, None)], "scenario_id string, point string, status string, actual double, evidence_txn_id string")
    perfect = R.score(key, key).agg(F.avg("marks")).first()[0]
    assert perfect == pytest.approx(1.0)
    assert R.score(key, key.limit(0)).agg(F.sum("marks")).first()[0] == 0.0
    off = key.withColumn("actual", F.col("actual") * 1.025)
    assert {r.point: r.marks for r in R.score(key, off).collect()} == pytest.approx({"1": 0.85, "2": 1.0, "3": 0.75})


def test_signals(spark):
    rows = spark.createDataFrame([(None, 1.0, "COMPLIANT", None), (6.0, 1.0, "BREACH", "t"), (1.05, 1.0, "BREACH", None), (1.08, 1.0, "COMPLIANT", None)], "a double, t double, s string, e string")
    got = [r[0] for r in rows.select(R.signals(*map(F.col, "atse"))).collect()]
    assert got == [["no_value"], ["far"], ["near", "no_evidence"], ["close"]]


def test_money_and_forms(spark):
    r = spark.createDataFrame([("pays $1,234.56 now", "none")], "a string, b string").select(X.money(F.col("a")), X.money(F.col("b"))).first()
    assert (float(r[0]), r[1]) == (1234.56, None)


def test_readers(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    for i in range(5):
        (docs / f"d{i}.txt").write_text(f"﻿text {i}")
    (docs / "odd.xyz").write_bytes(b"\x00")
    (tmp_path / "ledger.csv").write_text("﻿txn_id,account_id,date,counterparty,description,amount,currency\nTXN-A-1, ACC-1 ,2025-01-01,X,d,,USD\n")
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    (tmp_path / "template.json").write_text(json.dumps({"answers": {"A": {"6.1": {"status": None, "actual": None, "evidence_txn_id": None}}}}))
    (tmp_path / "key.json").write_text(json.dumps({"scenarios": {"A": {"covenants": {}}}}))
    found = readers.discover(spark, f"file://{tmp_path}")
    assert found.ledger.endswith("ledger.csv") and found.documents.endswith("docs") and any("answer key" in w for w in found.warnings)
    row = readers.read_ledger(spark, found.ledger).first()
    assert (row.txn_id, row.account_id, row.amount) == ("TXN-A-1", "ACC-1", None)
    texts = {r.doc_id: (r.text, r.method) for r in readers.read_texts(spark, found.documents).collect()}
    assert texts["d0.txt"] == ("text 0", "text") and texts["odd.xyz"][1] == "failed"
    cells = readers.read_submission(spark, found.template)
    filled = R.assemble(cells.select("scenario_id", "point"), cells.drop("actual", "status").withColumns({"actual": F.lit(2.005), "status": F.lit("BREACH")}))
    out = json.loads(readers.submission_json(filled, team="t").first()["value"])
    assert out == {"team": "t", "answers": {"A": {"6.1": {"status": "BREACH", "actual": 2.01, "evidence_txn_id": None}}}}
    readers.write_artifact(filled, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_extraction_replays_repairs_and_reports(spark):
    prompts = spark.createDataFrame([("a",), ("a",), ("b",), ("zzz",)], "prompt string")
    need = lambda p: [] if p.get("label") else ["no_label"]
    task = Extractor("labels", "1", replay({"a": '{"label": "opex"}', "b": "{}"}), (need,), repairs=1)
    got = {r.key: r for r in extract(prompts, task).collect()}
    key = {r.prompt: r.key for r in prompts.select("prompt", request_key(task, F.col("prompt")).alias("key")).collect()}
    assert len(got) == 3
    assert (got[key["a"]].attempts, got[key["b"]].error, got[key["b"]].attempts) == (1, "no_label", 2)
    assert got[key["zzz"]].error.startswith("KeyError")
    cache = spark.createDataFrame([(key["a"], '{"label": "taxes"}'), (key["b"], "broken")], "key string, payload string")
    again = {r.key: r for r in extract(prompts, task, cache).collect()}
    assert (again[key["a"]].payload, again[key["a"]].attempts, again[key["b"]].attempts) == ('{"label": "taxes"}', 0, 2)
    rows = prompts.withColumnRenamed("prompt", "k")
    assert sorted((r.k, r.label, r.fallback) for r in label_groups(rows, "k", task).collect()) == [("a", "opex", False), ("a", "opex", False), ("b", "other", True), ("zzz", "other", True)]


def test_streaming(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = stream_parquet(spark, str(tmp_path / "in"), events.schema, 1)
    query = windowed_counts(stream, lateness="10 years").writeStream.format("memory").queryName("seen").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {tuple(r) for r in spark.sql("SELECT window_start, event_type, n FROM seen").collect()} == {tuple(r) for r in windowed_counts(events).select("window_start", "event_type", "n").collect()}
    rows = stream.select(F.concat(F.lit("TXN-A-"), (F.col("event_id") % 100).cast("string")).alias("txn_id"), "value")
    for _ in range(2):
        upsert_ledger(rows, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("txn_id").distinct().count() == 100
