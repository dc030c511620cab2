"""Queries over whole runs: the chain of all steps, decisive transactions of whole tests, cells that cannot be computed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import covenants as C
from tallymark.operators import review as R
from tallymark.operators import tagging as T
from tallymark.plans.ledger_queries import _CANDIDATES, _NOTES, _VERDICTS_SQL, AGG, DIV, VERDICTS, _candidates, _magnitude, _notes, _ratio
from tallymark.plans.metric import Request
from tallymark.plans.run import Inputs, settle
from tallymark.registry import query
from tallymark.sources.ledger_view import ledger, read
from tallymark.tables import Store


def _inputs(spark: SparkSession, sf_dir: str, scoped: bool = False) -> Inputs:
    """The ledger view as a raw ledger of texts, with its categories, parties and notes as extracted tables.

    ``scoped``: categories come with scopes.
    """
    # The raw ledger, its categories and the notes all come of one view, whose joins are worked out once.
    store = Store(spark, "inputs")
    view = store.put(ledger(spark, sf_dir).select("txn_id", "scenario_id", "account_id", "date", "counterparty", "description", "category", "amount", "scope"))
    text = lambda c: F.col(c).cast("string").alias(c)
    code = F.when(F.substring("txn_id", -1, 1).isin("1", "3", "5"), " usd").alias("currency")
    raw = view.select("txn_id", "account_id", text("date"), "counterparty", "description", text("amount"), code)
    # Rows that no amount can be found for are counted and left out.
    lost = raw.where("txn_id LIKE '%17'").select(F.concat("txn_id", F.lit("9")).alias("txn_id"), "account_id", "date", "counterparty", "description", F.lit(" ").alias("amount"), "currency")
    supplier = read(spark, sf_dir, "supplier")
    nation = F.col("s_nationkey")
    related = (F.col("s_acctbal") + 1000) / 110 >= 20 + nation % 21
    entities = supplier.select(F.concat(F.lit("N"), nation.cast("string")).alias("scenario_id"), F.concat("s_name", F.lit(",")).alias("name"), F.col("s_suppkey").alias("pos"), related.alias("is_related"), (F.col("s_suppkey") % 3 == 0).alias("unrestricted"))
    template = read(spark, sf_dir, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("scenario_id"))
    template = template.select("scenario_id", F.explode(F.array(*map(F.lit, ("6.1", "6.2", "6.3", "6.9")))).alias("point"))
    rates = spark.createDataFrame([("EUR", 1.25)], "currency string, rate double")
    return Inputs(raw.union(lost), template, VERDICTS, rates, view.select("txn_id", "category", "scope") if scoped else view.select("txn_id", "category"), entities, store.put(_notes(view)))


_CHANGED = f"""{_NOTES}, acting AS (SELECT * FROM notes JOIN addressed USING (note_id) WHERE status = 'applied' AND (kind = 'cutoff' OR to_category IS NOT NULL)),
  changed AS (SELECT l.txn_id, l.scenario_id, l.counterparty, l.date, l.amount, l.party, 'borrower' AS scope, category AS first_category, c.txn_id IS NOT NULL AS excluded, coalesce(m.to_category, category) AS category FROM ledger l
    LEFT JOIN (SELECT DISTINCT txn_id FROM acting WHERE kind = 'cutoff') c ON c.txn_id = l.txn_id
    LEFT JOIN (SELECT txn_id, arg_max(to_category, pos) AS to_category FROM acting WHERE kind = 'reclassification' GROUP BY txn_id) m ON m.txn_id = l.txn_id),
  cells AS ({_VERDICTS_SQL.replace('FROM ledger', 'FROM changed')}),
  template AS (SELECT 'N' || n_nationkey AS scenario_id, unnest(['6.1', '6.2', '6.3', '6.9']) AS point FROM nation)"""


@query(
    f"""{_CHANGED} SELECT t.scenario_id, t.point, coalesce(status, 'COMPLIANT') AS status, coalesce(actual, 0.0) AS actual, status IS NULL OR actual IS NULL AS fallback
      FROM template t LEFT JOIN cells c ON c.scenario_id = t.scenario_id AND c.point = t.point""",
    ledger=True,
)
def run_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(_inputs(spark, sf_dir)).submission.select("scenario_id", "point", "status", "actual", "fallback")


@query(
    f"""{_CHANGED}, open_ AS (SELECT 'N' || s_nationkey AS sid, s_name FROM supplier WHERE s_suppkey % 3 = 0)
      SELECT scenario_id, code, count(*) AS n FROM (
        SELECT scenario_id, 'party_conflict' AS code FROM changed JOIN open_ ON sid = scenario_id AND s_name = counterparty WHERE party = 'related'
        UNION ALL SELECT DISTINCT scenario_id, 'rows_without_amount' FROM changed WHERE txn_id LIKE '%17') GROUP BY ALL""",
    ledger=True,
)
def run_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(_inputs(spark, sf_dir)).problems.groupBy("scenario_id", "code").agg(F.count("*").alias("n"))


@query(
    """SELECT scenario_id, coalesce(party, CASE WHEN s_suppkey % 3 = 0 AND s_nationkey = CAST(substr(scenario_id, 2) AS INT) THEN 'unrestricted_subsidiary' END) AS party, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total
      FROM ledger JOIN supplier ON s_name = counterparty GROUP BY ALL""",
    ledger=True,
)
def tagged_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs, view = _inputs(spark, sf_dir), ledger(spark, sf_dir)
    tagged = T.tag_parties(T.apply_categories(view, inputs.categories), inputs.entities)
    return tagged.groupBy("scenario_id", "party").agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("total"))


def _evidence(metric: str, direction: str, threshold: float, condition: str = "TRUE") -> str:
    """The winner by recomputing every sum for every candidate."""
    sign = ">" if direction == "max" else "<"
    verdict = f"({condition}) AND abs({metric}) {sign} {threshold}"
    return f"""{_CANDIDATES},
      base AS (SELECT scenario_id, {verdict} AS breach FROM ledger GROUP BY scenario_id),
      moved AS (SELECT b.scenario_id, b.txn_id AS candidate, b.basis, b.weight, l.amount, l.date, l.scope, l.excluded OR l.txn_id = b.txn_id AND b.revert_category IS NULL AND NOT b.clears_party AS excluded,
          CASE WHEN l.txn_id = b.txn_id THEN coalesce(b.revert_category, l.category) ELSE l.category END AS category, CASE WHEN l.txn_id = b.txn_id AND b.clears_party THEN NULL ELSE l.party END AS party
        FROM best b JOIN ledger l ON l.scenario_id = b.scenario_id),
      again AS (SELECT scenario_id, candidate, basis, weight, {verdict} AS breach FROM moved GROUP BY ALL),
      flips AS (SELECT a.*, row_number() OVER (PARTITION BY a.scenario_id ORDER BY weight DESC, candidate) AS nth, count(*) OVER (PARTITION BY a.scenario_id) AS n_flips, count(*) OVER (PARTITION BY a.scenario_id, weight) AS n_equal
        FROM again a JOIN base ON base.scenario_id = a.scenario_id WHERE base.breach <> a.breach)
      SELECT scenario_id, candidate AS txn_id, basis, weight, n_flips, n_equal FROM flips WHERE nth = 1"""


def _decided(spark: SparkSession, sf_dir: str, test: C.Covenant) -> DataFrame:
    return C.decisive_tests(ledger(spark, sf_dir), C.best_basis(_candidates(spark, sf_dir)), [test]).drop("point")


@query(_evidence(_ratio(_magnitude("any", " AND party = 'related'"), _magnitude("opex")), "max", 0.02), ledger=True)
def evidence_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, sf_dir, C.Covenant("6.1", "max", 0.02, DIV(AGG("any", party="related"), AGG("opex"))))


@query(_evidence(f"greatest({_magnitude('capex')}, {_magnitude('opex')})", "max", 1.9e6, f"{_magnitude('any', ' AND party = ' + chr(39) + 'related' + chr(39))} > 100000"), ledger=True)
def evidence_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = {"op": "MAX", "args": [AGG("capex"), AGG("opex")]}
    return _decided(spark, sf_dir, C.Covenant("6.2", "max", 1.9e6, metric, condition=AGG("any", party="related"), condition_threshold=1e5))


@query(
    """SELECT scenario_id, unnest(['6.1', '6.2', '6.3']) AS point, unnest(['COMPLIANT', CASE WHEN m > 1 THEN 'BREACH' ELSE 'COMPLIANT' END, CASE WHEN m > 0 THEN 'BREACH' ELSE 'COMPLIANT' END]) AS status,
        unnest([NULL, round(m, 2), NULL]) AS actual, unnest(['metric_not_computed: unknown node type POW', 'condition_not_computed: unknown node type POW', CASE WHEN m > 0 THEN 'not_finite' ELSE '' END]) AS problems
      FROM (SELECT scenario_id, CAST(abs(coalesce(sum(amount) FILTER (WHERE NOT excluded AND scope = 'borrower' AND category = 'opex'), 0)) AS DOUBLE) AS m FROM ledger GROUP BY scenario_id)""",
    ledger=True,
)
def uncomputable_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    power = {"op": "POW", "args": [AGG("opex"), {"op": "CONST", "value": 2}]}
    tests = [C.Covenant("6.1", "max", 1.0, power), C.Covenant("6.2", "max", 1.0, AGG("opex"), condition=power), C.Covenant("6.3", "max", 1.0, DIV(AGG("opex"), {"op": "CONST", "value": 0}))]
    return C.verdicts(ledger(spark, sf_dir), tests).select("scenario_id", "point", "status", "actual", "problems")


@query(
    """SELECT scenario_id, array_to_string(list(txn_id ORDER BY first_key, date, txn_id), ',') AS txn_ids FROM (
        SELECT scenario_id, txn_id, date, min(k) AS first_key FROM (SELECT *, 1 AS k FROM ledger WHERE party = 'related' UNION ALL SELECT *, 2 FROM ledger WHERE category = 'taxes') WHERE NOT excluded AND scope = 'borrower' GROUP BY ALL) GROUP BY scenario_id""",
    ledger=True,
)
def touched_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    trace = C.traces(ledger(spark, sf_dir), [Request("any", party="related"), Request("taxes")], "date")
    return C.touched(trace).select("scenario_id", F.array_join("txn_ids", ",").alias("txn_ids"))


@query(
    f"""WITH cells AS ({_VERDICTS_SQL}), marks AS (SELECT scenario_id, point, CASE WHEN scenario_id = 'N3' THEN 0.0 ELSE 0.5 + 0.5 * CASE WHEN point = '6.1' THEN 0.6 ELSE 1.0 END END AS marks FROM cells WHERE actual <> 0)
      SELECT scenario_id, point, round(marks, 4) AS marks FROM marks ORDER BY marks, scenario_id, point LIMIT 10""",
    ledger=True,
)
def loss_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = C.verdicts(ledger(spark, sf_dir), VERDICTS).where("actual <> 0").select("scenario_id", "point", "status", "actual", F.lit(None).cast("string").alias("evidence_txn_id"))
    given = key.withColumns({"status": F.when(F.col("scenario_id") == "N3", "NONE").otherwise(F.col("status")), "actual": F.col("actual") * F.when(F.col("point") == "6.1", 1.02).otherwise(1.0)})
    return R.losses(R.score(key, given)).select("scenario_id", "point", F.round("marks", 4).alias("marks"))
