"""Queries where every borrower has covenants of its own, and where requests are data."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import covenant_tables as CT
from tallymark.operators.requests import answer_table
from tallymark.plans.ledger_queries import _magnitude, _ratio
from tallymark.plans.metric import TOKEN
from tallymark.plans.run import Inputs, settle
from tallymark.plans.run_queries import _CHANGED, _inputs
from tallymark.registry import query
from tallymark.sources.ledger_view import CATEGORIES, ledger, read

_LIST = ", ".join(f"'{c}'" for c in (*CATEGORIES, "any"))


@query(
    f"""WITH asked AS (SELECT DISTINCT 'N' || c_nationkey AS scenario_id, list_extract([{_LIST}], CAST(o_orderkey % 13 + 1 AS INT)) AS category, CASE WHEN o_orderkey % 5 = 0 THEN 'group' ELSE 'borrower' END AS scope,
        CASE WHEN o_orderkey % 4 = 0 THEN 'related' END AS party, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS first_day,
        CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 500 - 20 AS INT) END AS last_day FROM orders JOIN customer ON o_custkey = c_custkey)
      SELECT a.scenario_id, a.category, a.scope, a.party, CAST(first_day AS VARCHAR) AS first_day, CAST(last_day AS VARCHAR) AS last_day, count(l.amount) AS n_rows, CAST(abs(coalesce(sum(l.amount), 0)) AS DOUBLE) AS value
      FROM asked a LEFT JOIN ledger l ON l.scenario_id = a.scenario_id AND NOT excluded AND l.scope = a.scope AND (a.category = 'any' OR l.category = a.category) AND (a.party IS NULL OR l.party = a.party)
        AND (first_day IS NULL OR date >= first_day) AND (last_day IS NULL OR date <= last_day) GROUP BY ALL""",
    ledger=True,
)
def many_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for every order: tens of thousands of periods, categories and parties, in one plan."""
    key = F.col("o_orderkey")
    orders = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    day = F.to_date("o_orderdate")
    category = F.element_at(F.array(*map(F.lit, (*CATEGORIES, "any"))), (key % 13 + 1).cast("int"))
    asked = orders.select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("scenario_id"), category.alias("category"), F.when(key % 5 == 0, "group").otherwise("borrower").alias("scope"),
        F.when(key % 4 == 0, "related").alias("party"), F.when(key % 7 != 0, day).alias("start"), F.when(key % 6 != 0, F.date_add(day, (key % 500 - 20).cast("int"))).alias("end"),
    )
    found = answer_table(ledger(spark, sf_dir), asked)
    day_text = lambda c, name: F.col(c).cast("string").alias(name)
    return found.select("scenario_id", "category", "scope", "party", day_text("start", "first_day"), day_text("end", "last_day"), "n_rows", F.abs(F.coalesce("total", F.lit(0))).cast("double").alias("value"))


def token(op: str, n: int = 0, **more: object) -> Column:
    """A token of a metric as a literal."""
    names = [f.partition(":")[0] for f in TOKEN[len("struct<") : -1].split(",")]
    given = {"op": op, "n": n, **more}
    return F.struct(*[F.lit(given.get(c)).alias(c) for c in names]).cast(TOKEN)


def _agg(category: str, **more: object) -> Column:
    return token("AGG", category=category, **more)


def _own_covenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tests for each nation, whose trees, thresholds, periods and conditions follow from its key."""
    k, none = F.col("n_nationkey"), F.lit(None).cast(f"array<{TOKEN}>")
    year = {"start": "1999-01-01", "end": "1999-12-31"}
    first = F.when(k % 3 == 0, F.array(_agg("opex"))).when(k % 3 == 1, F.array(_agg("revenue"), _agg("opex"), token("DIV", 2)))
    first = first.otherwise(F.array(_agg("lease"), token("DISCLOSED", key="add_back"), token("ADD", 2)))
    limit = F.when(k % 3 == 0, 1e6 + 50000.0 * k).when(k % 3 == 1, 0.5 + 0.05 * (k % 7)).otherwise(100000.0 * k)
    second = F.when(k % 2 == 0, F.array(_agg("capex"), _agg("opex"), _agg("payroll"), token("MAX", 3)))
    second = second.otherwise(F.array(_agg("revenue"), _agg("opex"), _agg("capex"), token("MAX", 2), token("SUB", 2)))
    third = F.array(_agg("capex", scope="group"), _agg("insurance", scope="group", start="1970-01-01", end="1970-12-31"), token("ADD", 2))
    inflow = F.when(k % 5 == 0, F.array(_agg("financing_inflow"))).otherwise(none)
    day = lambda d: F.lit(d).cast("date")
    tests = [
        ("6.1", F.when(k % 3 == 1, "min").otherwise("max"), limit, F.when(k % 3 == 0, day(year["start"])), F.when(k % 3 == 0, day(year["end"])), first, none),
        ("6.2", F.when(k % 2 == 0, "max").otherwise("min"), F.when(k % 2 == 0, 2e6).otherwise(1e5 + 1e4 * k), day(None), day(None), second, inflow),
        ("6.3", F.lit("max"), 30000.0 * k, day(None), day(None), third, none),
    ]
    names = ("point", "direction", "threshold", "start", "end", "metric", "condition")
    each = F.array(*[F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(c) for c, v in zip(names, t)]) for t in tests])
    rows = read(spark, sf_dir, "nation").select(F.concat(F.lit("N"), k.cast("string")).alias("scenario_id"), F.explode(each).alias("t"))
    return rows.select("scenario_id", "t.*", F.lit("max").alias("condition_direction"), F.lit(1e6).alias("condition_threshold"))


def _disclosed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return read(spark, sf_dir, "nation").where(k % 2 == 0).select(F.concat(F.lit("N"), k.cast("string")).alias("scenario_id"), F.lit("add_back").alias("key"), (-1000.5 * k).alias("amount"))


def _group_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of the group: one where the ledger has no row of the kind, one where it has."""
    k = F.col("n_nationkey")
    rows = read(spark, sf_dir, "nation").where(k % 4 == 0).select(F.concat(F.lit("N"), k.cast("string")).alias("scenario_id"), F.explode(F.array(F.lit("insurance"), F.lit("capex"))).alias("category"), (1000.0 * k).alias("amount"))
    return rows


_YEAR = " AND date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'"
_K = "CAST(substr(scenario_id, 2) AS INT)"
_ADD_BACK = f"CASE WHEN {_K} % 2 = 0 THEN 1000.5 * {_K} ELSE 0.0 END"
_NO_INSURANCE = f"CASE WHEN {_K} % 4 = 0 THEN 1000.0 * {_K} ELSE 0.0 END"
_GROUP_CAPEX = f"CASE WHEN count(*) FILTER (WHERE NOT excluded AND scope = 'group' AND category = 'capex') = 0 THEN {_NO_INSURANCE} ELSE {_magnitude('capex', scope='group')} END"
_M1 = f"CASE {_K} % 3 WHEN 0 THEN {_magnitude('opex', _YEAR)} WHEN 1 THEN {_ratio(_magnitude('revenue'), _magnitude('opex'))} ELSE {_magnitude('lease')} + {_ADD_BACK} END"
_M2 = f"""CASE WHEN {_K} % 2 = 0 THEN greatest({_magnitude('capex')}, {_magnitude('opex')}, {_magnitude('payroll')}) ELSE {_magnitude('revenue')} - greatest({_magnitude('opex')}, {_magnitude('capex')}) END"""
_MET = f"({_K} % 5 <> 0 OR {_magnitude('financing_inflow')} > 1e6)"
_M3 = f"{_GROUP_CAPEX} + {_NO_INSURANCE}"
#: scenario_id, m1, m2, m3, met and the three verdicts of every borrower, from a relation and further columns to group by.
_OWN = f"""SELECT *, CASE WHEN k % 3 = 1 THEN abs(m1) < 0.5 + 0.05 * (k % 7) WHEN k % 3 = 0 THEN abs(m1) > 1e6 + 50000.0 * k ELSE abs(m1) > 100000.0 * k END AS b1,
      met AND CASE WHEN k % 2 = 0 THEN abs(m2) > 2e6 ELSE abs(m2) < 1e5 + 1e4 * k END AS b2, abs(m3) > 30000.0 * k AS b3
    FROM (SELECT scenario_id, {{more}}{_K} AS k, {_M1} AS m1, {_M2} AS m2, {_MET} AS met, {_M3} AS m3 FROM {{source}} GROUP BY {{more}}scenario_id)"""
_EACH = """SELECT scenario_id, unnest(['6.1', '6.2', '6.3']) AS point, unnest([b1, b2, b3]) AS breach, unnest([m1, m2, m3]) AS m, unnest([true, met, true]) AS met FROM own"""


@query(
    f"""WITH own AS ({_OWN.format(more='', source='ledger')}), each AS ({_EACH})
      SELECT scenario_id, point, CASE WHEN breach THEN 'BREACH' ELSE 'COMPLIANT' END AS status, CASE WHEN isfinite(m) THEN round(abs(m), 2) END AS actual, met AS condition_met FROM each""",
    ledger=True,
)
def own_covenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = CT.verdict_table(ledger(spark, sf_dir), _own_covenants(spark, sf_dir), _disclosed(spark, sf_dir), _group_facts(spark, sf_dir))
    return found.select("scenario_id", "point", "status", "actual", "condition_met")


def _own_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The inputs of a whole run with own covenants, scopes, disclosed amounts and figures of the group."""
    return replace(_inputs(spark, sf_dir, scoped=True), covenants=_own_covenants(spark, sf_dir), disclosed=_disclosed(spark, sf_dir), group_facts=_group_facts(spark, sf_dir))


_PARTIES = "CASE WHEN l.party IS NOT NULL THEN l.party WHEN EXISTS (SELECT 1 FROM supplier WHERE 'N' || s_nationkey = l.scenario_id AND s_name = l.counterparty AND s_suppkey % 3 = 0) THEN 'unrestricted_subsidiary' END AS party"
#: The final ledger of such a run, with scopes and both kinds of parties.
_FINAL = _CHANGED.partition("cells AS (")[0].replace("'borrower' AS scope", "l.scope").replace("l.party,", f"{_PARTIES},")


@query(
    f"""{_FINAL} own AS ({_OWN.format(more='', source='changed')}), each AS ({_EACH}),
      template AS (SELECT 'N' || n_nationkey AS scenario_id, unnest(['6.1', '6.2', '6.3', '6.9']) AS point FROM nation)
      SELECT t.scenario_id, t.point, CASE WHEN breach THEN 'BREACH' ELSE 'COMPLIANT' END AS status, coalesce(CASE WHEN isfinite(m) THEN round(abs(m), 2) END, 0.0) AS actual
      FROM template t LEFT JOIN each e ON e.scenario_id = t.scenario_id AND e.point = t.point""",
    ledger=True,
)
def run_own_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(_own_inputs(spark, sf_dir)).submission.select("scenario_id", "point", "status", "actual")


@query(
    f"""{_FINAL} candidates AS (
        SELECT scenario_id, txn_id, 'reclassified' AS basis, 5 AS weight, -1 AS seq, first_category AS revert_category, false AS clears_party FROM changed WHERE category <> first_category
        UNION ALL SELECT c.scenario_id, c.txn_id, CASE WHEN kind = 'cutoff' THEN 'cutoff' ELSE 'reclassified' END, CASE WHEN kind = 'cutoff' THEN 3 ELSE 5 END, pos, CASE WHEN kind <> 'cutoff' THEN first_category END, false
          FROM notes JOIN changed c ON c.txn_id = target_txn_id
        UNION ALL SELECT scenario_id, txn_id, CASE WHEN party = 'related' THEN 'related_party' ELSE party END, 2, 1000000000, NULL, true FROM changed WHERE party IS NOT NULL),
      best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scenario_id, txn_id ORDER BY weight DESC, seq) AS nth FROM candidates) WHERE nth = 1),
      base AS ({_OWN.format(more='', source='changed')}),
      moved AS (SELECT b.scenario_id, b.txn_id AS candidate, b.basis, b.weight, l.amount, l.date, l.scope, l.excluded OR l.txn_id = b.txn_id AND b.revert_category IS NULL AND NOT b.clears_party AS excluded,
          CASE WHEN l.txn_id = b.txn_id THEN coalesce(b.revert_category, l.category) ELSE l.category END AS category, CASE WHEN l.txn_id = b.txn_id AND b.clears_party THEN NULL ELSE l.party END AS party
        FROM best b JOIN changed l ON l.scenario_id = b.scenario_id WHERE b.basis NOT IN ('related_party', 'unrestricted_subsidiary')),
      again AS ({_OWN.format(more='candidate, basis, weight, ', source='moved')}),
      each AS (SELECT a.scenario_id, candidate, basis, weight, unnest(['6.1', '6.2', '6.3']) AS point, unnest([a.b1 <> base.b1, a.b2 <> base.b2, a.b3 <> base.b3]) AS flips FROM again a JOIN base ON base.scenario_id = a.scenario_id),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY scenario_id, point ORDER BY weight DESC, candidate) AS nth, count(*) OVER (PARTITION BY scenario_id, point) AS n_flips,
        count(*) OVER (PARTITION BY scenario_id, point, weight) AS n_equal FROM each WHERE flips)
      SELECT scenario_id, point, candidate AS txn_id, basis, weight, n_flips, n_equal FROM ranked WHERE nth = 1""",
    ledger=True,
)
def run_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No test here reads a party, so candidates by party decide nothing; the SQL leaves them out of what it works out again."""
    return settle(_own_inputs(spark, sf_dir)).evidence
