"""Queries over the ledger view: aggregates, verdicts, decisive rows, tagging, review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.functions.dates import overlap_days
from tallymark.operators import covenants as C
from tallymark.operators import review as R
from tallymark.operators import tagging as T
from tallymark.plans.metric import Request
from tallymark.registry import query
from tallymark.sources.ledger_view import CATEGORIES, ledger, read
from tallymark.tables import Store

AGG = lambda category, **more: {"op": "AGG", "category": category, **more}
DIV = lambda a, b: {"op": "DIV", "args": [a, b]}
YEAR = ("1999-01-01", "1999-12-31")


def _sums(spark: SparkSession, sf_dir: str, requests: list[Request], by=("scenario_id",)) -> DataFrame:
    found = C.answer(ledger(spark, sf_dir), requests, by)
    each = found.select(*by, F.explode("sums").alias("key", "total"), "counts")
    return each.select(*by, "key", F.abs(F.coalesce("total", F.lit(0.0))).alias("value"), F.col("counts")[F.col("key")].alias("n_rows"))


_SUM = "SELECT scenario_id, '{key}' AS key, CAST(abs(coalesce(sum(amount) FILTER ({where}), 0)) AS DOUBLE) AS value, count(*) FILTER ({where}) AS n_rows FROM ledger GROUP BY scenario_id"


@query(" UNION ALL ".join(_SUM.format(key=f"{c}|borrower|*|*|*", where=f"WHERE NOT excluded AND scope = 'borrower' AND category = '{c}'") for c in CATEGORIES), ledger=True)
def agg_abs_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(spark, sf_dir, [Request(c) for c in CATEGORIES])


@query(_SUM.format(key="any|borrower|*|*|*", where="WHERE NOT excluded AND scope = 'borrower'"), ledger=True)
def agg_any_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(spark, sf_dir, [Request("any")])


@query(_SUM.format(key="any|borrower|related|*|*", where="WHERE NOT excluded AND scope = 'borrower' AND party = 'related'"), ledger=True)
def agg_related_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(spark, sf_dir, [Request("any", party="related")])


@query(_SUM.format(key="capex|group|*|*|*", where="WHERE NOT excluded AND scope = 'group' AND category = 'capex'").replace("scenario_id", "region_id"), ledger=True)
def agg_group_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(spark, sf_dir, [Request("capex", "group")], ("region_id",))


@query(_SUM.format(key="revenue|borrower|*|1998-04-01|1998-06-30", where="WHERE NOT excluded AND scope = 'borrower' AND category = 'revenue' AND date BETWEEN DATE '1998-04-01' AND DATE '1998-06-30'"), ledger=True)
def agg_quarter_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(spark, sf_dir, [Request("revenue", start="1998-04-01", end="1998-06-30")])


@query("SELECT scenario_id, category, count(*) AS n_excluded, CAST(sum(amount) AS DOUBLE) AS excluded_amount FROM ledger WHERE excluded GROUP BY ALL", ledger=True)
def agg_excluded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(spark, sf_dir).where("excluded").groupBy("scenario_id", "category").agg(F.count("*").alias("n_excluded"), F.sum("amount").cast("double").alias("excluded_amount"))


@query("SELECT scenario_id, category, array_to_string(list(txn_id ORDER BY txn_id), ',') AS txn_ids FROM ledger WHERE party = 'related' AND NOT excluded GROUP BY ALL", ledger=True)
def agg_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(spark, sf_dir).where("party = 'related' AND NOT excluded")
    return rows.groupBy("scenario_id", "category").agg(F.array_join(F.sort_array(F.collect_list("txn_id")), ",").alias("txn_ids"))


def _tests(spark: SparkSession, sf_dir: str, *tests: C.Covenant, disclosed: DataFrame | None = None) -> DataFrame:
    return C.verdicts(ledger(spark, sf_dir), list(tests), disclosed).select("scenario_id", "point", "status", "actual", "condition_met")


def _magnitude(category: str, more: str = "", scope: str = "borrower") -> str:
    only = "" if category == "any" else f" AND category = '{category}'"
    return f"CAST(abs(coalesce(sum(amount) FILTER (WHERE NOT excluded AND scope = '{scope}'{only}{more}), 0)) AS DOUBLE)"


def _verdict(metric: str, direction: str, threshold: float, point: str, condition: str = "TRUE", source: str = "") -> str:
    sign = ">" if direction == "max" else "<"
    return f"""SELECT scenario_id, '{point}' AS point, CASE WHEN c AND abs(m) {sign} {threshold} THEN 'BREACH' ELSE 'COMPLIANT' END AS status,
      CASE WHEN isfinite(m) THEN round(abs(m), 2) END AS actual, c AS condition_met
      FROM (SELECT scenario_id, {metric} AS m, {condition} AS c FROM ledger {source} GROUP BY scenario_id)"""


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} <> 0 THEN {a} / {b} WHEN {a} > 0 THEN CAST('inf' AS DOUBLE) ELSE 0.0 END"


_EBITDA = f"({_magnitude('revenue')} - {_magnitude('opex')} - {_magnitude('payroll')})"
EBITDA = {"op": "SUB", "args": [AGG("revenue"), AGG("opex"), AGG("payroll")]}


@query(_verdict(_ratio(_EBITDA, _magnitude("interest")), "min", 0.5, "6.1"), ledger=True)
def ratio_ebitda_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tests(spark, sf_dir, C.Covenant("6.1", "min", 0.5, DIV(EBITDA, AGG("interest"))))


_NEVER = " AND date BETWEEN DATE '1970-01-01' AND DATE '1970-12-31'"


@query(_verdict(_ratio(_magnitude("revenue"), _magnitude("lease", _NEVER)), "max", 3.0, "6.2"), ledger=True)
def ratio_zero_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tests(spark, sf_dir, C.Covenant("6.2", "max", 3.0, DIV(AGG("revenue"), AGG("lease", period=("1970-01-01", "1970-12-31")))))


@query(_verdict(f"greatest({_magnitude('lease')}, {_magnitude('insurance')}, {_magnitude('utilities')})", "max", 2e6, "6.3"), ledger=True)
def max_of_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tests(spark, sf_dir, C.Covenant("6.3", "max", 2e6, {"op": "MAX", "args": [AGG("lease"), AGG("insurance"), AGG("utilities")]}))


@query(_verdict(f"{_magnitude('revenue')} - greatest({_magnitude('opex')}, {_magnitude('capex')})", "min", 1e5, "6.4"), ledger=True)
def revenue_minus_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tests(spark, sf_dir, C.Covenant("6.4", "min", 1e5, {"op": "SUB", "args": [AGG("revenue"), {"op": "MAX", "args": [AGG("opex"), AGG("capex")]}]}))


@query(_verdict(f"least({_magnitude('taxes')}, {_magnitude('marketing')}) * 2.0 + abs({_magnitude('lease')} - {_magnitude('insurance')})", "max", 1e6, "6.5"), ledger=True)
def min_mul_abs_const(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = {"op": "MUL", "args": [{"op": "MIN", "args": [AGG("taxes"), AGG("marketing")]}, {"op": "CONST", "value": 2.0}]}
    return _tests(spark, sf_dir, C.Covenant("6.5", "max", 1e6, {"op": "ADD", "args": [product, {"op": "ABS", "args": [{"op": "SUB", "args": [AGG("lease"), AGG("insurance")]}]}]}))


@query(
    _verdict(f"{_magnitude('lease')} + coalesce(max(abs(d)), 0)", "max", 5e5, "6.6", source="LEFT JOIN (SELECT 'N' || n_nationkey AS sid, CAST(-1000.5 * n_nationkey AS DOUBLE) AS d FROM nation WHERE n_nationkey % 2 = 0) ON sid = scenario_id"), ledger=True
)
def add_disclosed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").where("n_nationkey % 2 = 0")
    amounts = nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("scenario_id"), F.lit("add_back").alias("key"), (F.lit(-1000.5) * F.col("n_nationkey")).alias("amount"))
    metric = {"op": "ADD", "args": [AGG("lease"), {"op": "DISCLOSED", "key": "add_back"}]}
    return _tests(spark, sf_dir, C.Covenant("6.6", "max", 5e5, metric), disclosed=amounts)


@query(_verdict(_ratio(_magnitude("capex"), _magnitude("revenue")), "max", 0.9, "6.7", f"{_magnitude('financing_inflow')} > 1000000.0"), ledger=True)
def springing_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tests(spark, sf_dir, C.Covenant("6.7", "max", 0.9, DIV(AGG("capex"), AGG("revenue")), condition=AGG("financing_inflow"), condition_threshold=1e6))


_IN_YEAR = " AND date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'"
VERDICTS = [
    C.Covenant("6.1", "max", 3e6, AGG("opex"), YEAR),
    C.Covenant("6.2", "min", 0.8, DIV(AGG("revenue"), AGG("opex")), YEAR),
    C.Covenant("6.3", "max", 2e5, AGG("any", party="related"), YEAR),
]
_VERDICTS_SQL = " UNION ALL ".join(
    [
        _verdict(_magnitude("opex", _IN_YEAR), "max", 3e6, "6.1"),
        _verdict(_ratio(_magnitude("revenue", _IN_YEAR), _magnitude("opex", _IN_YEAR)), "min", 0.8, "6.2"),
        _verdict(_magnitude("any", " AND party = 'related'" + _IN_YEAR), "max", 2e5, "6.3"),
    ]
)


@query(_VERDICTS_SQL, ledger=True)
def covenant_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tests(spark, sf_dir, *VERDICTS)


@query(
    f"""WITH empty AS (SELECT scenario_id, unnest(['6.1', '6.2']) AS point, unnest([r, r]) AS n FROM (
        SELECT scenario_id, count(*) FILTER (WHERE NOT excluded AND scope = 'borrower' AND party = 'related' AND category = 'taxes'{_IN_YEAR}) AS r FROM ledger GROUP BY scenario_id))
      SELECT scenario_id, min(point) AS point, 'taxes|borrower|related|1999-01-01|1999-12-31' AS key FROM empty WHERE n = 0 GROUP BY scenario_id""",
    ledger=True,
)
def empty_aggregate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaf = AGG("taxes", party="related")
    tests = [C.Covenant("6.1", "max", 1.0, leaf, YEAR), C.Covenant("6.2", "max", 1.0, DIV(leaf, AGG("revenue")), YEAR)]
    cells = C.verdicts(ledger(spark, sf_dir), tests).withColumn("missing", F.array_join(F.filter(F.split("missing", ","), lambda k: k.startswith("taxes")), ","))
    return C.first_reports(cells)


@query("SELECT txn_id, scenario_id FROM ledger WHERE scenario_id IN (SELECT 'N' || n_nationkey FROM nation WHERE n_regionkey = 1)", ledger=True)
def noise_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = read(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("scenario_id"))
    return T.in_template(ledger(spark, sf_dir), template).select("txn_id", "scenario_id")


@query("SELECT CASE WHEN len(string_split(txn_id, '-')) >= 3 THEN string_split(txn_id, '-')[2] ELSE '' END AS scenario, count(*) AS n_rows FROM ledger GROUP BY ALL", ledger=True)
def scenario_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(spark, sf_dir).select(T.scenario_of(F.col("txn_id")).alias("scenario")).groupBy("scenario").agg(F.count("*").alias("n_rows"))


@query(
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN NULL ELSE value END AS amount,
      (event_id % 5 <> 0 AND event_id % 7 = 0) AS bad FROM events"""
)
def amount_try_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 5 == 0, "  ").when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    rows = read(spark, sf_dir, "events").select("event_id", text.alias("raw"))
    amount = T.parse_amount(F.col("raw"))
    return rows.select("event_id", amount.alias("amount"), (amount.isNull() & (F.trim("raw") != "")).alias("bad"))


@query(
    """SELECT e.event_id, CASE WHEN user_id % 4 = 0 OR rate IS NULL THEN CAST(value AS DOUBLE) ELSE CAST(round(CAST(value AS DECIMAL(18,4)) * CAST(rate AS DECIMAL(18,6)), 2) AS DOUBLE) END AS amount_usd,
      (user_id % 4 <> 0 AND rate IS NULL) AS fx_missing FROM events e LEFT JOIN (VALUES (1, 1.25), (2, 0.5)) r(k, rate) ON user_id % 4 = k"""
)
def fx_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    currency = F.element_at(F.array(*map(F.lit, ("USD", "EUR", "KZT", "RUB"))), (F.col("user_id") % 4 + 1).cast("int"))
    rows = read(spark, sf_dir, "events").select("event_id", currency.alias("currency"), F.col("value").alias("amount"))
    rates = spark.createDataFrame([("EUR", 1.25), ("KZT", 0.5)], "currency string, rate double")
    return T.convert(rows, rates).select("event_id", "amount_usd", "fx_missing")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_txn_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.repeated_ids(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("WITH n AS (SELECT counterparty, scenario_id, count(*) AS n FROM ledger GROUP BY ALL) SELECT counterparty, count(*) AS holders, CAST(sum(n) AS BIGINT) AS n_rows FROM n GROUP BY counterparty HAVING count(*) > 1", ledger=True)
def shared_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(spark, sf_dir).groupBy("counterparty").agg(F.countDistinct("scenario_id").alias("holders"), F.count("*").alias("n_rows")).where("holders > 1")


@query(
    """WITH n AS (SELECT l_suppkey, o_custkey % 25 AS scn, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
      SELECT l_suppkey, n AS votes, scn FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, scn) AS nth FROM n) WHERE nth = 1"""
)
def account_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    n = line.join(orders, line.l_orderkey == orders.o_orderkey).groupBy("l_suppkey", (F.col("o_custkey") % 25).alias("scn")).agg(F.count("*").alias("votes"))
    return n.groupBy("l_suppkey").agg(F.max(F.struct("votes", (-F.col("scn")).alias("minus"))).alias("best")).select("l_suppkey", F.col("best.votes").alias("votes"), (-F.col("best.minus")).alias("scn"))


_NAME = "lower(trim(regexp_replace(regexp_replace(replace(name, 'L.L.P.', 'LLP'), '[.,;:\"]', ' ', 'g'), '\\s+', ' ', 'g')))"


@query(
    f"""WITH names AS (SELECT s_suppkey, s_nationkey, s_suppkey % 3 AS form, s_name AS plain,
        CASE s_suppkey % 3 WHEN 0 THEN '"' || s_name || '" L.L.P.' WHEN 1 THEN s_name || ',LLP' ELSE s_name || '  JSC' END AS name FROM supplier),
      norm AS (SELECT s_suppkey, s_nationkey, {_NAME} AS norm FROM names),
      entity AS (SELECT s_suppkey, s_nationkey, plain || ' LLP' AS name, lower(plain || ' LLP') AS norm, lower(plain) AS core FROM names)
      SELECT n.s_suppkey, coalesce(e.name, c.name) AS entity FROM norm n
      LEFT JOIN entity e ON e.s_nationkey = n.s_nationkey AND e.norm = n.norm
      LEFT JOIN entity c ON c.s_nationkey = n.s_nationkey AND c.core = trim(regexp_replace(n.norm, '( (jsc|llp))+$', ''))"""
)
def entity_match_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") % 3
    written = F.when(k == 0, F.concat(F.lit('"'), "s_name", F.lit('" L.L.P.'))).when(k == 1, F.concat("s_name", F.lit(",LLP"))).otherwise(F.concat("s_name", F.lit("  JSC")))
    rows = supplier.select("s_suppkey", F.col("s_nationkey").alias("scenario_id"), written.alias("counterparty"))
    entities = supplier.select(F.col("s_nationkey").alias("scenario_id"), F.concat("s_name", F.lit(" LLP")).alias("name"), F.col("s_suppkey").alias("pos"))
    return T.match_entities(rows, entities).select("s_suppkey", "entity")


def _notes(rows: DataFrame) -> DataFrame:
    """One note for each account of a ledger whose key ends in 0 to 3, about its first row: addressed in four ways."""
    picked = rows.groupBy("scenario_id", "account_id").agg(F.min(F.struct("txn_id", "counterparty", "amount")).alias("r"))
    n = F.substring(F.col("account_id"), 5, 9).cast("int")
    picked = picked.where(n % 10 < 4).withColumn("way", n % 10)
    way = F.col("way")
    return picked.select(
        F.concat(F.lit("note-"), "account_id").alias("note_id"), "scenario_id", n.alias("pos"), F.when(n % 3 == 0, "cutoff").otherwise("reclassification").alias("kind"), F.when(n % 7 == 0, "rejected").otherwise("applied").alias("status"),
        F.when(way == 0, F.col("r.txn_id")).alias("target_txn_id"), F.when(way.isin(1, 2), F.col("r.counterparty")).alias("target_counterparty"),
        F.when(way == 1, F.abs("r.amount")).when(way == 2, F.lit(0.01).cast("decimal(18,4)")).when(way == 3, F.abs("r.amount")).alias("value"), F.when(n % 4 != 1, "other").alias("to_category"),
    )


_NOTES = """WITH picked AS (SELECT scenario_id, account_id, min(struct_pack(txn_id := txn_id, counterparty := counterparty, amount := amount)) AS r FROM ledger GROUP BY ALL),
  numbered AS (SELECT *, CAST(substr(account_id, 5) AS INT) AS pos FROM picked),
  notes AS (SELECT 'note-' || account_id AS note_id, scenario_id, pos, CASE WHEN pos % 3 = 0 THEN 'cutoff' ELSE 'reclassification' END AS kind,
    CASE WHEN pos % 7 = 0 THEN 'rejected' ELSE 'applied' END AS status, CASE WHEN pos % 10 = 0 THEN r.txn_id END AS target_txn_id,
    CASE WHEN pos % 10 IN (1, 2) THEN r.counterparty END AS target_counterparty,
    CASE pos % 10 WHEN 1 THEN abs(r.amount) WHEN 2 THEN 0.01 WHEN 3 THEN abs(r.amount) END AS value, CASE WHEN pos % 4 <> 1 THEN 'other' END AS to_category FROM numbered WHERE pos % 10 < 4),
  hits AS (
    SELECT note_id, txn_id, 1 AS tier FROM notes JOIN ledger USING (scenario_id) WHERE target_txn_id = txn_id
    UNION ALL SELECT note_id, txn_id, CASE WHEN abs(abs(amount) - value) < 0.01 THEN 2 ELSE 3 END FROM notes JOIN ledger USING (scenario_id) WHERE target_counterparty = counterparty
    UNION ALL SELECT note_id, min(txn_id), 4 FROM notes JOIN ledger USING (scenario_id) WHERE abs(abs(amount) - value) < 0.01 GROUP BY note_id HAVING count(*) = 1),
  addressed AS (SELECT DISTINCT note_id, txn_id, tier FROM (SELECT *, min(tier) OVER (PARTITION BY note_id) AS best FROM hits) WHERE tier = best)"""


@query(f"{_NOTES} SELECT note_id, txn_id, tier FROM addressed", ledger=True)
def note_addressing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(spark, sf_dir)
    return T.address_notes(_notes(rows), rows)


@query(
    f"""{_NOTES}, acting AS (SELECT * FROM notes JOIN addressed USING (note_id) WHERE status = 'applied' AND (kind = 'cutoff' OR to_category IS NOT NULL)),
      changed AS (SELECT l.scenario_id, amount, excluded OR c.txn_id IS NOT NULL AS excluded, coalesce(m.to_category, category) AS category FROM ledger l
        LEFT JOIN (SELECT DISTINCT txn_id FROM acting WHERE kind = 'cutoff') c ON c.txn_id = l.txn_id
        LEFT JOIN (SELECT txn_id, arg_max(to_category, pos) AS to_category FROM acting WHERE kind = 'reclassification' GROUP BY txn_id) m ON m.txn_id = l.txn_id)
      SELECT scenario_id, category, count(*) FILTER (WHERE excluded) AS n_excluded, CAST(sum(amount) AS DOUBLE) AS total FROM changed GROUP BY ALL""",
    ledger=True,
)
def reclass_and_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Notes, addresses and the result all read the ledger: its joins are worked out once.
    store = Store(spark, "reclass")
    rows = store.put(ledger(spark, sf_dir).select("scenario_id", "account_id", "txn_id", "counterparty", "category", "amount", "excluded"))
    notes = store.put(_notes(rows))
    changed = T.apply_notes(rows, notes, T.address_notes(notes, rows))
    return changed.groupBy("scenario_id", "category").agg(F.count_if("excluded").alias("n_excluded"), F.sum("amount").cast("double").alias("total"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN TRUE WHEN s_suppkey % 13 = 0 THEN FALSE ELSE (s_acctbal + 1000) / 110 >= 20 + s_nationkey % 21 END AS related FROM supplier")
def related_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.when(F.col("s_suppkey") % 13 != 0, (F.col("s_acctbal") + 1000) / 110)
    basis = F.when(F.col("s_suppkey") % 11 == 0, "common control")
    return read(spark, sf_dir, "supplier").select("s_suppkey", T.is_related(share, (20 + F.col("s_nationkey") % 21).cast("double"), basis).alias("related"))


@query("SELECT o_orderkey, (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' AND (o_custkey % 9 = 0 OR o_totalprice < 100000)) AS falls FROM orders")
def materiality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "ebitda_adjustment").otherwise("off_ledger")
    status = F.when(F.col("o_orderstatus") == "O", "applied").otherwise("rejected")
    value = F.when(F.col("o_custkey") % 9 != 0, F.col("o_totalprice"))
    return read(spark, sf_dir, "orders").select("o_orderkey", T.immaterial(kind, status, value, F.lit(100000.0)).alias("falls"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every related row may have been an ordinary one; rows of 1999 with quantity-like ids may belong to another category."""
    rows = ledger(spark, sf_dir)
    related = rows.where("party = 'related'").select("scenario_id", "txn_id", F.lit("related_party").alias("basis"), F.lit(2).alias("weight"), F.lit(1).alias("seq"), F.lit(None).cast("string").alias("revert_category"), F.lit(True).alias("clears_party"))
    moved = rows.where("category = 'capex' AND txn_id LIKE '%7'").select("scenario_id", "txn_id", F.lit("reclassified"), F.lit(5), F.lit(2), F.lit("opex"), F.lit(False))
    cut = rows.where("party = 'related' AND txn_id LIKE '%3'").select("scenario_id", "txn_id", F.lit("cutoff"), F.lit(3), F.lit(3), F.lit(None).cast("string"), F.lit(False))
    return related.union(moved).union(cut)


_CANDIDATES = """WITH candidates AS (
  SELECT scenario_id, txn_id, 'related_party' AS basis, 2 AS weight, 1 AS seq, NULL AS revert_category, TRUE AS clears_party FROM ledger WHERE party = 'related'
  UNION ALL SELECT scenario_id, txn_id, 'reclassified', 5, 2, 'opex', FALSE FROM ledger WHERE category = 'capex' AND txn_id LIKE '%7'
  UNION ALL SELECT scenario_id, txn_id, 'cutoff', 3, 3, NULL, FALSE FROM ledger WHERE party = 'related' AND txn_id LIKE '%3'),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scenario_id, txn_id ORDER BY weight DESC, seq) AS nth FROM candidates) WHERE nth = 1)"""


@query(f"{_CANDIDATES} SELECT scenario_id, txn_id, basis, weight FROM best", ledger=True)
def evidence_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.best_basis(_candidates(spark, sf_dir)).select("scenario_id", "txn_id", "basis", "weight")


@query(
    f"""{_CANDIDATES},
      base AS (SELECT scenario_id, abs(coalesce(sum(amount) FILTER (WHERE NOT excluded AND scope = 'borrower' AND party = 'related'), 0)) AS m FROM ledger GROUP BY ALL),
      again AS (SELECT b.scenario_id, b.txn_id, b.basis, b.weight, abs(coalesce(sum(l.amount) FILTER (WHERE NOT l.excluded AND l.scope = 'borrower' AND (l.txn_id <> b.txn_id AND l.party = 'related'
          OR l.txn_id = b.txn_id AND NOT b.clears_party AND b.revert_category IS NOT NULL AND l.party = 'related')), 0)) AS m
        FROM best b JOIN ledger l ON l.scenario_id = b.scenario_id WHERE l.party = 'related' OR l.txn_id = b.txn_id GROUP BY ALL),
      flips AS (SELECT a.*, row_number() OVER (PARTITION BY a.scenario_id ORDER BY weight DESC, txn_id) AS nth, count(*) OVER (PARTITION BY a.scenario_id) AS n_flips
        FROM again a JOIN base ON base.scenario_id = a.scenario_id WHERE (base.m > 200000) <> (a.m > 200000))
      SELECT scenario_id, txn_id, basis, weight, n_flips FROM flips WHERE nth = 1""",
    ledger=True,
)
def evidence_decisive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.decisive(ledger(spark, sf_dir), C.best_basis(_candidates(spark, sf_dir)), Request("any", party="related"), 200000, "max")


_START, _END = "DATE '1998-01-01'", "DATE '1998-12-31'"


@query(
    f"""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY greatest(0, date_diff('day', greatest(d, {_START}), least(d + 180, {_END})) + 1) DESC, o_orderkey) AS nth
      FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)) WHERE nth = 1"""
)
def active_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    shared = overlap_days(d, F.date_add(d, 180), F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date"))
    return T.last_by(read(spark, sf_dir, "orders"), ["o_custkey"], [shared.desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query(
    """SELECT o_custkey, o_orderkey, nth > 1 AS stale FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate BETWEEN DATE '1998-01-01' - 45 AND DATE '1998-12-31' + 45 DESC, o_orderdate DESC, o_orderkey) AS nth FROM orders)"""
)
def latest_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    inside = (d >= F.date_sub(F.lit("1998-01-01").cast("date"), 45)) & (d <= F.date_add(F.lit("1998-12-31").cast("date"), 45))
    order = Window.partitionBy("o_custkey").orderBy(inside.desc(), d.desc(), "o_orderkey")
    return read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.row_number().over(order) > 1).alias("stale"))


@query(f"SELECT o_orderkey, CAST(greatest(0, date_diff('day', greatest(d, {_START}), least(d + 90, {_END})) + 1) AS INT) AS days FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def overlap_days_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    return read(spark, sf_dir, "orders").select("o_orderkey", overlap_days(d, F.date_add(d, 90), F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date")).alias("days"))


@query(
    """WITH days AS (SELECT * FROM ledger WHERE date BETWEEN DATE '1995-03-01' AND DATE '1995-03-14'), n AS (SELECT scenario_id, category, count(*) AS n FROM days WHERE NOT excluded GROUP BY ALL),
      grid AS (SELECT s.scenario_id, c.category, coalesce(n, 0) AS n FROM (SELECT DISTINCT scenario_id FROM days) s CROSS JOIN (SELECT DISTINCT category FROM days) c LEFT JOIN n ON n.scenario_id = s.scenario_id AND n.category = c.category),
      mid AS (SELECT category, median(n) AS median FROM grid GROUP BY category HAVING count(*) >= 3)
      SELECT scenario_id, n.category, n, median FROM n JOIN mid ON mid.category = n.category WHERE n >= 2 AND n >= 2 * median""",
    ledger=True,
)
def category_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A fortnight: over all years every borrower books each category about equally often.
    return R.category_outliers(ledger(spark, sf_dir).where("date BETWEEN DATE '1995-03-01' AND DATE '1995-03-14'"))


@query(
    """WITH v AS (SELECT scenario_id, category, CAST(abs(sum(amount)) AS DOUBLE) AS v FROM ledger GROUP BY ALL)
      SELECT scenario_id, round(CASE WHEN max(v) > 0 THEN sum(v) / max(v) ELSE 1.0 END, 9) AS amplification FROM v GROUP BY scenario_id""",
    ledger=True,
)
def amplification(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = ledger(spark, sf_dir).groupBy("scenario_id", "category").agg(F.abs(F.sum("amount")).cast("double").alias("v"))
    return v.groupBy("scenario_id").agg(F.collect_list("v").alias("v")).select("scenario_id", F.round(R.amplification(F.col("v")), 9).alias("amplification"))


def _result(sql: str) -> str:
    return f"""WITH cells AS ({sql}), thr AS (SELECT unnest(['6.1', '6.2', '6.3']) AS point, unnest([3000000.0, 0.8, 200000.0])::DOUBLE AS t)"""


@query(
    _result(_VERDICTS_SQL)
    + """, exact AS (SELECT *, abs(CAST(actual AS DECIMAL(28,8))) AS a, CAST(t AS DECIMAL(28,8)) AS b FROM cells c JOIN thr ON thr.point = c.point),
      s AS (SELECT scenario_id, c.point, CASE WHEN actual IS NULL THEN 1.0 WHEN a > b * 5 OR a * 5 < b THEN 0.9 WHEN abs(a - b) * 100 <= b * 5 THEN 0.7 WHEN abs(a - b) * 100 <= b * 10 THEN 0.25 ELSE 0 END
        + CASE WHEN status = 'BREACH' THEN 0.25 ELSE 0 END AS risk FROM (SELECT scenario_id, point, status, actual, a, b FROM exact) c)
      SELECT scenario_id, point, CAST(round(risk, 4) AS DOUBLE) AS risk, CAST(row_number() OVER (ORDER BY round(risk, 4) DESC, scenario_id, point) AS INT) AS place FROM s""",
    ledger=True,
)
def risk_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = C.verdicts(ledger(spark, sf_dir), VERDICTS)
    names = R.signals(F.col("actual"), F.col("threshold"), F.col("status"), F.lit(None).cast("string"))
    return R.places(cells.select("scenario_id", "point", R.risk(names).alias("risk")))


def _template(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("scenario_id"))
    return nations.select("scenario_id", F.explode(F.array(*map(F.lit, ("6.1", "6.3", "6.9")))).alias("point"))


_TEMPLATE = ", template AS (SELECT 'N' || n_nationkey AS scenario_id, unnest(['6.1', '6.3', '6.9']) AS point FROM nation)"


@query(
    _result(_VERDICTS_SQL) + _TEMPLATE + """ SELECT t.scenario_id, t.point, coalesce(status, 'COMPLIANT') AS status, coalesce(actual, 0.0) AS actual, (status IS NULL OR actual IS NULL) AS fallback
      FROM template t LEFT JOIN cells c ON c.scenario_id = t.scenario_id AND c.point = t.point""",
    ledger=True,
)
def template_left_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = C.verdicts(ledger(spark, sf_dir), VERDICTS).select("scenario_id", "point", "status", "actual", F.lit(None).cast("string").alias("evidence_txn_id"))
    return R.assemble(_template(spark, sf_dir), results).drop("evidence_txn_id")


@query(
    _result(_VERDICTS_SQL) + _TEMPLATE + """,
      given AS (SELECT scenario_id, point, CASE WHEN scenario_id = 'N3' THEN 'UNKNOWN' ELSE status END AS status, CASE WHEN scenario_id = 'N4' THEN NULL ELSE actual + CASE WHEN scenario_id = 'N5' THEN 0.001 ELSE 0 END END AS actual,
        CASE WHEN scenario_id = 'N6' THEN 'TXN-N6-0' WHEN scenario_id = 'N8' THEN (SELECT min(txn_id) FROM ledger WHERE scenario_id = 'N7') END AS evidence FROM cells)
      SELECT scenario_id, point, 'ERROR' AS level, 'missing_cell' AS code FROM template t WHERE NOT EXISTS (SELECT 1 FROM given g WHERE g.scenario_id = t.scenario_id AND g.point = t.point)
      UNION ALL SELECT scenario_id, point, 'WARN', 'extra_cell' FROM given g WHERE NOT EXISTS (SELECT 1 FROM template t WHERE g.scenario_id = t.scenario_id AND g.point = t.point)
      UNION ALL SELECT scenario_id, point, 'ERROR', 'bad_status' FROM given WHERE status NOT IN ('COMPLIANT', 'BREACH')
      UNION ALL SELECT scenario_id, point, 'ERROR', 'bad_actual' FROM given WHERE actual IS NULL OR actual < 0
      UNION ALL SELECT scenario_id, point, 'WARN', 'too_many_decimals' FROM given WHERE actual <> round(actual, 2)
      UNION ALL SELECT g.scenario_id, point, 'ERROR', CASE WHEN l.txn_id IS NULL THEN 'unknown_evidence' ELSE 'foreign_evidence' END FROM given g LEFT JOIN (SELECT DISTINCT txn_id, scenario_id FROM ledger) l ON l.txn_id = evidence
        WHERE evidence IS NOT NULL AND (l.txn_id IS NULL OR l.scenario_id <> g.scenario_id)""",
    ledger=True,
)
def submission_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(spark, sf_dir)
    results = C.verdicts(rows, VERDICTS)
    own = rows.where("scenario_id = 'N7'").agg(F.min("txn_id").alias("t"))
    sid = F.col("scenario_id")
    actual = F.when(sid != "N4", F.col("actual") + F.when(sid == "N5", 0.001).otherwise(0.0))
    given = results.crossJoin(own).select(sid, "point", F.when(sid == "N3", "UNKNOWN").otherwise(F.col("status")).alias("status"), actual.alias("actual"), F.when(sid == "N6", "TXN-N6-0").when(sid == "N8", F.col("t")).alias("evidence_txn_id"))
    owners = rows.select("txn_id", F.col("scenario_id").alias("owner"))
    return R.violations(_template(spark, sf_dir), given, owners)


_SCORES = """, key AS (SELECT scenario_id, point, status, actual FROM cells), given AS (SELECT scenario_id, point, CASE WHEN scenario_id = 'N3' THEN 'NONE' ELSE status END AS s, actual * CASE WHEN point = '6.1' THEN 1.02 ELSE 1 END AS a FROM cells WHERE scenario_id <> 'N9'),
  marks AS (SELECT k.scenario_id, k.point, CASE WHEN s = status THEN 0.5 ELSE 0 END::DOUBLE AS status_marks, CASE WHEN s = status THEN greatest(0, 1 - (CASE WHEN actual = 0 THEN CASE WHEN a = 0 THEN 0 ELSE 1 END ELSE abs(a - actual) / abs(actual) END) / 0.05) ELSE 0 END AS close
    FROM key k LEFT JOIN given g ON g.scenario_id = k.scenario_id AND g.point = k.point)"""


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = C.verdicts(ledger(spark, sf_dir), VERDICTS).select("scenario_id", "point", "status", "actual", F.lit(None).cast("string").alias("evidence_txn_id"))
    sid = F.col("scenario_id")
    given = key.where(sid != "N9").select(sid, "point", F.when(sid == "N3", "NONE").otherwise(F.col("status")).alias("status"), (F.col("actual") * F.when(F.col("point") == "6.1", 1.02).otherwise(1.0)).alias("actual"), "evidence_txn_id")
    return R.score(key, given)


@query(_result(_VERDICTS_SQL) + _SCORES + " SELECT scenario_id, point, status_marks, round(0.3 * coalesce(close, 0), 4) AS actual_marks, round(0.2 * coalesce(close, 0), 4) AS evidence_marks FROM marks", ledger=True)
def score_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("scenario_id", "point", "status_marks", F.round("actual_marks", 4).alias("actual_marks"), F.round("evidence_marks", 4).alias("evidence_marks"))


@query(_result(_VERDICTS_SQL) + _SCORES + " SELECT point, count(*) AS n_cells, sum(0.5 - status_marks) AS status_loss, round(avg(status_marks + 0.5 * coalesce(close, 0)), 4) AS mean_marks FROM marks GROUP BY point", ledger=True)
def score_loss_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).groupBy("point").agg(F.count("*").alias("n_cells"), F.sum(0.5 - F.col("status_marks")).alias("status_loss"), F.round(F.avg("marks"), 4).alias("mean_marks"))
