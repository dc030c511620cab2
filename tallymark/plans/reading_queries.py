"""Queries that read written-out figures, dates, names and quotes back from texts made of whole tables.

Each query words the rows of a table as a document would and reads them again; its SQL works from the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import text as X
from tallymark.functions.dates import all_dates, coverage, covenant_period, document_date, stated_period
from tallymark.operators import documents as D
from tallymark.operators import entities as E
from tallymark.operators import quality as Q
from tallymark.operators import review as R
from tallymark.operators import tagging as T
from tallymark.operators import trees as Trees
from tallymark.plans.metric import nest, problems
from tallymark.registry import query
from tallymark.sources.ledger_view import CATEGORIES, read


def worded(pattern: str, *values: Column | str) -> Column:
    """A text with values in the places of {}."""
    parts, out = pattern.split("{}"), []
    for i, part in enumerate(parts):
        out += [F.lit(part)] + ([F.col(v) if isinstance(v, str) else v] if i < len(values) and (v := values[i]) is not None else [])
    return F.concat(*[c.cast("string") for c in out])


def dollars(value: Column) -> Column:
    return F.format_number(value, 2)


def K() -> Column:
    return F.col("c_custkey")


def O() -> Column:  # noqa: E743
    return F.col("o_orderkey")


@query(
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'EUR' ELSE 'KZT' END AS currency, CAST(2 + c_custkey % 3 AS DOUBLE) AS rate FROM customer WHERE c_custkey % 4 IN (0, 1)"""
)
def fx_rates_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*map(F.lit, ("EUR", "KZT", "ZZZ", "USD"))), (K() % 4 + 1).cast("int"))
    units = 1000 + K() % 9000
    text = worded("Invoice. The sum of {} {} of the year was settled for ${} in full.", F.format_number(units, 0), code, dollars((units * (2 + K() % 3)).cast("double")))
    pairs = read(spark, sf_dir, "customer").select("c_custkey", F.explode(X.fx_pairs(text)).alias("p"))
    return pairs.select("c_custkey", "p.currency", F.round("p.rate", 6).alias("rate"))


@query(
    """SELECT currency, min(c_custkey) AS doc_id, arg_min(2 + c_custkey % 3, c_custkey) AS rate
      FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'EUR' ELSE 'KZT' END AS currency FROM customer WHERE c_custkey % 4 IN (0, 1)) GROUP BY currency"""
)
def fx_rates_of_first_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*map(F.lit, ("EUR", "KZT", "ZZZ", "USD"))), (K() % 4 + 1).cast("int"))
    text = worded("First 10 {} for $1,000. Then 100 {} cost ${}.", code, code, ((2 + K() % 3) * 100).cast("string"))
    rates = D.fx_rates(read(spark, sf_dir, "customer").select(K().alias("doc_id"), text.alias("text")))
    return rates.select("doc_id", "currency", F.round("rate", 6).cast("int").alias("rate"))


@query(
    """SELECT 'TXN-P' || o_custkey % 5 || '-' || o_orderkey AS txn_id, o_orderkey % 3 = 0 AND o_orderkey % 4 <> 1 AS recovered, o_orderkey % 3 = 0 AND o_orderkey % 4 = 2 AS sign_unknown,
        CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice WHEN o_orderkey % 4 = 0 THEN -o_totalprice WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_totalprice END AS amount FROM orders"""
)
def amount_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumns({"scenario_id": worded("P{}", F.col("o_custkey") % 5), "txn_id": worded("TXN-P{}-{}", F.col("o_custkey") % 5, O())})
    rows = orders.select("txn_id", "scenario_id", F.when(O() % 3 != 0, F.col("o_totalprice")).cast("decimal(18,2)").alias("amount"))
    usd, id_ = dollars(F.col("o_totalprice")), F.col("txn_id")
    text = (
        F.when(O() % 4 == 0, worded("Index: {}; {}777777. An estimate of $1.00 stood; for {} the actual amount of the payment is ${}.", id_, id_, id_, usd))
        .when(O() % 4 == 1, worded("Nothing on {}777777 but $5.00 of cost", id_))
        .when(O() % 4 == 2, worded("As to {}, ${} it was.", id_, usd))
        .otherwise(worded("Receipt: {} came to ${} in income.", id_, usd))
    )
    out = T.recover_amounts(rows, orders.where(O() % 3 == 0).select("scenario_id", worded("d{}", O()).alias("doc_id"), text.alias("text")))
    return out.select("txn_id", "recovered", "sign_unknown", F.col("amount").cast("double").alias("amount"))


@query("SELECT o_orderkey, unnest([0, 1, 2]) AS pos, unnest([d, d + 30, d + 400]) AS d FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def dates_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    text = worded("Signed {}, effective {} (not 2024-13-40); ends {}.", F.date_format(d, "d MMMM yyyy"), F.date_format(F.date_add(d, 30), "yyyy-MM-dd"), F.date_format(F.date_add(d, 400), "MMMM d, yyyy"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.posexplode(all_dates(text)).alias("pos", "d"))


@query("SELECT o_orderkey, o_orderkey % 4 <> 3 AS found FROM orders")
def threshold_appears(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (O() % 50 + 1) * 100000.0
    millions = F.regexp_replace(F.format_string("%.1f", n / 1e6), r"\.0$", "")
    text = F.when(O() % 4 == 0, worded("not over ${} a year", F.format_number(n, 0))).when(O() % 4 == 1, worded("{} million at most", millions)).when(O() % 4 == 2, worded("a sum of {}", n.cast("bigint"))).otherwise("about seven")
    return read(spark, sf_dir, "orders").select("o_orderkey", X.mentions(text, n).alias("found"))


@query("SELECT c_custkey, c_custkey % 3 = 0 AS grounded FROM customer")
def quote_in_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = worded("Section\n12\nThe  Borrower № {} shall keep “{}” – ①low", K(), "c_mktsegment")
    quote = worded('The Borrower No {} shall keep "{}" - 1low', K() + (K() % 3 == 2).cast("int"), "c_mktsegment")
    return read(spark, sf_dir, "customer").select("c_custkey", D.grounded(F.when(K() % 3 == 1, F.lower(quote)).otherwise(quote), source).alias("grounded"))


_BODY = "the ratio of debt stays below its level "


@query(f"SELECT c_custkey, CASE WHEN n >= 400 THEN n ELSE n + {len('Contents COVENANTS 7 END Intro. COVENANTS') + len('END rest')} END AS n FROM (SELECT c_custkey, 1 + {len(_BODY)} * (c_custkey % 20) AS n FROM customer)")
def section_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = worded("Contents COVENANTS 7 END Intro. COVENANTS {}END rest", F.repeat(F.lit(_BODY), (K() % 20).cast("int")))
    return read(spark, sf_dir, "customer").select("c_custkey", F.length(X.section(text, "COVENANTS", "END", 400, 12000)).alias("n"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'SUPPLEMENT' WHEN 1 THEN 'ANNEX' END AS anchor, CASE WHEN c_custkey % 3 < 2 THEN length('SUPPLEMENT x ANNEX') - CASE c_custkey % 3 WHEN 1 THEN length('SUPPLEMENT x ') ELSE 0 END ELSE length('intro  nothing') END AS n FROM customer")
def audit_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(K() % 3 == 0, "intro SUPPLEMENT x ANNEX").when(K() % 3 == 1, "intro ANNEX").otherwise("intro  nothing")
    part, anchor = X.first_anchored(text, ["SUPPLEMENT", "ANNEX"])
    return read(spark, sf_dir, "customer").select("c_custkey", anchor.alias("anchor"), F.length(part).alias("n"))


@query("SELECT c_custkey AS doc_id, 'ACC-' || c_custkey AS account_id FROM customer WHERE c_custkey % 3 <> 0")
def account_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    text = F.when(K() % 3 == 0, worded("only ACC-{}-B and X-ACC-{}", K(), K())).otherwise(worded("See ACC-{}; not X-ACC-{} or ACC-{}-B.", K(), K() + 1, K()))
    return D.attribute_by_account(customer.select(K().alias("doc_id"), text.alias("text")), customer.select(worded("ACC-{}", K()).alias("account_id")))


@query("SELECT c_custkey AS doc_id, unnest(['Alpha LLP', 'Beta Gamma JSC']) AS name, unnest([c_custkey % 100 + 0.5, c_custkey % 37])::DOUBLE AS pct, unnest([c_custkey % 100 + 0.5 < 50, c_custkey % 37 < 50]) AS unrestricted FROM customer")
def pledge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = worded("Pledged shares: Alpha LLP {}% Beta Gamma JSC {}% end. A company is unrestricted if its pledge is below 50%.", K() % 100 + F.lit(0.5), K() % 37)
    return D.pledges(read(spark, sf_dir, "customer").select(K().alias("doc_id"), text.alias("text")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) - (o_orderkey % 1000) + (o_custkey % 100) AS DOUBLE) END AS capex FROM orders")
def group_capex(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(O() % 5 != 0, "There were no disposals.").otherwise("Some assets were sold.")
    text = worded("Property: opening balance ${}; depreciation ${}; closing balance ${}. {}", dollars((O() % 1000).cast("double")), dollars((F.col("o_custkey") % 100).cast("double")), dollars(F.col("o_totalprice")), end)
    return read(spark, sf_dir, "orders").select("o_orderkey", D.roll_forward(text).cast("double").alias("capex"))


@query(
    """SELECT o_orderkey, d AS start, CAST(d + 180 AS DATE) AS "end", d AS dated, least(1.0, 90.0 / 181) < 0.5 AS little FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""
)
def stated_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    text = worded("Agreement. Valid from {} to {} in full.", F.date_format(d, "d MMMM yyyy"), F.date_format(F.date_add(d, 180), "d MMMM yyyy"))
    p = stated_period(text)
    little = coverage(p["start"], p["end"], d, F.date_add(d, 89)) < 0.5
    return read(spark, sf_dir, "orders").select("o_orderkey", p["start"].alias("start"), p["end"].alias("end"), document_date(text).alias("dated"), little.alias("little"))


@query("SELECT o_orderkey, CAST(d + CASE WHEN o_orderkey % 2 = 0 THEN 10 ELSE 0 END AS DATE) AS start FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def covenant_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    drawn = worded("Drawing from {} to {}.", d, F.date_add(d, 30))
    text = F.when(O() % 2 == 0, F.concat(drawn, worded(" FINANCIAL COVENANTS hold from {} to {}.", F.date_add(d, 10), F.date_add(d, 99)))).otherwise(drawn)
    return read(spark, sf_dir, "orders").select("o_orderkey", covenant_period(text, ("Financial Covenants", "FINANCIAL COVENANTS"))["start"].alias("start"))


@query(
    """WITH k AS (SELECT o_orderkey AS k, o_orderkey % 14 AS m FROM orders), codes AS (
        SELECT k, 'r' AS id, CASE WHEN k % 4 = 1 THEN 'cycle' WHEN k % 4 = 2 THEN 'missing_node' WHEN m >= 11 THEN 'too_deep' WHEN k % 6 = 0 THEN 'unknown_op' WHEN k % 4 = 0 THEN 'arity' END AS code FROM k
        UNION ALL SELECT k, 'x', CASE WHEN k % 5 = 0 THEN 'unknown_category' END FROM k WHERE k % 4 = 3 AND m < 11
        UNION ALL SELECT k, 'c' || m, CASE WHEN k % 3 = 0 THEN 'no_number' END FROM k WHERE k % 4 IN (0, 3) AND m < 11
        UNION ALL SELECT k, 'covenant', unnest(CASE k % 7 WHEN 0 THEN ['threshold_not_positive'] WHEN 1 THEN ['threshold_no_number'] WHEN 2 THEN ['ratio_too_large'] ELSE [] END) FROM k
        UNION ALL SELECT k, 'covenant', unnest(CASE WHEN k % 11 = 0 THEN ['period_reversed'] WHEN k % 11 = 1 THEN ['bad_period'] ELSE [] END) FROM k)
      SELECT k AS o_orderkey, id, code FROM codes WHERE code IS NOT NULL"""
)
def spec_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A covenant for every order: a ratio over a chain of nodes, some of them broken in one way or another."""
    orders, k = read(spark, sf_dir, "orders"), O()
    m, none = k % 14, F.lit(None)
    node = lambda i, op, args=none, category=none, value=none: F.struct(i.alias("id"), op.alias("op"), args.cast("array<string>").alias("args"), category.cast("string").alias("category"), value.cast("double").alias("value"))
    second = F.when(k % 4 == 1, F.array(F.lit("r"))).when(k % 4 == 2, F.array(F.lit("ghost"))).when(k % 4 == 3, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    root = node(F.lit("r"), F.when(k % 6 == 0, "POW").otherwise("DIV"), F.concat(F.array(F.lit("c0")), second))
    leaf = node(F.lit("x"), F.lit("AGG"), category=F.when(k % 5 == 0, "gifts").otherwise("revenue"))
    name = lambda i: F.concat(F.lit("c"), i.cast("string"))
    end = node(name(m), F.lit("CONST"), value=F.when(k % 3 != 0, 1.0))
    links = F.transform(F.when(m > 0, F.sequence(F.lit(0).cast("bigint"), m - 1)).otherwise(F.array().cast("array<bigint>")), lambda i: node(name(i), F.lit("ABS"), F.array(name(i + 1))))
    nodes = orders.select(k.alias("tree"), F.explode(F.concat(F.array(root, leaf, end), links)).alias("n")).select("tree", "n.*", F.lit(None).cast("string").alias("key"))
    found = Trees.tree_violations(nodes, orders.select(k.alias("tree"), F.lit("r").alias("root")), CATEGORIES)
    threshold = F.when(k % 7 == 0, "-1").when(k % 7 == 1, "none").when(k % 7 == 2, "5000").otherwise("2.5")
    start = F.col("o_orderdate").cast("date")
    last = F.when(k % 11 == 0, start.cast("string")).when(k % 11 == 1, F.date_format(start, "dd/MM/yyyy")).otherwise(F.date_add(start, 90).cast("string"))
    fields = orders.select(
        k.alias("tree"), k.alias("owner"), F.lit("6.1").alias("point"), threshold.alias("threshold"), F.lit("ratio").alias("unit"), start.cast("string").alias("start"), last.alias("end"),
        F.lit(False).alias("conditional"), F.lit(None).cast("string").alias("condition"),
    )
    told = Trees.covenant_violations(fields, Q.RATIO).select("tree", F.lit("covenant").alias("id"), "code")
    return found.union(told).select(F.col("tree").alias("o_orderkey"), "id", "code")


_POOLS = """notes AS (SELECT 'S' || o_custkey % 25 AS scenario_id, o_orderkey, o_orderkey % 2 = 0 AS off, CAST(o_totalprice AS DECIMAL(18,2)) AS value FROM orders WHERE o_orderstatus = 'F'),
  rows AS (SELECT 'S' || o_custkey % 25 AS scenario_id, CAST(o_totalprice AS DECIMAL(18,2)) AS value FROM orders WHERE o_orderkey % 10 = 2)"""


@query(
    f"""WITH {_POOLS} SELECT scenario_id, 'one_off_items' AS key, CAST(sum(value) AS DOUBLE) AS amount FROM notes WHERE NOT off GROUP BY ALL
      UNION ALL SELECT scenario_id, 'severance_programme', CAST(sum(value) AS DOUBLE) FROM notes WHERE off AND NOT EXISTS (SELECT 1 FROM rows WHERE rows.scenario_id = notes.scenario_id AND rows.value = notes.value) GROUP BY ALL"""
)
def disclosed_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumn("scenario_id", worded("S{}", F.col("o_custkey") % 25))
    notes = orders.select("scenario_id", worded("n{}", O()).alias("note_id"), F.when(O() % 2 == 0, "off_ledger").otherwise("ebitda_adjustment").alias("kind"), F.when(F.col("o_orderstatus") == "F", "applied").otherwise("rejected").alias("status"), F.lit(None).cast("string").alias("target_txn_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("value"))
    rows = orders.where(O() % 10 == 2).select("scenario_id", worded("t{}", O()).alias("txn_id"), (-F.col("o_totalprice")).alias("amount"))
    keys = orders.select("scenario_id").distinct().withColumn("key", F.explode(F.array(*map(F.lit, ("one_off_items", "severance_programme", "mystery")))))
    return E.disclosed(keys, E.note_pools(notes, rows)).withColumn("amount", F.col("amount").cast("double"))


@query(
    """SELECT o_orderkey, unnest(CASE o_orderkey % 6 WHEN 1 THEN ['bad_status'] WHEN 2 THEN ['no_value', 'no_target'] WHEN 3 THEN ['no_categories'] WHEN 4 THEN ['negative_value'] ELSE [] END) AS code FROM orders"""
)
def note_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    way = O() % 6
    kind = F.when(way.isin(2, 5), "missing_amount").when(way == 3, "reclassification").otherwise("off_ledger")
    status = F.when(way == 1, "maybe").when(way == 5, "rejected").otherwise("applied")
    value = F.when(way.isin(0, 3), F.col("o_totalprice")).when(way == 4, -F.col("o_totalprice"))
    none = F.lit(None).cast("string")
    notes = read(spark, sf_dir, "orders").select("o_orderkey", F.lit("A").alias("scenario_id"), O().cast("string").alias("note_id"), kind.alias("kind"), status.alias("status"), value.alias("value"), *[none.alias(c) for c in ("target_txn_id", "target_counterparty", "from_category", "to_category")])
    return Q.note_violations(notes).select(F.col("note_id").cast("long").alias("o_orderkey"), "code")


@query(
    """SELECT c_custkey, unnest(list_filter([CASE WHEN c_acctbal <= 0 THEN 'threshold_not_positive' END, CASE WHEN c_custkey % 3 = 0 AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') THEN 'applied_though_none_required' END],
        lambda c: c IS NOT NULL)) AS code FROM customer"""
)
def statement_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report for every customer; every order is a note of its customer's."""
    statements = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("scenario_id"), F.col("c_acctbal").alias("threshold"), (F.col("c_custkey") % 3 == 0).alias("none_required"))
    notes = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("scenario_id"), F.when(F.col("o_orderstatus") == "F", "applied").otherwise("rejected").alias("status"))
    return Q.statement_violations(statements, notes).withColumnRenamed("scenario_id", "c_custkey")


@query("SELECT s_name AS name, unnest(CASE s_suppkey % 4 WHEN 1 THEN ['threshold_range', 'verdict'] WHEN 2 THEN ['share_range'] WHEN 3 THEN ['no_section'] ELSE [] END) AS code FROM supplier")
def party_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 4
    share = F.when(k == 2, 130.0).when(k != 3, 30.0)
    parties = read(spark, sf_dir, "supplier").select(F.lit("A").alias("scenario_id"), F.col("s_name").alias("name"), share.alias("ownership_pct"), F.when(k == 1, 0.0).otherwise(20.0).alias("threshold_pct"), F.when(k == 2, "board").alias("basis"), (k == 0).alias("said"), (k != 3).alias("has_section"))
    return Q.party_violations(parties).select("name", "code")


@query(
    """SELECT 't' || o_orderkey AS txn_id, 'repeated' AS code FROM orders WHERE o_orderkey % 7 = 1 UNION ALL SELECT 't' || o_orderkey, 'missing' FROM orders WHERE o_orderkey % 7 = 3
      UNION ALL SELECT 't' || o_orderkey, 'invented' FROM orders WHERE o_orderkey % 7 = 5 UNION ALL SELECT 't' || o_orderkey, 'out_of_vocabulary' FROM orders WHERE o_orderkey % 7 = 2"""
)
def label_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(worded("t{}", O()).alias("txn_id"), (O() % 7).alias("way"))
    labels = orders.where("way <> 3").select("txn_id", F.when(F.col("way") == 2, "gifts").otherwise("opex").alias("category"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("way") == 1, 2).otherwise(1))).alias("n"))
    return Q.label_violations(labels.drop("n"), orders.where("way <> 5").select("txn_id"), CATEGORIES)


# --- names


@query("SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'OOO' WHEN 1 THEN 'XYZ' END AS form FROM supplier")
def unknown_legal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 5
    name = F.concat(F.lit("Alpha Works"), F.when(k == 0, " OOO").when(k == 1, ' "X.Y.Z."').when(k == 2, ", L.L.P.").when(k == 3, " ТОО").otherwise(" Bros"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", X.unknown_legal_form(name).alias("form"))


@query("SELECT s_suppkey, 'Port Services ' || s_suppkey || ' JSC' AS plain, CASE WHEN s_suppkey % 2 = 0 THEN 'Sary Holding JSC' ELSE 'SARY HOLDING JSC' END AS parent FROM supplier")
def trimmed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    written = F.concat(F.when(k % 3 == 0, "Организация ").when(k % 3 == 1, "За  Кредитора\n").otherwise(""), worded("Port\nServices {} JSC,", k))
    heading = F.when(k % 2 == 0, worded("31 DECEMBER {} Sary Holding JSC", 2000 + k % 30)).otherwise("SARY HOLDING JSC")
    return read(spark, sf_dir, "supplier").select("s_suppkey", X.without_layout(written).alias("plain"), X.without_heading(heading).alias("parent"))


@query(
    """SELECT 'N' || s_nationkey AS scenario_id, CASE WHEN min(s_suppkey) FILTER (WHERE s_suppkey % 3 = 0) IS NOT NULL THEN 'Upper ' || min(s_suppkey) FILTER (WHERE s_suppkey % 3 = 0) || ' Group LLP' END AS parent, min(s_suppkey) FILTER (WHERE s_suppkey % 3 = 0) AS doc_id
      FROM supplier GROUP BY s_nationkey HAVING min(s_suppkey) FILTER (WHERE s_suppkey % 3 = 0) IS NOT NULL"""
)
def parents_of_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, sid = F.col("s_suppkey"), worded("N{}", F.col("s_nationkey"))
    supplier = read(spark, sf_dir, "supplier").withColumn("scenario_id", sid)
    text = F.when(k % 3 == 0, worded("31 DECEMBER 2025 Upper {} Group LLP consolidates\nBorrower {} JSC and others", k, "scenario_id")).when(k % 3 == 1, worded("Borrower {} LLP consolidates Borrower {} JSC", "scenario_id", "scenario_id")).otherwise("Upper 1 Group LLP consolidates others")
    borrowers = supplier.select("scenario_id", worded("Borrower {} JSC", "scenario_id").alias("name")).distinct()
    return D.group_parents(supplier.select("scenario_id", k.alias("doc_id"), text.alias("text")), borrowers, (r"((?:[\p{Lu}\d][\p{L}\d]*\s){1,8}(?:LLP|JSC)) consolidates",))


@query("SELECT doc_id, len(list_distinct(regexp_extract_all(regexp_replace(text || ' Alpha Beta JSC and Alpha Beta JSC, Gamma LLP', '\\s+', ' ', 'g'), '(?:[A-Z][a-z]+ ){1,5}(?:JSC|LLP|LLC|LTD|PLC|GMBH|INC)\\b'))) >= 2 AS named FROM documents")
def organisation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("text", F.lit(" Alpha Beta JSC and Alpha Beta JSC, Gamma LLP"))
    return read(spark, sf_dir, "documents").select("doc_id", (F.size(X.organisations(text)) >= 2).alias("named"))


# --- small columns


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency, event_id % 4 < 3 AS yes FROM events")
def text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    code = F.when(n % 3 == 0, "  ").when(n % 3 == 2, " eur")
    said = F.element_at(F.array(*map(F.lit, ("1", "true", "True", "TRUE"))), (n % 4 + 1).cast("int"))
    return read(spark, sf_dir, "events").select("event_id", X.currency_of(code).alias("currency"), X.truth(said).alias("yes"))


@query("SELECT o_orderkey, o_custkey || ' | ' || o_orderpriority || ' | ' || o_orderstatus || ' | ' || CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '+' END || format('{:,.2f}', o_totalprice) AS line FROM orders")
def prompt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(O() % 2 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    return read(spark, sf_dir, "orders").select("o_orderkey", X.prompt_row(F.col("o_custkey"), F.col("o_orderpriority"), F.col("o_orderstatus"), amount).alias("line"))


@query("SELECT doc_id, round(CASE WHEN n > 0 THEN c / n ELSE 0 END, 9) AS ratio FROM (SELECT doc_id, length(regexp_replace(replace(text, 'a', 'а'), '[^Ѐ-ӿ]', '', 'g')) AS c, length(regexp_replace(replace(text, 'a', 'а'), '[^\\p{L}]', '', 'g')) AS n FROM documents)")
def cyrillic_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.round(X.cyrillic(F.replace("text", F.lit("a"), F.lit("а"))), 9).alias("ratio"))


# --- documents and their pages


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as pages: its text, then a page that every third one shows as a picture, then a last line."""
    k = F.col("doc_id")
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    page = lambda n, text, image: F.struct(F.lit(n).alias("page"), text.alias("text"), image.alias("has_image"))
    drawn = F.when(k % 3 == 0, "  ").otherwise(F.repeat(F.lit("w "), 40))
    return docs.select("doc_id", F.explode(F.array(page(1, F.col("text"), F.lit(False)), page(2, drawn, F.lit(True)), page(3, F.lit("last"), F.lit(False)))).alias("p")).select("doc_id", "p.*")


@query("SELECT doc_id, (length(trim(coalesce(text, ''))) + CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 79 END + 4) / 3.0 < 120 AS is_scan FROM documents")
def scanned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.scans(_pages(spark, sf_dir)).select("doc_id", "is_scan")


@query("SELECT doc_id, 2 AS page FROM documents WHERE doc_id % 3 = 0")
def image_only_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.drawn_pages(_pages(spark, sf_dir))


@query(
    """SELECT doc_id, doc_id % 6 = 3 AS needs_review, md5(coalesce(text, '') || chr(10) || CASE WHEN doc_id % 6 = 3 THEN '[page 2 could not be read]' WHEN doc_id % 3 = 0 THEN 'seen ' || doc_id ELSE repeat('w ', 40) END || chr(10) || 'last') AS digest FROM documents"""
)
def spliced_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    seen = D.drawn_pages(pages).where("doc_id % 6 <> 3").select("doc_id", "page", worded("seen {}", "doc_id").alias("text"))
    return D.spliced(pages, seen).select("doc_id", "needs_review", F.md5("text").alias("digest"))


@query("SELECT doc_id FROM documents WHERE doc_id % 5 IN (0, 1, 2, 3) AND doc_id % 7 <> 0")
def authority_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, (*D.AUTHORITATIVE, "LOAN_SUPERSEDED"))), (F.col("doc_id") % 5 + 1).cast("int"))
    docs = read(spark, sf_dir, "documents").select("doc_id", kind.alias("type"), F.when(F.col("doc_id") % 7 != 0, "S").alias("scenario_id"))
    return D.authoritative(docs).select("doc_id")


_LOANS = """SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN DATE '1998-01-01' ELSE CAST(o_orderdate AS DATE) END AS s,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN DATE '1998-12-31' ELSE CAST(o_orderdate AS DATE) + 180 END AS e, o_orderkey % 3 = 0 AS marked FROM orders"""


@query(
    f"""SELECT o_custkey AS scenario_id, o_orderkey AS doc_id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(s = DATE '1998-01-01' AND e = DATE '1998-12-31', FALSE) DESC,
      CASE WHEN s IS NULL THEN -1 ELSE greatest(0, date_diff('day', greatest(s, DATE '1998-01-01'), least(e, DATE '1998-12-31')) + 1) END DESC, marked, o_orderkey DESC) AS nth FROM ({_LOANS})) WHERE nth = 1"""
)
def active_agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    day = lambda t: F.lit(t).cast("date")
    start = F.when(O() % 11 == 0, None).when(O() % 13 == 0, day("1998-01-01")).otherwise(d)
    end = F.when(O() % 11 == 0, None).when(O() % 13 == 0, day("1998-12-31")).otherwise(F.date_add(d, 180))
    loans = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("scenario_id"), O().alias("doc_id"), start.alias("start"), end.alias("end"), day("1998-01-01").alias("from"), day("1998-12-31").alias("to"), (O() % 3 == 0).alias("marked"))
    return D.active_agreement(loans).select("scenario_id", "doc_id")


@query(
    """SELECT o_custkey AS scenario_id, o_orderpriority AS type, o_orderkey AS doc_id, (nth > 1 AND dated > 0) AS stale, (dated = 0 AND n > 1) AS undecided FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY coalesce(d BETWEEN DATE '1996-01-01' AND DATE '1996-12-31', FALSE) DESC, d DESC NULLS LAST, o_orderkey) AS nth,
          count(d) OVER (PARTITION BY o_custkey, o_orderpriority) AS dated, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS n
        FROM (SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders))"""
)
def current_document_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("scenario_id"), F.col("o_orderpriority").alias("type"), O().alias("doc_id"), F.when(O() % 3 != 0, F.to_date("o_orderdate")).alias("dated"), F.lit("1996-01-01").cast("date").alias("from"), F.lit("1996-12-31").cast("date").alias("to"))
    return D.current_versions(docs)


# --- reports


@query(
    """SELECT CASE o_orderkey % 5 WHEN 0 THEN 'P' || o_custkey % 9 WHEN 1 THEN 'P1' ELSE '*' END AS scenario_id, count(*) AS n FROM orders WHERE o_orderkey % 5 <> 4 GROUP BY ALL"""
)
def unknown_data_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    way = O() % 5
    line = F.when(way == 0, worded("TXN-P{}-{}: unknown currency", F.col("o_custkey") % 9, O())).when(way == 1, "P1: unknown form").when(way == 2, "the whole run: unknown category").when(way == 3, "unknown to all").otherwise("P1: all well")
    return R.unknown_data(read(spark, sf_dir, "orders").select(line.alias("line")), ("unknown",)).groupBy("scenario_id").agg(F.count("*").alias("n"))


@query("SELECT count(DISTINCT s_nationkey) AS scenarios, count(DISTINCT s_nationkey % 1) AS thresholds, count(DISTINCT s_nationkey) > 3 AS alarm FROM supplier")
def threshold_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.equal_thresholds(read(spark, sf_dir, "supplier").withColumn("t", F.col("s_nationkey") % 1), "s_nationkey", "t")


@query("SELECT event_id, round(value / 1000, 6) AS confidence FROM events WHERE event_id % 3 <> 0 AND value / 1000 < 0.5")
def low_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "events").select("event_id", (F.col("value") / 1000).alias("confidence"), (F.col("event_id") % 3 == 0).alias("fallback"))
    return R.doubtful(items, "event_id").select("event_id", F.round("confidence", 6).alias("confidence"))
