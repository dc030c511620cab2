"""A transaction ledger read off the star schema, in the engine's final-ledger shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The categories of ledger rows.
CATEGORIES = ("revenue", "opex", "capex", "payroll", "utilities", "taxes", "interest", "lease", "insurance", "marketing", "financing_inflow", "other")
ANY = "any"
INFLOWS = ("revenue", "financing_inflow")

_BY_NOUN = {"ring": "revenue", "bolt": "opex", "gear": "capex", "gizmo": "payroll", "plate": "utilities", "rod": "taxes", "anvil": "interest"}
_BY_ADJECTIVE = {"red": "lease", "blue": "lease", "hot": "insurance", "cold": "insurance", "old": "marketing", "new": "financing_inflow"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def category_of(name: Column) -> Column:
    """Category from a part's two-word name: the noun decides, widgets go by adjective."""
    noun, adjective = F.split_part(name, F.lit(" "), F.lit(2)), F.split_part(name, F.lit(" "), F.lit(1))
    out = F.when(F.lit(False), "other")
    for word, category in _BY_NOUN.items():
        out = out.when(noun == word, category)
    for word, category in _BY_ADJECTIVE.items():
        out = out.when(adjective == word, category)
    return out.otherwise("other")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """txn_id, scenario_id, region_id, account_id, date, counterparty, description, category, amount, party, scope, excluded.

    Outflows are negative and returns flip the sign, so refunds net out; amounts are exact decimals.
    """
    line, orders, customer, supplier, part = (read(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "part"))
    nation = read(spark, sf_dir, "nation")
    # Dimensions are left to the planner: it broadcasts those whose size allows it. Orders meet their customers first, as
    # they are fewer than their lines, which would have to be shuffled once more.
    owned = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, customer.c_nationkey == nation.n_nationkey)
    rows = (
        line.join(owned, line.l_orderkey == owned.o_orderkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(part, line.l_partkey == part.p_partkey)
    )
    padded = lambda c, n: F.lpad(F.col(c).cast("bigint").cast("string"), n, "0")
    category = category_of(F.col("p_name"))
    paid = (F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")
    outward = ~category.isin(*INFLOWS)
    related = (F.col("s_nationkey") == F.col("c_nationkey")) & ((F.col("s_acctbal") + 1000) / 110 >= 20 + F.col("c_nationkey") % 21)
    return rows.select(
        F.concat(F.lit("TXN-N"), F.col("c_nationkey").cast("string"), F.lit("-"), padded("l_orderkey", 7), F.col("l_linenumber").cast("string"), padded("l_partkey", 6), padded("l_suppkey", 5), padded("l_quantity", 2)).alias("txn_id"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("scenario_id"),
        F.col("n_regionkey").alias("region_id"),
        F.concat(F.lit("ACC-"), F.col("c_custkey").cast("string")).alias("account_id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("s_name").alias("counterparty"),
        F.concat("p_name", F.lit(" - "), "o_orderpriority").alias("description"),
        category.alias("category"),
        F.when(outward == (F.col("l_returnflag") == "R"), paid).otherwise(-paid).cast("decimal(18,4)").alias("amount"),
        F.when(related, "related").alias("party"),
        F.when(F.col("l_linenumber") == 7, "group").otherwise("borrower").alias("scope"),
        ((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N") & (F.col("l_quantity") >= 45)).alias("excluded"),
    )


#: The same view for DuckDB.
LEDGER_SQL = """
ledger_category AS MATERIALIZED (
  SELECT p_partkey, p_name, CASE split_part(p_name, ' ', 2)
    WHEN 'ring' THEN 'revenue' WHEN 'bolt' THEN 'opex' WHEN 'gear' THEN 'capex' WHEN 'gizmo' THEN 'payroll'
    WHEN 'plate' THEN 'utilities' WHEN 'rod' THEN 'taxes' WHEN 'anvil' THEN 'interest'
    ELSE CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'lease' WHEN 'blue' THEN 'lease' WHEN 'hot' THEN 'insurance'
      WHEN 'cold' THEN 'insurance' WHEN 'old' THEN 'marketing' WHEN 'new' THEN 'financing_inflow' ELSE 'other' END END AS category
  FROM part),
ledger AS MATERIALIZED (
  SELECT 'TXN-N' || c_nationkey || '-' || lpad(CAST(l_orderkey AS VARCHAR), 7, '0') || l_linenumber || lpad(CAST(l_partkey AS VARCHAR), 6, '0')
      || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') || lpad(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 2, '0') AS txn_id,
    'N' || c_nationkey AS scenario_id, n_regionkey AS region_id, 'ACC-' || c_custkey AS account_id, CAST(l_shipdate AS DATE) AS date,
    s_name AS counterparty, p_name || ' - ' || o_orderpriority AS description, category,
    CAST((CASE WHEN (category NOT IN ('revenue', 'financing_inflow')) = (l_returnflag = 'R') THEN 1 ELSE -1 END)
      * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS amount,
    CASE WHEN s_nationkey = c_nationkey AND (s_acctbal + 1000) / 110 >= 20 + c_nationkey % 21 THEN 'related' END AS party,
    CASE WHEN l_linenumber = 7 THEN 'group' ELSE 'borrower' END AS scope,
    (l_linestatus = 'O' AND l_returnflag = 'N' AND l_quantity >= 45) AS excluded
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN ledger_category ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey)
"""
