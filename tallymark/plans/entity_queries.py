"""Queries on entities, disclosed amounts, group figures, periods and checks of extracted tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import covenants as C
from tallymark.operators import entities as E
from tallymark.plans.ledger_queries import AGG
from tallymark.registry import query
from tallymark.sources.ledger_view import ledger, read


@query(
    """SELECT 'N' || s_nationkey AS scenario_id, s_name AS name, 'counterparty' AS role, CASE WHEN s_suppkey % 11 = 0 THEN TRUE WHEN s_suppkey % 7 = 0 THEN FALSE ELSE s_acctbal / 100 >= 50 END AS is_related,
        FALSE AS unrestricted, CASE WHEN s_suppkey % 7 = 0 AND s_suppkey % 11 <> 0 THEN 'no_share' END AS problem FROM supplier
      UNION ALL SELECT 'N' || n_nationkey, n_name || ' Sub', 'subsidiary', FALSE, n_nationkey % 3 <> 0 AND n_nationkey < 12, CASE WHEN n_nationkey % 3 = 0 THEN 'no_limit' END FROM nation
      UNION ALL SELECT 'N' || n_nationkey, n_name || ' Group', 'parent', FALSE, FALSE, NULL FROM nation"""
)
def entity_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    sid = lambda c: F.concat(F.lit("N"), F.col(c).cast("string")).alias("scenario_id")
    k = F.col("s_suppkey")
    parties = read(spark, sf_dir, "supplier").select(sid("s_nationkey"), F.col("s_name").alias("name"), F.when(k % 7 != 0, F.col("s_acctbal") / 100).alias("ownership_pct"), F.lit(None).cast("string").alias("basis"), F.when(k % 11 == 0, True).alias("is_related"), F.lit(50.0).alias("threshold_pct"))
    n = F.col("n_nationkey")
    nation = read(spark, sf_dir, "nation")
    pledges = nation.select(sid("n_nationkey"), F.concat("n_name", F.lit(" Sub")).alias("name"), n.cast("double").alias("pct"), F.when(n % 3 != 0, 12.0).alias("limit_pct"))
    graph = E.build_graph(parties, pledges, nation.select(sid("n_nationkey"), F.concat("n_name", F.lit(" Group")).alias("name")))
    return graph.drop("share")


@query(
    """SELECT scenario_id, CASE WHEN v > 1000 THEN 'BREACH' ELSE 'COMPLIANT' END AS status, round(v, 2) AS actual FROM (
        SELECT scenario_id, CASE WHEN count(*) FILTER (WHERE g) = 0 AND n IS NOT NULL THEN n ELSE CAST(abs(coalesce(sum(amount) FILTER (WHERE g), 0)) AS DOUBLE) END AS v
        FROM (SELECT *, NOT excluded AND scope = 'group' AND category = 'capex' AND date < DATE '1995-01-10' AS g FROM ledger)
        LEFT JOIN (SELECT 'N' || n_nationkey AS sid, 500.5 * n_nationkey AS n FROM nation WHERE n_nationkey < 20) ON sid = scenario_id GROUP BY scenario_id, n)""",
    ledger=True,
)
def group_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = read(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("scenario_id"), F.lit("capex").alias("category"), (500.5 * F.col("n_nationkey")).alias("amount"))
    test = C.Covenant("6.1", "max", 1000, AGG("capex", scope="group"), ("1900-01-01", "1995-01-09"))
    return C.verdicts(ledger(spark, sf_dir), [test], group_facts=facts).select("scenario_id", "status", "actual")


@query("SELECT s_nationkey AS scenario_id, min(s_name) AS name FROM supplier GROUP BY ALL")
def borrower_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read(spark, sf_dir, "supplier")
    variants = supplier.select(F.col("s_nationkey").alias("scenario_id"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("pos")).union(supplier.select("s_nationkey", F.upper("s_name"), F.lit(-1).cast("long")))
    return E.display_name(variants)


@query("SELECT s_nationkey AS scenario_id, s_name AS name FROM supplier WHERE s_acctbal > 5000 AND s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 50 AND l_linenumber >= 6)")
def unmatched_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, line = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "lineitem").where("l_quantity >= 50 AND l_linenumber >= 6")
    parties = supplier.select(F.col("s_nationkey").alias("scenario_id"), F.col("s_name").alias("name"), (F.col("s_acctbal") > 5000).alias("is_related"))
    paid = line.join(supplier, line.l_suppkey == supplier.s_suppkey).select(F.col("s_nationkey").alias("scenario_id"), F.col("s_name").alias("entity"))
    return E.unmatched(parties, paid)


