"""Queries over texts: classification, normalisation, sections, rates, names, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.functions import text as X
from tallymark.operators import documents as D
from tallymark.operators import review as R
from tallymark.operators import tagging as T
from tallymark.registry import query
from tallymark.sources.ledger_view import read

#: Rules over the synthetic documents: name, type, pattern.
RULES = [("license", "LEGAL", r"(?i)license|copyright"), ("contact", "CONTACT", r"@"), ("table", "TABLE", r" \| "), ("shouting", "NOISE", r"!!")]


@query(
    """SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)license|copyright') THEN 'LEGAL' WHEN contains(text, '@') THEN 'CONTACT' WHEN contains(text, ' | ') THEN 'TABLE'
      WHEN contains(text, '!!') THEN 'NOISE' ELSE 'BACKGROUND' END AS type FROM documents"""
)
def rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", X.cascade(F.col("text"), RULES, "BACKGROUND").alias("type"))


@query(
    """SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(text, '(?i)license|copyright') THEN 'license' END, CASE WHEN contains(text, '@') THEN 'contact' END,
        CASE WHEN contains(text, ' | ') THEN 'table' END, CASE WHEN contains(text, '!!') THEN 'shouting' END) AS rules
      FROM documents WHERE CAST(regexp_matches(text, '(?i)license|copyright') AS INT) + CAST(contains(text, '@') AS INT) + CAST(contains(text, ' | ') AS INT) + CAST(contains(text, '!!') AS INT) > 1"""
)
def rule_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "documents").select("doc_id", X.collisions(F.col("text"), RULES).alias("r"))
    return found.where(F.size("r") > 1).select("doc_id", F.array_join("r", ",").alias("rules"))


@query(
    """SELECT doc_id, round(CASE WHEN n > 0 THEN length(regexp_replace(text, '[^aeiouAEIOU]', '', 'g')) / n ELSE 0 END, 9) AS share
      FROM (SELECT doc_id, text, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n FROM documents)"""
)
def script_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.round(X.share(F.col("text"), "aeiouAEIOU", "A-Za-z"), 9).alias("share"))


_MIXED = "replace(text, 'on', 'о' || 'n')"


@query(
    f"""SELECT doc_id, round(CASE WHEN length(t) > 0 THEN len(regexp_extract_all(t, '[А-Яа-яЁё][A-Za-z]|[A-Za-z][А-Яа-яЁё]')) / length(t) ELSE 0 END, 9) AS ratio
      FROM (SELECT doc_id, {_MIXED} AS t FROM documents)"""
)
def garble_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.replace(F.col("text"), F.lit("on"), F.lit("оn"))
    return read(spark, sf_dir, "documents").select("doc_id", F.round(X.garble(mixed), 9).alias("ratio"))


@query(
    """WITH r AS (SELECT doc_id, n_chars, CASE WHEN n > 0 THEN length(regexp_replace(text, '[^aeiouAEIOU]', '', 'g')) / n ELSE 0 END AS share
        FROM (SELECT doc_id, n_chars, text, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n FROM documents)),
      m AS (SELECT list_sort(list(share))[count(*) // 2 + 1] AS mid FROM r WHERE n_chars >= 500)
      SELECT doc_id FROM r, m WHERE n_chars >= 500 AND mid >= 0.2 AND share < mid * 0.95"""
)
def script_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = read(spark, sf_dir, "documents").select("doc_id", "n_chars", X.share(F.col("text"), "aeiouAEIOU", "A-Za-z").alias("share"))
    return D.anomalies(shares.where("n_chars >= 500"), "share", least_median=0.2, part=0.95).select("doc_id")


@query("SELECT p_partkey, trim(lower(regexp_replace(p_name || '  ' || p_type || ' - lot ' || p_size, '\\s-\\s.*$', ''))) AS k FROM part".replace("trim(lower(", "trim(lower(regexp_replace(").replace(", '')))", ", ''), '\\s+', ' ', 'g')))"))
def group_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws("", "p_name", F.lit("  "), "p_type", F.lit(" - lot "), F.col("p_size").cast("string"))
    return read(spark, sf_dir, "part").select("p_partkey", X.group_key(text).alias("k"))


@query("WITH g AS (SELECT lower(p_name) AS k, min(p_partkey) AS representative, count(*) AS members FROM part GROUP BY ALL) SELECT p_partkey, representative, members FROM part JOIN g ON lower(p_name) = k")
def group_key_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.representatives(read(spark, sf_dir, "part").select("p_partkey", F.lower("p_name").alias("k")), "k", "p_partkey")


@query(
    """WITH w AS (SELECT doc_id, source, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-z]{7,}'))) AS name FROM documents WHERE lang = 'en'),
      n AS (SELECT name, source, count(*) AS hits FROM w GROUP BY ALL), t AS (SELECT name, sum(hits) AS total FROM n GROUP BY ALL),
      d AS (SELECT source, count(*) AS docs FROM documents WHERE lang = 'en' GROUP BY ALL)
      SELECT name, n.source, hits FROM n JOIN t USING (name) JOIN d ON d.source = n.source WHERE hits / docs >= 0.05 AND hits / total >= 0.8"""
)
def name_learning(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").where("lang = 'en'")
    named = docs.select("doc_id", "source", F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{7,}"), F.lit(0))).alias("names"))
    return D.learn_names(named, "source", coverage=0.05, discrimination=0.8).select("name", "source", "hits")


@query(
    """WITH names AS (SELECT DISTINCT c_mktsegment AS name, c_nationkey % 5 AS scn FROM customer WHERE c_nationkey < 10 UNION ALL SELECT 'BUILDING SITE', 7),
      docs AS (SELECT c_custkey, 'deal on ' || c_mktsegment || CASE WHEN c_custkey % 2 = 0 AND c_mktsegment = 'BUILDING' THEN ' SITE' ELSE '' END || ' terms' AS text FROM customer),
      hit AS (SELECT c_custkey, scn, length(name) AS n, max(length(name)) OVER (PARTITION BY c_custkey) AS best FROM docs JOIN names ON contains(text, name))
      SELECT c_custkey, min(scn) AS scn, count(DISTINCT scn) > 1 AS ambiguous FROM hit WHERE n = best GROUP BY ALL"""
)
def longest_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    names = customer.where("c_nationkey < 10").select(F.col("c_mktsegment").alias("name"), (F.col("c_nationkey") % 5).alias("scn")).distinct().union(spark.createDataFrame([("BUILDING SITE", 7)], "name string, scn int"))
    site = F.when((F.col("c_custkey") % 2 == 0) & (F.col("c_mktsegment") == "BUILDING"), " SITE").otherwise("")
    docs = customer.select("c_custkey", F.concat(F.lit("deal on "), "c_mktsegment", site, F.lit(" terms")).alias("text"))
    return D.longest_match(docs, names, "c_custkey", "scn")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def missing_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return customer.select("c_custkey").join(orders, customer.c_custkey == orders.o_custkey, "left_anti")


@query(
    """WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), b AS (SELECT user_id, max(n) AS m, sum(n) AS total FROM n GROUP BY ALL)
      SELECT n.user_id, min(event_type) AS event_type, round(max(m) / max(total), 9) AS share FROM n JOIN b ON b.user_id = n.user_id AND n = m GROUP BY ALL"""
)
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.majority(read(spark, sf_dir, "events"), "user_id", "event_type").withColumn("share", F.round("share", 9))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS total_k FROM events GROUP BY ALL")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total_k"))


@query("SELECT doc_id, substr(sha256('v1|' || source || '|' || n_chars), 1, 16) AS fingerprint FROM documents WHERE doc_id % 3 <> 0")
def fingerprint_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = D.fingerprints(read(spark, sf_dir, "documents"), "v1", "source", "n_chars")
    return D.changed(docs, docs.where("doc_id % 3 = 0").select("doc_id", "fingerprint"), "doc_id").select("doc_id", "fingerprint")


@query(
    """WITH g AS (SELECT source, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'fr') AS fr, count(*) FILTER (WHERE lang = 'de') AS de FROM documents GROUP BY ALL)
      SELECT source, 'not_one_active' AS code FROM g WHERE de <> 1 UNION ALL SELECT source, 'no_final' FROM g WHERE en < 1 UNION ALL SELECT source, 'no_kyc' FROM g WHERE fr < 1"""
)
def structure_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.invariants(read(spark, sf_dir, "documents").select("source", "lang"), "source", "lang", exactly_one={"de": "not_one_active"}, at_least_one={"en": "no_final", "fr": "no_kyc"})


@query("SELECT lang, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 9) AS share, count(*) > 0.6 * (SELECT count(*) FROM documents) AS alarm FROM documents GROUP BY lang")
def share_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.shares(read(spark, sf_dir, "documents"), "lang", 0.6)


@query("SELECT source, min(o) AS first_date, max(o) AS last_date FROM (SELECT c_mktsegment AS source, CAST(o_orderdate AS DATE) AS o FROM customer JOIN orders ON c_custkey = o_custkey) GROUP BY ALL")
def reporting_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return customer.join(orders, customer.c_custkey == orders.o_custkey).groupBy(F.col("c_mktsegment").alias("source")).agg(F.min(d).alias("first_date"), F.max(d).alias("last_date"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nth FROM documents) WHERE nth = 1")
def first_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.last_by(read(spark, sf_dir, "documents"), ["source"], [F.col("doc_id")]).select("doc_id", "source")


@query("SELECT o_orderkey, place FROM (SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS place FROM orders) WHERE place <= 3")
def top_k_per_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.rank().over(order).alias("place")).where("place <= 3")
