"""Risk ranking, assembly, validation and scoring of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.ranks import ranked
from tallymark.tables import Store

#: Weights of risk signals.
WEIGHTS = {
    "fallback": 1.0,
    "no_value": 1.0,
    "empty_sum": 1.0,
    "far": 0.9,
    "near": 0.7,
    "close": 0.25,
    "amplified": 0.5,
    "outlier": 0.45,
    "group_derived": 0.4,
    "related_evidence": 0.5,
    "group_gap": 0.4,
    "addressing_miss": 0.4,
    "unknown_data": 0.3,
    "no_evidence": 0.25,
}
#: Signals that count in the ranking but do not flag a cell, and cells flagged at most.
QUIET, FLAGGED = ("close", "no_evidence"), 20


def money(value: Column) -> Column:
    """An exact decimal, so that a margin of just 10 % is just 10 %."""
    return value.cast("decimal(28,8)")


def within(actual: Column, threshold: Column, hundredths: int) -> Column:
    """Whether the distance from the threshold is at most so many hundredths of it; no for a zero threshold."""
    a, t = F.abs(money(actual)), F.abs(money(threshold))
    return (t > 0) & (F.abs(a - t) * 100 <= t * hundredths)


def signals(actual: Column, threshold: Column, status: Column, evidence: Column, **more: Column) -> Column:
    """Names of the risk signals of a cell, in a fixed order.

    ``more``: conditions of the signals that other steps know of (fallback, empty_sum, amplified, outlier,
    group_derived, related_evidence, group_gap), and counts for those that weigh each time (addressing_miss, unknown_data).
    """
    a, t = F.abs(money(actual)), F.abs(money(threshold))
    far = (t > 0) & ((a > t * 5) | (a * 5 < t))
    near, close = within(actual, threshold, 5), within(actual, threshold, 10)
    own = {
        "no_value": actual.isNull(),
        "far": far,
        "near": near & ~far,
        "close": close & ~near & ~far,
        "no_evidence": (status == "BREACH") & evidence.isNull(),
    }
    each = ("addressing_miss", "unknown_data")
    once = [F.array_compact(F.array(*[F.when(own.get(n, more.get(n)), n) for n in WEIGHTS if n in own or n in more and n not in each]))]
    return F.concat(*once, *[F.array_repeat(F.lit(n), F.coalesce(more[n], F.lit(0)).cast("int")) for n in each if n in more])


def flagged(cells: DataFrame) -> DataFrame:
    """The cells with a signal that flags, riskiest first, FLAGGED at most (columns scenario_id, point, signals, risk)."""
    loud = F.exists("signals", lambda s: ~s.isin(*QUIET))
    return cells.where(loud).orderBy(F.desc("risk"), "scenario_id", "point").limit(FLAGGED)


def places(cells: DataFrame) -> DataFrame:
    """The cells with their place by risk, the riskiest first.

    Equal risks, which most cells may share, are told apart by borrower and point, so no task holds all cells of one.
    """
    order = [F.desc("risk"), F.asc("scenario_id"), F.asc("point")]
    placed = ranked(cells, order, Store(cells.sparkSession, "places").put)
    return placed.withColumn("place", (F.col("rank") + 1).cast("int")).drop("rank")


def unknown_data(lines: DataFrame, markers: tuple[str, ...]) -> DataFrame:
    """scenario_id, line of the report lines (column ``line``) that speak of unknown data; '*' where no scenario can be told.

    The scenario is that of a transaction id in the line, else a head before a colon of 8 characters at most without a space.
    """
    told = F.regexp_extract("line", r"TXN-([A-Za-z0-9]+)-\d+", 1)
    head = F.trim(F.split_part("line", F.lit(":"), F.lit(1)))
    by_head = F.when((F.length(head).between(1, 8)) & ~head.contains(" "), head)
    mine = lines.where(F.exists(F.array(*map(F.lit, markers)), lambda m: F.contains(F.col("line"), m)))
    return mine.select(F.coalesce(F.nullif(told, F.lit("")), by_head, F.lit("*")).alias("scenario_id"), "line")


def equal_thresholds(rows: DataFrame, scenario: str, threshold: str) -> DataFrame:
    """One row with the alarm that more than three scenarios all state one threshold."""
    n = rows.agg(F.countDistinct(scenario).alias("scenarios"), F.countDistinct(threshold).alias("thresholds"))
    return n.withColumn("alarm", (F.col("scenarios") > 3) & (F.col("thresholds") == 1))


def doubtful(items: DataFrame, key: str, least: float = 0.5) -> DataFrame:
    """Answers of low confidence that are no fallback, the least sure first."""
    return items.where(~F.col("fallback") & (F.col("confidence") < least)).orderBy("confidence", key)


def losses(marks: DataFrame, most: int = 10) -> DataFrame:
    """The cells that earned least, in ascending order."""
    return marks.orderBy("marks", "scenario_id", "point").limit(most)


def risk(names: Column) -> Column:
    """Sum of the signals' weights."""
    table = F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])
    return F.round(F.aggregate(names, F.lit(0.0), lambda a, s: a + table[s]), 4)


def amplification(values: Column) -> Column:
    """Sum of the positive magnitudes over the largest; 1 without any."""
    sizes = F.filter(F.transform(values, lambda v: F.abs(v)), lambda v: v > 0)
    return F.when(F.size(sizes) > 0, F.aggregate(sizes, F.lit(0.0), lambda a, v: a + v) / F.array_max(sizes)).otherwise(1.0)


def category_outliers(rows: DataFrame) -> DataFrame:
    """scenario_id, category, n, median of the categories that hold 2 rows and twice their median over scenarios at least.

    The median counts scenarios without a row as 0; fewer than three scenarios give none.
    """
    counts = rows.where(~F.col("excluded")).groupBy("scenario_id", "category").agg(F.count("*").alias("n"))
    scenarios, categories = rows.select("scenario_id").distinct(), rows.select("category").distinct()
    # Categories are a fixed list of twelve.
    grid = scenarios.crossJoin(F.broadcast(categories)).join(counts, ["scenario_id", "category"], "left").fillna(0, ["n"])
    middle = grid.groupBy("category").agg(F.median("n").alias("median"), F.count("*").alias("k")).where("k >= 3")
    return counts.join(middle, "category").where((F.col("n") >= 2) & (F.col("n") >= 2 * F.col("median"))).select("scenario_id", "category", "n", "median")


def assemble(template: DataFrame, results: DataFrame) -> DataFrame:
    """The template's cells with their results: status COMPLIANT and actual 0.0 where there is none (fallback = true)."""
    joined = template.join(results, ["scenario_id", "point"], "left")
    valid = F.col("status").isin("COMPLIANT", "BREACH")
    finite = F.col("actual").isNotNull() & ~F.isnan("actual") & (F.abs("actual") != float("inf"))
    return joined.select(
        "scenario_id", "point", F.when(valid, F.col("status")).otherwise("COMPLIANT").alias("status"), F.when(finite, F.round(F.abs("actual"), 2)).otherwise(0.0).alias("actual"), "evidence_txn_id", (~F.coalesce(valid, F.lit(False)) | ~F.coalesce(finite, F.lit(False))).alias("fallback")
    )


def violations(template: DataFrame, submission: DataFrame, owners: DataFrame) -> DataFrame:
    """scenario_id, point, level, code of everything wrong with a submission; ``owners`` (txn_id, owner) is the ledger index.

    One pass: the submission meets the template and the owners of the cited rows once, and each row lists its codes.
    """
    keys = ["scenario_id", "point"]
    # The index is read for the cited transactions only.
    cited = submission.select(F.col("evidence_txn_id").alias("txn_id")).where("txn_id IS NOT NULL").distinct()
    holder = owners.join(cited, "txn_id", "left_semi").groupBy("txn_id").agg(F.min("owner").alias("owner"))
    given = submission.withColumn("given", F.lit(True)).join(holder.withColumnRenamed("txn_id", "evidence_txn_id"), "evidence_txn_id", "left")
    both = given.join(template.select(*keys, F.lit(True).alias("asked")), keys, "full")
    there, evidence = F.col("given").isNotNull(), F.col("evidence_txn_id")
    found = {
        ("ERROR", "missing_cell"): ~there,
        ("WARN", "extra_cell"): F.col("asked").isNull(),
        ("ERROR", "bad_status"): there & ~F.coalesce(F.col("status").isin("COMPLIANT", "BREACH"), F.lit(False)),
        ("ERROR", "bad_actual"): there & (F.col("actual").isNull() | F.isnan("actual") | (F.col("actual") < 0)),
        ("WARN", "too_many_decimals"): F.col("actual") != F.round("actual", 2),
        ("ERROR", "unknown_evidence"): evidence.isNotNull() & F.col("owner").isNull(),
        ("ERROR", "foreign_evidence"): F.col("owner") != F.col("scenario_id"),
    }
    codes = F.array(*[F.when(test, F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"))) for (level, code), test in found.items()])
    return both.select(*keys, F.explode(F.array_compact(codes)).alias("v")).select(*keys, "v.*")


def scale(error: Column) -> Column:
    """Full marks at no relative error, none from 5 % on."""
    return F.greatest(F.lit(0.0), 1 - error / 0.05)


def score(key: DataFrame, submission: DataFrame) -> DataFrame:
    """scenario_id, point and the marks of each cell of the key: 0.5 status, 0.3 actual, 0.2 evidence; a wrong status earns nothing.

    Where the key has no evidence, those marks follow the actual value.
    """
    given = submission.select("scenario_id", "point", F.col("status").alias("s"), F.col("actual").alias("a"), F.col("evidence_txn_id").alias("e"))
    joined = key.join(given, ["scenario_id", "point"], "left")
    right = F.coalesce(F.col("s") == F.col("status"), F.lit(False))
    error = F.when(F.col("actual") == 0, F.when(F.col("a") == 0, 0.0).otherwise(1.0)).otherwise(F.try_divide(F.abs(F.col("a") - F.col("actual")), F.abs("actual")))
    close = F.coalesce(scale(error), F.lit(0.0))
    proof = F.when(F.col("evidence_txn_id").isNull(), F.when(F.col("e").isNull(), close).otherwise(0.0)).otherwise(F.coalesce((F.col("e") == F.col("evidence_txn_id")).cast("double"), F.lit(0.0)))
    marks = {"status_marks": F.lit(0.5), "actual_marks": 0.3 * close, "evidence_marks": 0.2 * proof}
    out = joined.select("scenario_id", "point", *[F.round(F.when(right, m).otherwise(0.0), 6).alias(n) for n, m in marks.items()])
    return out.withColumn("marks", F.round(F.col("status_marks") + F.col("actual_marks") + F.col("evidence_marks"), 6))


def majority(votes: DataFrame, item: str, value: str) -> DataFrame:
    """The most common value of each item, the least of equals, with its share of the votes."""
    counts = votes.groupBy(item, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(item).agg(F.max(F.struct("n")).alias("m"), F.sum("n").alias("total"))
    tied = counts.join(best, item).where(F.col("n") == F.col("m.n"))
    return tied.groupBy(item).agg(F.min(value).alias(value), (F.max("n") / F.max("total")).alias("share"))
