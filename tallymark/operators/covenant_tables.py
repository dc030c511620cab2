"""Verdicts where every borrower has covenants of its own: metrics are data.

A metric is an array of tokens in postfix order. Leaves become requests, whose answers, disclosed amounts and figures of
the group come back to their place in the array; a fold over the array then keeps a stack of numbers. The plan holds each
kind of node once, so any number of different trees runs in it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.covenants import Covenant, exceeds
from tallymark.operators.requests import CELL, EXACT, KEY, answer_table, day_of, held_cells, request_key, sizes_of, wanted_cells
from tallymark.operators.tagging import sieve
from tallymark.plans.metric import ARRAY_FOLDS, OPERATORS, TOKEN, postfix

COVENANTS = (
    "scenario_id string, point string, direction string, threshold double, start date, end date,"
    f" metric array<{TOKEN}>, condition array<{TOKEN}>, condition_direction string, condition_threshold double"
)
LEAVES = ("AGG", "DISCLOSED", "CONST")
_RESULT = ("status", "actual", "threshold", "condition_met", "missing", "problems")


def covenant_table(spark: SparkSession, covenants: Iterable[tuple[str, Covenant]]) -> DataFrame:
    """A table of covenants (COVENANTS) from pairs of a borrower and a covenant with nested metrics."""
    import datetime

    day = lambda d: datetime.date.fromisoformat(d) if isinstance(d, str) else d
    rows = [
        (s, c.point, c.direction, float(c.threshold), *map(day, c.period), postfix(c.metric), postfix(c.condition), c.condition_direction, float(c.condition_threshold)) for s, c in covenants
    ]
    return spark.createDataFrame(rows, COVENANTS)


@dataclass(frozen=True)
class _Folded:
    """A value of postfix tokens and why there is none."""

    value: Column
    problem: Column


def fold(tokens: Column) -> _Folded:
    """The value of an array of (op, n, leaf): ``leaf`` is the value of a leaf. A stack that runs out or over is a problem."""
    empty = F.struct(F.array().cast("array<double>").alias("stack"), F.lit(None).cast("string").alias("problem"))

    def step(state: Column, token: Column) -> Column:
        stack, op, n = state["stack"], token["op"], token["n"]
        held = F.size(stack)
        args = F.slice(stack, F.greatest(held - n, F.lit(0)) + 1, n)
        rest = F.slice(stack, F.lit(1), F.greatest(held - n, F.lit(0)))
        value, bad = F.when(op.isin(*LEAVES), token["leaf"]), F.when(op.isin(*LEAVES), F.when(n > 0, F.concat(op, F.lit(" takes no arguments"))))
        for name, array_fold in ARRAY_FOLDS.items():
            least, most, _ = OPERATORS[name]
            outside = (n < max(1, least)) | (n > most if most is not None else F.lit(False))
            told = F.lit(f"{name} takes {max(1, least)} to {most or 'any number of'} arguments")
            value, bad = value.when(op == name, array_fold(args)), bad.when(op == name, F.when(outside | (held < n), told))
        bad = bad.otherwise(F.concat(F.lit("unknown node type "), F.coalesce(op, F.lit("none"))))
        problem = F.coalesce(state["problem"], bad)
        return F.struct(F.when(problem.isNotNull(), stack).otherwise(F.concat(rest, F.array(value))).alias("stack"), problem.alias("problem"))

    done = F.aggregate(tokens, empty, step, lambda s: F.struct(F.get(s["stack"], F.lit(0)).alias("value"), F.coalesce(s["problem"], F.when(F.size(s["stack"]) != 1, "not one tree")).alias("problem")))
    return _Folded(F.when(done["problem"].isNull(), done["value"]), done["problem"])


def _leaves(tests: DataFrame) -> DataFrame:
    """(test, scenario_id, at, op, category, scope, party, start, end, request, key, value): a row for each leaf of a test.

    A leaf's own period stands in place of the test's.
    """
    tokens = F.concat(F.coalesce("metric", F.array().cast(f"array<{TOKEN}>")), F.coalesce("condition", F.array().cast(f"array<{TOKEN}>")))
    each = tests.select("test", "scenario_id", F.col("start").alias("_start"), F.col("end").alias("_end"), F.posexplode(tokens).alias("at", "t")).where(F.col("t.op").isin(*LEAVES))
    own = F.col("t.start").isNotNull() | F.col("t.end").isNotNull()
    each = each.select(
        "test", "scenario_id", "at", "t.op", "t.category", F.coalesce(F.nullif(F.col("t.scope"), F.lit("")), F.lit("borrower")).alias("scope"), "t.party",
        F.when(own, F.col("t.start")).otherwise(F.col("_start")).alias("start"), F.when(own, F.col("t.end")).otherwise(F.col("_end")).alias("end"), "t.key", "t.value",
    )
    request = request_key(*(F.col(c) for c in ("category", "scope", "party", "start", "end")))
    return each.withColumn("request", F.when(F.col("op") == "AGG", request))


def _answered(leaves: DataFrame, ledger: DataFrame, disclosed: DataFrame | None, group_facts: DataFrame | None) -> DataFrame:
    """(test, leaves): by test and place what its leaf is worked out from: request, total, n_rows, figure of the group, fixed value."""
    sums = answer_table(ledger, leaves.where("op = 'AGG'").select(*KEY))
    sums = sums.select("scenario_id", request_key(*(F.col(c) for c in KEY[1:])).alias("request"), "total", "n_rows")
    found = leaves.join(sums, ["scenario_id", "request"], "left")
    for name, table, key in (("disclosed", disclosed, "key"), ("figure", group_facts, "category")):
        if table is None:
            found = found.withColumn(name, F.lit(None).cast("double"))
        else:
            one = table.groupBy("scenario_id", key).agg(F.max(F.col("amount").cast("double")).alias(name))
            found = found.join(one, ["scenario_id", key], "left")
    # Without a row of the group, the figure derived from its reports stands in, whatever the period.
    stands_in = (F.col("scope") == "group") & F.col("party").isNull() & (F.col("category") != "any")
    fixed = F.when(F.col("op") == "DISCLOSED", F.abs(F.coalesce("disclosed", F.lit(0.0)))).otherwise(F.col("value"))
    told = F.col("party").isNotNull() | (F.col("category") != "any")
    total = F.coalesce("total", F.lit(0)).cast(EXACT)
    leaf = F.struct((F.col("op") == "AGG").alias("summed"), "request", told.alias("told"), total.alias("total"), "n_rows", F.when(stands_in, F.abs("figure")).alias("figure"), fixed.alias("fixed"))
    return found.groupBy("test").agg(F.map_from_entries(F.collect_list(F.struct("at", leaf.alias("leaf")))).alias("leaves"))


def _leaf_value(leaf: Column, move: Column) -> Column:
    """The value of a leaf whose sum has moved by ``move`` (total, n_rows), null if it has not."""
    total = F.abs((leaf["total"] + F.coalesce(move["total"], F.lit(0))).cast("double"))
    none_left = leaf["n_rows"] + F.coalesce(move["n_rows"], F.lit(0)) == 0
    return F.when(leaf["summed"], F.when(none_left, F.coalesce(leaf["figure"], total)).otherwise(total)).otherwise(leaf["fixed"])


MOVES = "map<int,struct<total:decimal(38,4),n_rows:bigint>>"


def _valued(part: str, offset: Column, moves: Column) -> _Folded:
    """The fold of a part of a test, whose first token is leaf number ``offset``, over sums moved by ``moves``."""
    own = lambda t, i: _leaf_value(F.try_element_at("leaves", i + offset), F.try_element_at(moves, i + offset))
    found = fold(F.transform(part, lambda t, i: F.struct(t["op"].alias("op"), t["n"].alias("n"), own(t, i).alias("leaf"))))
    return _Folded(F.when(F.col(part).isNotNull(), found.value), F.when(F.col(part).isNotNull(), found.problem))


def _tests(covenants: DataFrame) -> DataFrame:
    """The covenants, each once, with test: a name for all that tells it apart."""
    columns = ["scenario_id", "point", "direction", "threshold", "start", "end", "metric", "condition", "condition_direction", "condition_threshold"]
    named = covenants.select(*columns)
    return named.withColumn("test", F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)).dropDuplicates(["test"])


def _judged(tests: DataFrame, moves: Column) -> DataFrame:
    """``tests`` with leaves, and the columns of a verdict over sums moved by ``moves``."""
    metric, condition = _valued("metric", F.lit(0), moves), _valued("condition", F.coalesce(F.size("metric"), F.lit(0)), moves)
    judged = tests.withColumns({"m": metric.value, "c": condition.value, "m_bad": F.when(F.col("metric").isNull(), "no metric").otherwise(metric.problem), "c_bad": condition.problem})
    # A condition counts as met if there is none or it cannot be computed, or if the test has no metric anyway.
    beyond = lambda value, threshold, direction: F.when(direction == "max", exceeds(value, threshold, "max")).when(direction == "min", exceeds(value, threshold, "min"))
    tested = F.col("condition").isNotNull() & F.col("c_bad").isNull() & F.col("m_bad").isNull()
    met = F.when(tested, F.coalesce(beyond(F.col("c"), F.col("condition_threshold"), F.col("condition_direction")), F.lit(False))).otherwise(True)
    size = F.abs("m")
    finite = F.coalesce((size != float("inf")) & ~F.isnan("m"), F.lit(False))
    wrong = F.coalesce(beyond(size, F.col("threshold"), F.col("direction")), F.lit(False))
    told = [
        F.concat(F.lit("metric_not_computed: "), "m_bad"),
        F.when(F.col("m_bad").isNull(), F.concat(F.lit("condition_not_computed: "), "c_bad")),
        F.when(~F.coalesce(F.col("direction").isin("max", "min"), F.lit(False)), "unknown_direction"),
        F.when(F.col("threshold").isNull(), "no_threshold"),
        F.when(F.col("m_bad").isNull() & ~finite, "not_finite"),
        F.when(~met, "condition_not_met"),
    ]
    empty = F.filter(F.map_values("leaves"), lambda l: l["summed"] & l["told"] & (l["n_rows"] == 0))  # noqa: E741
    return judged.withColumns(
        {
            "condition_met": met,
            "status": F.when(met & wrong, "BREACH").otherwise("COMPLIANT"),
            "actual": F.when(finite, F.round(size, 2)),
            "missing": F.when(F.col("m_bad").isNull(), F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(empty, lambda l: l["request"]))), ","), F.lit(""))).otherwise(""),  # noqa: E741
            "problems": F.array_join(F.array_compact(F.array(*told)), ";"),
        }
    )


def verdict_table(ledger: DataFrame, covenants: DataFrame, disclosed: DataFrame | None = None, group_facts: DataFrame | None = None) -> DataFrame:
    """scenario_id, point, status, actual, threshold, condition_met, missing, problems of every row of ``covenants`` (COVENANTS).

    As ``covenants.verdicts``, but every borrower has tests, thresholds and periods of its own. A covenant of a borrower
    without ledger rows is judged over empty sums. A null direction or threshold is a problem and complies; equal rows
    give one verdict. ``disclosed`` (scenario_id, key, amount) and ``group_facts`` (scenario_id, category, amount) are one
    row a key; of several the largest amount counts.
    """
    tests = _tests(covenants)
    answered = tests.join(_answered(_leaves(tests), ledger, disclosed, group_facts), "test", "left")
    return _judged(answered, F.lit(None).cast(MOVES)).select("scenario_id", "point", *_RESULT)


def covenant_facts(ledger: DataFrame, covenants: DataFrame, disclosed: DataFrame | None = None, group_facts: DataFrame | None = None) -> DataFrame:
    """scenario_id, point, ratio, sums, derived, categories of every covenant: what a verdict rests on.

    ratio: whether the metric ends in a division; sums: the magnitudes that it is made of; derived: whether a figure of the
    group stands in for rows; categories: those that it reads of the borrower's own rows, whoever was paid.
    """
    tests = _tests(covenants)
    leaves = _leaves(tests)
    own = leaves.where("op = 'AGG' AND scope = 'borrower' AND party IS NULL AND category <> 'any'").groupBy("test").agg(F.array_sort(F.collect_set("category")).alias("categories"))
    answered = tests.join(_answered(leaves, ledger, disclosed, group_facts), "test", "left").join(own, "test", "left")
    summed = F.filter(F.map_values("leaves"), lambda x: x["summed"])
    return answered.select(
        "scenario_id", "point", F.coalesce(F.try_element_at("metric", F.lit(-1))["op"] == "DIV", F.lit(False)).alias("ratio"),
        F.coalesce(F.transform(summed, lambda x: F.abs(x["total"].cast("double"))), F.array().cast("array<double>")).alias("sums"),
        F.coalesce(F.exists(summed, lambda x: (x["n_rows"] == 0) & x["figure"].isNotNull()), F.lit(False)).alias("derived"),
        F.coalesce("categories", F.array().cast("array<string>")).alias("categories"),
    )


def decisive_table(ledger: DataFrame, candidates: DataFrame, covenants: DataFrame, disclosed: DataFrame | None = None, group_facts: DataFrame | None = None) -> DataFrame:
    """scenario_id, point, txn_id, basis, weight, n_flips, n_equal as ``covenants.decisive_tests``, for a table of covenants.

    A candidate's row meets the leaves that it counts in through the same cells as any row, once as it stands and once as
    it would stand when reversed; only tests that it moves are evaluated again, over moved sums.
    """
    tests = _tests(covenants)
    leaves = _leaves(tests)
    answered = tests.join(_answered(leaves, ledger, disclosed, group_facts), "test", "left")
    scope = F.col("revert_scope") if "revert_scope" in candidates.columns else F.lit(None).cast("string")
    rows = sieve(ledger.where(~F.col("excluded")), candidates, "scenario_id", "txn_id").join(candidates, ["scenario_id", "txn_id"]).withColumn("day", day_of(F.col("date")))
    reverts = F.col("revert_category").isNotNull() | F.col("clears_party") | scope.isNotNull()
    states = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("category"), F.col("scope"), F.col("party")),
        F.when(reverts, F.struct(F.lit(1).alias("sign"), F.coalesce("revert_category", "category").alias("category"), F.coalesce(scope, "scope").alias("scope"), F.when(~F.col("clears_party"), F.col("party")).alias("party"))),
    )
    proof = ["scenario_id", "txn_id", "basis", "weight"]
    each = rows.select(*proof, "amount", "day", F.explode(F.array_compact(states)).alias("s")).select(*proof, "amount", "day", "s.*")
    wanted = wanted_cells(leaves.where("op = 'AGG'"), "test", "at")
    met = held_cells(each, sizes_of(wanted), *proof, "amount", "sign").join(wanted, list(CELL))
    moved = met.groupBy("test", *proof, "at").agg(F.sum(F.col("amount").cast("decimal(18,4)") * F.col("sign")).cast(EXACT).alias("total"), F.sum("sign").alias("n_rows")).where("total <> 0 OR n_rows <> 0")
    moves = moved.groupBy("test", *proof).agg(F.map_from_entries(F.collect_list(F.struct("at", F.struct("total", "n_rows")))).cast(MOVES).alias("moves"))
    base = _judged(answered, F.lit(None).cast(MOVES)).select(*answered.columns, F.col("status").alias("base"))
    again = _judged(moves.join(base.drop("scenario_id"), "test"), F.col("moves"))
    flips = again.where("status <> base").select("scenario_id", "point", "txn_id", "basis", "weight")
    equal = flips.groupBy("scenario_id", "point", "weight").agg(F.min(F.struct("txn_id", "basis")).alias("w"), F.count("*").alias("n"))
    best = equal.groupBy("scenario_id", "point").agg(F.max(F.struct("weight", "n", "w")).alias("b"), F.sum("n").alias("n_flips"))
    return best.select("scenario_id", "point", "b.w.txn_id", "b.w.basis", "b.weight", "n_flips", F.col("b.n").alias("n_equal"))
