"""Aggregates, verdicts and decisive transactions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.plans.metric import Leaves, Request, compile_tree


#: The type of exact sums.
EXACT = "decimal(38,4)"


@dataclass(frozen=True)
class Covenant:
    """A test: BREACH if the metric exceeds (direction max) or falls below (min) the threshold; a condition may switch it off."""

    point: str
    direction: str
    threshold: float
    metric: dict
    period: tuple[str | None, str | None] = (None, None)
    condition: dict | None = None
    condition_direction: str = "max"
    condition_threshold: float = 0.0


def answer(ledger: DataFrame, requests: Iterable[Request], by: tuple[str, ...] = ("scenario_id",), exact: bool = False) -> DataFrame:
    """One row for each group: ``sums`` (doubles, or exact decimals) and ``counts``, maps from request key to signed sum and number of rows.

    All requests are conditional aggregates of one scan: partial sums are combined before the shuffle.
    """
    requests = sorted(set(requests), key=lambda r: r.key)
    cells = [(F.sum(F.when(r.matches(), F.col("amount"))), F.count(F.when(r.matches(), 1))) for r in requests]
    flat = ledger.groupBy(*by).agg(*[c.alias(f"{n}{i}") for i, pair in enumerate(cells) for n, c in zip("sc", pair)]) if cells else ledger.select(*by).distinct()
    kinds = {"sums": ("s", EXACT if exact else "double"), "counts": ("c", "bigint")}
    for name, (letter, kind) in kinds.items():
        entries = [x for i, r in enumerate(requests) for x in (F.lit(r.key), F.col(f"{letter}{i}").cast(kind))]
        flat = flat.withColumn(name, F.create_map(*entries) if entries else F.create_map().cast(f"map<string,{kind}>"))
    return flat.select(*by, "sums", "counts")


def exceeds(value: Column, threshold: Column, direction: str) -> Column:
    """Strictly beyond the threshold in the forbidden direction; equality complies."""
    if direction not in ("max", "min"):
        raise ValueError(f"unknown direction {direction}")
    return value > threshold if direction == "max" else value < threshold


@dataclass
class _Test:
    """A compiled test: its metric and condition as Columns over the answers, or why there is none."""

    covenant: Covenant
    metric: Column | None
    condition: Column | None
    requests: dict[str, Request]
    problems: list[str]


def _compiled(covenants: list[Covenant]) -> tuple[list[_Test], Leaves]:
    """The tests and all their leaves. A tree that cannot be compiled is a problem of its test and of no other."""
    tests, everything = [], Leaves()
    for c in covenants:
        own, found, problems = Leaves(), {}, []
        for part, tree in (("metric", c.metric), ("condition", c.condition)):
            try:
                found[part] = compile_tree(tree, own, c.period) if tree is not None else None
            except (ValueError, KeyError, TypeError) as e:
                problems.append(f"{part}_not_computed: {e}")
        if "metric" not in found:
            own = Leaves()
        everything.requests |= own.requests
        everything.disclosed |= own.disclosed
        tests.append(_Test(c, found.get("metric"), found.get("condition") if "metric" in found else None, own.requests, problems))
    return tests, everything


def _facts(ledger: DataFrame, leaves: Leaves, disclosed: DataFrame | None, group_facts: DataFrame | None) -> DataFrame:
    """The answers of each scenario: maps sums, counts, disclosed, group_facts."""
    facts = answer(ledger, leaves.requests.values(), exact=True)
    for name, table, key in (("disclosed", disclosed, "key"), ("group_facts", group_facts, "category")):
        if table is None:
            facts = facts.withColumn(name, F.lit(None).cast("map<string,double>"))
        else:
            amounts = table.groupBy("scenario_id").agg(F.map_from_entries(F.collect_list(F.struct(key, F.col("amount").cast("double")))).alias(name))
            facts = facts.join(amounts, "scenario_id", "left")
    return facts


def _judged(tests: list[_Test]) -> Column:
    """The verdicts of a scenario's answers, as an array in the order of the tests."""
    rows = []
    for t in tests:
        c, metric = t.covenant, t.metric if t.metric is not None else F.lit(None).cast("double")
        met = exceeds(t.condition, F.lit(float(c.condition_threshold)), c.condition_direction) if t.condition is not None else F.lit(True)
        breach = met & exceeds(F.abs(metric), F.lit(float(c.threshold)), c.direction)
        finite = (F.abs(metric) != float("inf")) & ~F.isnan(metric)
        # An empty sum over any category and party is no finding.
        empty = [F.when(F.coalesce(F.try_element_at("counts", F.lit(k)), F.lit(0)) == 0, F.lit(k)) for k, r in sorted(t.requests.items()) if r.party is not None or r.category != "any"]
        problems = [*map(F.lit, t.problems), F.when(~finite, "not_finite"), F.when(~met, "condition_not_met")]
        rows.append(
            F.struct(
                F.lit(c.point).alias("point"),
                F.when(breach, "BREACH").otherwise("COMPLIANT").alias("status"),
                F.when(finite, F.round(F.abs(metric), 2)).alias("actual"),
                F.lit(float(c.threshold)).alias("threshold"),
                met.alias("condition_met"),
                F.array_join(F.array_compact(F.array(*empty)) if empty else F.array().cast("array<string>"), ",").alias("missing"),
                F.array_join(F.array_compact(F.array(*problems)), ";").alias("problems"),
            )
        )
    return F.array(*rows)


def verdicts(ledger: DataFrame, covenants: list[Covenant], disclosed: DataFrame | None = None, group_facts: DataFrame | None = None) -> DataFrame:
    """scenario_id, point, status, actual, threshold, condition_met, missing (keys of empty aggregates), problems for every scenario and test.

    The magnitude of the metric is compared. A condition that is not met makes the test compliant; the actual value is
    reported all the same, rounded, and null if it is not finite. A metric that cannot be computed makes its cell
    compliant without a value, a condition that cannot counts as met; both are problems of the cell and of no other.
    ``disclosed`` (scenario_id, key, amount) and ``group_facts`` (scenario_id, category, amount) answer DISCLOSED leaves
    and group sums without rows.
    """
    tests, leaves = _compiled(covenants)
    facts = _facts(ledger, leaves, disclosed, group_facts)
    return facts.select("scenario_id", F.explode(_judged(tests)).alias("v")).select("scenario_id", "v.*")


def traces(ledger: DataFrame, requests: Iterable[Request], order: str) -> DataFrame:
    """scenario_id, key, txn_ids of the rows that each request adds up, in the ledger's order (column ``order``)."""
    each = [F.struct(F.lit(r.key).alias("key"), r.matches().alias("hit")) for r in sorted(set(requests), key=lambda r: r.key)]
    rows = ledger.select("scenario_id", "txn_id", order, F.explode(F.array(*each)).alias("r")).where("r.hit")
    found = rows.groupBy("scenario_id", "r.key").agg(F.array_sort(F.collect_list(F.struct(order, "txn_id"))).alias("rows"))
    return found.select("scenario_id", "key", F.transform("rows", lambda x: x["txn_id"]).alias("txn_ids"))


def touched(trace: DataFrame) -> DataFrame:
    """scenario_id, txn_ids: every transaction that a scenario's sums hold, once, in the order in which the requests name them."""
    lists = trace.groupBy("scenario_id").agg(F.array_sort(F.collect_list(F.struct("key", "txn_ids"))).alias("lists"))
    return lists.select("scenario_id", F.array_distinct(F.flatten(F.transform("lists", lambda x: x["txn_ids"]))).alias("txn_ids"))


def first_reports(cells: DataFrame) -> DataFrame:
    """scenario_id, point, key: each empty aggregate is reported by the first point of its scenario only."""
    each = cells.select("scenario_id", "point", F.explode(F.split("missing", ",")).alias("key")).where("key <> ''")
    return each.groupBy("scenario_id", "key").agg(F.min("point").alias("point")).select("scenario_id", "point", "key")


def decisive_tests(ledger: DataFrame, candidates: DataFrame, covenants: list[Covenant], disclosed: DataFrame | None = None, group_facts: DataFrame | None = None) -> DataFrame:
    """scenario_id, point, txn_id, basis, weight of the candidate whose reversal flips a test, with n_flips and n_equal.

    ``candidates``: scenario_id, txn_id, basis, weight, revert_category, clears_party and optionally revert_scope.
    Reversal puts back category, scope or party if any is given and otherwise removes the row. A reversal moves each
    sum that a test reads by the row's own contribution, so any tree (ratios, maxima, conditions) is evaluated again
    over moved sums and no row of the ledger is added up twice. Of several candidates that flip a test the heaviest
    wins, then the smallest id; n_flips counts them all, n_equal those of the winner's weight.
    """
    tests, leaves = _compiled(covenants)
    facts = _facts(ledger, leaves, disclosed, group_facts).withColumn("base", F.transform(_judged(tests), lambda v: v["status"]))
    requests = sorted(leaves.requests.values(), key=lambda r: r.key)
    scope = "revert_scope" if "revert_scope" in candidates.columns else None
    rows = ledger.join(candidates, ["scenario_id", "txn_id"])
    rows = rows.withColumns({f"was{i}": r.matches() for i, r in enumerate(requests)})
    reverts = F.col("revert_category").isNotNull() | F.col("clears_party") | (F.col(scope).isNotNull() if scope else F.lit(False))
    rows = rows.withColumns(
        {"reverts": reverts, "category": F.coalesce("revert_category", "category"), "party": F.when(~F.col("clears_party"), F.col("party")), "scope": F.coalesce(scope, "scope") if scope else F.col("scope")}
    )
    sign = [(F.col("reverts") & r.matches()).cast("int") - F.coalesce(F.col(f"was{i}"), F.lit(False)).cast("int") for i, r in enumerate(requests)]
    sign = [F.coalesce(x, F.lit(0)) for x in sign]
    moves = F.create_map(*[x for r, n in zip(requests, sign) for x in (F.lit(r.key), n)]) if requests else F.create_map().cast("map<string,int>")
    moved = rows.select("scenario_id", "txn_id", "basis", "weight", "amount", moves.alias("moves")).join(facts, "scenario_id")
    moved = moved.withColumns(
        {
            "sums": F.transform_values("sums", lambda k, v: (F.coalesce(v, F.lit(0)) + F.col("amount") * F.col("moves")[k]).cast(EXACT)),
            "counts": F.transform_values("counts", lambda k, v: F.coalesce(v, F.lit(0)) + F.col("moves")[k]),
        }
    )
    each = moved.select("scenario_id", "txn_id", "basis", "weight", F.explode(F.arrays_zip(_judged(tests).alias("v"), F.col("base"))).alias("t"))
    flips = each.where("t.v.status <> t.base").select("scenario_id", F.col("t.v.point").alias("point"), "txn_id", "basis", "weight")
    equal = flips.groupBy("scenario_id", "point", "weight").agg(F.min(F.struct("txn_id", "basis")).alias("w"), F.count("*").alias("n"))
    best = equal.groupBy("scenario_id", "point").agg(F.max(F.struct("weight", "n", "w")).alias("b"), F.sum("n").alias("n_flips"))
    return best.select("scenario_id", "point", "b.w.txn_id", "b.w.basis", "b.weight", "n_flips", F.col("b.n").alias("n_equal"))


def decisive(ledger: DataFrame, candidates: DataFrame, request: Request, threshold: float, direction: str) -> DataFrame:
    """scenario_id, txn_id, basis, weight, n_flips of the winning candidate of a test of one sum (see decisive_tests)."""
    leaf = {"op": "AGG", "category": request.category, "scope": request.scope, "party": request.party, "period": (request.start, request.end)}
    return decisive_tests(ledger, candidates, [Covenant("", direction, threshold, leaf)]).select("scenario_id", "txn_id", "basis", "weight", "n_flips")


def best_basis(candidates: DataFrame) -> DataFrame:
    """One row for each candidate transaction: its strongest basis, the first of equals."""
    order = Window.partitionBy("scenario_id", "txn_id").orderBy(F.desc("weight"), "seq")
    return candidates.withColumn("at", F.row_number().over(order)).where("at = 1").drop("at")
