"""Checks of metric trees that arrive as rows of nodes, for any number of trees at once.

Nodes settle level by level from the leaves: a node settles once all its arguments have. Trees of up to WHOLE nodes and
arguments meet their roots in one shuffle and settle as arrays within their row. The nodes of larger ones stay rows, which
no task holds together: each level is two anti joins on
(tree, id), so a tree of a million nodes spreads like a million trees of one. What has not settled after MAX_DEPTH levels
is too deep or never ends; to tell these apart without a level for each step, a node that waits for one argument only is
made to wait for what that one waits for, which halves chains in every round, while nodes that wait for nothing go.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.plans.metric import MAX_DEPTH, OPERATORS
from tallymark.tables import Store

KEY = ["tree", "id"]
#: Nodes and arguments of the largest tree that is checked within one row.
WHOLE = 64
#: Nodes from which tables of ids are never broadcast, however small their files are.
MANY = 200_000


def _marked(waits: DataFrame, open_: DataFrame) -> DataFrame:
    """``open_`` (KEY) with waiting: whether a node waits for anything; ``waits``: KEY, arg."""
    some = waits.groupBy(*KEY).agg(F.lit(True).alias("waiting"))
    return open_.select(*KEY).join(some, KEY, "left").select(*KEY, F.coalesce("waiting", F.lit(False)).alias("waiting"))


def _released(waits: DataFrame, done: DataFrame) -> DataFrame:
    """``waits`` without those for nodes that are done."""
    return waits.join(done.select("tree", F.col("id").alias("arg")), ["tree", "arg"], "left_anti").select(*KEY, "arg")


def _shortened(waits: DataFrame) -> DataFrame:
    """``waits`` where a node that waits for one argument, which itself waits for one, waits for that one's argument."""
    single = waits.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("arg").alias("arg")).where("n = 1").drop("n")
    beyond = single.select("tree", F.col("id").alias("arg"), F.col("arg").alias("further"))
    jumped = single.join(beyond, ["tree", "arg"], "left").select(*KEY, F.coalesce("further", "arg").alias("arg"))
    return waits.join(single.select(*KEY), KEY, "left_anti").select(*KEY, "arg").union(jumped)


def endless(waits: DataFrame, store: Store) -> DataFrame:
    """The nodes (KEY) of ``waits`` (KEY, arg) that wait for themselves or for a node that never settles.

    Rounds go on while nodes settle, and for as many more as it takes to halve the longest chain away.
    """
    waits = store.put(waits.distinct())
    open_ = store.put(waits.select(*KEY).distinct())
    idle = 0
    while True:
        n = open_.count()
        if not n or idle > math.ceil(math.log2(n)) + 1:
            return open_
        # An argument that waits for nothing is done; one that is no node at all never is, and waits for itself.
        left = store.put(_shortened(_released(waits, _finished(waits, open_))).distinct())
        rest = store.put(left.select(*KEY).distinct())
        idle = 0 if rest.count() < n else idle + 1
        store.drop(waits, open_)
        waits, open_ = left, rest


def _finished(waits: DataFrame, open_: DataFrame) -> DataFrame:
    """Arguments that are waited for and wait for nothing themselves."""
    return waits.select("tree", F.col("arg").alias("id")).distinct().join(open_, KEY, "left_anti")


def _node_checks(categories: tuple[str, ...]) -> dict[str, Column]:
    """code -> what a node is blamed for."""
    op, n = F.col("op"), F.coalesce(F.size("args"), F.lit(0))
    inner = [(op == name, (n < max(1, least)) | (n > most if most is not None else F.lit(False))) for name, (least, most, _) in OPERATORS.items()]
    known = reduce(lambda a, b: a | b, [op.isin("AGG", "DISCLOSED", "CONST"), *[is_it for is_it, _ in inner]])
    return {
        "unknown_op": ~F.coalesce(known, F.lit(False)),
        "arity": reduce(lambda a, b: a | b, [is_it & wrong for is_it, wrong in inner]),
        "agg_args": (op == "AGG") & (n > 0),
        "unknown_category": (op == "AGG") & ~F.coalesce(F.col("category").isin(*categories, "any"), F.lit(False)),
        "no_key": (op == "DISCLOSED") & (F.coalesce(F.col("key"), F.lit("")) == ""),
        "no_number": (op == "CONST") & F.col("value").isNull(),
    }


def _by_rows(nodes: DataFrame, roots: DataFrame, store: Store) -> DataFrame:
    """tree, id, code of trees of any size, a join a level; ``nodes``: tree, id, args (no nulls), codes; ``roots``: tree, root, once a tree."""
    nodes = store.put(nodes)
    if nodes.count() > MANY:
        nodes, store.hint = nodes.hint("merge"), "merge"
    roots = store.put(roots)
    repeated = store.put(nodes.groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1").select("tree").distinct())
    single = nodes.join(repeated, "tree", "left_anti")
    edges = store.put(single.select(*KEY, F.explode("args").alias("arg")).distinct())
    waits, open_ = edges, store.put(single.select(*KEY))
    for _ in range(MAX_DEPTH):
        level = store.put(_marked(waits, open_))
        done, open_ = level.where("NOT waiting"), level.where("waiting")
        if done.isEmpty() or open_.isEmpty():
            break
        waits = store.put(_released(waits, done))
    known = nodes.select("tree", F.col("id").alias("root")).distinct()
    fine = roots.join(repeated, "tree", "left_anti").select("tree", "root")
    lost = store.put(fine.join(known, ["tree", "root"], "left_anti").select("tree", "root"))
    unmet = store.put(edges.select("tree", F.col("arg").alias("root")).join(known, ["tree", "root"], "left_anti").select("tree").distinct())
    bad = store.put(fine.join(open_.select("tree", F.col("id").alias("root")), ["tree", "root"], "left_semi").select("tree", "root").union(lost))
    # An argument that is no node waits for itself.
    absent = edges.join(nodes.select("tree", F.col("id").alias("arg")), ["tree", "arg"], "left_anti").select("tree", F.col("arg").alias("id"), "arg")
    stuck = endless(waits.union(absent).join(bad.select("tree"), "tree", "left_semi"), store)
    never = stuck.select("tree", F.col("id").alias("root"), F.lit(True).alias("never"))
    judged = bad.join(never, ["tree", "root"], "left").join(unmet.withColumn("unmet", F.lit(True)), "tree", "left").join(lost.select("tree", F.lit(True).alias("lost")), "tree", "left")
    code = F.when(F.col("lost") | (F.col("unmet") & F.col("never")), "missing_node").when(F.col("never"), "cycle").otherwise("too_deep")
    whole = judged.select("tree", F.col("root").alias("id"), code.alias("code"))
    whole = whole.union(roots.join(repeated, "tree", "left_semi").select("tree", "root", F.lit("repeated_node")))
    # What the roots of good trees reach, a level at a time: as many levels as a tree may have.
    reached = level = store.put(fine.join(bad.select("tree"), "tree", "left_anti").select("tree", F.col("root").alias("id")))
    while not level.isEmpty():
        level = store.put(level.join(edges, KEY).select("tree", F.col("arg").alias("id")).distinct().join(reached, KEY, "left_anti"))
        reached = reached.union(level)
    return whole.union(nodes.join(reached, KEY, "left_semi").select(*KEY, F.explode("codes").alias("code")))


def _within_rows(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """tree, id, code of trees of few nodes; ``nodes``: tree, id, args (no nulls), codes; ``roots``: tree, root, once a tree."""
    each = nodes.select("tree", F.struct("id", "args", "codes").alias("node"), F.lit(None).cast("string").alias("root"), F.lit(False).alias("asked"))
    asked = roots.select("tree", F.lit(None).cast(each.schema["node"].dataType).alias("node"), F.col("root").cast("string").alias("root"), F.lit(True).alias("asked"))
    trees = each.union(asked).groupBy("tree").agg(F.collect_list("node").alias("nodes"), F.max("root").alias("root"), F.max("asked").alias("asked")).where("asked")
    none = F.array().cast("array<string>")
    ids, size = F.col("nodes.id"), F.size("nodes")
    # As a variable of a lambda a value is worked out once; the optimiser would write a column's expression into the inner loop.
    let = lambda value, use: F.transform(F.array(value), use)[0]
    levels = F.greatest(F.least(size, F.lit(MAX_DEPTH)), F.lit(1))
    settled = lambda levels: F.aggregate(F.sequence(F.lit(1), levels), none, lambda done, _: F.filter("nodes", lambda n: F.forall(n["args"], lambda a: F.array_contains(done, a)))["id"])
    in_ = lambda names: F.coalesce(F.array_contains(names, F.col("root")), F.lit(False))
    stands = trees.withColumns({"repeated": F.size(F.array_distinct(ids)) < size, "lost": ~in_(ids), "fine": in_(settled(levels))})
    # A level a node settles all that ever does.
    never = ~in_(settled(F.greatest(size, F.lit(1))))
    unmet = F.size(F.array_except(F.flatten("nodes.args"), ids)) > 0
    code = F.when(F.col("repeated"), "repeated_node").when(F.col("lost"), "missing_node")
    code = code.when(~F.col("fine"), F.when(~never, "too_deep").when(unmet, "missing_node").otherwise("cycle"))
    judged = stands.select("tree", "root", "nodes", code.alias("code"))
    step = lambda seen, _: F.array_union(seen, F.flatten(F.filter("nodes", lambda n: F.array_contains(seen, n["id"]))["args"]))
    reached = F.when(F.col("code").isNull(), F.aggregate(F.sequence(F.lit(1), levels), F.array("root"), step))
    blamed = let(reached, lambda seen: F.filter("nodes", lambda n: F.array_contains(seen, n["id"]) & (F.size(n["codes"]) > 0)))
    own = judged.select("tree", "root", "code", blamed.alias("blamed"))
    whole = lambda code: F.array(F.struct(F.col("root").alias("id"), code.alias("code")))
    blamed = F.flatten(F.transform("blamed", lambda n: F.transform(n["codes"], lambda c: F.struct(n["id"].alias("id"), c.alias("code")))))
    return own.select("tree", F.explode(F.when(F.col("code").isNotNull(), whole(F.col("code"))).otherwise(blamed)).alias("v")).select("tree", "v.id", "v.code")


def tree_violations(nodes: DataFrame, roots: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """tree, id, code of everything wrong with the trees of ``nodes`` (tree, id, op, args, category, key, value) from ``roots`` (tree, root).

    A tree that does not stand has one code, on its root: repeated_node, missing_node, cycle or too_deep. In one that stands
    each node that its root reaches has its own codes: unknown_op, arity, agg_args, unknown_category, no_key, no_number.
    Null arguments are missing nodes; a null root or op is missing or unknown; rows without a tree or an id are left out.
    """
    codes = F.array_compact(F.array(*[F.when(wrong, code) for code, wrong in _node_checks(categories).items()]))
    args = F.transform(F.coalesce("args", F.array().cast("array<string>")), lambda a: F.coalesce(a, F.lit("")))
    nodes = nodes.where("tree IS NOT NULL AND id IS NOT NULL").select(*KEY, args.alias("args"), codes.alias("codes"))
    roots = roots.where("tree IS NOT NULL").groupBy("tree").agg(F.max("root").alias("root"))
    store = Store(nodes.sparkSession, "trees")
    sizes = nodes.groupBy("tree").agg(F.sum(F.size("args") + 1).alias("n"))
    large = store.put(sizes.where(F.col("n") > WHOLE))
    if large.isEmpty():
        return _within_rows(nodes, roots)
    few = [t.join(large, "tree", "left_anti").select(t.columns) for t in (nodes, roots)]
    many = [t.join(large, "tree", "left_semi").select(t.columns) for t in (nodes, roots)]
    return _within_rows(*few).union(_by_rows(*many, store))


def covenant_violations(covenants: DataFrame, ratio: int) -> DataFrame:
    """tree, point, code of the fields of ``covenants`` (tree, point, threshold, unit, start, end, conditional, condition).

    threshold, start and end are texts as they were extracted; condition names the condition's tree. A point that a tree's
    owner states twice is repeated. ``ratio``: the largest threshold that a ratio can have.
    """
    number = F.trim("threshold").try_cast("double")
    number = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    day = lambda c: F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(c).try_cast("date"))
    said = lambda c: F.col(c).isNotNull()
    checks = {
        "threshold_no_number": number.isNull(),
        "threshold_not_positive": number <= 0,
        "ratio_too_large": (F.col("unit") == "ratio") & (number > ratio),
        "bad_period": (said("start") & day("start").isNull()) | (said("end") & day("end").isNull()),
        "period_reversed": day("start") >= day("end"),
        "no_condition": F.col("conditional") & F.col("condition").isNull(),
    }
    codes = F.array_compact(F.array(*[F.when(wrong, code) for code, wrong in checks.items()]))
    each = covenants.select("tree", "point", F.explode(codes).alias("code"))
    twice = covenants.groupBy("owner", "point").agg(F.count("*").alias("n"), F.min("tree").alias("tree")).where("n > 1")
    return each.union(twice.select("tree", "point", F.lit("repeated_point")))
