"""Connected components by alternating star contraction, wholly in DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Scratch

#: Edges that one task may hold (about 100 bytes each).
TASK_EDGES = 1_000_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (v, u) with u < v.

    Large: every neighbour above a node hangs from the smallest in its neighbourhood.
    Small: every node and its lower neighbours hang from the smallest of those.
    The minimum per node is a map-side combined aggregate, so a hub costs one row a task.
    """
    if large:
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m")).select("n", F.least("n", "m").alias("m"))
        # A node above its neighbour n takes the minimum that n knows.
        moved = edges.join(least, edges.u == least.n).select("v", F.col("m").alias("u"))
    else:
        least = edges.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m"))
        linked = edges.join(least, edges.v == least.n)
        moved = linked.select(F.col("u").alias("v"), F.col("m").alias("u")).union(linked.select("v", F.col("m").alias("u")))
    return moved.where("u < v").distinct()


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges replaced by a spanning forest of stars: (node, least node of its component in this task)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for v, u in zip(batch.column("v").to_pylist(), batch.column("u").to_pylist()):
            a, b = root(v), root(u)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())], names=["v", "u"])


def components(edges: DataFrame, scratch: Scratch, task_edges: int = TASK_EDGES, rows: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the smallest node reachable.

    Edges beyond what one task may hold are contracted: each task swaps its edges for a spanning forest, then a star
    round joins the forests. Rounds grow with the logarithm of the node count; each is written to the shared folder, so
    the plan stays short and a lost executor costs one round. Null or self links are ignored; no edges give no rows.
    ``rows``: how many edges there are, if known.
    """
    current = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), rows=rows)
    seen = None
    while True:
        mark = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("v", "u")).alias("x")).first()
        if mark["n"] <= task_edges:
            return current.coalesce(1).mapInArrow(_forest, "v long, u long").select(F.col("v").alias("node"), F.col("u").alias("component"))
        if mark == seen:
            break
        seen = mark
        forest = current.mapInArrow(_forest, "v long, u long").where("u < v").distinct()
        following = scratch.save(_star(_star(scratch.save(forest), True), False))
        scratch.drop(current)
        current = following
    return current.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        current.select(F.col("u").alias("node"), F.col("u").alias("component"))
    ).distinct()
