"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors of one label are projected on their leading principal axes (a contraction: two vectors are never closer
than their projections) and sorted by the grid cells, of side epsilon, of those coordinates. The sequence is cut into
blocks of BLOCK vectors with a bounding box each; intervals of FAN blocks, of FAN intervals and so on have boxes too.
The join starts from each label's whole sequence paired with itself and descends level by level, dropping every pair of
intervals whose boxes are farther apart than epsilon. The block pairs left are multiplied exactly, in double precision.

Equal vectors collapse first, into classes with keys of their own, in the order of the smallest ids. Block pairs are
multiplied in tiles of TILE by TILE blocks, so a block travels once for TILE of its pairs. A tile gives link counts per
vector and a spanning forest of its links, so its output grows with its rows, not with its links. The principal axes only
steer the pruning; no link depends on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Scratch, bounded_batches
from tallymark.llm.graph import components

COSINE = 0.98
#: Vectors of a block, intervals joined into one of the next level, and axes that have boxes.
BLOCK, FAN, AXES = 512, 16, 8
#: Blocks on each side of a tile.
TILE = 8
EPSILON = float(np.sqrt(2 - 2 * COSINE)) + 1e-9

BLOCKS = "label long, dim int, part int, n long, ids array<long>, copies array<long>, data binary, lo array<double>, hi array<double>"


def _unit(data: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safely for very large and very small numbers."""
    data = data / np.abs(data).max(axis=1, keepdims=True)
    return data / np.sqrt((data * data).sum(axis=1, keepdims=True))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second moments of unit vectors, as (dim, place, value): one row for each cell of a task's matrices."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = np.asarray(batch.column("dim"))
        for dim in np.unique(dims).tolist():
            x = _unit(np.asarray(batch.column("embedding").filter(pa.array(dims == dim)).flatten(), dtype=float).reshape(-1, dim))
            total[dim] = total.get(dim, 0) + x.T @ x
    for dim, m in total.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(dim * dim, dim), pa.int32()), pa.array(np.arange(dim * dim), pa.int64()), pa.array(m.ravel())], names=["dim", "place", "value"])


def principal_axes(vectors: DataFrame, most_dim: int = 1024) -> dict[int, np.ndarray]:
    """Leading principal axes by dimension, from the second moments of all vectors; dimensions above ``most_dim`` use plain axes."""
    sums = vectors.where(F.col("dim") <= most_dim).select("dim", "embedding").mapInArrow(_moments, "dim int, place long, value double").groupBy("dim", "place").agg(F.sum("value").alias("value"))
    axes = {}
    for dim in [r["dim"] for r in vectors.select("dim").distinct().orderBy("dim").limit(16).collect()]:
        m = np.zeros(dim * dim)
        for row in sums.where(F.col("dim") == dim).collect() if dim <= most_dim else ():
            m[row["place"]] = row["value"]
        axes[dim] = np.linalg.eigh(m.reshape(dim, dim))[1][:, ::-1][:, :AXES] if m.any() else np.eye(dim)[:, :AXES]
    return axes


def _projected(axes: dict[int, np.ndarray], dim: int, unit: np.ndarray) -> np.ndarray:
    """Coordinates on the leading axes, zero beyond the last."""
    out = np.zeros((len(unit), AXES))
    basis = axes.get(dim)
    out[:, : min(dim, AXES)] = unit @ basis if basis is not None else unit[:, :AXES]
    return out


def _blocks(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks of the epsilon grid order with their boxes."""
    axes = principal_axes(classes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, out = np.asarray(batch.column("dim")), np.zeros((batch.num_rows, AXES))
            for dim in np.unique(dims).tolist():
                mine = dims == dim
                x = np.asarray(batch.column("embedding").filter(pa.array(mine)).flatten(), dtype=float).reshape(-1, dim)
                out[mine] = _projected(axes, dim, _unit(x))
            cell = pa.FixedSizeListArray.from_arrays(pa.array(np.floor(out / EPSILON).astype(np.int32).ravel()), AXES)
            yield pa.RecordBatch.from_arrays([*batch.columns, cell.cast(pa.list_(pa.int32()))], names=[*batch.schema.names, "cell"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        key = None

        def out():
            nonlocal n
            data = np.array([h[2] for h in held], float)
            at = _projected(axes, key[1], _unit(data))
            row = [[key[0]], [key[1]], [part], [n], [[h[0] for h in held]], [[h[1] for h in held]], [data.tobytes()], [(at.min(0) - 1e-9).tolist()], [(at.max(0) + 1e-9).tolist()]]
            n += 1
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=["label", "dim", "part", "n", "ids", "copies", "data", "lo", "hi"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("label", "dim", "key", "n", "embedding")]
            for label, dim, own, copies, vector in zip(*columns):
                if held and (key != (label, dim) or len(held) == BLOCK):
                    yield out()
                    held = []
                key = (label, dim)
                held.append((own, copies, vector))
        if held:
            yield out()

    bounded_batches(classes.sparkSession)
    ordered = classes.select("label", "dim", "key", "n", "embedding").mapInArrow(cells, "label long, dim int, key long, n long, embedding array<double>, cell array<int>")
    keys = ["label", "dim", "cell", "key"]
    found = scratch.save(ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(cut, BLOCKS))
    # One row a partition: the number of blocks before it makes the sequence without gaps, however long a partition is.
    counts = found.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    before = dict(zip([r["part"] for r in counts], [0, *accumulate(r["n"] for r in counts)]))
    offsets = classes.sparkSession.createDataFrame([*before.items(), (-1, 0)], "part int, before long")
    return found.join(F.broadcast(offsets), "part").withColumn("seq", F.col("before") + F.col("n")).drop("part", "n", "before")


def _near(a: str, b: str):
    """Whether two boxes are at most epsilon apart."""
    gap = F.aggregate(
        F.zip_with(
            F.zip_with(F.col(f"{a}.lo"), F.col(f"{b}.hi"), lambda x, y: x - y),
            F.zip_with(F.col(f"{b}.lo"), F.col(f"{a}.hi"), lambda x, y: x - y),
            lambda x, y: F.greatest(x, y, F.lit(0.0)),
        ),
        F.lit(0.0),
        lambda s, g: s + g * g,
    )
    return gap <= EPSILON * EPSILON


def block_pairs(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(label, dim, a, b) with a <= b: sequence numbers of the block pairs that no box rules out."""
    boxes = scratch.save(blocks.select("label", "dim", "seq", "lo", "hi"))
    top = boxes.agg(F.max("seq").alias("m")).first()["m"] or 0
    levels = 0
    while top >> (4 * levels):
        levels += 1
    each = lambda f, c: F.array(*[f(F.col(c)[i]) for i in range(AXES)]).alias(c)

    def level(k: int) -> DataFrame:
        at = F.shiftright("seq", 4 * k)
        return boxes.groupBy("label", "dim", at.alias("at")).agg(each(F.min, "lo"), each(F.max, "hi")) if k else boxes.select("label", "dim", F.col("seq").alias("at"), "lo", "hi")

    pairs = level(levels).select("label", "dim", F.col("at").alias("a"), F.col("at").alias("b"))
    for k in range(levels - 1, -1, -1):
        below = level(k).select("label", "dim", F.shiftright("at", 4).alias("up"), F.struct("at", "lo", "hi").alias("box"))
        left = below.select("label", "dim", F.col("up").alias("a"), F.col("box").alias("x"))
        right = below.select("label", "dim", F.col("up").alias("b"), F.col("box").alias("y"))
        met = pairs.join(left, ["label", "dim", "a"]).join(right, ["label", "dim", "b"]).where(F.col("x.at") <= F.col("y.at")).where(_near("x", "y"))
        pairs = met.select("label", "dim", F.col("x.at").alias("a"), F.col("y.at").alias("b"))
    return scratch.save(pairs)


def _forest(linked: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a block pair, the least node of their component (rows first, then columns)."""
    n, m = linked.shape
    rows, cols = np.arange(n), np.arange(m) if same else np.arange(n, n + m)
    none = n + m
    while True:
        new_rows = np.minimum(rows, np.where(linked, cols[None, :], none).min(axis=1))
        new_cols = np.minimum(cols, np.where(linked, new_rows[:, None], none).min(axis=0))
        if same:
            new_rows = new_cols = np.minimum(new_rows, new_cols)
        if (new_rows == rows).all() and (new_cols == cols).all():
            return rows, cols
        rows, cols = new_rows, new_cols


def _join(tile: pa.Table) -> pa.Table:
    """(id, links, other) of a tile's block pairs: partial link counts have no other; links of the spanning forests count 0."""
    held = {}
    for seq, dim, partners, ids, copies, data in zip(*(tile.column(c) for c in ("seq", "dim", "partners", "ids", "copies", "data"))):
        vectors = _unit(np.frombuffer(data.as_buffer()).reshape(-1, dim.as_py()))
        held[seq.as_py()] = (partners.as_py(), np.asarray(ids.values), np.asarray(copies.values), vectors)
    ids, links, others = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [pa.array([], pa.int64())]
    for a, (partners, ids_a, copies_a, x) in held.items():
        for b in partners:
            same, (_, ids_b, copies_b, y) = a == b, held[b]
            linked = x @ y.T >= COSINE
            if same:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            for own, n in [(ids_a, linked @ copies_b)] + ([] if same else [(ids_b, linked.T @ copies_a)]):
                ids.append(own[n > 0])
                links.append(n[n > 0])
                others.append(pa.nulls(len(ids[-1]), pa.int64()))
            rows, cols = _forest(linked, same)
            nodes = ids_a if same else np.concatenate([ids_a, ids_b])
            label = rows if same else np.concatenate([rows, cols])
            tied = label != np.arange(len(nodes))
            ids.append(nodes[tied])
            links.append(np.zeros(tied.sum(), np.int64))
            others.append(pa.array(nodes[label[tied]], pa.int64()))
    return pa.table({"id": np.concatenate(ids), "links": np.concatenate(links).astype(np.int64), "other": pa.concat_arrays(others)})


def _tiles(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """The blocks of every tile, each with those it is to be multiplied with there (TILE at most)."""
    at = lambda c: F.floor(F.col(c) / TILE).alias(f"tile_{c}")
    tiled = pairs.select("a", "b", at("a"), at("b"))
    tile = ["tile_a", "tile_b"]
    left = tiled.groupBy(*tile, F.col("a").alias("seq")).agg(F.collect_list("b").alias("partners"))
    right = tiled.select(*tile, F.col("b").alias("seq")).distinct().withColumn("partners", F.array().cast("array<bigint>"))
    both = left.union(right).groupBy(*tile, "seq").agg(F.flatten(F.collect_list("partners")).alias("partners"))
    return both.join(blocks.select("seq", "dim", "ids", "copies", "data"), "seq").groupBy(*tile).applyInArrow(_join, "id long, links long, other long")


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Vectors are compared when their labels are equal and not null; those that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of unequal lengths with each other. Each row counts as one
    vector, so equal rows link, and rows of one id with unequal vectors have links and components of their own. A row
    with a null id links with nothing and has no component; it is kept. Further columns are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ego")
    bounded_batches(spark)
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad) & F.exists("embedding", lambda v: v != 0)
    clean = clean.withColumn("key", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64("label", "embedding")))
    usable = clean.where("key IS NOT NULL")
    classes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).withColumn("dim", F.size("embedding"))
    # Keys are unique and in the order of rep, so the smallest key of a component has its smallest id.
    classes = scratch.save(classes.repartitionByRange("rep", "label", "dim").sortWithinPartitions("rep", "label", "dim").withColumn("key", F.monotonically_increasing_id()))
    blocks = _blocks(classes, scratch)
    found = scratch.save(_tiles(block_pairs(blocks, scratch), blocks))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    labels = scratch.save(components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")), scratch))
    least = classes.select(F.col("key").alias("component"), F.col("rep").alias("component_id"))
    labels = labels.where("node <> component").join(least, "component").select("node", "component_id")
    named = classes.join(counts, classes.key == counts.id, "left").join(labels, classes.key == labels.node, "left")
    named = scratch.save(named.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")))
    scratch.keep(named)
    out = clean.join(named.withColumn("key", F.xxhash64("label", "embedding")), ["key", "label", "embedding"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
