"""Conversation prefix trie by one global sort.

A turn becomes a 16-byte digest, a conversation the string of its turns' digests: strings that begin alike stand together
once sorted, a prefix right before what it begins. Rows are dealt by ranges of (string, conv_id), so equal
conversations spread over tasks as well. Each task sweeps its rows once: the turns that a row shares with the row before it
say which nodes on the stack close and which open. All that a node needs is a sum over the rows of its interval:

* its own rows and its children's, counted where a row leaves the row before it;
* leaves: rows that the next row does not continue;
* code points: all of the members' turns, less those of every distinct node, which the row that opens it brings.

Nodes on the path of a task's first row or last row may go on beyond the task; they come out as parts, and the shared turns
of a task's last row and the next task's first row, found over the one row that each task leaves, stitch the parts by
plain sums. Of a task only its stack is in memory; texts never leave the first stage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Scratch, bounded_batches

#: Bytes of a turn's or a node's digest.
WIDTH = 16
#: Ids of one row of a node's list of ends.
IDS = 1 << 16
#: Conversations of one block may begin with the first turns of the block's first one, fewer than HEADS of them.
BLOCK, HEADS = 100, 6
NODE, PART, ENDS, EDGE = range(4)
SWEPT = (
    "kind int, part int, node binary, parent binary, depth long, conv_id long, n long, children long, leaves long, total long, fresh long, first long, prefix long, at_first boolean, at_last boolean,"
    " ends string, seq long, ids string, first_key binary, first_lens array<long>, last_key binary"
)
COLUMNS = [c.split()[0] for c in SWEPT.split(",")]


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): digest and code points of each turn, in the order of turn (null first, ties by the digest).

    Null roles and texts are empty; rows without a conv_id belong to no conversation and are left out. A conversation is
    one row of 24 bytes a turn, whatever its texts hold.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("size"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), place.alias("place"))
    turns = F.transform(F.array_sort(F.collect_list("place")), lambda p: F.struct(p["digest"].alias("digest"), p["size"].alias("size")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def rebuilt(arrays: DataFrame) -> DataFrame:
    """``arrays`` with the first h turns of the block's first conversation before the turns that follow the first h own ones."""
    base, h = F.col("conv_id") - F.col("conv_id") % BLOCK, F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    heads = arrays.where(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    joined = arrays.withColumn("base", base).join(heads, "base", "left")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    borrowed = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    return joined.select("conv_id", F.concat(borrowed, own).alias("turns"))


def shared(a: bytes, b: bytes) -> int:
    """Number of leading turns that two strings of digests have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // WIDTH


class _Open:
    """A node on the stack: what its rows so far add up to."""

    __slots__ = ("node", "conv_id", "n", "children", "leaves", "total", "fresh", "first", "prefix", "at_first", "ids", "seq")

    def __init__(self, node: bytes, conv_id: int, first: int, prefix: int, at_first: bool):
        self.node, self.conv_id, self.first, self.prefix, self.at_first = node, conv_id, first, prefix, at_first
        self.n = self.children = self.leaves = self.total = self.fresh = self.seq = 0
        self.ids: list[int] = []


class _Sweep:
    """One pass over sorted rows; what is finished gathers in ``out``."""

    def __init__(self, part: int):
        self.part, self.stack, self.out = part, [], []
        self.key: bytes | None = None

    def put(self, kind: int, **values) -> None:
        self.out.append({"kind": kind, "part": self.part} | values)

    def flush(self, top: _Open) -> None:
        if top.ids:
            self.put(ENDS, node=top.node, seq=top.seq, ids=",".join(map(str, top.ids)))
            top.seq, top.ids = top.seq + 1, []

    def close(self, depth: int, last: bool = False) -> None:
        """Take all nodes below ``depth`` off the stack, each into its parent; ``last``: no further row comes."""
        while len(self.stack) > depth + 1:
            top = self.stack.pop()
            parent = self.stack[-1] if self.stack else None
            whole = not (top.at_first or last)
            if not whole or top.seq:
                self.flush(top)
            ends = None if not whole or top.seq else hashlib.sha256(",".join(map(str, top.ids)).encode()).hexdigest()
            sums = {c: getattr(top, c) for c in ("node", "conv_id", "n", "children", "leaves", "total", "fresh", "first", "prefix", "at_first")}
            self.put(NODE if whole else PART, parent=parent and parent.node, depth=len(self.stack), at_last=last, ends=ends, **sums)
            if parent:
                parent.conv_id = min(parent.conv_id, top.conv_id)
                for c in ("n", "leaves", "total", "fresh"):
                    setattr(parent, c, getattr(parent, c) + getattr(top, c))

    def row(self, conv_id: int, key: bytes, lens: list[int]) -> None:
        length, total = len(key) // WIDTH, sum(lens)
        begins = self.key is None
        if begins:
            common = -1
            self.put(EDGE, first_key=key, first_lens=lens)
        else:
            common = shared(self.key, key)
            self.stack[-1].leaves += common < len(self.stack) - 1
            self.close(common)
            self.stack[-1].fresh += sum(lens[common:])
            self.stack[-1].children += length > common
        prefix = sum(lens[: max(common, 0)])
        for d in range(common + 1, length + 1):
            digest = hashlib.blake2b(self.stack[-1].node + key[(d - 1) * WIDTH : d * WIDTH], digest_size=WIDTH).digest() if d else bytes(WIDTH)
            opened = _Open(digest, conv_id, total, prefix, begins)
            opened.children = int(not begins and d < length)
            self.stack.append(opened)
            prefix += lens[d - 1] if d else 0
        top = self.stack[-1]
        top.conv_id = min(top.conv_id, conv_id)
        top.n += 1
        top.total += total
        top.ids.append(conv_id)
        if len(top.ids) >= IDS:
            self.flush(top)
        self.key = key

    def finish(self) -> None:
        if self.key is not None:
            self.put(EDGE, last_key=self.key)
            self.close(-1, last=True)

    def batch(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.RecordBatch.from_pylist([{c: r.get(c) for c in COLUMNS} for r in rows], schema=SCHEMA)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
SCHEMA = pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in SWEPT.split(","))])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweep = _Sweep(TaskContext.get().partitionId())
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "lens"))):
            sweep.row(*row)
        yield sweep.batch()
    sweep.finish()
    yield sweep.batch()


STITCHED = "part int, common long, brought long, first_length long, last_leaf long"


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From each task's first and last row, in order: the turns that its first row shares with the row before it (-1: none
    before it), the code points that row brings beyond them, its length, and whether the task's last row is a leaf."""
    out, before = [], None
    for batch in batches:
        for part, first, lens, last in zip(*(batch.column(c).to_pylist() for c in ("part", "first_key", "first_lens", "last_key"))):
            common = -1 if before is None else shared(before, first)
            if out:
                out[-1]["last_leaf"] = int(common < len(before) // WIDTH)
            out.append({"part": part, "common": common, "brought": sum(lens[max(common, 0) :]), "first_length": len(lens), "last_leaf": 1})
            before = last
    names = ("part", "common", "brought", "first_length", "last_leaf")
    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int32() if c == "part" else pa.int64()) for c in names], names=list(names))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of each node's ids, whose rows come one after another in order."""
    node, running, out = None, None, []
    for batch in batches:
        for this, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if this != node:
                if node is not None:
                    out.append((node, running.hexdigest()))
                node, running = this, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())], names=["node", "ends"])
        out = []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], names=["node", "ends"])


def trie(arrays: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of ``arrays`` (conv_id, turns of digest and size), from the root.

    node and parent (digests; the root's parent is null), depth, conv_id (smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. A conversation without turns is a member of the root. No
    conversations give no rows. The digest of one node's ends is one running sum over its ids, in one task but in rows of
    IDS; all else about equal conversations is dealt to many. A single conversation's turns stand in one row.
    """
    spark = arrays.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "trie")
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    strings = scratch.save(arrays.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["size"]).alias("lens")))
    swept = scratch.save(strings.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_sweep, SWEPT))
    scratch.drop(strings)
    # One row a task: its first and its last row.
    edges = swept.where(F.col("kind") == EDGE).groupBy("part").agg(*[F.max_by(c, F.col(c).isNotNull()).alias(c) for c in ("first_key", "first_lens", "last_key")])
    edges = edges.repartition(1).sortWithinPartitions("part").mapInArrow(_stitch, STITCHED)
    parts = swept.where(F.col("kind") == PART).join(edges, "part")
    goes_on = F.col("at_first") & (F.col("depth") <= F.col("common"))
    new_child = F.col("at_first") & (F.col("depth") < F.col("first_length")) & (F.col("common") <= F.col("depth"))
    sums = {
        "n": F.col("n"),
        "children": F.col("children") + new_child.cast("long"),
        "leaves": F.col("leaves") + F.when(F.col("at_last"), F.col("last_leaf")).otherwise(0),
        "total": F.col("total"),
        "fresh": F.col("fresh") + F.when(goes_on, F.col("brought")).otherwise(0),
    }
    stitched = parts.groupBy("node", "parent", "depth", "prefix").agg(F.min("conv_id").alias("conv_id"), *[F.sum(v).alias(c) for c, v in sums.items()], F.min_by("first", "part").alias("first"))
    ids = swept.where(F.col("kind") == ENDS).select("node", "part", "seq", "ids")
    digests = ids.repartition("node").sortWithinPartitions("node", "part", "seq").mapInArrow(_digests, "node binary, ends string")
    columns = ["node", "parent", "depth", "prefix", "conv_id", *sums, "first"]
    whole = swept.where(F.col("kind") == NODE)
    rest = stitched.select(*columns).union(whole.where("ends IS NULL").select(*columns)).join(digests, "node", "left")
    nodes = scratch.save(whole.where("ends IS NOT NULL").select(*columns, "ends").union(rest.select(*columns, "ends")))
    scratch.keep(nodes)
    above = nodes.where("children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    saved = F.col("total") - F.col("n") * F.col("prefix") - F.col("fresh") - (F.col("first") - F.col("prefix"))
    named = nodes.join(above, "parent", "left")
    return named.select(
        "node", "parent", "depth", "conv_id", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def report(conversations: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations by smallest member and depth."""
    nodes = trie(rebuilt(turn_arrays(conversations)))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
