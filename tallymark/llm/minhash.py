"""Near-duplicate documents by HyperMinHash: compressed registers, banding, estimate, verification.

Every document's set of word shingles gives REGISTERS minima; a register keeps the leading-zero count (6 bits) and the
next MANTISSA bits of its minimum. Four 16-bit registers make one 64-bit band value, so a band needs no further hash.
At a similarity of 0.75 a pair shares none of 32 bands with probability (1 - 0.75**4)**32 = 5e-6.

Equal sets collapse into classes first; a class has a key of its own, in the order of the smallest ids, so that one id
may stand on several texts. In each bucket, members are compared with hubs instead of with each other: first with the
smallest member, then, for as long as the members left belong to different components, with members of all components
but the largest. A hub has met all of its bucket and leaves it. A pair is left out only when its two ends are already in
one component, have been compared, or differ in so many cells of a parity sketch that they cannot be linked. So the
components are those of all pairs in all buckets, while a bucket of m copies costs m sketch comparisons a hub.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Scratch, bounded_batches, slices, texts
from tallymark.llm.graph import components
from tallymark.llm.shingles import mix, shingle_hashes

REGISTERS, ROWS, MANTISSA, WIDTH = 128, 4, 10, 5
BANDS = REGISTERS // ROWS
#: Shares, in hundredths: linked when 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
#: A pair is verified if its estimate reaches the threshold less this many standard errors.
SLACK = 4.5
#: In the round after its most central member a bucket takes one hub of each component but the largest; in each further
#: round so many times as many.
FASTER = 8
#: Members of a bucket that one task compares with the bucket's hubs.
TILE = 1024
#: Cells of the sketch that rules pairs out.
ODD_BITS = 10
ODD = 1 << ODD_BITS

SIGNED = "doc_id long, body long, n_shingles long, fp1 long, fp2 long, sig array<long>"


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers (uint16) of non-empty sets of 64-bit hashes, one row each."""
    seeds = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.intp)
    least = np.empty((REGISTERS, len(sets)), np.uint64)
    for k in range(REGISTERS):
        least[k] = np.minimum.reduceat((flat ^ (seeds[k] >> np.uint64(7))) * seeds[k], starts)
    least = np.maximum(least.T, np.uint64(1))
    zeros = (64 - np.frexp(least.astype(np.float64))[1]).clip(0, 63).astype(np.uint64)
    mantissa = (least << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return np.ascontiguousarray((zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        sets = shingle_hashes(part.column("text"), WIDTH)
        full = [i for i, s in enumerate(sets) if len(s)]
        sigs = [None] * len(sets)
        if full:
            for i, row in zip(full, registers([sets[i] for i in full]).view(np.int64).tolist()):
                sigs[i] = row
        prints = [[int(v) for v in (np.bitwise_xor.reduce(mix(s)).view(np.int64), np.add.reduce(mix(s ^ np.uint64(0xA5A5A5A5))).view(np.int64))] if len(s) else [None, None] for s in sets]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("body"), pa.array([len(s) for s in sets], pa.int64()), pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()), pa.array(sigs, pa.list_(pa.int64()))],
            names=["doc_id", "body", "n_shingles", "fp1", "fp2", "sig"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, body (a hash of the text), n_shingles, a 128-bit fingerprint of the set and its compressed registers (null for empty sets)."""
    bounded_batches(docs.sparkSession)
    return texts(docs).withColumn("body", F.xxhash64("text")).mapInArrow(_sign, SIGNED)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard from equal registers, corrected for the registers that agree by chance."""
    chance = np.log(2) * 2.0**-MANTISSA * n * m / (n + m) ** 2
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose corrected estimate can belong to linked sets."""
    t = THRESHOLD / 100
    least = t - SLACK * np.sqrt(t * (1 - t) / REGISTERS)
    for batch in batches:
        if batch.num_rows:
            a, b = (np.asarray(batch.column(c).flatten()).reshape(batch.num_rows, -1).view(np.uint16) for c in ("sig_a", "sig_b"))
            n, m = (np.asarray(batch.column(c)).astype(float) for c in ("n_a", "n_b"))
            keep = (estimate(a, b, n, m) >= least) & (100 * np.minimum(n, m) >= THRESHOLD * np.maximum(n, m))
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose full sets are linked."""
    for batch in batches:
        for part in slices(slices([batch], "text_a"), "text_b"):
            keep = []
            for x, y in zip(shingle_hashes(part.column("text_a"), WIDTH), shingle_hashes(part.column("text_b"), WIDTH)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verify(pairs: DataFrame, classes: DataFrame, bodies: DataFrame) -> DataFrame:
    """Pairs (a, b) of class keys: estimate on signatures, then exact sets of the whole texts."""
    side = lambda df, s, *cols: df.select(F.col("key").alias(s), *[F.col(c).alias(f"{n}_{s}") for c, n in cols])
    sigs = (("sig", "sig"), ("n_shingles", "n"))
    likely = pairs.join(side(classes, "a", *sigs), "a").join(side(classes, "b", *sigs), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(_likely, "a long, b long")
    body = (("text", "text"),)
    return likely.join(side(bodies, "a", *body), "a").join(side(bodies, "b", *body), "b").select("a", "b", "text_a", "text_b").mapInArrow(_linked, "a long, b long")


def _odd_sketches(bodies: DataFrame) -> DataFrame:
    """(key, odd): for each of ODD cells of the hash space, whether the text has an odd number of shingles in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            odd = [np.packbits(np.bincount((s >> np.uint64(64 - ODD_BITS)).astype(np.int64), minlength=ODD) & 1).view(np.int64).tolist() for s in shingle_hashes(part.column("text"), WIDTH)]
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(odd, pa.list_(pa.int64()))], names=["key", "odd"])

    return bodies.select("key", "text").mapInArrow(run, "key long, odd array<long>")


def _mixed(members: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The members (bucket, key) of buckets in which several components are left, with component and the bucket's tiles.

    A bucket's rows are only ever summed up by partial aggregates, however many it has.
    """
    rows = members.count()
    labelled = scratch.save(members.join(labels, "key", "left").withColumn("component", F.coalesce("component", "key")), rows=rows)
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    out = scratch.save(labelled.join(mixed.select("bucket", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")), "bucket"), rows=rows)
    scratch.drop(labelled)
    return out


def _hubs(open_: DataFrame, width: int) -> DataFrame:
    """Next hubs of each bucket, as (bucket, hub, hub_component, hub_n, hub_odd, tiles).

    First (width 0) the member of the most open buckets, which many copies are likely to be near; after that, ``width``
    members at most of every component but the one with the most members in the bucket. Minima of partial aggregates:
    neither a large bucket nor a large component goes to one task.
    """
    m = F.struct(-F.col("degree"), "key", "n_shingles", "odd", "component", "tiles")
    if not width:
        sides = open_.groupBy("bucket").agg(F.min(m).alias("m"))
    else:
        largest = open_.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("largest"))
        sides = open_.groupBy("bucket", "component", F.pmod(F.xxhash64("key", F.lit(width)), F.lit(width)).alias("share")).agg(F.min(m).alias("m"))
        sides = sides.join(largest, "bucket").where("component <> largest")
    return sides.select("bucket", F.col("m.key").alias("hub"), F.col("m.component").alias("hub_component"), F.col("m.n_shingles").alias("hub_n"), F.col("m.odd").alias("hub_odd"), F.col("m.tiles").alias("tiles"))


def _possible() -> Column:
    """Whether sizes and odd sketches leave a pair a chance to be linked.

    Cells of unequal parity are at most as many as the shingles that only one of the two holds, and linked sets hold
    at most (100 - THRESHOLD) / (100 + THRESHOLD) of their sizes' sum that way.
    """
    differ = reduce(lambda a, b: a + b, [F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("hub_odd")[i])) for i in range(ODD // 64)])
    sizes = 100 * F.least("n_shingles", "hub_n") >= THRESHOLD * F.greatest("n_shingles", "hub_n")
    return sizes & ((100 + THRESHOLD) * differ <= (100 - THRESHOLD) * (F.col("n_shingles") + F.col("hub_n")))


def _met(open_: DataFrame, chosen: DataFrame) -> DataFrame:
    """Pairs (a, b) of a hub and a member of another component of its bucket that may be linked; a large bucket is cut into tiles."""
    members = open_.select("bucket", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int").alias("tile"), "key", "component", "n_shingles", "odd")
    hubs = chosen.select(F.col("bucket").alias("at"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("at_tile"), "hub", "hub_component", "hub_n", "hub_odd")
    met = members.join(hubs, (F.col("bucket") == F.col("at")) & (F.col("tile") == F.col("at_tile")) & (F.col("component") != F.col("hub_component")) & _possible())
    return met.select(F.least("hub", "key").alias("a"), F.greatest("hub", "key").alias("b")).distinct()


def labelled_copies(docs: DataFrame) -> DataFrame:
    """As near_duplicates(), with body (xxhash64 of the text), which tells rows of one id and unequal texts apart."""
    spark, docs = docs.sparkSession, texts(docs)
    scratch = Scratch(spark, "minhash")
    signed = scratch.save(signatures(docs))
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Any row of a class has its set; the one of the smallest id stands for it.
    classes = usable.groupBy("fp1", "fp2", "n_shingles").agg(F.min_by("sig", F.struct("doc_id", "body")).alias("sig"), F.min(F.struct("doc_id", "body")).alias("m"))
    classes = classes.select("fp1", "fp2", "n_shingles", "sig", F.col("m.doc_id").alias("rep"), F.col("m.body").alias("body"))
    # Keys are unique and in the order of rep, so the smallest key of a component has its smallest id.
    order = ["rep", "body", "n_shingles", "fp1", "fp2"]
    classes = scratch.save(classes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("key", F.monotonically_increasing_id()))
    n = classes.count()
    posted = classes.select("key", F.posexplode("sig").alias("band", "value")).select(F.xxhash64("band", "value").alias("bucket"), "key")
    crowded = posted.groupBy("bucket").agg(F.min("key").alias("hub"), F.count("*").alias("n")).where("n > 1")
    buckets = scratch.save(posted.join(crowded, "bucket").where("key <> hub").select("bucket", "key", "hub"), rows=n)
    checked = scratch.save(buckets.select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct(), rows=buckets.count())
    # Only the texts of crowded buckets are ever compared; repeated rows give one text.
    used = checked.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(classes.select("key", F.col("rep").alias("doc_id"), "body"), "key")
    bodies = docs.withColumn("body", F.xxhash64("text")).join(used, ["doc_id", "body"]).groupBy("doc_id", "body", "key").agg(F.first("text").alias("text")).select("key", "text")
    bodies = scratch.save(bodies)
    links = scratch.save(_verify(checked, classes, bodies).repartition(scratch.files(checked.count())))
    labels = scratch.save(components(links, scratch, rows=links.count()).withColumnRenamed("node", "key"))
    open_ = _mixed(buckets.select("bucket", "key"), labels, scratch)
    facts = open_.groupBy("key").agg(F.count("*").alias("degree")).join(classes.select("key", "n_shingles"), "key")
    facts = scratch.save(facts.join(_odd_sketches(bodies.join(open_.select("key").distinct(), "key", "left_semi")), "key"), rows=open_.count())
    width = 0
    while rows := open_.count():
        members = open_.join(facts, "key")
        chosen = scratch.save(_hubs(members, width), rows=rows)
        pairs = scratch.save(_met(members, chosen).join(checked, ["a", "b"], "left_anti"), rows=rows)
        links = links.union(scratch.save(_verify(pairs, classes, bodies).repartition(scratch.files(pairs.count()))))
        checked = checked.union(pairs)
        labels = scratch.save(components(links, scratch, rows=links.count()).withColumnRenamed("node", "key"))
        met = chosen.select("bucket", F.col("hub").alias("key"))
        open_ = _mixed(open_.select("bucket", "key").join(met, ["bucket", "key"], "left_anti"), labels, scratch)
        width = max(1, FASTER * width)
    least = classes.select(F.col("key").alias("component"), F.col("rep").alias("component_id"))
    moved = labels.where("key <> component").join(least, "component").select("key", "component_id")
    named = classes.select("key", "fp1", "fp2", "n_shingles", "rep").join(moved, "key", "left")
    named = scratch.save(named.select("fp1", "fp2", "n_shingles", F.coalesce("component_id", "rep").alias("component_id")), rows=n)
    scratch.keep(signed, named)
    joined = signed.select("doc_id", "body", "n_shingles", "fp1", "fp2").join(named, ["fp1", "fp2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), "body").withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Null and wordless texts have an empty set, link with nothing and are kept, as are rows without an id (component
    null). Repeated rows all come back, with one component; rows of one id and unequal texts are documents of their own,
    each with the component of its text. Very long texts are read whole. Further columns, whatever their names, are ignored.
    """
    return labelled_copies(docs).select("doc_id", "n_shingles", "component_id", "kept")
