"""Mixing sources to target weights.

Words are summed by source; a source's target is its weight's share of the mix, but never more than MOST times what it
has, and what such a source cannot give is shared among the others by weight. A source whose target is r times its words
repeats each document floor(r) times, and once more by a Bernoulli draw with the probability that r leaves over.

The draws of a source are not independent: its documents stand in the order of their sizes, one uniform number u comes
from the hash of the seed and the source, and the document at place i draws a copy if a whole number lies in
(i * f + u, (i + 1) * f + u]. Each single draw is a Bernoulli draw of probability f over the seeds, yet among neighbours of
like size the share f is nearly met, so the words taken stay by the target even where few long documents hold most of
them. Documents of one size stand by the hash of the seed and their id. Any rerun draws alike.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Scratch
from tallymark.operators.ranks import ranked

#: How often a document may occur in the mix.
MOST = 3
SEED = "mix"
WORD, BLANKS = r"[^\x20\x09-\x0D]+", " \t\n\x0b\x0c\r"
#: Hexadecimal digits of a digest that make a uniform number.
DIGITS = 13


def n_words(text: Column) -> Column:
    """Number of words (null: 0); each word shrinks to one letter, so that no list of a long text's words is built."""
    return F.coalesce(F.length(F.translate(F.regexp_replace(text, WORD, "x"), BLANKS, "")).cast("long"), F.lit(0).cast("long"))


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the digest of ``key``."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (source, weight, source_size) with target (double): the words that each source gives to the mix.

    All words of all sources are shared out by weight; sources stop at ``most`` times their words, the excess is shared
    again by weight. Each round is one sum over the sources; a round that stops no further source is the last.
    """
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    whole = int(sources.agg(F.sum("source_size").alias("n")).first().n or 0)
    left, weight, stopped = whole, None, F.lit(False)
    while True:
        free = sources.where(~stopped).agg(F.sum("weight").alias("w")).first().w
        held = sources.where(stopped).agg(F.sum(exact("source_size") * most).alias("n")).first().n
        if free is None or int(free) == weight:
            break
        left, weight = whole - int(held or 0), int(free)
        stopped = exact("source_size") * F.lit(Decimal(most * weight)) <= exact("weight") * F.lit(Decimal(left))
    shared = F.col("weight").cast("double") * float(left) / float(weight or 1)
    return sources.withColumn("target", F.when(stopped, (F.col("source_size") * most).cast("double")).otherwise(shared))


def mix(docs: DataFrame, weigh, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of every row of ``docs`` (doc_id, text, source).

    ``weigh`` turns the rank of a source (from 0, by code point, null last) into its weight. Null texts and texts without
    words have the size 0 and bring nothing; a null source is a source. Repeated rows are documents of their own that
    draw one after the other. Rows without an id draw like others. Very long texts are counted whole. Further columns,
    whatever their names, are left behind; no rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    id_, source = F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source")
    sized = docs.select(id_, source, n_words(F.col("text").cast("string")).alias("size"))
    # Written first: texts are read once, and what is dealt by ranges of it is small.
    sized = scratch.save(sized.withColumn("lot", F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id")).cast("binary"))))
    placed = scratch.save(ranked(sized, [F.asc_nulls_last("source"), F.desc("size"), F.asc("lot")], scratch.save, ("source",)))
    sums = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = ranked(sums, [F.asc_nulls_last("source")], scratch.save).withColumn("weight", weigh(F.col("rank")).cast("long"))
    shares = scratch.save(targets(scratch.save(weighed.drop("rank")), most))
    scratch.keep(placed, shares)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = shares.select(F.col("source").alias("of"), "source_size", "target", rate.alias("rate"), uniform(F.concat_ws(":", F.lit(seed), "source")).alias("u"))
    fraction = F.col("rate") - F.floor("rate")
    drawn = F.floor((F.col("rank") + 1) * fraction + F.col("u")) - F.floor(F.col("rank") * fraction + F.col("u"))
    mixed = placed.join(shares, F.col("source").eqNullSafe(F.col("of")))
    copies = (F.floor("rate") + drawn).cast("long")
    return mixed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def emit(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as mix() says, for documents whose doc_id is unique and not null."""
    often = mixed.where("copies > 0").select(F.col("doc_id").alias("_id"), F.sequence(F.lit(1).cast("long"), "copies").alias("_copies"))
    return docs.join(often, docs["doc_id"] == F.col("_id")).withColumn("_copy", F.explode("_copies")).select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words) of every document; sources weigh 1, 2, 3, repeating."""
    mixed = mix(docs, lambda rank: F.pmod(rank, F.lit(3)) + 1)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
