"""Secret scans behind a trigram inverted index, with DataFrame functions only.

Each rule's regular expression yields a Boolean query over trigrams: clauses that must all hold, each a choice of
trigram sets. One pass over a text finds the trigrams that the queries name, and the index keeps, by trigram, the texts
that hold it. A rule's postings are intersected within a set, united over the choices and intersected over the clauses;
what is left are its candidates, which the regular expression verifies. Rules that demand no trigram scan every text.

Postings name a text by its 64-bit hash, so equal texts share them; two texts of one hash would only share candidates,
which are verified each by itself. All grouping is by text or by partial aggregates, never by trigram, so a trigram
that every text holds, or a text that a third of all rows repeat, loads no task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Scratch
from tallymark.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern, the group whose length counts, and the least length of a secret."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base kinds, in the order of the contract.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
#: Further public token formats.
FURTHER = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("login", r"://[^\s/:@]+:[^\s/:@]+@"),
)
RULES = BASE + FURTHER

SPANS = "array<struct<start:bigint,rank:int,kind:string,stop:bigint>>"


def _scanned(rule: Rule) -> str:
    """The pattern as run: for a plain run whose length alone decides, shorter runs need not be matched at all."""
    if rule.kind == "hex":
        return r"[0-9a-f]{16,}"
    return rule.pattern


def vocabulary(rules: tuple[Rule, ...] = RULES) -> list[str]:
    """The trigrams that the rules' queries name, in order."""
    return sorted({t for r in rules for clause in trigram_query(r.pattern) or () for option in clause for t in option})


def index(docs: DataFrame, names: list[str]) -> DataFrame:
    """The inverted index of ``docs`` (key, text) over the trigrams ``names``: distinct (trigram, key), trigram by its place in names.

    The trigrams of a text overlap, so each is captured ahead of an empty match.
    """
    by_first = {c: [re.escape(t[1:]) for t in names if t[0] == c] for c in sorted({t[0] for t in names})}
    every = "(?=(" + "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + "))"
    held = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(every), F.lit(1)))
    place = F.array_position(F.array(*map(F.lit, names)), F.col("t")).cast("int") - 1
    return docs.select("key", F.explode(held).alias("t")).distinct().select(place.alias("trigram"), "key")


def candidates(postings: DataFrame, rules: tuple[Rule, ...], names: list[str]) -> DataFrame:
    """(key, rules): the texts that some rules' queries admit, with the bits of those rules."""
    place = {t: i for i, t in enumerate(names)}
    asked = [
        (1 << r, c, o, len(option), len(query), place[t])
        for r, rule in enumerate(rules)
        if (query := trigram_query(rule.pattern)) is not None
        for c, clause in enumerate(query)
        for o, option in enumerate(sorted(clause, key=sorted))
        for t in sorted(option)
    ]
    # As many rows as the rules' queries name trigrams.
    query = F.broadcast(postings.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(map(str, asked))} AS asked(rule, clause, option, trigrams, clauses, trigram)"))
    met = postings.join(query, "trigram").groupBy("key", "rule", "clauses", "clause", "option", "trigrams").agg(F.count("*").alias("n")).where("n = trigrams")
    met = met.select("key", "rule", "clauses", "clause").distinct().groupBy("key", "rule", "clauses").agg(F.count("*").alias("n")).where("n = clauses")
    return met.groupBy("key").agg(F.bit_or(F.col("rule").cast("long")).alias("rules"))


#: Matches whose positions are summed up one after the other; blocks of so many are then moved to their places.
BLOCK = 256


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blocks(items: Column) -> Column:
    """An array (a column or a bound value) cut into arrays of BLOCK."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(items) / BLOCK).cast("int") - 1, F.lit(0))), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def running(values: Column, add) -> Column:
    """Running results of ``add`` before each value of an array of longs, from 0."""
    zero = F.array(F.lit(0).cast("long"))
    return F.aggregate(values, zero, lambda acc, v: F.concat(acc, F.array(add(F.element_at(acc, -1), v))))


def _spans(rule: Rule, rank: int, gaps: Column, hits: Column, grouped: Column) -> Column:
    """Spans of the matches, in code points: each match starts where the gaps and matches before it end."""
    long = lambda c: c.cast("long")
    zipped = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"), grouped.alias("kept")),
        lambda x: F.struct(long(F.length(x["gap"])).alias("gap"), long(F.length(x["hit"])).alias("hit"), F.length(x["kept"]).alias("kept")),
    )
    zero = F.lit(0).cast("long")
    parts = bound(zipped, lambda items: F.transform(blocks(items), lambda b: F.struct(b.alias("b"), F.aggregate(b, zero, lambda n, x: n + x["gap"] + x["hit"]).alias("n"))))
    placed = bound(parts, lambda p: F.arrays_zip(p.alias("part"), F.slice(running(F.transform(p, lambda q: q["n"]), lambda a, n: a + n), 1, F.size(p)).alias("at")))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        stop = begin + x["hit"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(x["kept"] >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).cast(SPANS).alias("spans"))

    own = lambda z: F.aggregate(z["part"]["b"], F.struct(z["at"].alias("at"), F.array().cast(SPANS).alias("spans")), step, lambda acc: acc["spans"])
    return F.flatten(F.transform(placed, own))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id (or the columns ``keep``) and, for each rule, the array of its spans (column ``spans_<kind>``) in every row's whole text.

    Matches are leftmost and non-overlapping per kind; those whose group is too short are dropped. A null or empty text
    has no spans; null ids, repeated rows and further columns change nothing; very long texts are searched whole.
    """
    names = vocabulary(rules)
    packed = (F.struct(*keep) if keep else F.struct(F.col("doc_id").cast("long").alias("doc_id"))).alias("row")
    frame = docs.select(packed, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    scratch = Scratch(docs.sparkSession, "secrets")
    postings = scratch.save(index(frame.select("key", "text"), names))
    admitted = scratch.save(candidates(postings, rules, names))
    scratch.keep(admitted)
    frame = frame.join(admitted, "key", "left")
    free = sum(1 << i for i, r in enumerate(rules) if trigram_query(r.pattern) is None)
    bits = F.coalesce("rules", F.lit(0).cast("long")).bitwiseOR(F.lit(free).cast("long"))
    frame = frame.select("row", "text", *[(bits.bitwiseAND(F.lit(1 << i).cast("long")) != 0).alias(f"is_{r.kind}") for i, r in enumerate(rules)])
    none = F.array().cast("array<string>")
    for r in rules:
        hit = F.when(F.col(f"is_{r.kind}"), F.regexp_extract_all("text", F.lit(_scanned(r)), F.lit(0))).otherwise(none)
        frame = frame.withColumn(f"hits_{r.kind}", hit)
    for r in rules:
        some, hits = F.size(f"hits_{r.kind}") > 0, F.col(f"hits_{r.kind}")
        gaps = F.when(some, F.split("text", _scanned(r), -1)).otherwise(none)
        frame = frame.withColumn(f"gaps_{r.kind}", gaps)
        if r.group:
            kept = F.when(some, F.regexp_extract_all("text", F.lit(_scanned(r)), F.lit(r.group))).otherwise(none)
            frame = frame.withColumn(f"kept_{r.kind}", kept)
    return frame.select(
        "row.*", *[F.when(F.size(f"hits_{r.kind}") > 0, _spans(r, i, F.col(f"gaps_{r.kind}"), F.col(f"hits_{r.kind}"), F.col(f"{'kept' if r.group else 'hits'}_{r.kind}"))).otherwise(F.array().cast(SPANS)).alias(f"spans_{r.kind}") for i, r in enumerate(rules)]
    )


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row (see ``find_secrets`` for odd rows)."""
    found = find_secrets(docs)
    base = F.concat(*[F.col(f"spans_{r.kind}") for r in BASE])
    return found.select(
        "doc_id",
        *[F.size(f"spans_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(*[F.col(f"spans_{r.kind}") for r in RULES])).alias("spans"),
    )
