"""The whole run: from a raw ledger, documents and extracted tables to a checked submission.

    python -m tallymark.plans.run --dataset DIR --tables DIR --out DIR [--score KEY]

``--tables`` holds what extraction gives, one Parquet table each: categories (with a scope, where a row is the group's),
entities, notes, rates, and covenants.json, whose entries may name the borrower that they bind; besides, where they are
known, documents, disclosed and group_facts. Each step's table is written below ``--out`` with a record of what it was made
from (plans/manifest.py); a step is worked out again if that has changed, or with ``--force``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tallymark.operators import covenant_tables as CT
from tallymark.operators import covenants as C
from tallymark.operators import documents as D
from tallymark.operators import review as R
from tallymark.operators import risk as K
from tallymark.operators import tagging as T
from tallymark.plans.metric import from_payload
from tallymark.sources.ledger_view import CATEGORIES
from tallymark.tables import Store

#: What makes a transaction a candidate for evidence, and how much it counts.
BASIS_WEIGHT = {"reclassified": 5, "recovered_amount": 4, "corrected": 4, "cutoff": 3, "related_party": 2, "unrestricted_subsidiary": 2}
#: The basis that an auditor's note gives, by its kind.
BASIS_OF_NOTE = {"reclassification": "reclassified", "missing_amount": "recovered_amount", "cutoff": "cutoff", "correction": "corrected"}


@dataclass(frozen=True)
class Inputs:
    """What a run starts from. ``covenants``: tests for every borrower, or a table of own ones (covenant_tables.COVENANTS).

    ``documents`` (scenario_id, doc_id, type, text) fill in missing amounts; ``disclosed`` (scenario_id, key, amount) and
    ``group_facts`` (scenario_id, category, amount) answer leaves that the ledger has no rows for.
    """

    ledger: DataFrame
    template: DataFrame
    covenants: list[C.Covenant] | DataFrame
    rates: DataFrame
    categories: DataFrame
    entities: DataFrame
    notes: DataFrame
    documents: DataFrame | None = None
    disclosed: DataFrame | None = None
    group_facts: DataFrame | None = None


@dataclass(frozen=True)
class Outcome:
    """Tables of a run; problems: scenario_id, subject, code; risk: the signals and the place of every cell, if asked for."""

    final: DataFrame
    cells: DataFrame
    evidence: DataFrame
    submission: DataFrame
    violations: DataFrame
    problems: DataFrame
    risk: DataFrame | None = None


def candidates(final: DataFrame, notes: DataFrame | None = None) -> DataFrame:
    """Rows whose treatment rests on a document, each by its strongest basis: BASIS_WEIGHT, then notes before parties.

    Notes of any status that name a transaction, rows that a note addressed in another way has moved, and rows whose
    counterparty the files name. Reversing a reclassification puts back the category before it, a party's clears the
    party; all others take the row away.
    """
    none = F.lit(None).cast("string")
    weight = F.create_map(*[x for k, w in BASIS_WEIGHT.items() for x in (F.lit(k), F.lit(w))])
    own = lambda basis, seq, category, clears: [F.col("scenario_id"), F.col("txn_id"), basis.alias("basis"), weight[basis].alias("weight"), seq.cast("long").alias("seq"), category.alias("revert_category"), F.lit(clears).alias("clears_party")]
    found = final.where("category <> first_category").select(*own(F.lit("reclassified"), F.lit(-1), F.col("first_category"), False))
    basis = F.when(F.col("party") == "related", "related_party").when(F.col("party") == "unrestricted_subsidiary", "unrestricted_subsidiary")
    found = found.union(final.where(basis.isNotNull()).select(*own(basis, F.lit(1 << 62), none, True)))
    if notes is not None:
        basis = F.lit(None).cast("string")
        for kind, name in BASIS_OF_NOTE.items():
            basis = F.when(F.col("kind") == kind, name).otherwise(basis)
        named = notes.where(F.col("target_txn_id").isNotNull()).select(F.col("target_txn_id").alias("txn_id"), basis.alias("basis"), "pos", F.col("from_category") if "from_category" in notes.columns else none.alias("from_category"))
        named = named.where("basis IS NOT NULL")
        named = named.join(T.sieve(final.select("scenario_id", "txn_id", "first_category"), named, "txn_id"), "txn_id")
        back = F.when(F.col("basis") == "reclassified", F.coalesce("from_category", "first_category"))
        found = found.union(named.select(*own(F.col("basis"), F.col("pos"), back, False)))
    return C.best_basis(found)


#: Keeps a step's table: (name, how to work it out, names of what it reads) -> the table.
Keep = Callable[[str, Callable[[], DataFrame], tuple[str, ...]], DataFrame]


#: The columns of the final ledger that later steps read; ranking also reads the counterparty.
READ = ("txn_id", "scenario_id", "date", "amount", "category", "first_category", "party", "scope", "excluded", "problem")


def _stored(inputs: Inputs, rank: bool) -> Keep:
    """Keeps the final ledger, as far as later steps read it, and the cells in the shared folder.

    The clean ledger stays a plan over ``inputs.ledger``, which should stand as a table, unless amounts are looked up in
    documents for it; what is read once stays a plan as well.
    """
    store = Store(inputs.ledger.sparkSession, "run")
    stored = ("final", "cells") if inputs.documents is None else ("clean", "final", "cells")

    def keep(name: str, build: Callable[[], DataFrame], reads: tuple[str, ...]) -> DataFrame:
        frame = build()
        if name == "final":
            frame = frame.select(*READ, *["counterparty"] * rank)
        return store.put(frame) if name in stored else frame

    return keep


def settle(inputs: Inputs, keep: Keep | None = None, rank: bool = False) -> Outcome:
    """All steps in order; ``keep`` may store a step's table, or take over one that stands.

    ``rank``: also rank the cells by risk. Without ``keep`` the final ledger comes back with the columns of READ only.
    """
    keep = keep or _stored(inputs, rank)

    def clean() -> DataFrame:
        rows = T.clean_ledger(T.in_template(inputs.ledger.withColumn("scenario_id", T.scenario_of(F.col("txn_id"))), inputs.template), inputs.rates)
        rows = rows.withColumn("amount", F.col("amount_usd").cast("decimal(18,4)"))
        if inputs.documents is None:
            return rows
        return T.recover_amounts(rows, D.authoritative(inputs.documents).select("scenario_id", "doc_id", "text")).withColumn("amount", F.col("amount").cast("decimal(18,4)"))

    def tagged() -> DataFrame:
        rows = T.final_ledger(usable.drop("problem", "scope"), inputs.categories, inputs.entities, inputs.notes)
        scope = F.coalesce(F.nullif(F.col("scope"), F.lit("")), F.lit("borrower")) if "scope" in inputs.categories.columns else F.lit("borrower")
        return rows.withColumn("scope", scope)

    own = isinstance(inputs.covenants, DataFrame)
    judge, decide = (CT.verdict_table, CT.decisive_table) if own else (C.verdicts, C.decisive_tests)
    rest = (inputs.covenants, inputs.disclosed, inputs.group_facts)
    usable, dropped = T.with_amounts(keep("clean", clean, ("ledger", "template", "rates", "documents")))
    unrated = usable.where("fx_missing").select("scenario_id", F.col("txn_id").alias("subject"), F.lit("no_rate").alias("code"))
    final = keep("final", tagged, ("clean", "categories", "entities", "notes"))
    cells = keep("cells", lambda: judge(final, *rest), ("final", "covenants", "disclosed", "group_facts"))
    evidence = keep("evidence", lambda: decide(final, candidates(final, inputs.notes), *rest), ("final", "notes", "covenants", "disclosed", "group_facts"))
    proof = evidence.select("scenario_id", "point", F.col("txn_id").alias("evidence_txn_id"), F.col("basis").alias("evidence_basis"))
    submission = keep("submission", lambda: R.assemble(inputs.template, cells.join(proof, ["scenario_id", "point"], "left")), ("template", "cells", "evidence"))
    violations = R.violations(inputs.template, submission, final.select("txn_id", F.col("scenario_id").alias("owner")))
    lost = dropped.select("scenario_id", F.col("n_dropped").cast("string").alias("subject"), F.lit("rows_without_amount").alias("code"))
    told = final.where("problem IS NOT NULL").select("scenario_id", F.col("txn_id").alias("subject"), F.explode(F.split("problem", ",")).alias("code"))
    each = cells.where("problems <> ''").select("scenario_id", F.col("point").alias("subject"), F.explode(F.split("problems", ";")).alias("code"))

    def ranked() -> DataFrame:
        tests = inputs.covenants if own else bound_covenants(final.sparkSession, [(None, c) for c in inputs.covenants], inputs.template)
        missed = K.misses(inputs.notes, T.address_notes(inputs.notes, final))
        unknown = usable.where("fx_missing").groupBy("scenario_id").agg(F.count_distinct("currency").alias("unknown_data"))
        return K.ranked_cells(submission, cells, evidence, CT.covenant_facts(final, tests, *rest[1:]), R.category_outliers(final), missed, unknown)

    risk = keep("risk", ranked, ("clean", "final", "notes", "cells", "evidence", "submission", "covenants", "disclosed", "group_facts")) if rank else None
    return Outcome(final, cells, evidence, submission, violations, unrated.union(lost).union(told).union(each), risk)


def read_covenants(text: str) -> list[tuple[str | None, C.Covenant]]:
    """Covenants of a JSON list, each with the borrower that it binds (None: all); a metric may be nested or a flat node list.

    A tree that does not stand is left to the verdicts to report.
    """
    out = []
    for c in json.loads(text):
        try:
            metric = from_payload(c)
        except ValueError as e:
            metric = {"op": str(e)}
        condition = c.get("condition_metric")
        period = (c.get("period_start"), c.get("period_end"))
        test = C.Covenant(c["point"], c["direction"], float(c["threshold"]), metric or {"op": "none"}, period, condition, c.get("condition_direction") or "max", float(c.get("condition_threshold") or 0))
        out.append((c.get("scenario_id"), test))
    return out


def bound_covenants(spark: SparkSession, covenants: list[tuple[str | None, C.Covenant]], template: DataFrame) -> DataFrame:
    """A table of covenants: own ones of a borrower, and those of all borrowers for each that the template names.

    An own covenant takes the place of a common one of the same point.
    """
    table = CT.covenant_table(spark, covenants)
    borrowers = template.select("scenario_id").distinct()
    own = table.where("scenario_id IS NOT NULL")
    # The common tests came from one file: every borrower takes them along as one literal.
    common = table.where("scenario_id IS NULL").toJSON().collect()
    tests = F.from_json(F.lit(f"[{','.join(common)}]"), ArrayType(table.schema))
    every = borrowers.select(F.col("scenario_id").alias("of"), F.explode(tests).alias("t")).select(F.col("of").alias("scenario_id"), *[f"t.{c}" for c in table.columns[1:]])
    return own.union(every.join(own.select("scenario_id", "point"), ["scenario_id", "point"], "left_anti").select(*own.columns))


def _arguments(arguments: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--dataset", required=True)
    p.add_argument("--tables", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--score", help="an answer key to score the submission against")
    p.add_argument("--force", action="store_true", help="work out every step anew")
    p.add_argument("--team", default="")
    p.add_argument("--model", default="")
    p.add_argument("--shuffle-partitions", type=int, help="partitions of a shuffle; unset, the session's")
    return p.parse_args(arguments)


#: Tables that a run may go without.
OPTIONAL = ("documents", "disclosed", "group_facts")


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """The command line; 1 if the submission breaks a rule that is an error."""
    from tallymark.plans.manifest import Manifest, category_counts, document_counts
    from tallymark.session import build_session
    from tallymark.sources import readers

    a = _arguments(arguments)
    spark = spark or build_session("run", shuffle_partitions=a.shuffle_partitions)
    found = readers.discover(spark, a.dataset)
    manifest = Manifest(spark, a.out, a.force)
    template = readers.read_submission(spark, found.template).select("scenario_id", "point")
    given = {"ledger": found.ledger, "template": found.template, "covenants": f"{a.tables}/covenants.json"}
    given |= {n: f"{a.tables}/{n}" for n in ("rates", "categories", "entities", "notes")}
    given |= {n: f"{a.tables}/{n}" for n in OPTIONAL if readers.stands(spark, f"{a.tables}/{n}")}
    for name, path in given.items():
        manifest.files(name, path)
    for name in OPTIONAL:
        manifest.contents.setdefault(name, "none")
    tables = {n: spark.read.parquet(p) for n, p in given.items() if n not in ("ledger", "template", "covenants")}
    covenants = bound_covenants(spark, read_covenants(readers.read_text(spark, given["covenants"])), template)
    counts = {"final": category_counts(CATEGORIES)}

    def keep(name: str, build: Callable[[], DataFrame], reads: tuple[str, ...]) -> DataFrame:
        return manifest.step(name, build, reads, counts=counts.get(name))

    if "documents" in tables:
        tables["documents"] = manifest.step("documents", lambda kept=tables["documents"]: kept, ("documents",), counts=document_counts)
    known = {f.name for f in fields(Inputs)}
    out = settle(Inputs(readers.read_ledger(spark, found.ledger), template, covenants, **{n: t for n, t in tables.items() if n in known}), keep, rank=True)
    readers.submission_json(out.submission, team=a.team, model=a.model).write.mode("overwrite").text(f"{a.out}/submission_json")
    out.problems.write.mode("overwrite").json(f"{a.out}/problems")
    out.violations.write.mode("overwrite").json(f"{a.out}/violations")
    readers.write_text(spark, f"{a.out}/alarms.json", json.dumps(manifest.alarms()))
    for row in out.violations.orderBy("scenario_id", "point", "code").collect():  # as few as the template's cells
        print(row["level"], row["scenario_id"], row["point"], row["code"])
    if a.score:
        marks = R.score(readers.read_submission(spark, a.score), out.submission)
        print(json.dumps(marks.agg(F.round(F.sum("marks"), 4).alias("marks"), F.count("*").alias("cells")).first().asDict()))
    return int(not out.violations.where("level = 'ERROR'").isEmpty())


if __name__ == "__main__":
    raise SystemExit(main())
