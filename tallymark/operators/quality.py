"""Checks of extracted tables, as rows of violations with typed codes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.plans.metric import flatten, from_payload, nest, problems
from tallymark.sources.ledger_view import CATEGORIES

#: What auditor notes may say of themselves.
NOTE_STATUSES = ("applied", "rejected", "immaterial", "informational")


def _codes(frame: DataFrame, keys: list[str], checks: dict[str, Column]) -> DataFrame:
    """keys, code of every check that holds."""
    found = F.array_compact(F.array(*[F.when(c, F.lit(code)) for code, c in checks.items()]))
    return frame.select(*keys, F.explode(found).alias("code"))


def note_violations(notes: DataFrame) -> DataFrame:
    """scenario_id, note_id, code. Field rules hold for applied notes only."""
    applied, kind = F.col("status") == "applied", F.col("kind")
    return _codes(
        notes,
        ["scenario_id", "note_id"],
        {
            "bad_status": ~F.coalesce(F.col("status").isin(*NOTE_STATUSES), F.lit(False)),
            "no_value": applied & kind.isin("missing_amount", "off_ledger") & F.col("value").isNull(),
            "no_target": applied & (kind == "missing_amount") & (F.coalesce("target_txn_id", F.lit("")) == ""),
            "no_categories": applied & (kind == "reclassification") & (F.coalesce("from_category", "to_category", F.lit("")) == ""),
            "negative_value": applied & (F.col("value") < 0),
        },
    )


def statement_violations(statements: DataFrame, notes: DataFrame) -> DataFrame:
    """scenario_id, code of what an auditor's report says of itself: ``statements`` (scenario_id, threshold, none_required).

    A threshold of materiality must be positive where one is given, and where no adjustment was required no note of the
    borrower may be applied.
    """
    applied = notes.groupBy("scenario_id").agg(F.coalesce(F.bool_or(F.col("status") == "applied"), F.lit(False)).alias("applied"))
    known = statements.join(applied, "scenario_id", "left")
    checks = {"threshold_not_positive": F.col("threshold") <= 0, "applied_though_none_required": F.col("none_required") & F.coalesce("applied", F.lit(False))}
    return _codes(known, ["scenario_id"], checks)


def party_violations(parties: DataFrame) -> DataFrame:
    """scenario_id, name, code: shares and thresholds out of range, and verdicts against the arithmetic without a basis."""
    share, limit = F.col("ownership_pct"), F.col("threshold_pct")
    return _codes(
        parties,
        ["scenario_id", "name"],
        {
            "threshold_range": (limit <= 0) | (limit > 100),
            "share_range": (share < 0) | (share > 100),
            "no_section": ~F.col("has_section"),
            "verdict": F.col("basis").isNull() & (F.col("said") != F.coalesce(share >= limit, F.lit(False))),
        },
    )


def label_violations(labels: DataFrame, asked: DataFrame, vocabulary: tuple[str, ...]) -> DataFrame:
    """txn_id, code: repeated, missing, invented and out-of-vocabulary labels."""
    say = lambda f, code: f.select("txn_id", F.lit(code).alias("code"))
    repeated = labels.groupBy("txn_id").agg(F.count("*").alias("n")).where("n > 1")
    unknown = labels.where(~F.coalesce(F.col("category").isin(*vocabulary), F.lit(False))).select("txn_id").distinct()
    missing, invented = asked.join(labels, "txn_id", "left_anti"), labels.select("txn_id").distinct().join(asked, "txn_id", "left_anti")
    return say(repeated, "repeated").union(say(missing, "missing")).union(say(invented, "invented")).union(say(unknown, "out_of_vocabulary"))


#: The largest threshold that a ratio can have.
RATIO = 1000


def spec_codes(nodes: list[dict], root: str, threshold: object, unit: str, start: str | None = None, end: str | None = None, conditional: bool = False, condition: dict | None = None) -> list[str]:
    """What is wrong with one extracted covenant, as codes."""
    try:
        found = problems(nest(nodes, root), CATEGORIES)
    except ValueError:
        found = ["bad_tree"]
    number = isinstance(threshold, (int, float)) and not isinstance(threshold, bool)
    checks = {
        "threshold_no_number": not number,
        "threshold_not_positive": number and threshold <= 0,
        "ratio_too_large": number and unit == "ratio" and threshold > RATIO,
        "bad_period": any(d is not None and not _is_day(d) for d in (start, end)),
        "period_reversed": bool(start and end and _is_day(start) and _is_day(end) and start >= end),
        "no_condition": conditional and condition is None,
    }
    if condition is not None:
        found += [f"condition_{code}" for code in problems(condition, CATEGORIES)]
    return found + [code for code, wrong in checks.items() if wrong]


def _is_day(text: str) -> bool:
    try:
        return len(date.fromisoformat(text).isoformat()) == len(text)
    except ValueError:
        return False


def covenant_codes(payload: dict) -> list[tuple[str | None, str]]:
    """(point, code) of everything wrong with an answer that lists covenants."""
    covenants = payload.get("covenants", [])
    points = [c.get("point") for c in covenants]
    found = [(p, "repeated_point") for p in dict.fromkeys(points) if points.count(p) > 1]
    for c in covenants:
        try:
            tree = from_payload(c)
        except ValueError:
            tree = None
        nodes, root = flatten(tree) if tree is not None else ([], "")
        codes = spec_codes(nodes, root, c.get("threshold"), c.get("unit", ""), c.get("period_start"), c.get("period_end"), bool(c.get("is_conditional")), c.get("condition_metric"))
        found += [(c.get("point"), code) for code in codes]
    return found
