"""The signals of every cell of a run, and its place by risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators import review as R

#: A ratio whose sums add up to so many times the largest amplifies an error of them.
AMPLIFIED = 1.5


def misses(notes: DataFrame, addressed: DataFrame) -> DataFrame:
    """scenario_id, addressing_miss: number of notes that should have changed a row and found none."""
    acting = notes.where("status = 'applied' AND (kind = 'cutoff' OR kind = 'reclassification' AND to_category IS NOT NULL)")
    return acting.join(addressed.select("note_id").distinct(), "note_id", "left_anti").groupBy("scenario_id").agg(F.count("*").alias("addressing_miss"))


def ranked_cells(submission: DataFrame, cells: DataFrame, evidence: DataFrame, facts: DataFrame, outliers: DataFrame, missed: DataFrame, unknown: DataFrame) -> DataFrame:
    """scenario_id, point, signals, risk, place of every cell of the ``submission``, the riskiest first.

    ``cells``: verdicts; ``facts``: covenant_tables.covenant_facts; ``outliers``: scenario_id, category of categories with
    unlike many rows; ``missed`` and ``unknown``: scenario_id with addressing_miss and unknown_data, how often each weighs.
    A cell without a verdict has fallen back and has no value. A sum of the group without rows or figure puts the other
    cells of its borrower in doubt.
    """
    key = ["scenario_id", "point"]
    # A figure that stands in leaves no gap.
    gap = F.col("missing").contains("|group|") & ~F.coalesce("derived", F.lit(False))
    gaps = cells.join(facts, key, "left").where(gap).select("scenario_id", F.lit(True).alias("borrower_gap")).distinct()
    odd = facts.select(*key, F.explode("categories").alias("category")).join(outliers.select("scenario_id", "category"), ["scenario_id", "category"], "left_semi")
    odd = odd.select(*key, F.lit(True).alias("odd")).distinct()
    each = submission.select(*key, "fallback", "evidence_txn_id").join(cells.select(*key, "status", "actual", "threshold", "missing"), key, "left")
    each = each.join(evidence.select(*key, F.col("basis")), key, "left").join(facts, key, "left").join(odd, key, "left")
    for table in (gaps, missed, unknown):
        each = each.join(table, "scenario_id", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    names = R.signals(
        F.col("actual"), F.col("threshold"), F.col("status"), F.col("evidence_txn_id"),
        fallback=yes(F.col("fallback")),
        # A figure of the group that stands in leaves no sum empty.
        empty_sum=yes((F.col("missing") != "") & ~yes(F.col("derived"))),
        amplified=yes(F.col("ratio") & (R.amplification(F.col("sums")) >= AMPLIFIED)),
        outlier=yes(F.col("odd")),
        group_derived=yes(F.col("derived")),
        related_evidence=yes(F.col("basis") == "related_party"),
        group_gap=yes(F.col("borrower_gap")) & ~yes(gap),
        addressing_miss=F.coalesce("addressing_miss", F.lit(0)),
        unknown_data=F.coalesce("unknown_data", F.lit(0)),
    )
    found = each.select(*key, names.alias("signals"))
    return R.places(found.withColumn("risk", R.risk(F.col("signals"))))
