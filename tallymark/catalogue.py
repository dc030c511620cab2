"""Registered queries and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.plans import covenant_queries, document_queries, entity_queries, event_queries, ledger_queries, reading_queries, run_queries  # noqa: F401
from tallymark.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of three covenants for every borrower."""
    return ledger_queries.covenant_verdicts(spark, sf_dir)
