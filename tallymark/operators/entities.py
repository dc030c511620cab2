"""Borrowers' surroundings: ownership, group figures, disclosed amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.tagging import is_related

#: Words by which a disclosed key is known as an add-back or as an off-ledger obligation.
ADDBACK_WORDS = ("addback", "add_back", "one_off", "oneoff", "one_time", "onetime", "non_recurring", "nonrecurring", "exceptional", "ebitda")
OFF_LEDGER_WORDS = ("off_ledger", "offledger", "off_balance", "offbalance", "severance", "obligation", "liabilit", "commitment", "programme", "program", "undisclosed", "unrecorded")


def build_graph(parties: DataFrame, pledges: DataFrame, parents: DataFrame) -> DataFrame:
    """scenario_id, name, role, share, is_related, unrestricted, problem.

    ``parties`` (scenario_id, name, ownership_pct, basis, is_related, threshold_pct): an explicit verdict wins over the
    share, and neither is a problem. ``pledges`` (scenario_id, name, pct, limit_pct): unrestricted below the limit, if
    there is one. ``parents`` (scenario_id, name).
    """
    no = F.lit(None)
    by_share = is_related(F.col("ownership_pct"), F.col("threshold_pct"), F.col("basis"))
    unknown = F.col("is_related").isNull() & F.col("basis").isNull() & (F.col("ownership_pct").isNull() | F.col("threshold_pct").isNull())
    kin = parties.select("scenario_id", "name", F.lit("counterparty").alias("role"), F.col("ownership_pct").alias("share"), F.coalesce("is_related", by_share).alias("is_related"), F.lit(False).alias("unrestricted"), F.when(unknown, "no_share").alias("problem"))
    open_ = F.coalesce(F.col("pct") < F.col("limit_pct"), F.lit(False))
    below = pledges.select("scenario_id", "name", F.lit("subsidiary"), F.col("pct"), F.lit(False), open_, F.when(F.col("limit_pct").isNull(), "no_limit"))
    return kin.union(below).union(parents.select("scenario_id", "name", F.lit("parent"), no.cast("double"), F.lit(False), F.lit(False), no.cast("string")))


def unmatched(parties: DataFrame, matched: DataFrame) -> DataFrame:
    """Related parties that no payment names: perhaps written otherwise. ``matched``: scenario_id, entity."""
    seen = matched.select("scenario_id", F.col("entity").alias("name")).where("name IS NOT NULL").distinct()
    return parties.where("is_related").join(seen, ["scenario_id", "name"], "left_anti").select("scenario_id", "name")


def display_name(names: DataFrame) -> DataFrame:
    """scenario_id, name: the first variant by pos that holds a lower-case letter, else the first."""
    order = F.struct(~F.col("name").rlike(r"\p{Ll}"), F.col("pos"))
    return names.groupBy("scenario_id").agg(F.min_by("name", order).alias("name"))


def note_pools(notes: DataFrame, ledger: DataFrame) -> DataFrame:
    """scenario_id, pool, amount: applied notes with a value, by pool.

    EBITDA adjustments are add-backs. Off-ledger notes whose transaction id or amount, to the cent, is on the ledger
    after all would count twice and are left out.
    """
    applied = notes.where("status = 'applied' AND value IS NOT NULL")
    add = applied.where("kind = 'ebitda_adjustment'").select("scenario_id", F.lit("addback").alias("pool"), "value")
    off = applied.where("kind = 'off_ledger'")
    cents = lambda c: F.round(F.abs(F.col(c).cast("decimal(18,4)")), 2)
    ids = ledger.select("scenario_id", F.col("txn_id").alias("target_txn_id")).distinct()
    amounts = ledger.select("scenario_id", cents("amount").alias("cents")).distinct()
    off = off.join(ids, ["scenario_id", "target_txn_id"], "left_anti").withColumn("cents", cents("value")).join(amounts, ["scenario_id", "cents"], "left_anti")
    return add.union(off.select("scenario_id", F.lit("off_ledger"), "value")).groupBy("scenario_id", "pool").agg(F.round(F.sum("value"), 2).alias("amount"))


def pool_of(key: Column, pools: Column) -> Column:
    """The pool a disclosed key stands for: by its words if they point one way, else the only pool there is, else null."""
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(key), w))
    add, off = has(ADDBACK_WORDS), has(OFF_LEDGER_WORDS)
    return F.when(add & ~off, "addback").when(off & ~add, "off_ledger").when(F.size(pools) == 1, pools[0])


def disclosed(keys: DataFrame, pools: DataFrame) -> DataFrame:
    """scenario_id, key, amount of the requested keys (scenario_id, key) that a pool answers; an empty pool gives nothing."""
    there = pools.groupBy("scenario_id").agg(F.sort_array(F.collect_set("pool")).alias("pools"))
    asked = keys.distinct().join(there, "scenario_id").withColumn("pool", pool_of(F.col("key"), F.col("pools")))
    return asked.join(pools, ["scenario_id", "pool"]).select("scenario_id", "key", "amount")
