"""Exact places of rows in a global order, without a task that holds them all."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Where monotonically_increasing_id() keeps the number of the partition.
PART_BITS = 33


def ranked(rows: DataFrame, order: list[Column], put: Callable[[DataFrame], DataFrame], within: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with rank: the place of each in ``order`` from 0, counted anew for each value of ``within``.

    ``within`` must lead the order. Rows are dealt by ranges and written once by ``put``, so that what is counted and what
    is returned are the same ranges, and a value that a third of all rows share spreads over many of them; only the number
    of rows of each range and value is summed up. Rows that are alike in all of ``order`` get their places in any order.
    """
    placed = put(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", PART_BITS))
    runs = placed.groupBy("_part", *within).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    runs = runs.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_w{i}") for i, c in enumerate(within)], "_first", "_before")
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(within):
        same &= F.col(c).eqNullSafe(F.col(f"_w{i}"))
    return placed.join(runs, same).withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).select(*rows.columns, "rank")


def upper_median(placed: DataFrame, column: str) -> DataFrame:
    """One row, mid: the value at place n div 2 of ``placed``, which is ranked by ``column``; no row if there are none."""
    middle = placed.agg(F.floor(F.count("*") / 2).alias("middle"))
    return placed.join(F.broadcast(middle), F.col("rank") == F.col("middle")).select(F.col(column).alias("mid"))
