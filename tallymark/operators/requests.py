"""Any number of filtered sums over the ledger in one plan: requests are rows, not columns.

A request asks for the rows of a borrower, a scope, a category ('any' for all), a party (null for all) and a period. A
ledger row belongs to at most four combinations of category and party, so it is summed up under each of them. Periods meet
rows through dyadic intervals of days: a period is a union of a few intervals of 2**k days that start at a multiple of
2**k, and a day lies in exactly one interval of each size, so that period and row meet by equality. Rows are summed up by
day within the tasks first; a sum of more days is a sum of daily ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.tagging import sieve

#: Intervals are of 1 to 2**BITS days, which is more than the calendar has; ALWAYS also holds the rows without a date.
BITS = 22
ALWAYS = BITS + 1
FIRST_DAY = "0001-01-01"
#: What tells requests apart.
KEY = ("scenario_id", "category", "scope", "party", "start", "end")
EXACT = "decimal(38,4)"
#: What tells cells apart: rows and requests meet where all of it is equal.
CELL = ("scenario_id", "scope", "category", "party_key", "size", "place")


def request_key(category: Column, scope: Column, party: Column, start: Column, end: Column) -> Column:
    """The name of a request within its borrower."""
    open_ = lambda c: F.coalesce(c.cast("string"), F.lit("*"))
    return F.concat_ws("|", category, scope, open_(party), open_(start), open_(end))


def _day(date: Column) -> Column:
    return F.datediff(date, F.lit(FIRST_DAY).cast("date"))


def _party_key(party: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), party), F.lit("*"))


def intervals(start: Column, end: Column) -> Column:
    """The fewest dyadic intervals (size, place) that make up the days from ``start`` to ``end``; none if they are turned round.

    Of the intervals of one size that lie within, only an outermost one whose pair does not is taken. An open end reaches
    to the end of the calendar; a period that is open on both sides also takes rows without a date.
    """
    first, last = F.coalesce(_day(start), F.lit(0)), F.coalesce(_day(end), F.lit((1 << BITS) - 1))
    taken = []
    for k in range(BITS + 1):
        low, high = F.shiftright(first + ((1 << k) - 1), k), F.shiftright(last + 1, k) - 1
        cell = lambda place: F.struct(F.lit(k).alias("size"), place.alias("place"))  # noqa: B023, E731
        taken += [F.when((low <= high) & (low % 2 == 1), cell(low)), F.when((low <= high) & (high % 2 == 0), cell(high))]
    always = F.array(F.struct(F.lit(ALWAYS).alias("size"), F.lit(0).alias("place")))
    return F.when(start.isNull() & end.isNull(), always).otherwise(F.array_compact(F.array(*taken)))


def wanted_cells(requests: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the cells (scenario_id, scope, category, party_key, size, place) that make up each row of ``requests`` (KEY and others)."""
    cut = requests.withColumn("party_key", _party_key(F.col("party"))).withColumn("i", F.explode(intervals(F.col("start"), F.col("end"))))
    return cut.select(*dict.fromkeys((*keep, *CELL[:4])), "i.size", "i.place")


def held_cells(rows: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """``keep`` and every cell that a row of ``rows`` (scenario_id, scope, category, party, day) lies in, of intervals of ``sizes``.

    At most two categories (its own and 'any') by two parties (its own and all) by one interval of each size.
    """
    cells = [F.struct(F.lit(k).alias("size"), (F.lit(0) if k == ALWAYS else F.shiftright("day", k)).alias("place")) for k in sizes]
    held = rows.withColumn("category", F.explode(F.array_distinct(F.array_compact(F.array("category", F.lit("any"))))))
    held = held.withColumn("party_key", F.explode(F.array_distinct(F.array(F.lit("*"), _party_key(F.col("party"))))))
    held = held.withColumn("i", F.explode(F.array(*cells) if cells else F.array().cast("array<struct<size:int,place:int>>")))
    return held.select(*dict.fromkeys((*keep, *CELL[:4])), "i.size", "i.place").where("place IS NOT NULL")


def sizes_of(wanted: DataFrame) -> list[int]:
    """The sizes of intervals that are asked for: at most ALWAYS + 1 numbers."""
    return sorted(r["size"] for r in wanted.select("size").distinct().collect())


def day_of(date: Column) -> Column:
    """The number of a day; null for a row without a date, which lies in ALWAYS only."""
    return _day(date)


def answer_table(ledger: DataFrame, requests: DataFrame) -> DataFrame:
    """KEY, total (exact, null without rows) and n_rows of each distinct row of ``requests`` (KEY; start and end are dates).

    ``ledger``: scenario_id, scope, category, party, date, amount, excluded. Excluded rows count nowhere, rows without a
    date only where the period is open on both sides, rows without a category only for 'any'. The plan is the same for
    one request and for millions. Repeated requests come back once; no requests give no rows.
    """
    asked = requests.select(*KEY).distinct()
    wanted = wanted_cells(asked, *KEY)
    daily = ledger.where(~F.col("excluded")).groupBy("scenario_id", "scope", "category", "party", _day(F.col("date")).alias("day"))
    daily = daily.agg(F.sum(F.col("amount").cast("decimal(18,4)")).cast(EXACT).alias("total"), F.count("*").alias("n_rows"))
    # Most cells that a row lies in are asked for by nobody; they go before cells are shuffled.
    held = sieve(held_cells(daily, sizes_of(wanted), "total", "n_rows"), wanted, *CELL)
    sums = held.groupBy(*CELL).agg(F.sum("total").cast(EXACT).alias("total"), F.sum("n_rows").alias("n_rows"))
    met = wanted.join(sums, list(CELL)).groupBy(*KEY).agg(F.sum("total").cast(EXACT).alias("total"), F.sum("n_rows").alias("n_rows"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"m.{c}")) for c in KEY]
    both = asked.alias("a").join(met.alias("m"), same, "left")
    return both.select(*[F.col(f"a.{c}").alias(c) for c in KEY], F.col("m.total").alias("total"), F.coalesce("m.n_rows", F.lit(0)).alias("n_rows"))
