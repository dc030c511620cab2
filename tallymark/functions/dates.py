"""Date functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names by number.
MONTHS = {
    "en": "january february march april may june july august september october november december".split(),
    "ru": "января февраля марта апреля мая июня июля августа сентября октября ноября декабря".split(),
}


def all_dates(text: Column) -> Column:
    """Dates in reading order: ISO, 'd Month yyyy' in English or Russian, 'Month d, yyyy'. Impossible dates are left out."""
    names = [m for months in MONTHS.values() for m in months]
    pattern = rf"(?iu)\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}\s+(?:{'|'.join(names)})\s+\d{{4}}|(?:{'|'.join(MONTHS['en'])})\s+\d{{1,2}},\s*\d{{4}}"
    number = F.create_map(*[F.lit(x) for months in MONTHS.values() for i, m in enumerate(months) for x in (m, i + 1)])

    def parsed(hit: Column) -> Column:
        low = F.lower(hit)
        day, name, year = F.regexp_extract(low, r"(?<!\d)(\d{1,2})(?!\d)", 1), F.regexp_extract(low, r"([^\d\s,-]+)", 1), F.regexp_extract(low, r"(\d{4})", 1)
        words = F.format_string("%s-%02d-%02d", year, F.try_element_at(number, name), day.try_cast("int"))
        return F.when(low.rlike(r"^\d{4}-"), low.try_cast("date")).otherwise(words.try_cast("date"))

    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), parsed), lambda d: d.isNotNull())


def overlap_days(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """Days that two inclusive periods share, 0 at least."""
    return F.greatest(F.lit(0), F.datediff(F.least(end, other_end), F.greatest(start, other_start)) + 1)


def document_date(text: Column) -> Column:
    """The first date of the heading, else the first of the opening with a label before it, else the last of the text."""
    opening = F.regexp_extract(F.substring(text, 1, 2500), r"(?isu)(?:dated?|дата|от)\s*:?\s(.*)$", 1)
    return F.coalesce(F.try_element_at(all_dates(F.substring(text, 1, 1500)), F.lit(1)), F.try_element_at(all_dates(opening), F.lit(1)), F.try_element_at(all_dates(text), F.lit(-1)))


def stated_period(text: Column) -> Column:
    """(start, end) of the first 'from … to …' (Russian too) with two dates in order; null without one."""
    spans = F.transform(F.regexp_extract_all(text, F.lit(r"(?isu)(?<!\p{L})(?:from|с)\s.{6,40}?\s(?:to|until|по)\s.{0,30}"), F.lit(0)), all_dates)
    fit = F.filter(spans, lambda d: (F.size(d) >= 2) & (F.get(d, F.lit(0)) < F.get(d, F.lit(1))))
    first = F.get(fit, F.lit(0))
    return F.when(F.size(fit) > 0, F.struct(F.get(first, F.lit(0)).alias("start"), F.get(first, F.lit(1)).alias("end")))


def padded(start: Column, end: Column, days: int = 45) -> tuple[Column, Column]:
    """A period widened at both ends."""
    return F.date_sub(start, days), F.date_add(end, days)


def touches(dates: Column, start: Column, end: Column) -> Column:
    """Whether any of the dates lies in the inclusive period."""
    return F.exists(dates, lambda d: d.between(start, end))


def covenant_period(text: Column, anchors: tuple[str, ...], most: int = 6000) -> Column:
    """(start, end) stated in the section that the first of the anchors opens; else anywhere in the text."""
    sections = [stated_period(F.substring(text, F.call_function("instr", text, F.lit(a)), F.lit(most))) for a in anchors]
    return F.coalesce(*[F.when(F.contains(text, F.lit(a)), s) for a, s in zip(anchors, sections)], stated_period(text))


def coverage(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """Share of a period's days that another one covers; null for an empty period. Under one half is a problem."""
    return F.try_divide(overlap_days(start, end, other_start, other_end), overlap_days(start, end, start, end))
