"""Text functions as Column expressions."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: Legal forms of companies, and currencies that a rate may be derived for.
LEGAL_FORMS = ("jsc", "llp", "llc", "ltd", "plc", "gmbh", "inc", "ао", "тоо", "жшс", "ақ")
CURRENCIES = ("USD", "EUR", "KZT", "RUB", "GBP", "CHF", "CNY", "JPY", "TRY", "AED", "KGS", "UZS", "AZN", "GEL", "BYN", "PLN", "SEK", "NOK", "DKK", "CAD", "AUD", "SGD", "HKD", "INR", "KRW")
_SPACES = "    "
_QUOTES = "«»“”„‟\"'’‘`"
_DASHES = "‐‑‒–—−"


def collapse(text: Column) -> Column:
    """Runs of white space (no-break spaces too) become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(F.translate(text, _SPACES, " " * len(_SPACES)), r"\s+", " "))


def unify(text: Column) -> Column:
    """One kind of dash and quote, no soft hyphens."""
    return F.translate(text, _DASHES + _QUOTES + "­", "-" * len(_DASHES) + '"' * len(_QUOTES))


def fold(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def nfkc(text: Column) -> Column:
    """Unicode compatibility composition, which no built-in function offers: whole texts in Arrow batches."""

    def run(texts: pd.Series) -> pd.Series:
        from unicodedata import normalize

        return texts.map(lambda t: normalize("NFKC", t), na_action="ignore")

    return pandas_udf(run, StringType())(text)


def normal_form(text: Column) -> Column:
    """For comparing quotes with sources: compatibility characters composed, page-number lines gone, dashes, quotes and spaces unified.

    Case stays: a quote must stand as it was written.
    """
    return collapse(unify(F.regexp_replace(nfkc(text), r"(?m)^\s*-?\s*\d{1,3}\s*-?\s*$", "")))


#: The stops of a dotted acronym of two letters or more (L.L.P.).
_ACRONYM_STOP = r"(?<=(?<![\p{L}\d])\p{L})\.(?=\p{L}\.)|(?<=(?<![\p{L}\d])\p{L}\.\p{L})\.|(?<=\.\p{L}\.\p{L})\."


def company(name: Column) -> Column:
    """A company name for matching: no parentheses or quotes, dotted acronyms joined, other stops as spaces, folded."""
    bare = F.translate(F.regexp_replace(name, r"\([^)]*\)", " "), _QUOTES, " " * len(_QUOTES))
    return fold(collapse(F.translate(F.regexp_replace(bare, _ACRONYM_STOP, ""), ".,;:", "    ")))


def unknown_legal_form(name: Column) -> Column:
    """The last word of a name of two words or more, if it looks like a legal form that the list lacks; else null."""
    words = F.split(collapse(F.replace(name, F.lit('"'), F.lit(" "))), " ")
    tail = F.regexp_replace(F.regexp_replace(F.element_at(words, -1), _ACRONYM_STOP, ""), r"^[.,;:]+|[.,;:]+$", "")
    return F.when((F.size(words) >= 2) & tail.rlike(r"^\p{Lu}{2,4}$") & ~F.lower(tail).isin(*LEGAL_FORMS), tail)


def without_layout(name: Column) -> Column:
    """A name from its first Latin word on, if all words before that are Cyrillic ones of a layout, and without stops at its ends."""
    ends = lambda c: F.regexp_replace(c, r"^[ .,;:]+|[ .,;:]+$", "")
    bare = ends(collapse(name))
    words = F.split(bare, " ")
    first = F.array_position(F.transform(words, lambda w: w.rlike("[A-Za-z]")), True).cast("int")
    layout = F.forall(F.slice(words, F.lit(1), F.greatest(first - 1, F.lit(0))), lambda w: w.rlike(r"\p{IsCyrillic}"))
    return F.when((first > 1) & layout, ends(F.array_join(F.slice(words, F.greatest(first, F.lit(1)), F.size(words)), " "))).otherwise(bare)


def without_heading(name: Column) -> Column:
    """A name without the numbers and capitals of a heading before it, provided that a word in title case stands somewhere."""
    words = F.filter(F.split(collapse(name), " "), lambda w: w != "")
    titled = F.exists(words, lambda w: w.rlike(r"^\p{Lu}") & w.rlike(r"\p{Ll}"))
    head = lambda w: w.rlike(r"^\d+$") | (w.rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$") & ~F.lower(w).isin(*LEGAL_FORMS))
    first = F.array_position(F.transform(words, lambda w: ~head(w)), True).cast("int")
    kept = F.when(first > 0, F.slice(words, F.greatest(first, F.lit(1)), F.size(words))).otherwise(F.slice(words, F.greatest(F.size(words), F.lit(1)), F.lit(1)))
    return F.array_join(F.when(titled, kept).otherwise(words), " ")


def organisations(text: Column) -> Column:
    """Distinct names of one to five capitalised words with a legal form behind them."""
    return F.array_distinct(F.regexp_extract_all(collapse(text), F.lit(r"(?:\p{Lu}[\p{L}'-]+ ){1,5}(?:JSC|LLP|LLC|LTD|PLC|GMBH|INC)\b"), F.lit(0)))


def truth(text: Column) -> Column:
    """Whether a text says yes: 1, true or True and nothing else."""
    return F.coalesce(F.trim(text).isin("1", "true", "True"), F.lit(False))


def currency_of(text: Column) -> Column:
    """A currency code in capitals; USD where there is none."""
    return F.upper(F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit("USD")))


def first_anchored(text: Column, anchors: list[str]) -> tuple[Column, Column]:
    """The text from the first anchor of a priority list on, and that anchor; the whole text and null without one."""
    found = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(a)), F.lit(a)) for a in anchors]))
    anchor = F.get(found, F.lit(0))
    return F.when(anchor.isNotNull(), F.substring(text, F.call_function("instr", text, anchor), F.length(text))).otherwise(text), anchor


def prompt_row(number: Column, counterparty: Column, description: Column, amount: Column) -> Column:
    """A ledger row on one line, as a prompt lists it."""
    return F.concat_ws(" | ", F.format_string("%d", number), counterparty, description, F.concat(F.when(amount < 0, "-").otherwise("+"), F.format_number(F.abs(amount), 2)))


def company_core(normal: Column) -> Column:
    """A normalised company name without its trailing legal forms; the name itself if nothing else is left."""
    core = F.trim(F.regexp_replace(normal, rf"( ({'|'.join(LEGAL_FORMS)}))+$", ""))
    return F.when(core == "", normal).otherwise(core)


def group_key(description: Column) -> Column:
    """The part of a description before a spaced dash, folded."""
    return fold(collapse(F.regexp_replace(unify(description), r"\s-\s.*$", "")))


def money(text: Column) -> Column:
    """The first $ amount as a decimal; null without one."""
    found = F.regexp_extract(text, r"\$\s?(\d{1,3}(?:,\d{3})*(?:\.\d{1,2})?|\d+(?:\.\d{1,2})?)", 1)
    return F.try_to_number(F.nullif(F.replace(found, F.lit(","), F.lit("")), F.lit("")), F.lit("999999999999.99")).cast("decimal(18,2)")


def written_forms(number: Column) -> Column:
    """Ways a number may be written in a text: plain, with separators of thousands, as millions, as a percentage."""
    whole = F.format_string("%.0f", number)
    grouped = F.format_number(number, 0)
    millions = F.concat(F.regexp_replace(F.format_string("%.2f", number / 1e6), r"\.?0+$", ""), F.lit(" million"))
    short = F.regexp_replace(F.format_string("%.2f", number), r"\.?0+$", "")
    return F.array_distinct(F.array(whole, grouped, F.translate(grouped, ",", " "), F.translate(grouped, ",", "."), millions, short, F.translate(short, ".", ",")))


def mentions(text: Column, number: Column) -> Column:
    """Whether any written form of the number occurs in the text."""
    return F.exists(written_forms(number), lambda f: F.contains(text, f))


def share(text: Column, letters: str, of: str) -> Column:
    """Characters of one class as a share of another; 0 if there are none."""
    n = F.length(F.regexp_replace(text, f"[^{of}]", ""))
    return F.when(n > 0, F.length(F.regexp_replace(text, f"[^{letters}]", "")) / n).otherwise(0.0)


def garble(text: Column) -> Column:
    """Places where Latin and Cyrillic letters touch, per character; above 0.04 a recognised text is doubtful."""
    joints = F.regexp_count(text, F.lit("[А-Яа-яЁё][A-Za-z]|[A-Za-z][А-Яа-яЁё]"))
    return F.when(F.length(text) > 0, joints / F.length(text)).otherwise(0.0)


def cyrillic(text: Column) -> Column:
    """Cyrillic letters as a share of all letters; 0 without letters."""
    n = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.when(n > 0, F.regexp_count(text, F.lit("[Ѐ-ӿ]")) / n).otherwise(0.0)


def cascade(text: Column, rules: list[tuple[str, str, str]], otherwise: str) -> Column:
    """Type of the first of the ordered rules (name, type, pattern) that matches."""
    return reduce(lambda acc, r: F.when(text.rlike(r[2]), r[1]).otherwise(acc), reversed(rules), F.lit(otherwise))


def collisions(text: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Names of all rules that match."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), n) for n, _, p in rules]))


def section(text: Column, start: str, end: str, least: int, most: int) -> Column:
    """The longest body between a start and an end pattern that has ``least`` characters, cut at ``most``; else the whole text."""
    bodies = F.transform(F.slice(F.split(text, start, -1), F.lit(2), F.size(F.split(text, start, -1))), lambda b: F.split(b, end)[0])
    longest = F.array_max(F.transform(F.filter(bodies, lambda b: F.length(b) >= least), lambda b: F.struct(F.length(b).alias("n"), b.alias("b"))))
    return F.coalesce(F.substring(longest["b"], 1, most), text)


def fx_pairs(text: Column) -> Column:
    """(currency, rate) of disclosed pairs 'amount CUR ... $amount': known foreign currencies, rates from 0.01 to 100."""
    pattern = r"(\d[\d,]*(?:\.\d+)?) ([A-Z]{3})\b[^.$]{0,160}?\$ ?(\d[\d,]*(?:\.\d+)?)"
    flat = collapse(text)
    parts = [F.regexp_extract_all(flat, F.lit(pattern), F.lit(i)) for i in (1, 2, 3)]
    number = lambda c: F.replace(c, F.lit(","), F.lit("")).try_cast("double")
    pairs = F.zip_with(F.arrays_zip(parts[0].alias("f"), parts[1].alias("c")), parts[2], lambda a, u: F.struct(a["c"].alias("currency"), F.try_divide(number(u), number(a["f"])).alias("rate")))
    return F.filter(pairs, lambda p: p["currency"].isin(*[c for c in CURRENCIES if c != "USD"]) & p["rate"].between(0.01, 100))
