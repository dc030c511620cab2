"""Cleaning the ledger and tagging its rows: categories, parties, auditor notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.text import company, company_core, currency_of


def scenario_of(txn_id: Column) -> Column:
    """The second dash token of an id of three or more; else ''."""
    parts = F.split(txn_id, "-")
    return F.when(F.size(parts) >= 3, parts[1]).otherwise("")


def parse_amount(text: Column) -> Column:
    """A finite number or null; blanks are missing, never 0."""
    value = F.nullif(F.trim(text), F.lit("")).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def in_template(ledger: DataFrame, template: DataFrame) -> DataFrame:
    """Rows of the scenarios that the template names."""
    return ledger.join(template.select("scenario_id").distinct(), "scenario_id", "left_semi")


def repeated_ids(ledger: DataFrame, *keys: str) -> DataFrame:
    """Ids that stand on more than one row, with the number of rows; the rows themselves stay."""
    return ledger.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def convert(ledger: DataFrame, rates: DataFrame) -> DataFrame:
    """amount_usd at the currency's rate, in exact decimals; without a rate the amount stands at face value and fx_missing says so."""
    joined = ledger.withColumn("currency", currency_of(F.col("currency"))).join(rates.select("currency", "rate"), "currency", "left")
    usd = F.col("currency") == "USD"
    return joined.withColumns(
        {"amount_usd": F.when(usd, F.col("amount")).otherwise(F.coalesce(F.round(F.col("amount").cast("decimal(18,4)") * F.col("rate").cast("decimal(18,6)"), 2).cast("double"), F.col("amount"))), "fx_missing": ~usd & F.col("rate").isNull()}
    )


#: Beginnings of words that tell money going out from money coming in.
OUTWARD = ("расход", "списан", "уплач", "платёж", "платеж", "outflow", "expense")
INWARD = ("поступлен", "доход", "получен", "inflow", "income")
#: Further words, which decide only where none of those stands.
MORE_OUTWARD, MORE_INWARD = ("payment", "paid", "cost", "оплат"), ("receipt", "received", "revenue", "proceeds")
#: What announces the amount that is meant.
ANNOUNCED = ("actual amount", r"фактическ\p{L}* сумм\p{L}*", "составляет")


def first_place(text: Column, words: tuple[str, ...]) -> Column:
    """Where the first of some words begins; null if none stands there."""
    return F.array_min(F.filter(F.array(*[F.locate(w, text) for w in words]), lambda at: at > 0))


def recover_amounts(ledger: DataFrame, documents: DataFrame, near: int = 320) -> DataFrame:
    """Missing amounts read from the first mention of the transaction, by document and place, that an amount follows.

    ``documents``: scenario_id, doc_id, text, authoritative ones only. The window from each mention (white space counts
    once) is searched for a $ amount, the one after 'actual amount' first; words of spending make it negative. An id
    inside a longer one is no mention. Found rows have recovered = true.
    """
    from tallymark.functions.text import money

    gaps = ledger.where("amount IS NULL").select("txn_id", "scenario_id")
    # Documents are cut into the windows of their ids once, so the match is an equality.
    txn = r"TXN-[A-Za-z0-9]+-\d+"
    windows = F.regexp_extract_all(F.regexp_replace("text", r"\s+", " "), F.lit(rf"(?<!\w)(?<!\w-)(?={txn}(?!\w|-\d))(?=(.{{0,{near}}}))"), F.lit(1))
    named = documents.select("scenario_id", "doc_id", F.posexplode(windows).alias("at", "w")).withColumn("txn_id", F.regexp_extract("w", f"^{txn}", 0))
    seen = gaps.join(named, ["scenario_id", "txn_id"])
    meant = F.regexp_extract("w", rf"(?isu)(?:{'|'.join(ANNOUNCED)})(.*)$", 1)
    value = F.coalesce(money(meant), money(F.col("w")))
    # The first word of direction decides; without one the amount is positive and flagged.
    said = F.lower("w")
    pairs = [(first_place(said, out), first_place(said, in_)) for out, in_ in ((OUTWARD, INWARD), (MORE_OUTWARD, MORE_INWARD))]
    told = [F.coalesce(out < in_, F.when(out.isNotNull(), True), F.when(in_.isNotNull(), False)) for out, in_ in pairs]
    spent, unknown = F.coalesce(*told, F.lit(False)), F.coalesce(*told).isNull()
    seen = seen.withColumns({"value": F.when(spent, -value).otherwise(value), "sign_unknown": unknown}).where("value IS NOT NULL")
    first = seen.groupBy("scenario_id", "txn_id").agg(F.min_by(F.struct("value", "sign_unknown"), F.struct("doc_id", "at")).alias("f"), F.min("doc_id").alias("evidence"))
    joined = ledger.join(first, ["scenario_id", "txn_id"], "left")
    recovered = F.col("amount").isNull() & F.col("f.value").isNotNull()
    return joined.withColumns({"recovered": recovered, "sign_unknown": recovered & F.col("f.sign_unknown"), "amount": F.coalesce("amount", "f.value")}).drop("f")


def match_entities(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """entity of each row's counterparty: equal normalised name, else equal core name if only one entity has it.

    ``entities``: scenario_id, name, pos; of entities with equal normalised names the last by pos counts.
    """
    known = entities.withColumn("norm", company(F.col("name")))
    exact = known.groupBy("scenario_id", "norm").agg(F.max_by("name", "pos").alias("exact_entity"))
    core = known.withColumn("core", company_core(F.col("norm"))).groupBy("scenario_id", "core").agg(F.min("name").alias("core_entity"), F.countDistinct("norm").alias("k")).where("k = 1").drop("k")
    named = rows.withColumn("norm", company(F.col("counterparty"))).withColumn("core", company_core(F.col("norm")))
    found = named.join(exact, ["scenario_id", "norm"], "left").join(core, ["scenario_id", "core"], "left")
    return found.withColumn("entity", F.coalesce("exact_entity", "core_entity")).drop("norm", "core", "exact_entity", "core_entity")


def is_related(share: Column, threshold: Column, basis: Column) -> Column:
    """A stated basis decides; else the share must reach the threshold; unknown numbers mean no."""
    return F.when(basis.isNotNull(), True).otherwise(F.coalesce(share >= threshold, F.lit(False)))


def immaterial(kind: Column, status: Column, value: Column, threshold: Column) -> Column:
    """Applied EBITDA adjustments below the threshold, or without a value, fall away; equality counts."""
    return (kind == "ebitda_adjustment") & (status == "applied") & threshold.isNotNull() & (value.isNull() | (value < threshold))


#: Bits of the sieve that spares rows a shuffle; it is broadcast as 2**20 numbers of 64 bits at most, whatever is asked.
SIEVE_BITS = 26


def sieve(rows: DataFrame, asked: DataFrame, *keys: str) -> DataFrame:
    """``rows`` without most of those that have no partner of equal ``keys`` in ``asked``; all that have one stay.

    Both sides hash their keys to a bit, and rows whose bit nothing that is asked has set go before they are shuffled.
    """
    bit = F.xxhash64(*[F.col(k).cast("string") for k in keys]).bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    place, mask = F.shiftright("_bit", 6).alias("_place"), F.expr("shiftleft(1L, cast(_bit & 63 AS int))").alias("_mask")
    marks = asked.select(bit.alias("_bit")).select(place, mask).groupBy("_place").agg(F.bit_or("_mask").alias("_marks"))
    each = rows.withColumn("_bit", bit).select(*rows.columns, place, mask)
    return each.join(F.broadcast(marks), "_place").where(F.col("_marks").bitwiseAND(F.col("_mask")) != 0).select(*rows.columns)


def address_notes(notes: DataFrame, ledger: DataFrame) -> DataFrame:
    """note_id, txn_id, tier: the rows a note speaks of, by the first tier that finds any.

    Tiers: 1 transaction id; 2 counterparty and amount to the cent; 3 counterparty; 4 amount alone, if one row only has it.
    """
    # Rows and notes meet once, by any of their keys. An amount within a cent lies in the same or the next cell of a cent's width.
    key = lambda kind, c: F.concat(F.lit(kind), c.cast("string"))
    size = F.abs("amount")
    rows = ledger.select("scenario_id", "txn_id", size.alias("size"), F.explode(F.array(key("i", F.col("txn_id")), key("n", F.col("counterparty")), key("s", F.floor(size * 100)))).alias("key"))
    value = F.abs("value")
    cells = [key("s", F.floor(value * 100) + i) for i in (-1, 0, 1)]
    asked = notes.select("scenario_id", "note_id", value.alias("value"), F.explode(F.array_compact(F.array(key("i", F.col("target_txn_id")), key("n", F.col("target_counterparty")), *cells))).alias("key"))
    kind, close = F.substring("key", 1, 1), F.coalesce(F.abs(F.col("size") - F.col("value")) < 0.01, F.lit(False))
    tier = F.when(kind == "i", 1).when(kind == "n", F.when(close, 2).otherwise(3)).when(close, 4)
    tiers = sieve(rows, asked, "scenario_id", "key").join(asked, ["scenario_id", "key"]).withColumn("tier", tier).where("tier IS NOT NULL").groupBy("note_id", "tier").agg(F.collect_set("txn_id").alias("ids"))
    best = tiers.where((F.col("tier") < 4) | (F.size("ids") == 1)).groupBy("note_id").agg(F.min_by(F.struct("tier", "ids"), "tier").alias("b"))
    return best.select("note_id", F.explode("b.ids").alias("txn_id"), F.col("b.tier").alias("tier"))


def apply_notes(ledger: DataFrame, notes: DataFrame, addressed: DataFrame) -> DataFrame:
    """The ledger after cut-offs (excluded, not removed) and reclassifications; of several notes to a row the last counts.

    Only applied notes of these two kinds act, a reclassification only with a target category.
    """
    acting = notes.where("status = 'applied' AND (kind = 'cutoff' OR kind = 'reclassification' AND to_category IS NOT NULL)").join(addressed, "note_id")
    moves = F.col("kind") == "reclassification"
    each = acting.groupBy("txn_id").agg(F.max(~moves).alias("cut"), F.max_by(F.when(moves, F.col("to_category")), F.when(moves, F.col("pos"))).alias("to_category"))
    joined = ledger.join(each, "txn_id", "left")
    return joined.withColumns({"excluded": F.col("excluded") | F.coalesce("cut", F.lit(False)), "category": F.coalesce("to_category", "category")}).drop("cut", "to_category")


def apply_categories(ledger: DataFrame, categories: DataFrame) -> DataFrame:
    """The ledger with the category of each transaction (txn_id, category), or other and a problem; the origin says which.

    ``categories`` with a scope also give that, the largest of several.
    """
    joined = ledger.drop("category")
    if "scope" in categories.columns:
        # Every row has met all categories of its transaction where the join has put it.
        joined = joined.drop("scope").join(categories.select("txn_id", "category", "scope"), "txn_id", "left").withColumn("scope", F.max("scope").over(Window.partitionBy("txn_id")))
    else:
        joined = joined.join(categories.select("txn_id", "category"), "txn_id", "left")
    missing = F.col("category").isNull()
    return joined.withColumns(
        {"category": F.coalesce("category", F.lit("other")), "origin": F.array(F.when(missing, "category: none").otherwise("category")), "problem": F.when(missing, "no_category")}
    )


def tag_parties(ledger: DataFrame, entities: DataFrame, clean: DataFrame | None = None) -> DataFrame:
    """The ledger with party from ``entities`` (scenario_id, name, pos, is_related, unrestricted): related wins over unrestricted.

    A counterparty that is both is a problem (party_conflict). The origin names what was applied. ``clean``: the rows before
    they met others by txn_id, all of which have one; parties then come to them by it as well, and no row moves again.
    """
    sides = {"related": "is_related", "unrestricted_subsidiary": "unrestricted"}
    key = ["scenario_id", "counterparty"]
    # Each name is matched once.
    names = (ledger if clean is None else clean).select(*key).distinct()
    for side, flag in sides.items():
        names = match_entities(names, entities.where(flag)).withColumnRenamed("entity", side)
    names = names.where(" OR ".join(f"{s} IS NOT NULL" for s in sides))
    if clean is None:
        out = ledger.join(names, key, "left")
    else:
        rows = clean.select("txn_id", *key)
        hits = sieve(rows, names, *key).join(names, key).groupBy("txn_id").agg(F.collect_set(F.struct(*key, *sides)).alias("_hits"))
        same = F.filter("_hits", lambda h: (h["scenario_id"] == F.col("scenario_id")) & (h["counterparty"] == F.col("counterparty")))
        out = ledger.join(hits, "txn_id", "left").withColumn("_hit", F.get(same, F.lit(0)))
        out = out.withColumns({s: F.col(f"_hit.{s}") for s in sides}).drop("_hits", "_hit")
    related, open_ = F.col("related").isNotNull(), F.col("unrestricted_subsidiary").isNotNull()
    party = F.when(related, "related").when(open_, "unrestricted_subsidiary")
    note = F.when(related, F.concat(F.lit("related: "), "related")).when(open_, F.concat(F.lit("unrestricted: "), "unrestricted_subsidiary"))
    origin = F.when(party.isNotNull(), F.array_append("origin", note)).otherwise(F.col("origin"))
    problem = F.concat_ws(",", "problem", F.when(related & open_, "party_conflict"))
    return out.withColumns({"party": party, "origin": origin, "problem": F.nullif(problem, F.lit(""))}).drop(*sides)


def final_ledger(clean: DataFrame, categories: DataFrame, entities: DataFrame, notes: DataFrame) -> DataFrame:
    """The clean ledger tagged in the engine's order: categories, related parties, unrestricted subsidiaries, auditor notes.

    first_category is the category before the notes.
    """
    tagged = tag_parties(apply_categories(clean, categories), entities, clean).withColumn("excluded", F.lit(False))
    before = tagged.withColumn("first_category", F.col("category"))
    # Notes speak of what the clean rows hold already; asked of the tagged ones, they would be joined with all tags once more.
    noted = apply_notes(before, notes, address_notes(notes, clean))
    moved, cut = F.col("category") != F.col("first_category"), F.col("excluded")
    steps = F.array_compact(F.array(F.when(moved, F.concat(F.lit("reclassified from "), "first_category")), F.when(cut, "cutoff")))
    return noted.withColumn("origin", F.concat("origin", steps))


def clean_ledger(raw: DataFrame, rates: DataFrame) -> DataFrame:
    """Typed rows of a raw ledger (all strings): scenario, amount, currency (USD if none) and amount at the currency's rate.

    Rows without an amount stay, flagged, so that they can be recovered and counted; ``with_amounts`` leaves them out.
    """
    typed = raw.withColumns({"scenario_id": scenario_of(F.col("txn_id")), "amount": parse_amount(F.col("amount")), "date": F.trim("date").try_cast("date")})
    return convert(typed, rates).withColumn("problem", F.when(F.col("amount").isNull(), "no_amount").when(F.col("fx_missing"), "no_rate"))


def with_amounts(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that have an amount, and the number of those left out by scenario."""
    gone = ledger.where("amount IS NULL").groupBy("scenario_id").agg(F.count("*").alias("n_dropped"))
    return ledger.where("amount IS NOT NULL"), gone


def last_by(frame: DataFrame, partition: list[str], order: list[Column]) -> DataFrame:
    """The first row of each partition in the given order."""
    return frame.withColumn("at_", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).where("at_ = 1").drop("at_")
