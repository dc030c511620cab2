"""Classifying, attributing and reading documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.dates import coverage, overlap_days
from tallymark.functions.text import collapse, company_core, company, fx_pairs, money, normal_form, without_heading
from tallymark.operators.ranks import ranked, upper_median
from tallymark.tables import Store


def anomalies(rows: DataFrame, column: str, least_median: float, part: float) -> DataFrame:
    """Rows whose value lies under a part of the upper median, if that median is large enough to tell anything."""
    placed = ranked(rows, [F.asc(column)], Store(rows.sparkSession, "median").put)
    middle = upper_median(placed, column)
    return placed.drop("rank").crossJoin(F.broadcast(middle)).where((F.col("mid") >= least_median) & (F.col(column) < F.col("mid") * part)).drop("mid")


def representatives(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Each row with the first row of its key and the number of rows that share it: one costly call may serve them all."""
    groups = rows.groupBy(key).agg(F.min(order).alias("representative"), F.count("*").alias("members"))
    return rows.join(groups, key).select(order, "representative", "members")


def fx_rates(docs: DataFrame) -> DataFrame:
    """doc_id, currency, rate: the last pair of a document counts, and the first document for a currency."""
    pairs = docs.select("doc_id", F.posexplode(fx_pairs(F.col("text"))).alias("pos", "p")).select("doc_id", "pos", "p.*")
    own = pairs.groupBy("doc_id", "currency").agg(F.max_by("rate", "pos").alias("rate"))
    return own.groupBy("currency").agg(F.min("doc_id").alias("doc_id"), F.min_by("rate", "doc_id").alias("rate"))


def grounded(quote: Column, source: Column, least: int = 12) -> Column:
    """Whether a quote of some length stands in the source, whatever their dashes, quotes, spaces and page numbers; case counts."""
    q = normal_form(quote)
    return (F.length(q) >= least) & F.contains(normal_form(source), q)


def learn_names(docs: DataFrame, owner: str, coverage: float, discrimination: float) -> DataFrame:
    """name, owner, hits: names found in enough of an owner's documents and hardly elsewhere. ``docs``: doc_id, owner, names."""
    hits = docs.select(owner, F.explode("names").alias("name")).groupBy("name", owner).agg(F.count("*").alias("hits"))
    total = hits.groupBy("name").agg(F.sum("hits").alias("total"))
    own = docs.groupBy(owner).agg(F.count("*").alias("docs"))
    return hits.join(total, "name").join(own, owner).where((F.col("hits") / F.col("docs") >= coverage) & (F.col("hits") / F.col("total") >= discrimination))


#: Words of texts and names, and what stands around and between them.
_WORD, _OTHER = r"[\p{L}\p{N}]+", r"[^\p{L}\p{N}]+"


def longest_match(docs: DataFrame, names: DataFrame, doc: str, owner: str) -> DataFrame:
    """doc, owner, ambiguous: the owner of the longest known name in a text; ``names``: name, owner.

    A name is found where its words and what stands between them follow one another in the text; white space counts once,
    punctuation around a name not at all. Every run of as many words as some name has is cut out of the text once and meets
    the names by equality of the whole, so names that begin alike, however many, are different keys and texts are not
    carried through the join. Null texts and names without a word match nothing; no names give no rows.
    """
    core = F.regexp_replace("name", rf"^{_OTHER}|{_OTHER}$", "")
    known = names.select(collapse(F.col("name")).alias("name"), owner).withColumn("run", core).where("run <> ''")
    known = known.withColumn("words", F.size(F.regexp_extract_all("run", F.lit(_WORD), F.lit(0))))
    # As many numbers as names have lengths.
    lengths = sorted(r["words"] for r in known.select("words").distinct().collect())
    flat = docs.select(doc, F.regexp_extract_all(collapse(F.col("text")), F.lit(f"{_WORD}|{_OTHER}"), F.lit(0)).alias("pieces"))
    # Words and what stands between them take turns; the first word is the first or the second piece.
    first = F.when(F.get("pieces", F.lit(0)).rlike(f"^{_WORD}"), 1).otherwise(2)
    flat = flat.withColumn("starts", F.when(F.size("pieces") >= first, F.sequence(first, F.size("pieces"), F.lit(2))))

    def of_length(n: int) -> Column:
        reach = F.filter("starts", lambda s: s + (2 * n - 2) <= F.size("pieces"))
        return F.transform(reach, lambda s: F.array_join(F.slice("pieces", s, F.lit(2 * n - 1)), ""))

    runs = [of_length(n) for n in lengths]
    cut = flat.select(doc, F.explode(F.array_distinct(F.flatten(F.array(*runs))) if runs else F.array().cast("array<string>")).alias("run"))
    hits = cut.join(known, "run").select(doc, owner, F.length("name").alias("n"))
    by_length = hits.groupBy(doc, "n").agg(F.min(owner).alias(owner), (F.countDistinct(owner) > 1).alias("ambiguous"))
    return by_length.groupBy(doc).agg(F.max_by(F.struct(owner, "ambiguous"), "n").alias("b")).select(doc, f"b.{owner}", "b.ambiguous")


def attribute_by_account(docs: DataFrame, accounts: DataFrame) -> DataFrame:
    """doc_id, account_id: the longest known account id that stands alone in the text, the smallest of equals.

    Texts are cut into id tokens, so the match is an equality and no account is searched for in every text.
    """
    tokens = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?<![\w-])ACC-[\w-]*\w"), F.lit(0)))).alias("account_id"))
    best = tokens.join(accounts, "account_id").groupBy("doc_id").agg(F.min(F.struct((-F.length("account_id")).alias("n"), "account_id")).alias("b"))
    return best.select("doc_id", "b.account_id")


def pledges(docs: DataFrame) -> DataFrame:
    """doc_id, name, pct, unrestricted of pledge tables; the threshold is the 'below X%' near 'unrestricted'."""
    window = F.substring(F.regexp_extract("text", r"(?is)pledged shares(.*)", 1), 1, 900)
    line = r"(\p{Lu}[\p{L} ]*? (?:LLP|JSC|LLC)) (\d+(?:\.\d+)?)%"
    parts = [F.regexp_extract_all(window, F.lit(line), F.lit(i)) for i in (1, 2)]
    limit = F.regexp_extract("text", r"(?is)unrestricted.{0,300}?below (\d+(?:\.\d+)?)%", 1).try_cast("double")
    rows = docs.select("doc_id", limit.alias("limit"), F.explode(F.arrays_zip(parts[0].alias("name"), parts[1].alias("pct"))).alias("p"))
    return rows.select("doc_id", "p.name", F.col("p.pct").cast("double").alias("pct"), (F.col("p.pct").cast("double") < F.col("limit")).alias("unrestricted"))


def roll_forward(text: Column) -> Column:
    """Capital spending from a property roll-forward: closing less opening plus depreciation; null unless disposals are ruled out."""
    part = lambda word: money(F.regexp_extract(text, rf"(?i){word}[^$]{{0,80}}(\$[\d,.]*\d)", 1))
    return F.when(text.rlike("(?i)no disposals"), part("closing balance") - part("opening balance") + part("depreciation"))


def fingerprints(rows: DataFrame, version: str, *columns: str) -> DataFrame:
    """A short digest of a version and some columns."""
    return rows.withColumn("fingerprint", F.substring(F.sha2(F.concat_ws("|", F.lit(version), *[F.col(c).cast("string") for c in columns]), 256), 1, 16))


def changed(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key and fingerprint are not among those already done."""
    return rows.join(done, [key, "fingerprint"], "left_anti")


def invariants(docs: DataFrame, owner: str, kind: str, exactly_one: dict[str, str], at_least_one: dict[str, str]) -> DataFrame:
    """owner, code of owners whose documents break a rule on how many of a kind there are."""
    n = lambda k: F.count_if(F.col(kind) == k)
    checks = [F.when(n(k) != 1, code) for k, code in exactly_one.items()] + [F.when(n(k) < 1, code) for k, code in at_least_one.items()]
    return docs.groupBy(owner).agg(F.array_compact(F.array(*checks)).alias("codes")).select(owner, F.explode("codes").alias("code"))


def shares(rows: DataFrame, key: str, most: float) -> DataFrame:
    """Rows of each key as a share of all, with an alarm above ``most``."""
    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.crossJoin(F.broadcast(total)).select(key, "n", F.round(F.col("n") / F.col("total"), 9).alias("share"), (F.col("n") > most * F.col("total")).alias("alarm"))


#: A document with fewer characters a page is a scan; a page with a picture and fewer characters is drawn; what an unreadable page leaves.
SCAN_CHARS, DRAWN_CHARS, UNREADABLE = 120, 60, "[page {} could not be read]"
#: Types of documents whose figures may be used.
AUTHORITATIVE = ("LOAN_ACTIVE", "AUDIT_FINAL", "KYC", "TREASURY_MEMO")


def scans(pages: DataFrame) -> DataFrame:
    """doc_id, per_page, is_scan of ``pages`` (doc_id, page, text, has_image): whether the text layer is missing or poor."""
    per = pages.groupBy("doc_id").agg((F.sum(F.length(F.trim("text"))) / F.count("*")).alias("per_page"))
    return per.withColumn("is_scan", F.col("per_page") < SCAN_CHARS)


def drawn_pages(pages: DataFrame) -> DataFrame:
    """doc_id, page of the pages that show a picture and next to no text."""
    return pages.where(F.col("has_image") & (F.length(F.trim(F.coalesce("text", F.lit("")))) < DRAWN_CHARS)).select("doc_id", "page")


def spliced(pages: DataFrame, read: DataFrame) -> DataFrame:
    """doc_id, text, needs_review: whole texts with the drawn pages in place as ``read`` (doc_id, page, text) gives them.

    A drawn page that was not read leaves a visible mark, and its document needs a review.
    """
    drawn = drawn_pages(pages).withColumn("drawn", F.lit(True))
    joined = pages.join(drawn, ["doc_id", "page"], "left").join(read.select("doc_id", "page", F.col("text").alias("seen")), ["doc_id", "page"], "left")
    lost = F.coalesce("drawn", F.lit(False)) & F.col("seen").isNull()
    mark = F.format_string(UNREADABLE.replace("{}", "%d"), "page")
    text = F.when(lost, mark).when(F.col("drawn"), F.col("seen")).otherwise(F.coalesce("text", F.lit("")))
    whole = joined.withColumns({"t": text, "lost": lost}).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "t"))).alias("ts"), F.max("lost").alias("needs_review"))
    return whole.select("doc_id", F.array_join(F.transform("ts", lambda p: p["t"]), "\n").alias("text"), "needs_review")


def authoritative(docs: DataFrame) -> DataFrame:
    """Documents of a resolved type and scenario: superseded loans, drafts and the unattributed never feed figures."""
    return docs.where(F.col("type").isin(*AUTHORITATIVE) & F.col("scenario_id").isNotNull())


def active_agreement(loans: DataFrame) -> DataFrame:
    """scenario_id, doc_id, problem of the agreement in force: ``loans`` (scenario_id, doc_id, start, end, from, to, marked).

    An exact match of the reporting period (from, to) counts most, then the days shared, then no mark, then the larger id.
    """
    known = F.col("start").isNotNull() & F.col("end").isNotNull() & F.col("from").isNotNull()
    days = F.when(known, overlap_days(F.col("start"), F.col("end"), F.col("from"), F.col("to"))).otherwise(-1)
    exact = F.coalesce(known & (F.col("start") == F.col("from")) & (F.col("end") == F.col("to")), F.lit(False))
    ranked = loans.withColumn("r", F.struct(exact.alias("exact"), days.alias("days"), (~F.col("marked")).alias("plain"), "doc_id"))
    best = ranked.groupBy("scenario_id").agg(F.max("r").alias("r"), F.max_by(F.struct("start", "end", "from", "to", "marked"), "r").alias("p"))
    little = coverage(F.col("p.start"), F.col("p.end"), F.col("p.from"), F.col("p.to")) < 0.5
    problem = F.concat_ws(",", F.when(F.col("p.start").isNull(), "no_period").when(little, "little_coverage"), F.when(F.col("p.marked"), "marked"))
    return best.select("scenario_id", "r.doc_id", problem.alias("problem"))


def current_versions(docs: DataFrame) -> DataFrame:
    """scenario_id, type, doc_id, stale, undecided of documents (scenario_id, type, doc_id, dated, from, to).

    Of several of one type the one dated in the period and latest stays, the first by id of equals; if none is dated
    nothing is decided and none is stale.
    """
    inside = F.coalesce(F.col("dated").between(F.col("from"), F.col("to")), F.lit(False))
    group = Window.partitionBy("scenario_id", "type")
    order = group.orderBy(inside.desc(), F.col("dated").desc_nulls_last(), "doc_id")
    undecided = (F.count("dated").over(group) == 0) & (F.count("*").over(group) > 1)
    out = docs.withColumns({"nth": F.row_number().over(order), "undecided": undecided})
    return out.select("scenario_id", "type", "doc_id", ((F.col("nth") > 1) & ~F.col("undecided")).alias("stale"), "undecided")


def group_parents(docs: DataFrame, borrowers: DataFrame, patterns: tuple[str, ...]) -> DataFrame:
    """scenario_id, parent, doc_id: the first document that names the borrower and, by the first of ``patterns`` that gives
    another name than the borrower's, a parent. ``docs``: scenario_id, doc_id, text; ``borrowers``: scenario_id, name.
    """
    own = borrowers.withColumn("core", company_core(company(F.col("name")))).where("core <> ''")
    met = docs.join(own.select("scenario_id", "core"), "scenario_id").withColumn("flat", collapse(F.col("text"))).where(F.contains(F.lower("flat"), F.col("core")))
    names = [without_heading(F.regexp_extract("flat", p, 1)) for p in patterns]
    other = [F.when((n != "") & (company_core(company(n)) != F.col("core")), n) for n in names]
    found = met.withColumn("parent", F.coalesce(*other)).where("parent IS NOT NULL")
    return found.groupBy("scenario_id").agg(F.min_by("parent", "doc_id").alias("parent"), F.min("doc_id").alias("doc_id"))
