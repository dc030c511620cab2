"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Every detected entity is reduced to a canonical form (digits of a number, lower case of an address, single words of a
name), and a keyed hash of that form picks its surrogate: letters become letters, digits digits, a number keeps its
separators and length, a card number its check digit, a name its honorific, hence gender, its script and its number of
words. Equal entities get equal surrogates in every document. Two unequal entities whose surrogates would coincide, or
a surrogate that is itself an entity of the corpus, are found by one aggregate over distinct entities; all but one take
the next surrogate of their sequence until none collide. Every few tries surrogates grow, so the room for them never runs
out and the tries end. Only those exceptions travel back to the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Scratch, texts

#: Honorifics by gender, and the name parts that surrogates are built from, by script.
MALE, FEMALE, OPEN = "Mr Herr Señor Sr Don Monsieur г-н господин".split(), "Mrs Ms Miss Frau Señora Sra Doña Madame Mme Mlle г-жа госпожа".split(), "Dr Prof".split()
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Henri Ivan Jonas Karl Louis Marc Niko Oscar Paul Rafael Simon Tomas Viktor".split(),
    ("latin", "f"): "Alba Berta Clara Diana Elena Flora Greta Helene Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sara Teresa Vera".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Тимур".split(),
    ("cyrillic", "f"): "Алина Белла Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Римма".split(),
}
PARTS = {"latin": "ba ber cor dan del fer gar hol kem lan mar nor pel ren sal tor ul van wes zan".split(), "cyrillic": "ба вер гор дан зел кир лан мар нор пел рен сал тор ул ван фед".split()}

#: Further given names by which a person without an honorific is known.
KNOWN = {
    "m": "Alejandro Alexander Andrew Anthony Antonio Carlos Charles Christian Daniel Edward Fernando Francisco François Frank Franz George Guillaume Hans Heinrich Henry Jacques James Javier Jean Johann John Jorge José Joseph Juan Jürgen Klaus Luis Manuel Matthew Matthias Michael Michel Miguel Nicolas Otto Pablo Pedro Peter Philippe Pierre Richard Robert Stefan Thomas Uwe William Wolfgang Алексей Андрей Владимир Дмитрий Михаил Сергей Юрий".split(),
    "f": "Alice Ana Anna Anne Barbara Carmen Caroline Catherine Charlotte Christine Dorothy Elizabeth Emily Emma Eva Heike Ingrid Isabel Isabelle Jane Jeanne Jennifer Jessica Katharina Linda Lucía Margaret Marie Marta Martina Mary Monika Nathalie Patricia Petra Pilar Sabine Sandra Sarah Sophie Susan Susanne Sylvie Ursula Анна Екатерина Наталья Светлана Татьяна".split(),
}

_HONORIFIC = rf"(?:{'|'.join(MALE + FEMALE + OPEN)})"
_ALL_GIVEN = sorted({w for words in (*GIVEN.values(), *KNOWN.values()) for w in words})
#: Grouped by first letter, so that most places are left after one comparison a letter.
_GIVEN = rf"(?=\p{{Lu}})(?:{'|'.join(f'{c}(?:' + '|'.join(w[1:] for w in _ALL_GIVEN if w[0] == c) + ')' for c in sorted({w[0] for w in _ALL_GIVEN}))})"
_NAME = r"\p{Lu}[\p{L}'-]+"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Country codes of one and of two digits; all others have three.
_CODE = r"(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Telephone numbers: 3-3-4; international with 8 digits or more in any groups, up to an address; pairs; trunk code 0; nine digits in Spain; ten bare ones in America.
_PHONES = (
    r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}",
    r"\+(?=(?:[ .()/-]{0,2}\d){8,15}(?!\d))\d{1,3}(?:(?! (?:\d{1,3}\.){3}\d)[ ./-]?\(?\d{1,4}\)?){1,7}(?<=\d)",
    r"0\d(?:[ .-]\d{2}){4}",
    r"\(?0\d{1,4}\)?[ /-]{1,3}\d{3,4}[ -]?\d{3,5}",
    r"[6-9]\d{2}(?: \d{3}){2}(?! \d)",
    r"[6-9]\d{2}(?: \d{2}){3}(?! \d)",
    r"[2-9]\d{9}",
)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: A domain label; names have 127 labels at most, so that matching one is bounded too.
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
#: Kinds in the order in which they are tried at one place. No pattern can start inside a run that it would itself extend,
#: and every repeated group is bounded: the engine recurses once for each repetition of a group.
KINDS = {
    "email": rf"(?<![\w.%+-])[A-Za-z0-9._%+-]++@(?:{_LABEL}\.){{1,126}}[A-Za-z]{{2,63}}",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d)"
    rf"|(?=[0-9A-Fa-f:]{{1,5}}:)(?<![\w:.])(?=[A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|(?:{_HEX}:){{2,7}}:|::(?:{_HEX}:){{0,6}}{_HEX})(?![\w:]|\.\d)",
    "card": r"(?<![\w+])(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,4}(?:[ -]?\d{1,3})?|\d{4}[ -]?\d{6}[ -]?\d{4,5})(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": rf"(?=[\d+(])(?<![\w+])(?:{'|'.join(_PHONES)})(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "person": rf"(?<![\p{{L}}\d_-])(?:{_HONORIFIC}\.? {_NAME}(?: {_NAME}){{0,2}}|{_GIVEN}(?: {_NAME}){{1,2}})",
}
#: No kind starts behind an ASCII word character: looked at first, that leaves most places at once.
COMBINED = rf"(?<!\w)(?:{'|'.join(f'(?:{p})' for p in KINDS.values())})"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def kind_of(hit: Column) -> Column:
    """The first kind that a hit has the look of; none for long numbers that are neither cards nor telephone numbers."""
    digits = F.regexp_replace(hit, r"\D", "")
    return (
        F.when(hit.contains("@"), "email")
        .when(hit.rlike(r"^[0-9A-Fa-f]*:[0-9A-Fa-f:]+$"), "ip")
        .when(hit.rlike(r"^[\d.]+$") & (F.length(F.regexp_replace(hit, r"[^.]", "")) == 3), "ip")
        .when(hit.rlike(r"^(?:\d{4}[ -]?){3}\d{4}$"), "card")
        .when(hit.rlike(r"^\d[\d -]+\d$") & F.length(digits).between(13, 19) & (_checked(digits) == digits), "card")
        .when(hit.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(hit.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$"), "iban")
        .when(hit.rlike(rf"^(?:{'|'.join(_PHONES)})$"), "phone")
        .when(hit.rlike(r"^\d"), "none")
        .otherwise("person")
    )


def _seed(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """64 hex digits, keyed."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canonical, attempt.cast("string")), 256)


#: Tries after which surrogates grow by one character, and again by one each.
TRIES = 4


def _more(seed: Column, attempt: Column, signs: str) -> Column:
    """What the surrogates of later tries are longer by: a sign of ``signs`` (16) for every TRIES tries."""
    return F.substring(F.translate(F.sha2(seed, 256), "0123456789abcdef", signs), F.lit(1), F.floor(attempt / TRIES).cast("int"))


def _number(seed: Column, place: Column) -> Column:
    """A number from 0 to 255 for a place of the seed."""
    return F.conv(F.substring(seed, F.pmod(place * 2, F.lit(62)) + 1, F.lit(2)), 16, 10).cast("int")


def _substring(text: Column, place: Column) -> Column:
    return F.substring(text, place, F.lit(1))


def _same_classes(canonical: Column, seed: Column, spared: Column) -> Column:
    """Letters for letters and digits for digits; characters past ``spared`` (a length) stay."""

    def one(i: Column) -> Column:
        c, n = _substring(canonical, i + 1), _number(seed, i)
        return (
            F.when(i >= spared, c)
            .when(c.rlike("[0-9]"), F.pmod(n, F.lit(10)).cast("string"))
            .when(c.rlike("[a-z]"), _substring(F.lit(LETTERS), F.pmod(n, F.lit(26)) + 1))
            .when(c.rlike("[A-Z]"), _substring(F.lit(LETTERS.upper()), F.pmod(n, F.lit(26)) + 1))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(0), F.length(canonical) - 1), one), "")


def _checked(digits: Column) -> Column:
    """The digits with their last one replaced by the Luhn check digit."""
    n = F.length(digits)
    places = F.sequence(F.lit(1), n - 1)
    twice = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    total = F.aggregate(F.transform(places, lambda i: F.when(F.pmod(n - i, F.lit(2)) == 1, twice(value(i))).otherwise(value(i))), F.lit(0), lambda a, b: a + b)
    return F.concat(F.substring(digits, F.lit(1), n - 1), F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))


def _pick(words: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), F.pmod(n, F.lit(len(words))) + 1)


def surrogate(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """The surrogate of a canonical entity: canonical itself, in the same form.

    A name word arrives as role (given or family), gender and lower-cased word, joined by slashes.
    """
    seed = _seed(key, kind, canonical, attempt)
    plain = F.concat(_same_classes(canonical, seed, F.length(canonical)), _more(seed, attempt, "0123456789012345"))
    email = F.concat(_more(seed, attempt, LETTERS[:16]), _same_classes(canonical, seed, F.length(canonical) - F.length(F.regexp_extract(canonical, r"\.[^.]*$", 0))))
    ip = F.array_join(F.transform(F.split(canonical, r"\."), lambda part, i: (F.pmod(_number(seed, i), F.lit(254)) + 1).cast("string")), ".")
    # Four numbers, or the groups as they stand, for some tries; then all eight groups are written.
    group = lambda i: F.substring(seed, F.pmod(i * 4, F.lit(60)) + 1, F.lit(4))
    kept = F.array_join(F.transform(F.split(canonical, ":"), lambda part, i: F.when(part == "", part).otherwise(group(i))), ":")
    ip = F.when(attempt >= TRIES, F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), group), ":")).when(canonical.contains(":"), kept).otherwise(ip)
    iban = F.concat(F.substring(canonical, 1, 2), F.substring(plain, F.lit(3), F.length(canonical)))
    # A country code (without a plus, whatever stands before the last ten digits) and a trunk 0 are format.
    code = F.when(canonical.startswith("+"), F.length(F.regexp_extract(canonical, rf"^\+{_CODE}", 0))).when(canonical.startswith("0"), 1).otherwise(F.greatest(F.length(canonical) - 10, F.lit(0)))
    phone = F.concat(F.substring(canonical, F.lit(1), code), F.substring(plain, code + 1, F.length(canonical)))
    word = F.split_part(canonical, F.lit("/"), F.lit(3))
    male, cyrillic = F.split_part(canonical, F.lit("/"), F.lit(2)) == "m", word.rlike(r"[Ѐ-ӿ]")
    given = F.when(cyrillic, F.when(male, _pick(GIVEN["cyrillic", "m"], _number(seed, F.lit(0)))).otherwise(_pick(GIVEN["cyrillic", "f"], _number(seed, F.lit(0))))).otherwise(
        F.when(male, _pick(GIVEN["latin", "m"], _number(seed, F.lit(0)))).otherwise(_pick(GIVEN["latin", "f"], _number(seed, F.lit(0))))
    )
    longer = {"latin": _more(seed, attempt, "abcdefghiklmnoru"), "cyrillic": _more(seed, attempt, "абвгдезиклмнорту")}
    family = {s: F.initcap(F.concat(*[_pick(PARTS[s], _number(seed, F.lit(i))) for i in range(4)], longer[s])) for s in PARTS}
    # Given names carry a family-like ending after the first try.
    more = {s: F.concat(given, F.lit("-"), F.initcap(F.concat(*[_pick(PARTS[s], _number(seed, F.lit(i + 4))) for i in range(4)], longer[s]))) for s in PARTS}
    name = F.when(F.split_part(canonical, F.lit("/"), F.lit(1)) == "family", F.when(cyrillic, family["cyrillic"]).otherwise(family["latin"])).otherwise(
        F.when(attempt == 0, given).when(cyrillic, more["cyrillic"]).otherwise(more["latin"])
    )
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", _checked(plain)).when(kind == "iban", iban).when(kind == "phone", phone).when(kind == "person", name).otherwise(plain)


def titled(hit: Column) -> Column:
    """Whether a name starts with an honorific."""
    return F.regexp_replace(F.split(hit, " ")[0], r"\.", "").isin(*MALE, *FEMALE, *OPEN)


def canonicals(kind: Column, hit: Column, known: Column | None = None) -> Column:
    """Canonical entities of a hit: one, or one for each word of a name but the honorific.

    ``known``: canonical name words of the document; a name without an honorific takes its words from there first.
    """
    words = F.split(hit, " ")
    female, male = (F.regexp_replace(words[0], r"\.", "").isin(*g) for g in (FEMALE, MALE))
    names = F.slice(words, F.when(titled(hit), 2).otherwise(1), F.size(words))
    in_list = {g: names[0].isin(*KNOWN[g], *GIVEN["latin", g], *GIVEN["cyrillic", g]) for g in "mf"}
    # A title without gender, or none: the first name of the surrogate follows the given name, or else its ending.
    gender = F.when(female, "f").when(male, "m").when(in_list["f"], "f").when(in_list["m"], "m").when(F.lower(names[0]).rlike("[aeя]$"), "f").otherwise("m")
    parts = F.transform(names, lambda w, i: F.when(i == F.size(names) - 1, F.concat(F.lit("family/-/"), F.lower(w))).otherwise(F.concat(F.lit("given/"), gender, F.lit("/"), F.lower(w))))
    if known is not None:
        same = lambda p: F.try_element_at(F.filter(known, lambda k: F.split_part(k, F.lit("/"), F.lit(3)) == F.split_part(p, F.lit("/"), F.lit(3))), F.lit(1))
        parts = F.when(titled(hit), parts).otherwise(F.transform(parts, lambda p: F.coalesce(same(p), p)))
    phone = F.concat(F.when(hit.startswith("+"), "+").otherwise(""), F.regexp_replace(hit, r"\D", ""))
    return F.when(kind == "person", parts).when(kind == "none", F.array().cast("array<string>")).otherwise(
        F.array(F.when(kind == "email", F.lower(hit)).when(kind == "ip", F.lower(hit)).when(kind == "phone", phone).when(kind == "iban", F.replace(hit, F.lit(" "), F.lit(""))).otherwise(F.regexp_replace(hit, r"\D", "")))
    )


def _rendered(kind: Column, hit: Column, fakes: Column) -> Column:
    """The surrogates in the format of the hit."""
    fake = F.ltrim(F.get(fakes, F.lit(0)), F.lit("+"))
    zero = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"))

    def step(acc: Column, c: Column) -> Column:
        takes = c.rlike("[0-9A-Z]")
        return F.struct((acc["at"] + F.when(takes, 1).otherwise(0)).alias("at"), F.concat(acc["text"], F.when(takes, F.substring(fake, acc["at"], F.lit(1))).otherwise(c)).alias("text"))

    # A surrogate that has grown goes on behind the places of the hit.
    filled = F.aggregate(F.split(hit, ""), zero, step, lambda acc: F.concat(acc["text"], F.substring(fake, acc["at"], F.length(fake))))
    name = F.concat_ws(" ", F.when(titled(hit), F.split(hit, " ")[0]), F.array_join(fakes, " "))
    return F.when(kind == "none", hit).when(kind.isin("email", "ip"), fake).when(kind == "person", name).otherwise(filled)


def _distinct_fakes(found: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, canonical, attempt) of the entities whose first surrogate would collide, with the first attempt that does not."""
    entities = scratch.save(found.select(F.explode("entities").alias("e")).select("e.kind", F.explode("e.canonical").alias("canonical")).distinct().withColumn("attempt", F.lit(0)))
    # Names coincide with entities as words, whatever their role.
    word = F.when(F.col("kind") == "person", F.lower(F.split_part("canonical", F.lit("/"), F.lit(3)))).otherwise(F.col("canonical"))
    # Given and family names never meet in one place of a name; numbers of unequal kinds may.
    space = F.when(F.col("kind") == "person", F.split_part("canonical", F.lit("/"), F.lit(1))).otherwise(F.lit(""))
    spent = entities
    while True:
        faked = entities.withColumn("fake", F.lower(surrogate(key, F.col("kind"), F.col("canonical"), F.col("attempt")))).withColumns({"space": space, "word": word})
        owner = faked.groupBy("kind", "space", "fake").agg(F.min(F.struct(-F.col("attempt"), "canonical")).alias("first"), F.count("*").alias("n")).where("n > 1")
        real = faked.select("kind", "space", F.col("word").alias("fake")).distinct().withColumn("real", F.lit(True))
        judged = faked.join(owner, ["kind", "space", "fake"], "left").join(real, ["kind", "space", "fake"], "left")
        loses = F.coalesce(F.col("real"), F.lit(False)) | (F.col("first").isNotNull() & (F.col("first.canonical") != F.col("canonical")))
        following = scratch.save(judged.select("kind", "canonical", (F.col("attempt") + loses.cast("int")).alias("attempt"), loses.alias("moved")))
        moved = not following.where("moved").isEmpty()
        scratch.drop(spent)
        entities, spent = following.drop("moved"), following
        if not moved:
            return scratch.save(entities.where("attempt > 0"))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, n_<kind> (entities of each kind), text with every entity replaced, for every row of ``docs``.

    A null text stays null and has no entities. Repeated rows, null ids and further columns change nothing. Honorifics
    are kept, so the gender they show is kept; a name without one is detected by a common given name before it, or by a
    word that stands in a detected name of the same document. Cards of other than 16 digits need a right check digit.
    Very long texts are searched whole, at a cost that grows with their length and, after a first name is found, with the
    number of their distinct name words.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pii")
    frame = texts(docs)
    hits = frame.withColumn("hits", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(COMBINED), F.lit(0)))
    # Names found by themselves give the words that are looked for throughout their document.
    people = F.filter("hits", lambda h: kind_of(h) == "person")
    known = F.array_distinct(F.flatten(F.transform("people", lambda h: canonicals(F.lit("person"), h))))
    bare = F.array_distinct(F.flatten(F.transform("people", lambda h: F.filter(F.split(h, " "), lambda w: ~titled(w)))))
    bare = F.concat(F.lit("(?:"), F.array_join(F.reverse(F.array_sort(bare)), "|"), F.lit(")"))
    hits = hits.withColumn("people", people).withColumn("known", known).withColumn("bare", F.when(F.size("people") > 0, bare))
    pattern = F.concat(F.lit(rf"{COMBINED}|(?<![\p{{L}}\d_-])"), F.col("bare"), F.lit("(?: "), F.col("bare"), F.lit(r"){0,5}(?![\p{L}\d_-])"))
    hits = hits.withColumn("hits", F.when(F.col("bare").isNull(), F.col("hits")).otherwise(F.regexp_extract_all("text", pattern, F.lit(0))))
    described = F.transform("hits", lambda h: F.struct(h.alias("hit"), kind_of(h).alias("kind"), canonicals(kind_of(h), h, F.col("known")).alias("canonical")))
    # Texts are searched once and written with what they hold: a search costs far more than reading them again.
    hits = scratch.save(hits.select("doc_id", "text", "bare", described.alias("entities")))
    # Rows meet their exceptions by a digest of the whole text; those that need none are dealt out evenly.
    some = F.size("entities") > 0
    body = F.when(some, F.sha2("text", 256)).otherwise(F.concat(F.lit("#"), F.xxhash64("doc_id", F.length("text"))))
    found = scratch.save(hits.where(some).select(body.alias("body"), "entities"))
    exceptions = _distinct_fakes(found, key, scratch)
    listed = found.select("body", F.explode("entities").alias("e")).select("body", "e.kind", F.explode("e.canonical").alias("canonical")).distinct()
    by_body = listed.join(exceptions, ["kind", "canonical"]).groupBy("body").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "canonical"), "attempt"))).alias("attempts"))
    by_body = scratch.save(by_body)
    scratch.keep(by_body, hits)
    full = hits.withColumn("body", body).join(by_body, "body", "left")
    attempt = lambda kind, c: F.coalesce(F.try_element_at("attempts", F.concat_ws("\x1f", kind, c)), F.lit(0))
    fakes = F.transform("entities", lambda e: _rendered(e["kind"], e["hit"], F.transform(e["canonical"], lambda c: surrogate(key, e["kind"], c, attempt(e["kind"], c)))))
    full = full.withColumn("fakes", F.when(some, fakes)).withColumn("gaps", F.when(some, F.split("text", F.coalesce(pattern, F.lit(COMBINED)), -1)))
    text = F.concat(F.array_join(F.transform("fakes", lambda f, i: F.concat(F.element_at("gaps", i + 1), f)), ""), F.element_at("gaps", -1))
    kinds = F.transform("entities", lambda e: e["kind"])
    counts = [F.size(F.array_remove(kinds, k)).cast("long") for k in KINDS]
    counts = [(F.size("entities").cast("long") - n).alias(f"n_{k}") for k, n in zip(KINDS, counts)]
    return full.select("doc_id", *counts, F.when(some, text).otherwise(F.col("text")).alias("text"))
