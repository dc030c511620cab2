"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: numbers, names and units turn into typed placeholders, other words are
lower-cased and stripped of surrounding punctuation. Windows of WINDOW template tokens are hash-joined with those of
the benchmark. Matches of one document and item on one diagonal (document position less item position) are an
alignment; it counts when it covers enough of the item and when every name or number slot of the item stands for one
value throughout the alignment, so a question with other numbers and names is caught and a chance agreement is not.

Templates depend on capitals and need some length, so the words as they stand, case-folded, are joined by windows too:
an item shorter than a window as a whole, scripts without spaces by their characters. Items of fewer than LEAST words say
too little to be found within a text: they match a text that is the item and nothing else.

The document side is thinned by a bitmap of fixed size over the benchmark's window hashes before anything is shuffled;
the join itself is exact, so a larger benchmark costs more rows but loses none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bounded_batches, slices, texts
from tallymark.llm.shingles import MIX, mix

#: Template tokens of a window, literal ones among them at least, and tokens that an alignment must cover
#: (of a shorter item, that share).
WINDOW, LITERALS, COVERED, SHARE = 8, 3, 13, 0.8
#: Words of an item that is looked for within texts, at least.
LEAST = 5
#: Bits of the bitmap: 2 MB, whatever the benchmark's size.
BITMAP = 1 << 24

#: Number words and units.
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split())
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb oz ml l dl s sec secs min mins h hr hrs hour hours minute minutes second seconds day days week weeks month months year years "
    "meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram grams kilogram kilograms pound pounds ton tons liter liters litre litres gallon gallons "
    "dollar dollars cent cents euro euros usd eur percent degrees kmh mph".split()
)
LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3
#: Patterns of whole words: what stands around a core, a sentence's end, a number.
_EDGES = r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$"
_ENDS = r"""[.!?]["')\]»”’]*$"""
_NUMBER = r"^[+-]?\p{Nd}[\p{Nd}.,:/]*(%|st|nd|rd|th)?$"
#: Characters of scripts that put no spaces between words.
_UNSPACED = r"[\x{0e00}-\x{0eff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}]"
_ALONE = re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), _UNSPACED)
_PIECES, _OUTER = re.compile(f"{_ALONE}|(?:(?!{_ALONE}).)+", re.S), re.compile(r"^\W+|\W+$")
#: Sets the hashes of words as they stand apart from those of template tokens.
SPOKEN = 0x5BD1E995


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each string."""
    return hash_array(words.to_numpy(zero_copy_only=False), categorize=False) if len(words) else np.zeros(0, np.uint64)


def _flags(words: pa.Array, pattern: str) -> np.ndarray:
    """Whether a pattern matches each string."""
    return np.asarray(pc.match_substring_regex(words, pattern)).astype(bool)


class Words:
    """The words of some texts: what there is to know of each distinct one, and for each word its place there and its text.

    hashes: of the folded core, a word without the punctuation around it; kinds: NAME only if not at a sentence start;
    ends: whether it ends a sentence; real: whether it has a core; spoken, starts, sizes: hashes of what stands between
    spaces, or of its characters in a script without spaces.
    """

    def __init__(self, texts_: pa.Array):
        split = pc.utf8_split_whitespace(pc.fill_null(texts_, ""))
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary
        self.at, self.parents, self.texts = np.asarray(coded.indices), np.asarray(pc.list_parent_indices(split)), len(texts_)
        core = pc.replace_substring_regex(distinct, _EDGES, "")
        # Folded as far as letters go that case splits in two.
        low = pc.replace_substring(pc.replace_substring(pc.utf8_lower(core), "ß", "ss"), "ς", "σ")
        self.hashes, self.real = _hashes(low), np.asarray(pc.greater(pc.binary_length(low), 0)).astype(bool)
        self.ends = _flags(distinct, _ENDS)
        upper, single = (np.asarray(x).astype(bool) for x in (pc.utf8_is_upper(core), pc.equal(pc.utf8_length(core), 1)))
        name = (_flags(core, r"^\p{Lu}") & ~upper) | (upper & single & ~np.asarray(pc.equal(core, "I")).astype(bool))
        is_in = lambda values: np.asarray(pc.is_in(low, pa.array(sorted(values)))).astype(bool)
        self.kinds = np.select([_flags(core, _NUMBER) | is_in(NUMBER_WORDS), is_in(UNITS), name], [NUMBER, UNIT, NAME], LITERAL).astype(np.int8)
        self.sizes = self.real.astype(np.int64)
        unspaced = np.flatnonzero(_flags(low, _UNSPACED)).tolist()
        parts = [[y for x in _PIECES.findall(low[i].as_py()) if (y := _OUTER.sub("", x))] for i in unspaced]
        self.sizes[unspaced] = [len(p) for p in parts]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.spoken = np.zeros(int(self.sizes.sum()), np.uint64)
        plain = self.real.copy()
        plain[unspaced] = False
        self.spoken[self.starts[plain]] = self.hashes[plain]
        if parts:
            flat = _hashes(pa.array([x for p in parts for x in p], pa.string()))
            self.spoken[np.concatenate([np.arange(self.starts[i], self.starts[i] + len(p)) for i, p in zip(unspaced, parts)])] = flat


def template(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template hash and slot value (0: not a slot) of every template token, and the number of tokens of each text.

    A capitalised word is a name unless it starts a sentence (the text's start is one); a unit word is a placeholder
    only after a number; runs of names make one placeholder whose value is the run's first name.
    """
    parents = words.parents
    hashes, kinds, ends, real = (known[words.at] for known in (words.hashes, words.kinds, words.ends, words.real))
    first = np.ones(len(hashes), bool)
    first[1:] = (parents[1:] != parents[:-1]) | ends[:-1]
    hashes, kinds, first, parents = hashes[real], kinds[real], first[real], parents[real]
    after = lambda a: np.concatenate((np.zeros(1, bool), a[:-1] & (parents[1:] == parents[:-1]))) if len(a) else a
    kinds = np.where((kinds == NAME) & first, LITERAL, kinds)
    kinds = np.where((kinds == UNIT) & ~after(kinds == NUMBER), LITERAL, kinds)
    keep = ~((kinds == NAME) & after(kinds == NAME))
    hashes, kinds, parents = hashes[keep], kinds[keep], parents[keep]
    slots = np.where((kinds == NUMBER) | (kinds == NAME), hashes | np.uint64(1), np.uint64(0))
    holders = mix(np.arange(4, dtype=np.uint64) + np.uint64(11))
    return np.where(kinds == LITERAL, hashes & ~np.uint64(1), holders[kinds] | np.uint64(1)), slots, np.bincount(parents, minlength=words.texts)


def verbatim(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As template(), with every token literal and no slots."""
    each, starts = words.sizes[words.at], words.starts[words.at]
    at = np.repeat(starts - (np.cumsum(each) - each), each) + np.arange(each.sum())
    tokens = mix(words.spoken[at] ^ np.uint64(SPOKEN)) & ~np.uint64(1)
    return tokens, np.zeros(len(tokens), np.uint64), np.bincount(np.repeat(words.parents, each), minlength=words.texts)


def window_hashes(tokens: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the window that starts at each token, and whether it holds enough literal tokens."""
    n = max(0, len(tokens) - width + 1)
    rolled, literals = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    literal = (tokens & np.uint64(1)) == 0
    for k in range(width):
        rolled = mix(rolled * MIX + tokens[k : k + n] + np.uint64(width))
        literals += literal[k : k + n]
    return rolled, literals >= min(LITERALS, width)


def _windows(keys: tuple[str, ...], widths: dict[bool, tuple[int, ...]], bitmap=None, whole: bool = False):
    """An Arrow function: rows (keys, at, width, hash, slots, n_tokens, exact) of the windows of each text.

    widths: of the windows of template tokens (False) and of the words as they stand (True: exact).
    whole: a text shorter than WINDOW makes one window of its own length, instead of windows of every width. A window of
    fewer than LEAST tokens is always a whole text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(bitmap.value, np.uint8)) if bitmap is not None else None
        for part in slices(batches):
            words = Words(part.column("text"))
            read = {exact: (verbatim if exact else template)(words) for exact, some in widths.items() if some}
            for exact, width in [(exact, width) for exact in read for width in widths[exact]]:
                tokens, slots, counts = read[exact]
                ends = np.cumsum(counts)
                owner = np.repeat(np.arange(len(counts)), counts)
                left = ends[owner] - np.arange(len(tokens))
                rolled, good = window_hashes(tokens, width)
                n = len(rolled)
                good &= left[:n] >= width
                if width < LEAST:
                    good &= counts[owner[:n]] == width
                if whole:
                    good &= (counts[owner[:n]] == width) if width < WINDOW else (counts[owner[:n]] >= WINDOW)
                if bits is not None:
                    good &= bits[(rolled >> np.uint64(40)).astype(np.int64)] == 1
                at = np.flatnonzero(good)
                if not len(at):
                    continue
                who = owner[at]
                picked = pa.FixedSizeListArray.from_arrays(pa.array(slots[at[:, None] + np.arange(width)].view(np.int64).ravel()), width).cast(pa.list_(pa.int64()))
                starts = ends[who] - counts[who]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k).take(pa.array(who)) for k in keys), pa.array(at - starts, pa.int64()), pa.array(np.full(len(at), width), pa.int32()), pa.array(rolled[at].view(np.int64)), picked, pa.array(counts[who], pa.int64()), pa.array(np.full(len(at), exact))],
                    names=[*keys, "at", "width", "hash", "slots", "n_tokens", "exact"],
                )

    return run


def _bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct places of the window hashes in the bitmap."""
    for batch in batches:
        place = np.unique(np.asarray(batch.column("hash")).view(np.uint64) >> np.uint64(40)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(place)], names=["place"])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, body (xxhash64 of the text), item_id, covered, n_tokens, verbatim: each contaminated text with its items.

    Rows of one id and unequal texts are searched apart, rows of one id and text count once.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = "at long, width int, hash long, slots array<long>, n_tokens long, exact boolean"
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL")
    # Two texts may stand under one item_id: windows of one never continue those of the other.
    items = items.withColumn("item_body", F.xxhash64("text"))
    widths = {False: (5, 6, 7, WINDOW), True: tuple(range(1, WINDOW + 1))}
    asked = items.mapInArrow(_windows(("item_id", "item_body"), widths, whole=True), f"item_id long, item_body long, {kind}").distinct()
    table = np.zeros(BITMAP, np.uint8)
    places = asked.select("hash").mapInArrow(_bitmap, "place long").distinct()
    found = places.toArrow().column("place").to_numpy()  # at most BITMAP numbers
    table[found] = 1
    met_widths = asked.select("exact", "width").distinct().orderBy("width").collect()
    used = {exact: tuple(r["width"] for r in met_widths if r["exact"] == exact) for exact in (False, True)}
    bitmap = spark.sparkContext.broadcast(np.packbits(table).tobytes())
    said = texts(docs).where("doc_id IS NOT NULL").withColumn("body", F.xxhash64("text")).mapInArrow(_windows(("doc_id", "body"), used, bitmap), f"doc_id long, body long, {kind}")
    said = said.select("doc_id", "body", F.col("at").alias("doc_at"), "exact", "width", "hash", F.col("slots").alias("doc_slots"))
    met = said.join(asked.withColumnRenamed("at", "item_at"), ["exact", "width", "hash"])
    paired = F.transform(
        F.filter(F.arrays_zip(F.col("slots").alias("s"), F.col("doc_slots").alias("d"), F.sequence(F.lit(0), F.col("width") - 1).alias("k")), lambda z: z["s"] != 0),
        lambda z: F.struct(z["s"].alias("s"), z["d"].alias("d")),
    )
    pair = ["doc_id", "body", "item_id", "item_body"]
    met = met.select(*pair, "exact", (F.col("doc_at") - F.col("item_at")).alias("diagonal"), "item_at", "width", "n_tokens", paired.alias("pairs"))
    # One diagonal has at most as many windows as the item has tokens, so these sets are bounded by the item.
    lines = met.groupBy(*pair, "exact", "diagonal").agg(
        F.collect_set(F.sequence(F.col("item_at"), F.col("item_at") + F.col("width") - 1)).alias("at"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"), F.max("n_tokens").alias("n_tokens")
    )
    lines = lines.select(
        *pair,
        "exact",
        F.size(F.array_distinct(F.flatten("at"))).cast("long").alias("covered"),
        "n_tokens",
        (F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["s"])))).alias("consistent"),
        F.forall("pairs", lambda p: p["s"] == p["d"]).alias("verbatim"),
    )
    most = F.ceil(F.col("n_tokens") * SHARE)
    lines = lines.withColumns({"enough": F.col("consistent") & (F.col("covered") >= F.least(F.lit(COVERED), most)), "most": F.col("covered") >= most})
    best = lambda c, exact: F.max(F.when(F.col("enough") & (F.col("exact") == exact), F.col(c)))
    pairs = lines.groupBy(*pair).agg(
        *[F.coalesce(best(c, False), best(c, True)).alias(c) for c in ("covered", "n_tokens")],
        F.max(F.when(F.col("enough"), F.col("verbatim"))).alias("verbatim"),
        (F.max(F.when(F.col("enough") & (~F.col("exact") | F.col("most")), True)).isNotNull() | F.min("consistent")).alias("clear"),
    )
    return pairs.where("covered IS NOT NULL AND clear").drop("clear", "item_body")


def alignments(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, covered (template tokens), n_tokens (of the item), verbatim: contaminated pairs.

    verbatim tells whether all slots carry the item's own values. Null or empty texts, on either side, match nothing;
    neither do null ids. Words as they stand count like an alignment, but where a slot of the item stands for two values
    they must cover SHARE of the item; then covered and n_tokens are words, if no template matches. Repeated rows of
    either table give one row for each pair of ids; of unequal texts under one id each is searched by itself, and the one
    that covers most is told. An item of fewer than LEAST words matches a text that consists of it. Columns other than
    doc_id, text and item_id, text are ignored. Very long texts are searched whole.
    """
    best = matches(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max(F.struct("covered", "verbatim", "n_tokens")).alias("b"))
    return best.select("doc_id", "item_id", "b.covered", "b.n_tokens", "b.verbatim")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no contaminated pair under its id; rows with a null id stay."""
    hit = matches(docs, benchmark).select(F.col("doc_id").alias("leaked_id"), F.col("body").alias("leaked_body")).distinct()
    mine = (docs["doc_id"].cast("long") == hit["leaked_id"]) & (F.xxhash64(docs["text"].cast("string")) == hit["leaked_body"])
    return docs.join(hit, mine, "left_anti")
