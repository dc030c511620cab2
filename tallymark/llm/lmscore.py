"""Cross-entropy difference of documents under a target and a background n-gram model.

The shared vocabulary is every word of the corpus. Each model has two parts: the relative frequency of a word on its
side, drawn towards the word's frequency in the whole corpus so that the smaller side is not blamed for its size, and
the word's spelling under the side's character model of order ORDER. A word's loss is the mean of both parts' losses.
Word counts are exact, taken over every document, and left out for the document that is scored, so its words are never
measured by themselves. A document's score is its mean loss per word under the target model less that under the
background model; lower means closer to the target.

Texts are read in chunks of about CHUNK bytes. A chunk sums its words, the sums of all chunks meet by word in a table
that grows with the corpus and is neither broadcast nor collected, and the totals go back to the chunks. A word has one
row a chunk, however often it stands there. Texts are never shuffled; a chunk travels as its distinct words and their
places, both compressed, stands in a file of its own, so that no reader holds more than one, and is scored STEP words at
a time. Only the character tables are broadcast: SYMBOLS ** ORDER cells at most for any corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import Scratch, bounded_batches, slices, texts

ORDER = 4
#: Words' worth of the corpus frequency that a side's own is drawn by, weight of that frequency beside the spelling of a
#: word that no other document holds, and bytes of text in a chunk (one longer text stands alone).
PRIOR, KNOWN, CHUNK = 1000.0, 0.9, 1 << 24
#: Words that are worked on at once (the words of one document always are).
STEP = 1 << 17
#: Weights of the orders, the longest first, and of the uniform distribution.
WEIGHTS = (0.55, 0.25, 0.12, 0.07, 0.01)


def symbols() -> np.ndarray:
    """Symbol of each byte: lower-case letters stand alone, other bytes fall into classes."""
    out = np.zeros(256, np.int64)
    for i, b in enumerate(b"abcdefghijklmnopqrstuvwxyz"):
        out[b] = i
    classes = (range(65, 91), b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", b".", b",", b"!?", b"'\"`", b"()[]{}<>|/\\", range(0x80, 0x90), range(0x90, 0xA0), range(0xA0, 0xB0), range(0xB0, 0xC0), range(0xC0, 0x100))
    rest = 26 + len(classes)
    out[:] = np.where(np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)), out, rest)
    for i, members in enumerate(classes):
        out[list(members)] = 26 + i
    return out


SYMBOL_OF = symbols()
SYMBOLS = int(SYMBOL_OF.max()) + 1
BREAK = int(SYMBOL_OF[ord("\n")])


def codes(texts_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code of the n-gram that ends at each byte of each text (line breaks stand before a text), and the texts' lengths."""
    filled = pc.fill_null(texts_, "")
    sizes = np.asarray(pc.binary_length(filled)).astype(np.int64)
    data = np.frombuffer(b"".join(s.as_buffer() for s in filled if s.as_buffer() is not None), np.uint8)
    ids = SYMBOL_OF[data]
    at = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = ids.copy()
    for k in range(1, ORDER):
        before = np.full(len(ids), BREAK, np.int64)
        before[k:] = ids[:-k] if k else ids
        out += np.where(at >= k, before, BREAK) * SYMBOLS**k
    return out, sizes


def losses(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of the last symbol of every n-gram, from the n-gram counts."""
    p = np.full(SYMBOLS**ORDER, WEIGHTS[-1] / SYMBOLS)
    left = np.full(SYMBOLS**ORDER, 1 - WEIGHTS[-1])
    table = counts.astype(float)
    for n, weight in zip(range(ORDER, 0, -1), WEIGHTS):
        context = table.reshape(-1, SYMBOLS).sum(axis=1, keepdims=True)
        share = np.divide(table.reshape(-1, SYMBOLS), context, out=np.zeros((len(table) // SYMBOLS, SYMBOLS)), where=context > 0)
        repeat = SYMBOLS ** (ORDER - n)
        p += weight * np.tile(share.ravel(), repeat)
        left -= weight * np.tile(np.repeat((context > 0).ravel(), SYMBOLS), repeat)
        table = table.reshape(SYMBOLS, -1).sum(axis=0)
    # The weight of contexts never met goes to the uniform distribution.
    return -np.log(p + np.maximum(left, 0) / SYMBOLS)


CHUNKS = "chunk long, doc_ids array<long>, sizes array<int>, places binary, words binary"


def packed_places(places: np.ndarray) -> bytes:
    """Places as compressed planes of bytes: the high ones are nearly all zero."""
    return zstandard.compress(places.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def places_of(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view("<i4").ravel()


def packed_words(words: pa.Array) -> bytes:
    """Words, which hold no spaces, as one compressed text."""
    return zstandard.compress(b" ".join(words.cast(pa.binary()).to_pylist()), 3)


def words_of(data: bytes) -> list[bytes]:
    text = zstandard.decompress(data)
    return text.split(b" ") if text else []


def spelled(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the letters of each word and of the space behind it, where each word's begin, and how many there are.

    The space before a word is context, not part of it.
    """
    code, sizes = codes(pc.binary_join_element_wise("", words, "", " "))
    inner = np.ones(len(code), bool)
    inner[np.cumsum(sizes) - sizes] = False
    return code[inner], np.cumsum(sizes - 1) - (sizes - 1), sizes - 1


def _spelled_by_step(words: list[bytes]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """``spelled`` for STEP words at a time, and which they are."""
    for i in range(0, len(words), STEP):
        yield slice(i, i + STEP), *spelled(pa.array(words[i : i + STEP], pa.binary()).cast(pa.string()))


def _words(texts_: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts (as in shingles.word_hashes), and the texts' word counts."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts_, "")))
    flat, parents = words.flatten(), np.asarray(pc.list_parent_indices(words))
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))
    return flat.filter(pa.array(real)).dictionary_encode(), np.bincount(parents[real], minlength=len(texts_))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) to chunks of documents and their words."""
    part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

    def out() -> pa.RecordBatch:
        nonlocal n, held, size
        coded = pa.chunked_array([h[0] for h in held]).unify_dictionaries()
        words, place = coded.chunk(0).dictionary, np.concatenate([np.asarray(c.indices) for c in coded.chunks])
        # Frequent words get small places, which take little room.
        order = np.argsort(-np.bincount(place, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        ids, sizes = [i for h in held for i in h[2]], np.concatenate([h[1] for h in held]).astype(np.int32)
        row = [part * (1 << 32) + n, ids, sizes, packed_places(rank[place]), packed_words(words.take(pa.array(order)))]
        n, held, size = n + 1, [], 0
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[f.split(" ")[0] for f in CHUNKS.split(", ")])

    for batch in slices(batches):
        held.append((*_words(batch.column("text")), batch.column("doc_id").to_pylist()))
        size += batch.column("text").nbytes
        if size >= CHUNK:
            yield out()
    if held:
        yield out()


def _sides(row: dict, n: int) -> np.ndarray:
    """Which of a chunk's documents are targets."""
    out = np.zeros(n, bool)
    out[np.asarray(row["targets"])] = True
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, place, key, target, background): how often each word of a chunk stands on either side.

    Rows with place -1 have the code of a character n-gram for a key.
    """
    names = ["chunk", "place", "key", "target", "background"]
    for batch in batches:
        for i in range(batch.num_rows):
            chunk, sizes = batch.column("chunk")[i].as_py(), np.asarray(batch.column("sizes")[i].values)
            places, words = places_of(batch.column("places")[i].as_py()), words_of(batch.column("words")[i].as_py())
            n = len(words)
            target = np.bincount(places[np.repeat(_sides({"targets": batch.column("targets")[i].values}, len(sizes)), sizes)], minlength=n).astype(np.int64)
            background = np.bincount(places, minlength=n) - target
            keys = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, n).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk)), pa.array(np.arange(n), pa.int32()), *map(pa.array, (keys, target, background))], names=names)
            if n:
                both = np.zeros((2, SYMBOLS**ORDER), np.int64)
                for step, code, _, letters in _spelled_by_step(words):
                    for count, side in zip(both, (target, background)):
                        np.add.at(count, code, np.repeat(side[step], letters))
                met = np.flatnonzero(both[0] + both[1])
                m = len(met)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, chunk)), pa.array(np.full(m, -1), pa.int32()), pa.array(met), *(pa.array(c[met]) for c in both)], names=names)


def word_loss(seen: np.ndarray, size: np.ndarray, anywhere: np.ndarray, all_words: np.ndarray, spelling: np.ndarray) -> np.ndarray:
    """Loss of each word on a side: the mean of its frequency's, drawn towards the corpus, and of its spelling's."""
    known = np.where(all_words > 0, KNOWN, 0.0)
    corpus = known * anywhere / np.maximum(all_words, 1) + (1 - known) * np.exp(-spelling)
    return (spelling - np.log((seen + PRIOR * corpus) / (size + PRIOR))) / 2


def _scores(total: tuple[int, int], shared):
    """A function of a chunk's words with their corpus counts (place, t, b) and of the chunk itself: its documents' scores."""

    def run(counts: pa.Table, chunks: pa.Table) -> pa.Table:
        tables = np.frombuffer(shared.value, np.float32).reshape(2, -1)
        doc_ids, sizes = chunks.column("doc_ids")[0].values, np.asarray(chunks.column("sizes")[0].values).astype(np.int64)
        places, words = places_of(chunks.column("places")[0].as_py()), words_of(chunks.column("words")[0].as_py())
        some, mean, side = sizes > 0, np.zeros((2, len(sizes))), _sides({"targets": chunks.column("targets")[0].values}, len(sizes))
        spellings, seen, n = np.zeros((2, len(words))), np.zeros((2, len(words))), len(words)
        for step, code, starts, _ in _spelled_by_step(words):
            for k, table in enumerate(tables):
                spellings[k, step] = np.add.reduceat(table[code].astype(float), starts)
        del words
        where = np.asarray(counts.column("place"))
        for k, name in enumerate(("t", "b")):
            seen[k, where] = np.asarray(counts.column(name))
        ends = np.cumsum(sizes)
        # Runs of documents that hold about STEP words.
        for docs in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(ends // STEP)) + 1):
            own_sizes = sizes[docs]
            place = places[ends[docs[0]] - sizes[docs[0]] : ends[docs[-1]]]
            owner = np.repeat(np.arange(len(docs)), own_sizes)
            _, at, own = np.unique(owner * n + place, return_inverse=True, return_counts=True)
            own, length, mine = own[at], own_sizes[owner], side[docs][owner]
            for k, out in enumerate(mean):
                on_side = mine == (k == 0)
                loss = word_loss(seen[k, place] - own * on_side, total[k] - length * on_side, seen[0, place] + seen[1, place] - own, sum(total) - length, spellings[k, place])
                out[docs] = np.bincount(owner, loss, len(docs)) / np.maximum(own_sizes, 1)
        return pa.table(
            [doc_ids, pa.array(sizes), *(pa.array(m, mask=~some) for m in mean), pa.array(np.where(some, mean[0] - mean[1], 0.0))], names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"]
        )

    return run


def cross_entropy_difference(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score of every row of ``docs`` (doc_id, text).

    ``chosen`` (doc_id) names the target documents; all others are the background. The loss of a document is the mean
    over its words, each side's counts without the document's own. Null and wordless texts have no tokens, null losses
    and score 0. A side without words has the corpus frequencies and a uniform spelling. Repeated rows count each time; null ids are background;
    very long texts are read whole and are a chunk of their own; further columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "lmscore")
    chunks = scratch.save(texts(docs).mapInArrow(_chunks, CHUNKS), maxRecordsPerFile=1)
    marks = chosen.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    # Labels grow with the corpus: they meet the ids of the chunks, not the texts.
    targets = chunks.select("chunk", F.posexplode("doc_ids").alias("at", "doc_id")).join(marks.hint("merge"), "doc_id").groupBy("chunk").agg(F.collect_list("at").alias("targets"))
    sided = chunks.join(scratch.save(targets), "chunk", "left").withColumn("targets", F.coalesce("targets", F.array().cast("array<int>")))
    sums = scratch.save(sided.mapInArrow(_sums, "chunk long, place int, key long, target long, background long"), compression="zstd")
    words, letters = sums.where("place >= 0"), sums.where("place < 0")
    total = words.agg(F.sum("target").alias("t"), F.sum("background").alias("b")).first()
    counted = letters.groupBy("key").agg(F.sum("target").alias("target"), F.sum("background").alias("background")).toArrow()
    tables = []
    for side in ("target", "background"):
        dense = np.zeros(SYMBOLS**ORDER, np.int64)
        dense[np.asarray(counted.column("key"))] = np.asarray(counted.column(side))
        tables.append(losses(dense).astype(np.float32))
    shared = spark.sparkContext.broadcast(np.stack(tables).tobytes())
    # A word has one row a chunk, so the rows of one word are as few as the chunks.
    by_word = Window.partitionBy("key")
    met = words.select("chunk", "place", F.sum("target").over(by_word).alias("t"), F.sum("background").over(by_word).alias("b"))
    # One chunk at a time meets its counts: neither side holds more than a chunk in memory.
    mine = sided.select("chunk", "doc_ids", "targets", "sizes", "places", "words")
    schema = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
    return met.groupBy("chunk").cogroup(mine.groupBy("chunk")).applyInArrow(_scores((total["t"] or 0, total["b"] or 0), shared), schema)
