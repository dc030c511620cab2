"""Byte-level BPE encoding with character offsets, and decoding, over Arrow batches.

Texts are cut where one space stands between two characters that are not white space: no match of the pattern spans
such a place, so the pieces (each with its leading space) encode on their own, and the tokenizers library sees each
distinct piece of a slice once. Recent pieces are kept in two bounded generations per worker process, with their ids
packed, four bytes each: lists of them would take twice the memory.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bounded_batches, slices, texts

VOCABULARY = "byte_bpe_50k"
#: Pieces remembered in one generation, and the longest piece that is remembered.
REMEMBERED, LONGEST = 600_000, 48

_CUT = re.compile(r"(?<=\S) (?=\S)")
_IRREGULAR = re.compile(r"\s\s|^\s|\s$")


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones themselves, others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(shifted)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary; the rank file and the library's file must agree."""

    def __init__(self, name: str = VOCABULARY):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.tokenizer.encode_special_tokens = True
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        to_byte = {c: b for b, c in enumerate(byte_characters())}
        learned = {bytes(map(to_byte.__getitem__, t)): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if all(c in to_byte for c in t)}
        if any(learned.get(token) != rank for token, rank in ranks.items()):
            raise ValueError(f"the files of {name} disagree")
        self.size = max(ranks.values()) + 1
        self.bytes = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.decimal = [str(i) for i in range(self.size)]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text cut into pieces; every piece but the first has lost its leading space."""
        return _CUT.split(text) if _IRREGULAR.search(text) else text.split(" ")

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.pieces(t) for t in texts]
        firsts = [p[0] for p in cut]
        local: dict[str, bytes] = {}
        missing = []
        for piece in set(chain.from_iterable(p[1:] for p in cut)):
            ids = self.young.get(piece)
            if ids is None:
                ids = self.old.get(piece)
            if ids is None:
                missing.append(piece)
            else:
                local[piece] = ids
        coded = self.tokenizer.encode_batch_fast([*firsts, *(f" {p}" for p in missing)], add_special_tokens=False)
        heads = [_packed(c.ids) for c in coded[: len(firsts)]]
        local.update(zip(missing, (_packed(c.ids) for c in coded[len(firsts) :])))
        if len(self.young) + len(local) > REMEMBERED:
            self.old, self.young = self.young, {}
        self.young.update((p, ids) for p, ids in local.items() if len(p) <= LONGEST)
        return [np.frombuffer(b"".join((head, *map(local.__getitem__, p[1:]))), np.uint32).tolist() for head, p in zip(heads, cut)]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-end code point of each token; tokens that share a split character both cover it."""
        ends = np.cumsum([len(self.bytes[i]) for i in ids], dtype=np.int64)
        lead = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        return lead[starts] - 1, lead[ends - 1]


@lru_cache(maxsize=2)
def codec(name: str = VOCABULARY) -> Codec:
    """One codec a worker process."""
    return Codec(name)


def encode(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, ids and the code-point offsets starts, ends of every whole text (null counts as empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(name)
        for part in slices(batches):
            texts_ = [t or "" for t in part.column("text").to_pylist()]
            ids = c.encode(texts_)
            spans = [c.offsets(t, i) for t, i in zip(texts_, ids)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([s for s, _ in spans], pa.list_(pa.int32())), pa.array([e for _, e in spans], pa.list_(pa.int32()))],
                names=["doc_id", "ids", "starts", "ends"],
            )

    bounded_batches(docs.sparkSession)
    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(tokens: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, data and text of ``tokens`` (doc_id, ids); bytes that make no character become U+FFFD in text. Null ids: no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(name)
        for batch in batches:
            data = [c.decode_bytes(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary()), pa.array([d.decode("utf-8", "replace") for d in data])], names=["doc_id", "data", "text"])

    bounded_batches(tokens.sparkSession)
    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, data binary, text string")


def digests(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row's whole text.

    A null text counts as empty: no tokens and the digests of the empty string. Null ids, repeated rows and further
    columns change nothing: one row comes back for each row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(name)
        for part in slices(batches):
            ids = c.encode([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(" ".join(map(c.decimal.__getitem__, i)).encode()).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(c.decode_bytes(i)).hexdigest() for i in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    bounded_batches(docs.sparkSession)
    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
