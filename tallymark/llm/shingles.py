"""Hashes of words and of word shingles, vectorised over Arrow slices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words of each text.

    A-Z are lower-cased; a word is a run of bytes other than space and 0x09-0x0D; a null text has no words.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, parents = words.flatten(), pc.list_parent_indices(words)
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))
    coded = flat.dictionary_encode()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)), np.uint64, len(coded.dictionary))
    hashes = table[np.asarray(coded.indices)] if len(table) else np.zeros(0, np.uint64)
    return hashes[real], np.bincount(np.asarray(parents)[real], minlength=len(texts))


def shingle_hashes(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    Fewer words than ``width`` make one shingle of the whole sequence; no words make none.
    """
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        rolled = mix(rolled * MIX + hashes[k : k + len(rolled)] + np.uint64(k))
    out = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= width:
            s = np.sort(rolled[end - n : end - width + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif n:
            h = np.uint64(n)
            for w in hashes[end - n : end]:
                h = mix(np.array([h], np.uint64) * MIX + w)[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
