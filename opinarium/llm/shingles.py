"""Hashes of words and of runs of words, for many texts at once."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

SHINGLE_WORDS = 5
ID_BITS = 48
# Texts of one call; their numbers share a 64-bit sort key with the shingle ids.
MAX_TEXTS = 1 << (64 - ID_BITS)


@functools.cache
def word_characters() -> np.ndarray:
    """By code point: whether it belongs to a word (letters, digits, underscore)."""
    table = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    table[ord("_")] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-case words in order, and the number of words of each text."""
    lowered = [t.lower() for t in texts]
    chars = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(chars) + 2, bool)
    inside[1:-1] = table[chars]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    places = np.flatnonzero(inside[1:-1])
    length = end - start
    first = np.cumsum(length) - length
    offset = np.arange(len(places)) - np.repeat(first, length)
    value = chars[places].astype(np.uint64) | (offset.astype(np.uint64) << np.uint64(21))
    hashes = mix(np.add.reduceat(mix(value + np.uint64(0x9E3779B97F4A7C15)), first))
    begins = np.cumsum([0] + [len(t) + 1 for t in lowered])
    return hashes, np.diff(np.searchsorted(start, begins))


@dataclass
class Shingles:
    """Distinct shingles of some texts, ordered by text and id, with their counts."""

    text: np.ndarray
    ids: np.ndarray
    count: np.ndarray
    totals: np.ndarray  # shingles of each text, repetitions counted

    def of(self, text: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(*np.searchsorted(self.text, [text, text + 1]))
        return self.ids[part], self.count[part]


def shingles(texts: list[str], table: np.ndarray, words: int = SHINGLE_WORDS) -> Shingles:
    """Runs of `words` words; a text of fewer words but at least one is one shingle."""
    if len(texts) > MAX_TEXTS:
        raise ValueError(f"at most {MAX_TEXTS} texts at once")
    hashes, n = word_hashes(texts, table)
    runs = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
    text = np.repeat(np.arange(len(texts)), runs)
    begin = np.cumsum(n) - n
    place = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    first, size = begin[text] + place, np.minimum(n, words)[text]
    total = np.zeros(len(text), np.uint64)
    for k in range(words):
        factor = mix(np.array([k + 1], np.uint64))[0] | np.uint64(1)
        has = size > k
        total[has] += hashes[first[has] + k] * factor
    ids = mix(total + size.astype(np.uint64)) >> np.uint64(64 - ID_BITS)
    keys = np.sort((text.astype(np.uint64) << np.uint64(ID_BITS)) | ids)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    new = np.asarray(new, np.int64)
    distinct = keys[new]
    return Shingles(
        (distinct >> np.uint64(ID_BITS)).astype(np.int64),
        distinct & np.uint64((1 << ID_BITS) - 1),
        np.diff(np.append(new, len(keys))),
        runs,
    )
