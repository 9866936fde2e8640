"""Benchmark decontamination: pigeonhole edit matching.

Texts are compared as lower-case words with single blanks. An item of n characters may be
met with up to n / 20 edits (insertions, deletions, substitutions of a character). Cut into one piece more
than edits, at least one piece of it must occur unchanged; all pieces of all items
sit in one Aho-Corasick automaton that reads each document once. Around a hit, Myers'
bit-parallel distance decides whether the whole item is there.

Items travel to the workers in blocks of bounded size; documents are read once per block. NULL
and empty texts match nothing, and items without a word are never met. An item that repeats
another's text is reported as well. Repeated document rows are reported once each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.llm.common import ids_back, packed, texts_with_ids
from opinarium.runtime import broadcast_if_small, materialize

ERROR_SHARE = 0.05
BLOCK_CHARS = 4 << 20
WORD = re.compile(r"\w+")

HIT = "doc_id string, item_id long, distance int, end int, matches int"


def normal(text: str | None) -> str:
    """Lower-case words with single blanks, a blank on either side; "" without a word."""
    words = WORD.findall(text.lower()) if text else []
    return f" {' '.join(words)} " if words else ""


def split_pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(place, piece): `edits` + 1 pieces of nearly equal length that cover the item."""
    count = min(edits + 1, len(item))
    bounds = [len(item) * i // count for i in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class Myers:
    """Edit distance of a pattern to the best end in a text, a machine word per pattern."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.full, self.last = (1 << self.size) - 1, 1 << (self.size - 1)
        self.masks: dict[str, int] = {}
        for i, letter in enumerate(pattern):
            self.masks[letter] = self.masks.get(letter, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the closest substring; the first of equals."""
        plus, minus, score = self.full, 0, self.size
        best, end = score, 0
        masks, full, last = self.masks, self.full, self.last
        for i, letter in enumerate(text, 1):
            equal = masks.get(letter, 0)
            straight = equal | minus
            across = ((((equal & plus) + plus) & full) ^ plus) | equal
            up = minus | (full & ~(across | plus))
            down = plus & across
            if up & last:
                score += 1
            elif down & last:
                score -= 1
            up = (up << 1) & full
            down = (down << 1) & full
            plus = down | (full & ~(straight | up))
            minus = up & straight
            if score < best:
                best, end = score, i
        return best, end


class Matcher:
    """Finds items in normal texts within their budgets of edits."""

    def __init__(self, items: list[tuple[int, str]], error_share: float):
        import ahocorasick

        self.items = [(number, text) for number, text in items if text]
        self.edits = [int(len(text) * error_share) for _, text in self.items]
        self.myers: dict[int, Myers] = {}
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(self.items):
            for place, piece in split_pieces(text, self.edits[k]):
                where.setdefault(piece, []).append((k, place))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if where:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, end, matches) of each item found; the best match, the first of equals.

        Hits whose item would start at nearly the same place are verified together.
        """
        if not self.items or not text:
            return
        starts: dict[int, list[int]] = {}
        for end, (size, uses) in self.automaton.iter(text):
            begin = end + 1 - size
            for k, place in uses:
                starts.setdefault(k, []).append(begin - place)
        for k, begins in starts.items():
            number, item = self.items[k]
            edits, found = self.edits[k], []
            begins.sort()
            i = 0
            while i < len(begins):
                j = i
                while j + 1 < len(begins) and begins[j + 1] - begins[j] <= edits:
                    j += 1
                low = max(begins[i] - edits, 0)
                window = text[low : begins[j] + len(item) + edits]
                if item in window:
                    found.append((0, low + window.index(item) + len(item)))
                else:
                    if k not in self.myers:
                        self.myers[k] = Myers(item)
                    distance, end = self.myers[k].best(window)
                    if distance <= edits:
                        found.append((distance, low + end))
                i = j + 1
            if found:
                yield number, *min(found), len(found)


def _blocks(benchmark: DataFrame, block_chars: int) -> list[DataFrame]:
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = max(-(-chars // block_chars), 1)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [items.where(block == i) for i in range(count)]


def _hits(
    texts: DataFrame, benchmark: DataFrame, error_share: float, block_chars: int
) -> DataFrame:
    """The items met in each row of (doc_id string, text)."""
    context = texts.sparkSession.sparkContext
    found = []
    for block in _blocks(benchmark, block_chars):
        items = [(r["item_id"], normal(r["text"])) for r in block.collect()]
        shared = context.broadcast(items)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            match = Matcher(shared.value, error_share)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                    for item, distance, end, matches in match(normal(text)):
                        rows.append((doc_id, item, distance, end, matches))
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "end", "matches"])
                yield out.astype({"item_id": "Int64"})

        found.append(texts.mapInPandas(run, HIT))
    return reduce(DataFrame.unionByName, found)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    error_share: float = ERROR_SHARE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, distance, end, matches): the items met in each document.

    `end` counts characters of the normal text. A block of items holds about `block_chars` characters.
    """
    return ids_back(_hits(texts_with_ids(docs), benchmark, error_share, block_chars))


def keep_clean(docs: DataFrame, benchmark: DataFrame, error_share: float = ERROR_SHARE) -> DataFrame:
    """The documents in which no item is met, with their columns.

    Documents are told apart by their texts here, so ids may be missing or repeated.
    """
    key = F.md5(F.col("text").cast("binary"))
    texts = docs.select(key.alias("doc_id"), "text")
    hits = _hits(texts, benchmark, error_share, BLOCK_CHARS)
    leaks = hits.select(F.col("doc_id").alias("key")).distinct()
    leaks = broadcast_if_small(materialize(leaks, "leaks"))
    rows = packed(docs, "text").select("row", key.alias("key"))
    return rows.join(leaks, "key", "left_anti").select("row.*")
