"""Language identification of spans.

Every maximal run of letters is a word. Its score under a language is the sum of learned
log probabilities of its letter trigrams; the scripts of its letters narrow the languages that
may claim it. A Viterbi pass over the words of a text with a penalty for switching labels
spans; the language with most letters is the prediction.

NULL texts and texts without a letter are `und` with score 0. Ties go to the language
first in alphabetical order. Nothing is learned from rows without text, language or id. Repeated rows are labelled
each for itself, texts of any length whole; an empty table gives an empty result, and other columns are not
looked at, so their names cannot clash.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.llm.common import chunks, fold, ids_back, is_held_out, texts_with_ids
from opinarium.runtime import materialize

UNKNOWN = "und"
CHUNK_CHARS = 1 << 20

# First and last code point of the blocks of a script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
SCRIPT_NAMES = ["other", *SCRIPTS]

Tables = tuple[np.ndarray, np.ndarray, np.ndarray]


@functools.cache
def code_tables() -> Tables:
    """By code point: whether it is a letter, the number of its script, and its lower case, where that
    is one character too: letters are lowered one by one, so that none changes the places of others."""
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    scripts = np.zeros(0x110000, np.int8)
    for number, name in enumerate(SCRIPT_NAMES[1:], 1):
        for first, last in SCRIPTS[name]:
            scripts[first : last + 1] = number
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in map(chr, np.flatnonzero(letters).tolist()):
        if len(c.lower()) == 1:
            lower[ord(c)] = ord(c.lower())
    return letters, scripts, lower


@dataclass
class Words:
    """The words of some texts, neighbours in one array of characters."""

    start: np.ndarray  # place in its own text
    length: np.ndarray
    text: np.ndarray  # number of the text
    script: np.ndarray
    grams: np.ndarray  # all trigrams, word after word, each as one number
    first: np.ndarray  # place of a word's first trigram in `grams`


def find_words(texts: list[str], tables: Tables) -> Words:
    """All letter runs; a word of n letters, edges marked, has n trigrams."""
    is_letter, scripts, lower = tables
    joined = "\n".join([*texts, ""])
    chars = lower[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    letter = np.zeros(len(chars) + 2, bool)
    letter[1:-1] = is_letter[chars]
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    start, end = edges[0::2], edges[1::2]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    text = np.searchsorted(begins, start, side="right") - 1
    marked = np.where(letter[1:-1], chars, 0).astype(np.int64)
    padded = np.concatenate([[0], marked, [0]])
    places = np.flatnonzero(letter[1:-1])
    # a code point has 21 bits
    grams = padded[places] << 42 | padded[places + 1] << 21 | padded[places + 2]
    length = end - start
    first = np.concatenate([[0], np.cumsum(length)])[:-1]
    return Words(start - begins[text], length, text, scripts[chars[start]], grams, first)


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # the learned trigrams, ascending
    weights: np.ndarray  # log probabilities by trigram and language, the last row for all others
    allowed: np.ndarray  # scripts x languages

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """The row of each trigram in `weights`."""
        if not len(self.grams):
            return np.zeros(len(grams), np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, at, len(self.grams))


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word; `counts` words per text, texts one after another.

    All texts advance together, word by word, the longest texts last.
    """
    total, kinds = scores.shape
    order = np.argsort(-counts, kind="stable")
    begin = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    origin = np.empty((total, kinds), np.int16)
    best = np.zeros((len(counts), kinds), np.float32)
    labels = np.empty(total, np.int64)
    own = np.arange(kinds, dtype=np.int16)
    longest = int(sizes[0]) if len(sizes) else 0
    actives = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
    for step in range(longest):
        active = actives[step]
        word = begin[:active] + step
        if step:
            now = best[:active]
            top = now.argmax(axis=1)
            moved = now[np.arange(active), top] - penalty
            stay = now >= moved[:, None]
            origin[word] = np.where(stay, own, top[:, None])
            best[:active] = np.where(stay, now, moved[:, None])
        best[:active] += scores[word]
    state = best.argmax(axis=1)
    for step in range(longest - 1, -1, -1):
        active = actives[step]
        word = begin[:active] + step
        labels[word] = state[:active]
        if step:
            state[:active] = origin[word, state[:active]]
    return labels


class Identifier:
    def __init__(self, model: Model, tables: Tables, penalty: float):
        self.model, self.tables, self.penalty = model, tables, penalty

    def __call__(self, texts: list[str]) -> Iterator[tuple[str, float, list[tuple[int, int, str]]]]:
        """Language, share of its letters, and spans (start, end, language) of each text."""
        model, kinds = self.model, len(self.model.languages)
        words = find_words(texts, self.tables)
        n = len(words.start)
        counts = np.bincount(words.text, minlength=len(texts)) if n else np.zeros(len(texts), int)
        if n and kinds:
            scores = np.add.reduceat(model.weights[model.rows(words.grams)], words.first, axis=0)
            scores = np.where(model.allowed[words.script], scores, np.float32(-1e6))
            labels = viterbi(scores, counts, self.penalty)
        ends = np.cumsum(counts)
        for i in range(len(texts)):
            a, b = ends[i] - counts[i], ends[i]
            if a == b or not kinds:
                yield UNKNOWN, 0.0, []
                continue
            mine, start, length = labels[a:b], words.start[a:b], words.length[a:b]
            letters = np.bincount(mine, weights=length, minlength=kinds)
            top = int(letters.argmax())
            turns = np.concatenate([[0], np.flatnonzero(mine[1:] != mine[:-1]) + 1, [b - a]])
            spans = [
                (int(start[x]), int(start[y - 1] + length[y - 1]), model.languages[mine[x]])
                for x, y in zip(turns[:-1], turns[1:], strict=True)
            ]
            yield model.languages[top], float(letters[top] / letters.sum()), spans


def fit(docs: DataFrame, folds: int, held_out: int, sample_rows: int) -> Model:
    """Trigram log probabilities from about `sample_rows` documents at most.

    The model has every trigram of the sample, and so the size that the sample bounds.
    """
    usable = docs.where("text is not null and lang is not null and doc_id is not null")
    usable = usable.where(fold("doc_id", folds) != held_out)
    total = usable.count()
    if total > sample_rows:
        share = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) / 1e6
        usable = usable.where(share < sample_rows / total)

    tables = docs.sparkSession.sparkContext.broadcast(code_tables())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [len(t) for t in batch["text"]]
            for part in chunks(sizes, CHUNK_CHARS):
                rows = batch.iloc[part]
                for lang, group in rows.groupby("lang"):
                    words = find_words(list(group["text"]), tables.value)
                    if not len(words.start):
                        continue
                    seen, n = np.unique(words.grams, return_counts=True)
                    by_script = np.bincount(words.script, words.length, len(SCRIPT_NAMES))
                    keys = np.concatenate([seen, -1 - np.arange(len(SCRIPT_NAMES))])
                    values = np.concatenate([n, by_script.astype(np.int64)])
                    yield pd.DataFrame({"lang": lang, "gram": keys, "n": values})

    counted = usable.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    rows = materialize(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    table = rows.toPandas()
    languages = sorted(table["lang"].unique())
    number = {lang: i for i, lang in enumerate(languages)}
    scripts = np.zeros((len(SCRIPT_NAMES), len(languages)))
    where = table["lang"].map(number).to_numpy(np.int64)
    gram, n = (table[c].to_numpy(np.int64) for c in ("gram", "n"))
    is_gram = gram >= 0
    known, row = np.unique(gram[is_gram], return_inverse=True)
    counts = np.zeros((len(known) + 1, len(languages)))
    counts[row, where[is_gram]] = n[is_gram]
    scripts[-1 - gram[~is_gram], where[~is_gram]] = n[~is_gram]
    weights = np.log((counts + 0.5) / (counts.sum(axis=0, keepdims=True) + 0.5 * len(counts)))
    allowed = scripts > 1e-3 * np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, known, weights.astype(np.float32), allowed)


def label_spans(docs: DataFrame, model: Model, penalty: float = 12.0) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every document; places count characters from 0."""
    parts = model.languages, model.grams, model.weights, model.allowed, code_tables()
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        *made_of, tables = shared.value
        identify = Identifier(Model(*made_of), tables, penalty)
        for batch in batches:
            texts = batch["text"].fillna("")
            sizes = texts.str.len().to_numpy()
            order = np.argsort(sizes, kind="stable")
            texts, ids, sizes = texts.iloc[order].tolist(), batch["doc_id"].iloc[order], sizes[order]
            for part in chunks(sizes, CHUNK_CHARS):
                found = list(identify(texts[part]))
                yield pd.DataFrame(
                    {
                        "doc_id": ids.iloc[part].to_numpy(),
                        "lang_pred": [x[0] for x in found],
                        "score": [x[1] for x in found],
                        "spans": [
                            [{"start": a, "end": b, "lang": lang} for a, b, lang in x[2]] for x in found
                        ],
                    }
                )

    shape = (
        "doc_id string, lang_pred string, score double, "
        "spans array<struct<start: int, end: int, lang: string>>"
    )
    return ids_back(texts_with_ids(docs).mapInPandas(run, shape))


def identify(
    docs: DataFrame,
    folds: int = 4,
    held_out: int = 2,
    sample_rows: int = 8_000,
    penalty: float = 12.0,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans), learned outside fold `held_out` only."""
    labelled = label_spans(docs, fit(docs, folds, held_out, sample_rows), penalty)
    return labelled.select(
        "doc_id", is_held_out(folds, held_out).alias("held_out"), "lang_pred", "score", "spans"
    )
