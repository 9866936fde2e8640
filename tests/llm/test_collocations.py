"""Phrases against counting every n-gram, and summaries against their guarantee."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from opinarium.llm import collocations as C
from opinarium.llm import queries

from .samples import prose

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, threshold=30, top=2000, longest=4):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    wanted = {key: a for key, a in counts.items() if a >= threshold and len(key[1]) > 1}
    out = {}
    for (lang, words), a in wanted.items():
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]], k) for k in range(1, len(words))]
        score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for x, y, k in cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right, words))
    covered = {
        (lang, words[i : i + size])
        for (lang, words), a in wanted.items()
        for size in range(2, len(words))
        for i in range(len(words) - size + 1)
        if 100 * a >= 80 * counts[lang, words[i : i + size]]
    }
    rows = []
    for lang, found in out.items():
        kept = sorted(f for f in found if (lang, f[5]) not in covered)[:top]
        rows += [(lang, i, p.decode(), -a, x, y, totals[lang], -s) for i, (s, a, p, x, y, _) in enumerate(kept, 1)]
    return sorted(rows)


def found(spark, rows, **more):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    return sorted(map(tuple, C.collocations(docs, **more).collect()))


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(3)
    keys = np.concatenate([np.repeat(np.arange(20), 40), rng.integers(100, 3000, 9000)]).astype(np.uint64)
    rng.shuffle(keys)
    threshold = 30
    capacity = len(keys) // threshold + 1
    held, lost = (np.empty(0, np.uint64), np.empty(0, np.int64)), 0
    for part in np.array_split(keys, 23):
        *small, first = C.merge_summaries(*C._summed(part, np.ones(len(part), np.int64)), capacity)
        *held, second = C.merge_summaries(*(np.concatenate(x) for x in zip(held, small, strict=True)), capacity)
        lost += first + second
        assert len(held[0]) <= capacity
    assert 0 < lost < threshold
    true = Counter(keys.tolist())
    left = dict(zip(held[0].tolist(), held[1].tolist(), strict=True))
    assert all(left.get(k, 0) > 0 for k, n in true.items() if n >= threshold)
    assert all(left[k] <= true[k] <= left[k] + lost for k in left)


def test_packed_counts_come_back():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64))
    for most in (200, 1 << 20, 1 << 40):
        counts = np.arange(500) % 7 + 1
        counts[3] = most
        packed = C._keys(keys, 6).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : C.KEY_BYTES].tobytes()
        row = {"n": 500, "hashes": packed, "counts": counts.astype(C._width(counts)).tobytes()}
        found = C._unpacked(row)
        assert (found[0] == C._keys(keys, 6)).all() and (found[1] == counts).all()


def test_words_of_buffers():
    texts = ["The  cat\tsat. ON the Mat", "", None, " ", "x!y", "Éa éA\u0085b", "a" * 50]
    batch = pa.record_batch([pa.array(texts), pa.array(["en", "en", "de", "de", "fr", "fr", "fr"])], names=["t", "l"])
    for size in (1, 9, 1 << 20):
        seen = []
        for words, names in C.buffers(iter([batch]), size):
            spans = zip(words.starts, words.ends, words.lang, strict=True)
            seen += [(words.clean[a:b].tobytes().decode(), names[g]) for a, b, g in spans]
        assert seen == [("the", "en"), ("cat", "en"), ("sat", "en"), ("on the", "en"), ("mat", "en"),
                        ("x", "fr"), ("y", "fr"), ("Éa", "fr"), ("éa\u0085b", "fr"), ("a" * 50, "fr")]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(C.Words, "_hashes", lambda self, at, sizes, seeds: np.zeros(len(sizes), np.uint64))
    batch = pa.record_batch([pa.array(["a b a cc", "a b"]), pa.array(["en", "de"])], names=["t", "l"])
    (words, _), = C.buffers(iter([batch]))
    assert words.numbers().tolist() == [0, 1, 0, 2, 3, 4]


def test_equals_counting_all(spark):
    repeated = ["New York City is big, new york is. Old  York\tCity was", "a b c d e f; a b c d! b c d e", "the the the the"]
    rows = [(t, lang) for t in repeated for lang in ("en", None) for _ in range(9)] + [(None, "en"), ("", None), (prose(4, 300), "de")]
    assert found(spark, rows, threshold=5) == brute(rows, 5) != []
    assert found(spark, rows, threshold=9, top=3) == brute(rows, 9, 3)
    assert found(spark, rows, threshold=5, longest=2) == brute(rows, 5, longest=2)
    assert found(spark, rows, threshold=1) == brute(rows, 1)


def test_cuts_between_buffers_change_nothing(spark, monkeypatch):
    rows = [("one two three four. " * 50 + "five six " * 40, "en")] * 3
    expected = brute(rows)
    monkeypatch.setattr(C, "KEPT", 20)
    monkeypatch.setattr(C.buffers, "__defaults__", (100,))
    assert found(spark, rows) == expected != []


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("text", "lang").collect()]
    assert sorted(map(tuple, C.collocations(odd_docs, threshold=2).collect())) == brute(rows, 2)
    assert C.collocations(no_docs).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_equals_counting_all(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang").collect()]
    result = queries.QUERIES["op11_collocations"](spark, folder)
    assert [kind for _, kind in result.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    assert sorted(map(tuple, result.collect())) == brute(rows) != []
