"""Packing: exact round trip of the pieces, bounds and best fit against brute force."""

import itertools
import zlib

import numpy as np
import pytest
from .samples import odd_rows, prose
from pyspark.sql import functions as F

from opinarium.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_vocabulary()[0])


def check(rows, packed, tokenizer, length=packing.LENGTH):
    """Every token of every document is in one place, and no two are in the same."""
    by_doc = {}
    for r in packed:
        by_doc.setdefault(r["doc_id"], []).append(r)
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(text)
    assert set(by_doc) == set(texts)
    for doc_id, own in texts.items():
        expected = []
        for text in own:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
            first = len(ids) % length or min(len(ids), length)
            bounds = [0, *range(first, len(ids), length), len(ids)]
            expected += [
                (i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                for i, (a, b) in enumerate(itertools.pairwise(bounds))
            ]
        found = [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc_id]]
        assert sorted(found) == sorted(expected)
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, size in sorted(places):
            assert offset == end
            end += size
        assert end <= length
    return len(sequences)


def test_given_documents(spark, tokenizer, some_docs):
    rows = [(r["doc_id"], r["text"]) for r in some_docs.collect()]
    packed = packing.pack(some_docs).collect()
    used = check(rows, packed, tokenizer)
    sizes = np.array([r["length"] for r in packed])
    bound = packing.lower_bound(sizes[sizes < packing.LENGTH]) + (sizes == packing.LENGTH).sum()
    assert bound <= used <= bound + 1


def test_odd_rows(odd_docs, tokenizer):
    rows = [(r[0], r[1]) for r in odd_rows()]
    check(rows, packing.pack(odd_docs).collect(), tokenizer)


def test_empty_table(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_many_groups_exchange_documents(spark, tokenizer):
    rows = [(i, prose(i, 3 + i * 7 % 200)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    apart = packing.pack(docs, group_rows=20, rounds=0).collect()
    packed = packing.pack(docs, group_rows=20).collect()
    used, before = check(rows, packed, tokenizer), check(rows, apart, tokenizer)
    sizes = np.array([r["length"] for r in packed])
    assert packing.lower_bound(sizes) <= used <= before


def test_cut_leaves_only_the_first_piece_short():
    for total in range(1, 40):
        parts = packing.cut(total, 8)
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) == total
        assert all(n == 8 for _, n in parts[1:]) and 1 <= parts[0][1] <= 8


def fewest(sizes, length):
    """The least number of bins by trying all ways."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best and i < len(sizes):
            return
        if i == len(sizes):
            best = min(best, len(bins))
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= length:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_bounds_and_best_fit_against_all_ways():
    rng = np.random.default_rng(2)
    for _ in range(60):
        sizes = rng.integers(1, 21, rng.integers(1, 9))
        place, offset = packing.best_fit(sizes, 20)
        bins = place.max() + 1
        optimum = fewest(sizes.tolist(), 20)
        assert packing.lower_bound(sizes, 20) <= optimum <= bins <= optimum * 1.5 + 1
        for k in range(bins):
            mine = sorted(zip(offset[place == k], sizes[place == k], strict=True))
            assert [a for a, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))]
            assert sum(n for _, n in mine) <= 20


def test_best_fit_takes_the_tightest_sequence():
    sizes = np.array([7, 6, 3, 3, 1])
    place, _ = packing.best_fit(sizes, 10)
    assert place.tolist() == [0, 1, 0, 1, 1]


def test_both_tokenizers_agree(tokenizer, some_docs):
    encode = packing.Encoder(*packing.default_vocabulary())
    texts = [r["text"] for r in some_docs.select("text").collect()] + [r[1] or "" for r in odd_rows()]
    texts += ["\t\n  x  \n\n", "ÀÖØöøÿƿ x’s", "don't I'LL 12345678901 \u3000 a\u200bb", "a" * 5000]
    for text in texts:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_equal_rows_are_packed_apart(spark, tokenizer):
    rows = [(1, "the same row")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert check(rows, packing.pack(docs).collect(), tokenizer) == 1
    assert docs.select(F.count("*")).first()[0] == 50


def test_ids_of_added_tokens_in_texts(spark, tokenizer):
    """The vocabulary's own token at the start, in the middle, at the end, doubled, broken and beside other scripts."""
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", f"{mark}start", f"end{mark}", f"x{mark}{mark}y", "<|endoftext", f"日本 {mark} é", "<| endoftext |>"]
    encode = packing.Encoder(*packing.default_vocabulary())
    for text in texts:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert encode(texts[0]).tolist() == [64, 220, 50256, 275]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(list(enumerate(texts)), packing.pack(docs).collect(), tokenizer)
