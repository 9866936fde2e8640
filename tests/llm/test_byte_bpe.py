"""Byte-level BPE against the rank library, and decoding against the texts."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from opinarium.llm import byte_bpe, queries

PATH, PATTERN = byte_bpe.default_vocabulary()


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(*byte_bpe.Codec.parts(PATH, PATTERN))


@pytest.fixture(scope="module")
def library():
    ranks = {token: i for i, token in enumerate(byte_bpe.load_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def decoded(codec, *lists):
    ids = np.array([i for ids in lists for i in ids], np.int64)
    return codec.decode(ids, np.array([len(ids) for ids in lists], np.int64)).to_pylist()


def test_perfect_hash_fills_every_slot():
    for n in (1, 2, 3, 10, 1000):
        keys = [f"key {i}".encode() for i in range(n)]
        table = byte_bpe.PerfectHash.build(keys)
        assert sorted(table.slot(key) for key in keys) == list(range(n))
    with pytest.raises(ValueError):
        byte_bpe.PerfectHash.build([b"a", b"a"])


def test_whole_vocabulary_is_found(codec):
    tokens = byte_bpe.load_ranks(PATH)
    assert [codec.find(token) for token in tokens] == list(range(len(tokens)))
    assert codec.find(b"no token is like this") == -1


def test_merges_equal_the_library(codec, library):
    rng = random.Random(5)
    for _ in range(400):
        piece = "".join(rng.choices("aabbcdeeeinorstth", k=rng.randint(1, 80)))
        assert codec.merge(piece.encode()) == library.encode_ordinary(piece)


def test_all_characters_are_cut_as_the_library_cuts(codec, library):
    """Every code point, next to a letter, a digit, a sign, blanks and an apostrophe."""
    # no version of Unicode has letters, digits or blanks in the planes left out
    points = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x40000)])]
    for before, behind in (("x", " 1"), ("1", "y!")):
        for start in range(0, len(points), 64):
            text = "".join(f"{before}{c}{behind}" for c in points[start : start + 64])
            assert codec.encode(text).tolist() == library.encode_ordinary(text), hex(ord(points[start]))


def test_texts_with_odd_signs(codec, library):
    texts = ["", " ", "\n\n  \t", "I'll we'RE 's", "<|endoftext|> a<|endoftext|>", "a" * 30_000, "é" * 5_000,
             "\u0000\u001c\u0085 ", "x" + " " * 3_000 + "y", "\U0003d000letters of a newer version࢏1"]
    for text in texts:
        ids = codec.encode(text).tolist()
        assert ids == library.encode_ordinary(text)
        assert decoded(codec, ids) == [text.encode()]


def test_ids_outside_the_vocabulary(codec):
    assert decoded(codec, [], [1, 2], [-1], [3, 10**6, 4], [5], []) == [b"", b'"#', None, None, b"&", b""]
    assert decoded(codec) == []


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    found = queries.QUERIES["op12_byte_bpe"](spark, folder)
    assert found.dtypes[:2] == [("doc_id", "bigint"), ("n_tokens", "bigint")]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_odd_rows(spark, odd_docs, no_docs, library):
    rows = byte_bpe.decode(byte_bpe.encode(odd_docs)).collect()
    texts = sorted(((d, t or "") for d, t in odd_docs.select("doc_id", "text").collect()), key=str)
    found = sorted(((r["doc_id"], bytes(r["bytes"]).decode()) for r in rows), key=str)
    assert found == texts
    assert all(r["ids"] == library.encode_ordinary(bytes(r["bytes"]).decode()) for r in rows)
    assert byte_bpe.decode(byte_bpe.encode(no_docs)).count() == 0
    lists = spark.createDataFrame([(1, None, "x"), (None, [], "y"), (2, [5, None], "z")], "doc_id long, ids array<int>, bytes string")
    assert [r["bytes"] for r in byte_bpe.decode(lists).orderBy(F.col("doc_id").asc_nulls_first()).collect()] == [b"", None, None]
