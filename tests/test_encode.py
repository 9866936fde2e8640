from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinarium.functions.text import words
from opinarium.operators import encode as enc
from opinarium.operators import features

SETTINGS = settings(
    max_examples=6, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def test_vocabulary(spark):
    texts = ["b a b", "c a", "", "b d"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["token"]: (r["occurrences"], r["id"]) for r in enc.build_vocabulary(df, words(F.col("text"))).collect()}
    counted = Counter(" ".join(texts).split())
    order = sorted(counted, key=lambda w: (-counted[w], w))
    assert got == {w: (counted[w], i + enc.RESERVED) for i, w in enumerate(order)}


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(["a", "b", "zz", "?"]), max_size=9), min_size=1, max_size=12))
def test_encode_like_a_loop(spark, lists):
    ids = {"a": 4, "b": 5}
    vocabulary = spark.createDataFrame(list(ids.items()), "token string, id long")
    df = spark.createDataFrame(list(enumerate(lists)), "id int, t array<string>")
    got = enc.encode(df, vocabulary, F.col("t"), "id", 6)
    for row in got.collect():
        real = [2, *[ids.get(t, 1) for t in lists[row["id"]][:4]], 3]
        assert row["input_ids"] == real + [0] * (6 - len(real))
        assert row["attention_mask"] == [1] * len(real) + [0] * (6 - len(real))
    assert got.count() == len(lists)


def cut_pair(a, b, room):
    while len(a) + len(b) > room:
        if len(a) > len(b):
            a = a[:-1]
        else:
            b = b[:-1]
    return a, b


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=10))
def test_encode_pair_like_a_loop(spark, sizes):
    vocabulary = spark.createDataFrame([("x", 7), ("yy", 8)], "token string, id long")
    rows = [(i, " ".join(["x"] * a), " ".join(["yy"] * b)) for i, (a, b) in enumerate(sizes)]
    df = spark.createDataFrame(rows, "id int, q string, a string")
    side = lambda c: (F.col(c), F.array_remove(F.split(c, " "), ""))
    got = {r["id"]: r for r in enc.encode_pair(df, vocabulary, side("q"), side("a"), "id", 12).collect()}
    assert len(got) == len(rows)
    for i, q, a in rows:
        qa, aa = cut_pair(q.split(), a.split(), 9)
        ids = [2, *[7] * len(qa), 3, *[8] * len(aa), 3]
        pad = [0] * (12 - len(ids))
        row = got[i]
        assert row["input_ids"] == ids + pad
        assert row["segment_ids"] == [0] * (len(qa) + 2) + [1] * (len(aa) + 1) + pad
        assert row["attention_mask"] == [1] * len(ids) + pad
        spans = [(s["start"], s["end"]) for s in row["offsets"]]
        assert spans[1 : 1 + len(qa)] == [(2 * k, 2 * k + 1) for k in range(len(qa))]
        assert spans[len(qa) + 2 : len(qa) + 2 + len(aa)] == [(3 * k, 3 * k + 2) for k in range(len(aa))]
        assert len(spans) == 12


def test_counts_stay_per_row(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["c"]), (3, []), (4, ["d"])], "id int, tokens array<string>")
    known = features.vocabulary(df.where("id < 3"), "tokens")
    for binary, value in ((False, 2.0), (True, 1.0)):
        cells = features.word_counts(df, "id", "tokens", known, binary)
        assert sorted(tuple(r) for r in cells.collect()) == [(1, "a", value), (1, "b", 1.0), (2, "c", 1.0)]


def test_a_vector_has_the_width_its_caller_gives(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b", "a"])], "id int, tokens array<string>")
    assert features.fit_word_counts(df, "tokens", "f", 1).vocabulary == ["a"]
    assert features.hashed_counts("tokens", "f", 8).transform(df).first()["f"].size == 8


def test_two_rows_of_one_key(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["b"])], "id int, w array<string>")
    vocabulary = spark.createDataFrame([("a", 4), ("b", 5)], "token string, id int")
    with pytest.raises(Exception, match="one key"):
        enc.look_up(df, vocabulary, ["w"], "id").collect()
