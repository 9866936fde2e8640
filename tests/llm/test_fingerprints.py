"""Fingerprints: the edit and the neighbours exactly, the likeness against all shingles."""

import hashlib
import re

import pytest
from .samples import odd_rows, prose

from opinarium.llm import fingerprints


def words(text):
    return [w for w in re.split(r"\s+", text.lower(), flags=re.ASCII) if w]


def bag(text):
    own = words(text)
    return {tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1))}


def likeness(a, b):
    return len(bag(a) & bag(b)) / len(bag(a) | bag(b))


def expected(rows):
    """Per row in order: (doc_id, text, edited, next text)."""
    rows = [(i, t or "") for i, t in rows]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for (doc_id, text), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        cut = len(text) // 3
        out.append((doc_id, text, text[: len(text) - cut] + after[:cut], after))
    return out


def compare(found, rows):
    found = {(r["doc_id"], r["n_chars"], r["edited_sha256"]): r for r in found}
    wanted = expected(rows)
    assert len({(i, t) for i, t, _, _ in wanted}) == len({(i, t) for i, t in [(a, b or "") for a, b in rows]})
    for doc_id, text, edited, after in wanted:
        r = found[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()]
        assert len(r["fingerprint"]) == len(r["edited_fingerprint"]) == fingerprints.BINS
        assert r["near_edited"] == pytest.approx(likeness(text, edited), abs=0.2)
        assert r["near_next"] == pytest.approx(likeness(text, after), abs=0.2)
    return found


def test_given_documents(some_docs):
    rows = [(r["doc_id"], r["text"]) for r in some_docs.collect()]
    found = fingerprints.edited_neighbours(some_docs).collect()
    assert len(found) == len(rows)
    by = compare(found, rows)
    off = [r["near_edited"] - likeness(t, e) for i, t, e, _ in expected(rows)
           for r in [by[i, len(t), hashlib.sha256(e.encode()).hexdigest()]]]
    assert abs(sum(off) / len(off)) < 0.02


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 4)
    rows = [(i * i * 37, prose(i, i * 3)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    compare(fingerprints.edited_neighbours(docs).collect(), rows)


def spread(spark, rows, limit):
    """Rows per range, and that every row is followed by one other row, in one circle."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ranged, _ = fingerprints._with_ranges(docs)
    sizes = [r["count"] for r in ranged.groupBy(*fingerprints.RANGE).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 2 * limit
    found = fingerprints.edited_neighbours(docs).collect()
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("rows", [
    [*[(i, f"text number {i} of many") for i in range(400)], (2**62, "far away")],
    [(i if i % 3 else None, f"text number {i} of many") for i in range(400)],
    [(i if i % 3 else 77, f"text number {i} of many") for i in range(400)],
    [(i if i % 3 else None, f"text {i}" if i % 3 else "one text") for i in range(400)],
    [(2**62 + i, f"text number {i} of many") for i in range(300)],
])
def test_no_range_holds_far_more_than_others(spark, monkeypatch, rows):
    """One far id, a third NULL, one hot id, a third equal in all, ids beyond exact floating point."""
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 20)
    monkeypatch.setattr(fingerprints, "STEP", 4)
    found = spread(spark, rows, 20 if rows[0][0] != 2**62 else 256)
    texts = [t for _, t in rows]
    cut = {t: len(t) // 3 for t in texts}
    starts = {t[: cut[o]] for t in texts for o in texts[:3]}
    ends = {hashlib.sha256((t[: len(t) - cut[t]] + s).encode()).hexdigest() for t in texts for s in {o[: cut[t]] for o in texts}}
    assert starts and all(r["edited_sha256"] in ends for r in found)


@pytest.mark.parametrize("n", [1, 2])
def test_few_rows(spark, n):
    rows = [(i, prose(i, 30)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compare(fingerprints.edited_neighbours(docs).collect(), rows)


def test_odd_rows(odd_docs):
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] not in (11, 6, 7)]
    docs = odd_docs.where("doc_id is null or doc_id not in (11, 6, 7)")
    found = fingerprints.edited_neighbours(docs).collect()
    assert len(found) == len(rows)
    wanted = sorted(
        (i is not None, i or 0, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in expected(rows)
    )
    assert wanted == sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in found
    )


def test_equal_texts_and_long_texts(odd_docs):
    found = fingerprints.edited_neighbours(odd_docs).collect()
    by = {r["doc_id"]: r["fingerprint"] for r in found}
    assert by[6] == by[7] and by[3] == by[4] == by[2]
    assert by[6] != by[8]


def test_likeness_is_unbiased(spark):
    rows = []
    for i in range(80):
        own = prose(i, 300).split()
        rows.append((i, " ".join(own), " ".join(own[: 150 + i] + prose(1000 + i, 150 - i).split())))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
    found = df.select("a", "b", fingerprints.likeness("x", "y").alias("l")).collect()
    errors = [r["l"] - likeness(r["a"], r["b"]) for r in found]
    assert abs(sum(errors) / len(errors)) < 0.015
    assert max(map(abs, errors)) < 0.15


def test_short_texts_are_densified(spark):
    rows = [("a",), ("A ",), ("b",), ("a b c d e f",), ("a b c d e g",)]
    df = fingerprints.with_fingerprint(spark.createDataFrame(rows, "t string"), "t", "f")
    same = {r["t"]: r["f"] for r in df.collect()}
    assert same["a"] == same["A "] and same["a"] != same["b"]
    chance = sum(x == y for x, y in zip(same["a"], same["b"], strict=True))
    assert chance < 40  # one shingle fills all bins, digits agree by chance only
    pair = sum(x == y for x, y in zip(same["a b c d e f"], same["a b c d e g"], strict=True))
    assert 0.15 < pair / fingerprints.BINS < 0.55  # one of three shingles is shared


def test_empty_table(no_docs):
    assert fingerprints.edited_neighbours(no_docs).count() == 0


def test_no_python_in_the_plan(some_docs):
    plan = fingerprints.edited_neighbours(some_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
