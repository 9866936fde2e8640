"""BagMinHash classes against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from .samples import prose

from opinarium.llm import near_duplicates as near
from opinarium.llm.shingles import shingles, word_characters

TABLE = word_characters()


def bag(text):
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def likeness(a, b):
    shared, total = sum((a & b).values()), sum((a | b).values())
    return shared / total if total else 0.0


def brute_classes(rows):
    """{row number: smallest id of its class}, links by equal text or overlap of 0.8."""
    bags = [bag(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if a is None or b is None:
                continue
            if a == b or likeness(bags[i], bags[j]) >= 0.8:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    return {i: min(members[find(i)]) for i in range(len(rows))}


def test_shingles_are_multisets():
    texts = ["a b c d e f", "", "a A a a a a a", "one two", "..."]
    found = shingles(texts, TABLE)
    for i, text in enumerate(texts):
        ids, counts = found.of(i)
        expected = bag(text)
        assert sorted(counts.tolist()) == sorted(expected.values())
        assert len(set(ids.tolist())) == len(expected)
        assert found.totals[i] == sum(expected.values())
    assert shingles(["x y", "Y x", "X  Y"], TABLE).ids.tolist()[0] == shingles(["x y"], TABLE).ids[0]


def test_signatures_estimate_weighted_similarity():
    """Unbiased over many pairs: counts differ, sets do not."""
    errors = []
    for seed in range(60):
        line = prose(seed, 30)
        a, b = " ".join([line] * 4), " ".join([line] * 7)
        one, two = (np.frombuffer(s, np.uint32) for s in near.signatures([a, b], TABLE))
        errors.append((one == two).mean() - likeness(bag(a), bag(b)))
    assert abs(np.mean(errors)) < 0.02
    assert max(map(abs, errors)) < 0.2


def test_signatures_do_not_depend_on_the_batch():
    texts = [prose(i, 5 + 40 * i) for i in range(12)] + ["", "word", "one one " * 900]
    together = near.signatures(texts, TABLE)
    assert together == [near.signatures([t], TABLE)[0] for t in texts]
    assert together[12] is None and all(together[i] for i in range(12))


def test_classes_against_all_pairs(spark):
    rows, n = [], 0
    for seed in range(25):
        words = prose(seed, 60 + 20 * seed).split()
        for copy in range(seed % 6):
            changed = list(words)
            for k in range(copy):
                changed[(7 + 31 * k) % len(changed)] = f"new{copy}x{k}"
            rows.append((n, " ".join(changed)))
            n += 1
    rows += [(900, ""), (901, ""), (902, None), (903, None), (904, "..."), (905, "one"), (906, "One!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(docs).collect()}
    expected = brute_classes(rows)
    assert found == {rows[i][0]: c for i, c in expected.items()}


def test_a_chain_of_near_copies_is_one_class(spark):
    """Neighbours are alike, the ends are not; a common band alone must not decide."""
    base = prose(77, 400).split()
    rows = []
    for step in range(30):
        words = list(base)
        for k in range(step):
            words[(k * 13) % 400] = f"step{k}"
        rows.append((step, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(docs).collect()}
    assert found == {rows[i][0]: c for i, c in brute_classes(rows).items()}


def test_large_buckets_are_compared_by_blocks(spark, monkeypatch):
    """A family of texts with different numbers of edits: some are alike, many are not quite."""
    monkeypatch.setattr(near, "LISTED_BUCKET", 8)
    monkeypatch.setattr(near, "BLOCK", 16)
    rng = random.Random(3)
    base, rows = prose(9, 150).split(), []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(12)):
            words[rng.randrange(150)] = f"edit{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(docs).collect()}
    expected = brute_classes(rows)
    assert found == expected and len(set(expected.values())) > 5


def test_overlaps_of_two_sides():
    texts = ["a a a b a a a b c", "a a a a a a", "", "x y z x y z x y z", "b a a a b", "x y z x y z"]
    left, right = shingles(texts[:3], TABLE), shingles(texts[3:], TABLE)
    found = near._overlaps(left, right)
    for i in range(3):
        for j in range(3):
            assert found[i, j] == pytest.approx(likeness(bag(texts[i]), bag(texts[3 + j])))


def test_given_documents_against_all_pairs(spark, some_docs):
    rows = [(r["doc_id"], r["text"]) for r in some_docs.collect()]
    found = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(some_docs).collect()}
    assert found == {rows[i][0]: c for i, c in brute_classes(rows).items()}


def test_components_of_long_paths(spark):
    links = [(bytes([i]), bytes([i + 1])) for i in range(1, 40) if i != 20] + [(b"\x05", b"\x02")]
    df = spark.createDataFrame(links, "a binary, b binary")
    parts = {bytes(r["key"]): bytes(r["part"]) for r in near.components(df).collect()}
    assert parts == {bytes([i]): b"\x01" if i <= 20 else bytes([21]) for i in range(1, 41)}


def test_odd_rows(odd_docs):
    rows = near.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["class_id"], r["class_size"]))
    assert by[1] == [(1, 2), (1, 2)]
    assert by[2] == [(2, 1)]
    assert by[3] == by[4] == [(3, 2)]
    assert by[6] == by[7] == [(6, 2)]
    assert sorted(by[10]) == [(10, 1), (10, 1)]


def test_one_row_of_each_class_stays(odd_docs):
    kept = near.keep_one(odd_docs)
    assert kept.schema == odd_docs.schema
    ids = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    counted = Counter(i for some, i, _ in ids if some)
    assert counted == {1: 1, 2: 1, 3: 1, 5: 1, 6: 1, 8: 1, 9: 1, 10: 2, 11: 1, 2**62 + 1: 1, 2**63 - 1: 1, -(2**63): 1}
    assert sum(not some for some, _, _ in ids) == 2


def test_empty_table(no_docs):
    assert near.near_duplicates(no_docs).count() == 0
    assert near.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("copies", [300])
def test_a_large_group_costs_rows_in_proportion(spark, copies):
    """Pairs compared stay near the number of band members, far below all pairs."""
    base = prose(5, 300).split()
    rows = []
    for i in range(copies):
        words = list(base)
        words[(i * 7) % 300] = f"copy{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    search = near._Search(docs, near.THRESHOLD)
    classes = search.classes()
    assert classes.select("class_id").distinct().count() == 1
    assert search.tested.count() < 10 * copies


def test_one_asked_member_repeats_no_other(spark):
    n = 4 * near.BLOCK
    rows = [(1, i.to_bytes(4, "big"), b"a" if i else b"b", n) for i in range(n)]
    placed = spark.createDataFrame(rows, "band long, key binary, part binary, n long")
    found = near._dealt(placed).groupBy("asked").count().collect()
    assert {r["asked"]: r["count"] for r in found} == {True: 4, False: n}
