"""Hard negatives against all scores, and the bounds against exact products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinarium.llm import hard_negatives as H
from opinarium.llm import queries


def brute(rows):
    """All pairs of (vec_id, vector, label) rows, by long arithmetic."""
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(256 * x) for x in vector], label))
    out = []
    for anchor, a, label in kept:
        if anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v, strict=False)), i, own) for i, v, own in kept if i != anchor]
        scored.sort()
        for ps, positive, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and -80 * ps <= -100 * s[0] <= -100 * ps]
            for rank, (ns, negative, _) in enumerate(inside[:5], 1):
                out.append((anchor, positive, rank, negative, -ps, -ns))
    return sorted(out)


def mined(spark, rows, **more):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = H.mine(table.repartition(3), "embedding", F.col("label"), F.col("vec_id") % 100 == 0, **more)
    return sorted(map(tuple, found.collect()))


def some_rows(n, width, seed, spread=1.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        centre = random.Random(i % 7)
        vector = [centre.gauss(0, 1) + spread * rng.gauss(0, 1) for _ in range(width)]
        rows.append((10 * i, vector, rng.randrange(4)))
    return rows


def test_tree_is_a_minimum():
    vectors = np.random.default_rng(1).normal(size=(40, 5))
    order, parent, length = H.spanning_tree(vectors)
    assert sorted(order) == list(range(40)) and parent[order[0]] == -1
    seen = set()
    for i in order:
        assert parent[i] in seen or parent[i] == -1
        seen.add(i)
    edges = sorted((float(np.linalg.norm(vectors[a] - vectors[b])), a, b) for a in range(40) for b in range(a))
    group, total = list(range(40)), 0.0
    for away, a, b in edges:
        if group[a] != group[b]:
            total += away
            group = [group[a] if g == group[b] else g for g in group]
    assert length.sum() == pytest.approx(total)


def test_bounds_hold_and_save_scores():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16) * 300
    anchors = np.floor(centre + rng.normal(size=(30, 16)) * 3)
    candidates = np.floor(rng.normal(size=(500, 16)) * 300)
    order, parent, length = H.spanning_tree(anchors)
    product = H.Products(anchors, candidates)
    for i in order[1:]:
        apart = np.abs(product(i, slice(None)) - product(parent[i], slice(None)))
        assert (apart <= product.reach(length[i])).all()
    step_of = np.argsort(order)
    row = H._written(np.arange(30) * 100, np.zeros(30), anchors[order])
    row |= {"block": 1, "lengths": length[order].tobytes(),
            "parents": np.where(parent[order] < 0, -1, step_of[parent[order]]).astype("<i8").tobytes()}
    block = H.Block(row, H._open(row, True), True)
    scored = block.meet(np.arange(500) + 10_000, np.zeros(500, int), candidates)
    assert scored < 30 * 500 / 2
    for i, windows in enumerate(block.windows):
        exact = candidates @ anchors[order][i]
        assert windows[0].scores.tolist() == sorted(exact.astype(int).tolist(), reverse=True)[:5]


@pytest.mark.parametrize(("width", "spread"), [(1, 1.0), (3, 0.01), (8, 1.0)])
def test_equals_all_scores(spark, width, spread, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 4)
    rows = some_rows(120, width, width, spread)
    assert mined(spark, rows) == brute(rows) != []


def test_copies_ties_and_odd_rows(spark):
    hot = [0.5, -0.25, 1.0]
    rows = some_rows(60, 3, 9) + [(10_000 + 50 * i, hot, i % 2) for i in range(60)]
    rows += [(None, hot, 1), (300_000, None, 1), (300_100, [None, 1.0, 2.0], 1), (300_200, [math.nan, 1.0, 1.0], 0)]
    rows += [(300_300, [math.inf, 1.0, 1.0], 0), (300_400, hot, None), (300_500, [], 1), (300_600, [1.0], 1)]
    rows += [(300_700, [0.0, 0.0, 0.0], 0), (300_800, [-3.0, -3.0, -3.0], 2), (-100, hot, -5)]
    assert mined(spark, rows) == brute(rows)


def test_repeated_ids_take_part_each(spark):
    rows = some_rows(30, 2, 4)
    rows += rows[5:12]
    assert mined(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(50 * i, [1e5 * (i + 1), 3e4 - i, float(i % 3)], i % 2) for i in range(12)]
    assert mined(spark, rows) == brute(rows) != []


def test_beyond_a_long_does_not_fail(spark):
    rows = [(50 * i, [1e200 * (i + 1), -1e300], i % 2) for i in range(6)]
    assert all(abs(r[4]) <= 2**63 for r in mined(spark, rows))


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(7, [1.0], 1), (9, [1.0], 2)]) == []


def test_query_equals_all_scores(spark):
    folder = "/root/testdata/sf0.001"
    rows = [
        (i, None if v is None else list(v), (label + 1) % 10 if label is not None and i % 7 == 0 else label)
        for i, v, label in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    ]
    found = queries.QUERIES["op13_hard_negatives"](spark, folder)
    assert dict(found.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                  "positive_score": "bigint", "negative_score": "bigint"}
    assert sorted(map(tuple, found.collect())) == brute(rows) != []
