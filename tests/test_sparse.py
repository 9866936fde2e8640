"""Linear models over words against a solver with dense vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinarium.functions.losses import cross_entropy
from opinarium.operators import sparse

WORDS = [f"w{i}" for i in range(12)]


@pytest.fixture(scope="module")
def bags(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(60):
        tokens = rng.choice(WORDS, rng.integers(1, 9)).tolist() if i else []
        rows.append((i, tokens, int(rng.integers(3)), rng.normal(size=3).tolist()))
    df = spark.createDataFrame(rows, "id int, tokens array<string>, y int, teacher array<double>")
    hot = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda c: (c == F.col("y")).cast("double"))
    return rows, df.withColumn("target", hot).cache()


def dense(rows):
    x = np.zeros((len(rows), len(WORDS)))
    for i, (_, tokens, _, _) in enumerate(rows):
        for t in tokens:
            x[i, WORDS.index(t)] += 1
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def solve(x, residual, classes, penalty):
    """Plain gradient descent to a far smaller slope."""
    w, b = np.zeros((x.shape[1], classes)), np.zeros(classes)
    for _ in range(20_000):
        r = residual(x @ w + b) / len(x)
        gw, gb = x.T @ r + penalty * w, r.sum(axis=0)
        if max(abs(gw).max(), abs(gb).max()) < 1e-11:
            break
        w, b = w - gw, b - gb
    return x @ w + b


def soft(s):
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def by_id(df):
    return np.array([r["scores"] for r in df.orderBy("id").collect()])


def check(bags, residual, dense_residual, classes):
    rows, df = bags
    cells = sparse.unit_cells(df, "id", "tokens").cache()
    model = sparse.fit(df, cells, "id", residual, classes, 0.2, tolerance=1e-8)
    assert model.slopes[-1] <= 1e-8 < model.slopes[0]
    expected = solve(dense(rows), dense_residual(rows), classes, 0.2)
    assert np.allclose(by_id(sparse.scored(df, cells, "id", model)), expected, atol=1e-5)
    slopes = sparse.slopes_at(df, cells, "id", residual, model, 0.2).collect()
    assert {r["word"] for r in slopes} == {None, *WORDS}
    assert all(abs(s) < 1e-5 for r in slopes for s in r["slopes"])
    return model


def test_several_classes(bags):
    check(bags, sparse.one_of(F.col("target")), lambda rows: lambda s: soft(s) - np.eye(3)[[r[2] for r in rows]], 3)


def test_all_positions_of_a_label_at_once(bags):
    labels = F.transform(F.col("target"), lambda t: 1.0 - t)
    dense_residual = lambda rows: lambda s: 1 / (1 + np.exp(-s)) - (1 - np.eye(3)[[r[2] for r in rows]])
    check(bags, sparse.each_of(labels), dense_residual, 3)


def test_two_targets(bags):
    other = F.reverse(F.col("target"))

    def dense_residual(rows):
        y = np.eye(3)[[r[2] for r in rows]]
        return lambda s: np.hstack([soft(s[:, :3]) - y, soft(s[:, 3:]) - y[:, ::-1]])

    check(bags, sparse.side_by_side([F.col("target"), other], 3), dense_residual, 6)


def test_temperature_reaches_the_student(bags):
    alpha = 0.7
    fits = {}
    for warmth in (1.0, 2.0):
        def dense_residual(rows, warmth=warmth):
            y, t = np.eye(3)[[r[2] for r in rows]], np.array([r[3] for r in rows])
            return lambda s: alpha * warmth * (soft(s / warmth) - soft(t / warmth)) + (1 - alpha) * (soft(s) - y)

        residual = sparse.taught(F.col("teacher"), F.col("target"), alpha, warmth)
        fits[warmth] = check(bags, residual, dense_residual, 3)
    assert not np.allclose(fits[1.0].bias, fits[2.0].bias, atol=1e-3)


def test_unknown_words_and_empty_tables(bags, spark):
    rows, df = bags
    cells = sparse.unit_cells(df, "id", "tokens")
    model = sparse.fit(df, cells, "id", sparse.one_of(F.col("target")), 3, 0.2, steps=3)
    new = spark.createDataFrame([(1, ["never seen"]), (2, None)], "id int, tokens array<string>")
    found = by_id(sparse.scored(new, sparse.unit_cells(new, "id", "tokens"), "id", model))
    assert np.allclose(found, [model.bias] * 2)
    none = df.limit(0)
    empty = sparse.fit(none, sparse.unit_cells(none, "id", "tokens"), "id", sparse.one_of(F.col("target")), 3, 0.2)
    assert empty.weights.count() == 0 and empty.bias == [0.0] * 3


def test_many_words(spark):
    """More words than a vector of Spark ML's counter would hold by default; none is dropped."""
    n = (1 << 18) + 1000
    words = spark.range(n).select((F.col("id") % 40).cast("int").alias("id"), F.concat(F.lit("w"), "id").alias("word"))
    cells = words.withColumn("value", F.lit(0.01)).cache()
    rows = spark.range(40).select(F.col("id").cast("int"), F.array((F.col("id") % 2).cast("double")).alias("target")).cache()
    model = sparse.fit(rows, cells, "id", sparse.each_of(F.col("target")), 1, 0.5, steps=4, tolerance=1e-4)
    assert model.weights.count() == n
    assert model.weights.where(F.col("w")[0] == 0).count() == 0


def test_epochs_against_a_dense_loop(bags):
    """Snapshots, losses and accuracy of every epoch; held-out rows take no part in a step."""
    rows, df = bags
    df = df.withColumn("label", F.col("y")).withColumn("held_out", F.col("id") % 5 == 0).cache()
    cells = sparse.unit_cells(df, "id", "tokens").cache()
    history, snapshots = sparse.train_epochs(
        df, cells, "id", sparse.one_of(F.col("target")), lambda s: cross_entropy(s, F.col("label")), 3,
        epochs=2, rate=0.8, batch=F.col("id") % 3, penalty=0.01,
    )
    x, y = dense(rows), np.array([r[2] for r in rows])
    ids, hot = np.arange(len(rows)), np.eye(3)[y]
    w, b = np.zeros((x.shape[1], 3)), np.zeros(3)
    lines = {r["epoch"]: r for r in history.collect()}
    for epoch in (1, 2):
        for part in range(3):
            own = (ids % 3 == part) & (ids % 5 != 0)
            r = (soft(x[own] @ w + b) - hot[own]) / own.sum()
            w, b = w - 0.8 * (x[own].T @ r + 0.01 * w), b - 0.8 * r.sum(axis=0)
        p = soft(x @ w + b)
        loss, held = -np.log(p[ids, y]), ids % 5 == 0
        assert lines[epoch]["train_loss"] == pytest.approx(loss[~held].mean())
        assert lines[epoch]["valid_loss"] == pytest.approx(loss[held].mean())
        assert lines[epoch]["valid_accuracy"] == pytest.approx((p.argmax(axis=1) == y)[held].mean())
        assert np.allclose(by_id(sparse.scored(df, cells, "id", snapshots[epoch - 1])), x @ w + b)


def refuse(*_, **__):
    raise AssertionError("cells are moved")


def test_steps_move_no_cells(bags, monkeypatch):
    """Cells are listed by row once; steps, scores and slopes read the lists and join nothing by word."""
    rows, df = bags
    cells = sparse.packed(sparse.unit_cells(df, "id", "tokens").cache(), "id", 3)
    assert cells.front == len(WORDS) and cells.rest is None
    assert {r["_ids"] is None for r in cells.lists.collect()} == {False}
    for name in ("_scores", "_gradient"):
        monkeypatch.setattr(sparse, name, refuse)
    residual = sparse.one_of(F.col("target"))
    model = sparse.fit(df, cells, "id", residual, 3, 0.2, tolerance=1e-5)
    expected = solve(dense(rows), lambda s: soft(s) - np.eye(3)[[r[2] for r in rows]], 3, 0.2)
    assert np.allclose(by_id(sparse.scored(df, cells, "id", model)), expected, atol=1e-3)
    slopes = sparse.slopes_at(df, cells, "id", residual, model, 0.2).collect()
    assert {r["word"] for r in slopes} == {None, *WORDS}
    assert all(abs(s) < 1e-2 for r in slopes for s in r["slopes"])


def test_rare_words_behind_the_front(bags, monkeypatch):
    """Words that the arrays have no room for are fitted as the others are."""
    rows, df = bags
    cells = sparse.unit_cells(df, "id", "tokens").cache()
    residual = sparse.one_of(F.col("target"))
    whole = sparse.fit(df, cells, "id", residual, 3, 0.2, tolerance=1e-5)
    monkeypatch.setattr(sparse, "NUMBERS", 15)
    parts = sparse.packed(cells, "id", 3)
    assert parts.front == 5 and parts.rest.select("word").distinct().count() == len(WORDS) - 5
    model = sparse.fit(df, parts, "id", residual, 3, 0.2, tolerance=1e-5)
    assert np.allclose(model.slopes, whole.slopes, atol=1e-9)
    assert np.allclose(by_id(sparse.scored(df, parts, "id", model)), by_id(sparse.scored(df, cells, "id", whole)))
    slopes = sparse.slopes_at(df, parts, "id", residual, model, 0.2).collect()
    docs = {r["word"]: r["n"] for r in cells.groupBy("word").agg(F.count("*").alias("n")).collect()}
    assert {r["word"]: r["docs"] for r in slopes} == {None: len(rows), **docs}
    assert all(abs(s) < 1e-2 for r in slopes for s in r["slopes"])


@pytest.mark.parametrize("numbers", [1 << 22, 2])
def test_repeated_null_and_missing_rows(spark, monkeypatch, numbers):
    """Copies of a key count each, rows without a target not at all; words of these only have no weight and no slope."""
    rows = spark.createDataFrame(
        [(1, ["a", "b"], [1.0, 0.0]), (1, ["a"], [0.0, 1.0]), (2, ["b", "c"], None), (3, ["c", "a"], [1.0, None]),
         (4, ["d"], None), (5, None, [0.0, 1.0]), (None, ["a", "e"], [1.0, 1.0])],
        "id int, tokens array<string>, target array<double>",
    ).cache()
    cells = sparse.unit_cells(rows, "id", "tokens").cache()
    assert {(r["id"], r["word"]) for r in cells.collect()} == {
        (1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "a"), (3, "c"), (4, "d")
    }
    residual = sparse.each_of(F.col("target"))
    monkeypatch.setattr(sparse, "NUMBERS", numbers)
    model = sparse.fit(rows, sparse.packed(cells, "id", 2), "id", residual, 2, 0.1, tolerance=1e-9)
    found = {r["word"]: r["w"] for r in model.weights.collect()}
    assert found["d"] == [None, None] and found["c"][1] is None and None not in found["a"] + found["b"]
    slopes = {r["word"]: r for r in sparse.slopes_at(rows, sparse.packed(cells, "id", 2), "id", residual, model, 0.1).collect()}
    assert {w: r["docs"] for w, r in slopes.items()} == {None: 7, "a": 2, "b": 2, "c": 2, "d": 1}
    assert slopes["d"]["slopes"] == [None, None] and slopes["c"]["slopes"][1] is None
    numbers = [s for r in slopes.values() for s in r["slopes"] if s is not None]
    assert len(numbers) == 7 and all(abs(s) < 1e-6 for s in numbers)
