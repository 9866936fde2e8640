"""Histogram boosting against trees grown by trying every split."""

import numpy as np
import pytest

from opinarium.operators import boosting, training

RATE, L2 = 0.3, 1.0


def data(seed, n=80, features=5):
    rng = np.random.default_rng(seed)
    x = rng.integers(-2, 4, (n, features)).astype(float)
    x[rng.random((n, features)) < 0.4] = 0.0
    y = ((x[:, 0] > 0).astype(int) + (x[:, 1] + x[:, 2] > 1).astype(int)).astype(int)
    return x, y, 1.0 + np.arange(n) % 2, rng.random(n) < 0.25


def frames(spark, x, y, weight, held):
    rows = spark.createDataFrame(
        [(i, int(y[i]), float(weight[i]), bool(held[i])) for i in range(len(y))], "id int, label int, weight double, held_out boolean"
    )
    cells = [(int(i), f"f{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)]
    return rows.cache(), spark.createDataFrame(cells, "id int, feature string, value double").cache()


def soft(m):
    e = np.exp(m - m.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def grow(x, g, h, depth):
    """Leaf values of the rows used and a function for all rows, by trying every border of every feature."""
    def build(mask, level):
        G, H = g[mask].sum(), h[mask].sum()
        best = None
        if level:
            for j in range(x.shape[1]):
                for border in sorted({0.0, *x[:, j]}):
                    low = mask & (x[:, j] <= border)
                    high = mask & ~low
                    gl, hl, gr, hr = g[low].sum(), h[low].sum(), g[high].sum(), h[high].sum()
                    if hl >= boosting.LEAST and hr >= boosting.LEAST:
                        gain = round(gl**2 / (hl + L2) + gr**2 / (hr + L2) - G**2 / (H + L2), 9)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = gain, j, border, low, high
        if best is None:
            return lambda z: np.full(len(z), -RATE * G / (H + L2))
        _, j, border, low, high = best
        left, right = build(low, level - 1), build(high, level - 1)
        return lambda z: np.where(z[:, j] <= border, left(z), right(z))

    return build(np.ones(len(g), bool), depth)


def brute(x, y, weight, held, rounds, depth, classes=3):
    margins, losses = np.zeros((len(y), classes)), []
    train = ~held
    for _ in range(rounds):
        p = soft(margins)
        step = []
        for k in range(classes):
            g, h = (p[:, k] - (y == k)) * weight, p[:, k] * (1 - p[:, k]) * weight
            step.append(grow(x[train], g[train], h[train], depth)(x))
        margins = margins + np.stack(step, axis=1)
        loss = -np.log(soft(margins)[np.arange(len(y)), y]) * weight
        losses.append(loss[held].sum() / weight[held].sum())
    return margins, losses


def margins_of(rows, cells, model):
    return np.array([r["margins"] for r in boosting.with_margins(rows, cells, "id", model).orderBy("id").collect()])


@pytest.mark.parametrize(("depth", "rounds"), [(1, 3), (3, 2)])
def test_equals_trying_every_split(spark, depth, rounds):
    table = data(depth)
    rows, cells = frames(spark, *table)
    model = boosting.boost(rows, cells, "id", 3, rounds, depth, RATE, L2)
    expected, losses = brute(*table, rounds, depth)
    assert np.allclose(margins_of(rows, cells, model), expected)
    assert np.allclose(model.losses, losses)


def test_goes_on_where_another_ended(spark):
    rows, cells = frames(spark, *data(5))
    whole = boosting.boost(rows, cells, "id", 3, 3, 2, RATE, L2)
    first = boosting.boost(rows, cells, "id", 3, 1, 2, RATE, L2)
    second = boosting.boost(rows, cells, "id", 3, 2, 2, RATE, L2, start=first)
    assert len(first.rounds) == 1 and len(second.rounds) == 3
    assert [[t.splits for t in trees] for trees in second.rounds] == [[t.splits for t in trees] for trees in whole.rounds]
    assert np.allclose(margins_of(rows, cells, second), margins_of(rows, cells, whole))


def test_stops_when_held_out_rows_get_worse(spark):
    x, y, weight, held = data(6)
    y = np.where(held, np.random.default_rng(1).integers(0, 3, len(y)), y)  # nothing to be learned for these
    rows, cells = frames(spark, x, y, weight, held)
    model = boosting.boost(rows, cells, "id", 3, 8, 2, 1.0, L2, patience=1)
    assert len(model.rounds) < 7
    assert model.losses == sorted(model.losses, reverse=True)


def test_few_bins_and_odd_tables(spark):
    x, y, weight, held = data(7, n=40)
    rows, cells = frames(spark, x + np.linspace(0.01, 0.02, 200).reshape(40, 5), y, weight, held)
    borders = {r["feature"]: r["borders"] for r in boosting.bin_borders(cells, 4).collect()}
    assert all(len(b) <= 6 and b == sorted(b) and 0.0 in b for b in borders.values())
    assert len(boosting.boost(rows, cells, "id", 3, 1, 2, RATE, L2, bins=4).rounds) == 1
    none = boosting.boost(rows, cells.limit(0), "id", 3, 1, 2, RATE, L2)  # no features: one leaf per class
    p = np.full(3, 1 / 3)
    train = ~held
    expected = [-RATE * ((p[k] - (y == k)) * weight)[train].sum() / ((2 / 9) * weight[train].sum() + L2) for k in range(3)]
    assert np.allclose(margins_of(rows, cells, none), [expected] * 40)
    empty = boosting.boost(rows.limit(0), cells.limit(0), "id", 3, 1, 2, RATE, L2)
    assert np.allclose(margins_of(rows, cells, empty), 0.0)


def bayes(counts, y, train, classes):
    """Log joint probabilities from dense counts; words without a training row count nothing."""
    known = (counts[train] > 0).any(axis=0)
    raw = []
    for k in range(classes):
        sums = counts[train & (y == k)].sum(axis=0)
        weights = np.log(sums + 1) - np.log(sums[known].sum() + known.sum())
        prior = np.log((train & (y == k)).sum() + 1) - np.log(train.sum() + classes)
        raw.append(prior + counts[:, known] @ weights[known])
    return np.stack(raw, axis=1)


def test_three_rounds_of_co_teaching_for_three_classes(spark):
    x, y, _, held = data(11)
    x = np.abs(x)
    rows = spark.createDataFrame([(i, int(y[i]), bool(held[i])) for i in range(len(y))], "id int, label int, held_out boolean")
    cells = [(int(i), f"f{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)]
    cells = spark.createDataFrame(cells, "id int, word string, value double")
    history, rounds = training.co_teach(rows.cache(), cells.cache(), "id", 3, trees=1, depth=1, learning_rate=RATE)
    shares, margins, train = np.full((len(y), 3), 1 / 3), np.zeros((len(y), 3)), ~held
    lines = {(r["epoch"], r["metric"]): r["value"] for r in history.collect()}
    for n, found in enumerate(rounds, 1):
        teacher = bayes(np.hstack([x, shares]), y, train, 3).argmax(axis=1)
        weight = np.where(teacher != y, 10.0, 1.0)
        p = soft(margins)
        step = []
        for k in range(3):
            g, h = (p[:, k] - (y == k)) * weight, p[:, k] * (1 - p[:, k]) * weight
            step.append(grow(x[train], g[train], h[train], 1)(x))
        margins = margins + np.stack(step, axis=1)
        shares = soft(margins)
        got = sorted(map(tuple, found.select("id", "teacher_pred", "weight", "student_pred").collect()))
        assert got == [(i, teacher[i], weight[i], margins[i].argmax()) for i in range(len(y))]
        assert lines[n, "student_valid_accuracy"] == pytest.approx((margins.argmax(axis=1) == y)[held].mean())
    assert len(rounds) == 3


def test_cells_are_binned_and_summed_once_for_all_rounds(spark, monkeypatch):
    x, y, _, held = data(12, n=30)
    rows = spark.createDataFrame([(i, int(y[i]), bool(held[i])) for i in range(len(y))], "id int, label int, held_out boolean")
    cells = [(int(i), f"f{j}", abs(float(x[i, j]))) for i, j in zip(*np.nonzero(x), strict=True)]
    cells = spark.createDataFrame(cells, "id int, word string, value double")
    calls = []
    for module, name in ((boosting, "binned"), (training, "cell_bayes")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real, name=name, **k: calls.append(name) or real(*a, **k))
    training.co_teach(rows.cache(), cells.cache(), "id", 3, rounds=2, trees=1, depth=1)
    assert sorted(calls) == ["binned", "cell_bayes"]


def test_calls_share_bins(spark):
    rows, cells = frames(spark, *data(13, n=40))
    shared = boosting.binned(cells, rows.where("not held_out"), "id")
    first = boosting.boost(rows, cells, "id", 3, 1, 1, RATE, L2, features=shared)
    second = boosting.boost(rows, cells, "id", 3, 1, 1, RATE, L2, start=first, features=shared)
    whole = boosting.boost(rows, cells, "id", 3, 2, 1, RATE, L2)
    assert [[t.splits for t in trees] for trees in second.rounds] == [[t.splits for t in trees] for trees in whole.rounds]
    # a row's cells are one row, whatever the number of features
    assert shared.rows.count() == cells.select("id").distinct().count()
