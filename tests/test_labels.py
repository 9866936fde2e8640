import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinarium.functions import labels as lb
from opinarium.functions import losses
from opinarium.operators import scoring

VECTORS = [[0.1, 0.7, 0.7], [1.0, float("nan")], [3.0], None, [], [-1.0, -2.0]]


def test_argmax(column):
    assert column(lb.argmax, VECTORS, "array<double>") == [1, 1, 0, None, None, 0]


def test_softmax_and_sigmoid(column):
    rows = [[1.0, 2.0, 3.0], [1000.0, 1000.0], [-5.0, 0.0, 700.0]]
    for got, z in zip(column(lb.softmax, rows, "array<double>"), rows):
        e = np.exp(np.array(z) - max(z))
        assert np.allclose(got, e / e.sum())
    got = column(lb.sigmoid, [[0.0, 2.0]], "array<double>")[0]
    assert np.allclose(got, [0.5, 1 / (1 + math.exp(-2))])
    assert column(lambda c: lb.threshold(c), [[0.5, 0.49]], "array<double>") == [[1, 0]]
    shares = column(lb.class_probabilities, [[1.0, 1.0]], "array<double>")[0]
    assert shares == {0: pytest.approx(0.5), 1: pytest.approx(0.5)}


def test_one_hot_and_lists(column):
    assert column(lambda c: lb.one_hot(c, 3), [0, 2], "int") == [[1, 0, 0], [0, 0, 1]]
    texts = ["[1,0, 0,1]", "[0.0, 1.0]", "(1,0)", "[1,0,]", "", None, "[1,null]"]
    parsed = column(lb.parse_multi_hot, texts)
    assert parsed == [[1, 0, 0, 1], [0, 1], None, None, None, None, None]


def test_decode(column):
    names = ["a", "b"]
    got = column(lambda c: scoring.decode_label(c, names), [[0.1, 0.9], [0.0, 0.1, 0.2], None], "array<double>")
    assert got == ["b", None, None]


def test_names_to_ids(spark):
    names = scoring.label_table(spark, ["a", "b"])
    df = spark.createDataFrame([(1, "b"), (2, "x")], "id int, property string")
    got = {r["id"]: r["label_id"] for r in scoring.label_ids(df, names, "property").collect()}
    assert got == {1: 1, 2: None}


@pytest.fixture()
def scored(spark):
    draw = np.random.default_rng(3)
    s, t = draw.normal(size=(40, 5)), draw.normal(size=(40, 5))
    y = draw.integers(0, 5, 40)
    q, hot = 1 / (1 + np.exp(-s)), draw.integers(0, 2, (40, 5))
    q[0, 0], hot[0, 0] = 0.0, 1
    rows = [
        (i, int(y[i]), s[i].tolist(), t[i].tolist(), q[i].tolist(), hot[i].tolist()) for i in range(40)
    ]
    types = "id int, y int, s array<double>, t array<double>, q array<double>, hot array<int>"
    return spark.createDataFrame(rows, types), s, t, y, q, hot


def values(df, loss):
    return np.array([r[0] for r in df.orderBy("id").select(loss).collect()])


def log_softmax(z):
    return z - z.max(1, keepdims=True) - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True))


def test_losses_like_numpy(scored):
    df, s, t, y, q, hot = scored
    ce = -log_softmax(s)[np.arange(40), y]
    col = F.col
    assert np.allclose(values(df, losses.cross_entropy(col("s"), col("y"))), ce)
    assert np.allclose(values(df, losses.cross_entropy(lb.softmax(col("s")), col("y"), "probs")), ce)
    twice = -log_softmax(np.exp(log_softmax(s)))[np.arange(40), y]
    assert np.allclose(values(df, losses.cross_entropy(col("s"), col("y"), "probs_as_logits")), twice)
    with np.errstate(divide="ignore"):
        cells = -(hot * np.maximum(np.log(q), -100) + (1 - hot) * np.maximum(np.log(1 - q), -100))
    assert np.allclose(values(df, losses.binary_cross_entropy(col("q"), col("hot"))), cells.mean(1))
    lt, ls = log_softmax(t / 2), log_softmax(s / 2)
    kd = 0.3 * 4 * (np.exp(lt) * (lt - ls)).mean(1) + 0.7 * ce
    got = values(df, losses.distillation_loss(col("s"), col("t"), col("y"), 0.3, 2.0))
    assert np.allclose(got, kd)


def test_unknown_scale():
    with pytest.raises(ValueError):
        losses.cross_entropy(F.lit(1), F.lit(1), "other")
