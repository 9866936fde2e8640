import random

import pytest
from pyspark.sql import functions as F

from opinarium.operators import evaluate
from opinarium.sinks.files import best_and_last


def rows_of(df):
    return {r["class"]: tuple(r)[1:] for r in df.collect()}


def test_report_by_hand(spark):
    # class 2 is predicted but never true, class 1 true but never predicted
    data = [(0, 0), (0, 0), (0, 2), (1, 0)]
    df = spark.createDataFrame(data, "label int, pred int")
    got = rows_of(evaluate.class_report(df))
    assert got["0"] == (0.6667, 0.6667, 0.6667, 3)
    assert got["1"] == (0.0, 0.0, 0.0, 1)
    assert got["2"] == (0.0, 0.0, 0.0, 0)
    assert got["macro avg"] == (0.2222, 0.2222, 0.2222, 4)
    assert got["weighted avg"] == (0.5, 0.5, 0.5, 4)
    assert got["micro avg"] == (0.5, 0.5, 0.5, 4)
    named = rows_of(evaluate.class_report(df, names={0: "none", 7: "seven"}))
    assert "none" in named and "0" not in named and "1" in named
    assert evaluate.accuracy(df).first()[0] == 0.5
    assert evaluate.class_count(df).first()[0] == 2


def test_confusion_keeps_empty_rows_and_columns(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 0)], "label int, pred int")
    cells = {(r["label"], r["pred"]): r["n"] for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {
        (0, 0): 1, (0, 1): 0, (0, 2): 1, (1, 0): 1, (1, 1): 0, (1, 2): 0,
        (2, 0): 0, (2, 1): 0, (2, 2): 0,
    }
    wide = {r["label"]: tuple(r)[1:] for r in evaluate.confusion_wide(df, [0, 1, 2]).collect()}
    assert wide == {0: (1, 0, 1), 1: (1, 0, 0)}


def test_row_sums_are_support(spark):
    draw = random.Random(4)
    data = [(draw.randrange(4), draw.randrange(5)) for _ in range(300)]
    df = spark.createDataFrame(data, "label int, pred int")
    sums = {
        str(r["label"]): r["n"]
        for r in evaluate.confusion_matrix(df).groupBy("label").agg(F.sum("n").alias("n")).collect()
    }
    report = rows_of(evaluate.class_report(df))
    assert sums == {c: report[c][3] for c in sums}


def test_failed_predictions_are_wrong_and_no_class(spark):
    data = [(0, 0), (1, 1), (0, None), (1, None), (None, 0)]
    df = spark.createDataFrame(data, "label int, pred int")
    assert evaluate.accuracy(df).first()[0] == 0.5
    got = rows_of(evaluate.class_report(df))
    assert got["0"] == got["1"] == (1.0, 0.5, 0.6667, 2)
    assert got["micro avg"] == (1.0, 0.5, 0.6667, 4)
    assert set(got) == {"0", "1", "macro avg", "weighted avg", "micro avg"}
    cells = {(r["label"], r["pred"]): r["n"] for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 0, (1, 1): 1, (0, None): 1, (1, None): 1}
    sparse = {(r["label"], r["pred"]): r["n"] for r in evaluate.pair_counts(df).collect()}
    assert sparse == {k: n for k, n in cells.items() if n}


def test_matrix_of_many_classes(spark):
    df = spark.range(4000).select((F.col("id") % 2000).alias("label"), (F.col("id") * 7 % 2000).alias("pred"))
    matrix = evaluate.confusion_matrix(df)
    assert matrix.agg(F.count("*"), F.sum("n")).first() == (2000 * 2000, 4000)


def test_failed_multi_label_rows_are_all_zero(spark):
    data = [([1, 0], [1, 0]), ([1, 1], None)]
    df = spark.createDataFrame(data, "y array<int>, p array<int>")
    got = rows_of(evaluate.multi_label_report(df, "y", "p"))
    assert got["0"] == (1.0, 0.5, 0.6667, 2) and got["1"] == (0.0, 0.0, 0.0, 1)
    share = evaluate.cell_accuracy(df, "y", "p").first()
    assert share["cell_accuracy"] == 0.5 and share["row_accuracy"] == 0.5


def test_multi_label(spark):
    data = [([1, 0, 1], [1, 1, 1]), ([0, 0, 0], [0, 0, 0]), ([1, 0, 0], [0, 0, 0])]
    df = spark.createDataFrame(data, "y array<int>, p array<int>")
    got = rows_of(evaluate.multi_label_report(df, "y", "p"))
    assert got["0"] == (1.0, 0.5, 0.6667, 2)
    assert got["1"] == (0.0, 0.0, 0.0, 0)
    assert got["micro avg"] == (0.6667, 0.6667, 0.6667, 3)
    assert got["samples avg"] == (0.2222, 0.3333, 0.2667, 3)
    share = evaluate.cell_accuracy(df, "y", "p").first()
    assert share["cell_accuracy"] == pytest.approx(7 / 9)
    assert share["row_accuracy"] == pytest.approx((2 / 3 + 1 + 2 / 3) / 3)
    assert tuple(evaluate.label_width(df, "y").first()) == (3, True)


def test_batch_means_weigh_the_short_batch_fully(spark):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate([0, 0, 0, 0, 9])], "id int, x double")
    got = evaluate.batch_means(df.repartition(3), ["id"], 2, {"x": F.col("x")}).first()
    assert tuple(got) == (3, 3.0)


def test_best_metric_ties_go_to_the_later_epoch(spark):
    df = spark.createDataFrame([(1, 0.5, 9.0), (2, 0.7, 8.0), (3, 0.7, 7.0), (4, 0.1, 6.0)],
                               "epoch int, accuracy double, loss double")
    got = {r["kind"]: tuple(r)[1:] for r in best_and_last(df).collect()}
    assert got == {"best": (3, 0.7, 7.0), "last": (4, 0.1, 6.0)}
