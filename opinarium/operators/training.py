"""Training and evaluating text classifiers with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinarium.functions.labels import argmax, softmax
from opinarium.operators import boosting
from opinarium.operators.features import error_weight, with_probabilities
from opinarium.operators.frames import items
from opinarium.runtime import broadcast_if_small, materialize


# Estimators of a text classifier by name.
LINEAR, BAYES = "linear", "bayes"


def classifier(kind: str = LINEAR, **settings):
    """Logistic regression, or multinomial naive Bayes, binary or multi-class."""
    if kind == LINEAR:
        return LogisticRegression(**settings)
    if kind == BAYES:
        return NaiveBayes(modelType="multinomial", **settings)
    raise ValueError(f"unknown classifier {kind!r}")


def text_classifier(size: int, tokens: str = "tokens", kind: str = LINEAR, **settings) -> Pipeline:
    """Word counts, of the `size` most frequent words at most, and a classifier."""
    return Pipeline(
        stages=[
            CountVectorizer(inputCol=tokens, outputCol="features", vocabSize=size),
            classifier(kind, **settings),
        ]
    )


def predictions(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """(key, label, scores, pred) of a fitted classifier."""
    return model.transform(df).select(
        key,
        F.col("label").cast("int").alias("label"),
        vector_to_array("probability").alias("scores"),
        F.col("prediction").cast("int").alias("pred"),
    )


def word_bayes(rows: DataFrame, key: str, label: str, tokens: str, classes: int = 2) -> DataFrame:
    """(key, raw): log joint probability of each row and class under multinomial naive Bayes of `rows`.

    In closed form, one smoothing count per word and class. Counts by word are a table that is joined
    to the rows' words, so a vocabulary of any size is whole. Keys must be unique.
    """
    found = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    docs = [found.get(c, 0) for c in range(classes)]
    bag = items(rows, [key, label], F.col(tokens), "word").groupBy(key, label, "word")
    counted = materialize(bag.agg(F.count("*").alias("n")), "bayes-counts")
    sides = [F.sum(F.when(F.col(label) == c, F.col("n")).otherwise(0)).alias(f"_{c}") for c in range(classes)]
    known = materialize(counted.groupBy("word").agg(*sides), "bayes-words")
    width, *totals = known.agg(
        F.count("*"), *[F.coalesce(F.sum(f"_{c}"), F.lit(0)) for c in range(classes)]
    ).first()
    weights = [
        (F.ln(F.col(f"_{c}") + 1.0) - F.ln(F.lit(float(max(totals[c] + width, 1))))).alias(f"_{c}")
        for c in range(classes)
    ]
    joined = counted.join(broadcast_if_small(known.select("word", *weights)), "word")
    sums = joined.groupBy(key).agg(*[F.sum(F.col("n") * F.col(f"_{c}")).alias(f"_{c}") for c in range(classes)])
    raw = [
        F.lit(math.log(docs[c] + 1) - math.log(sum(docs) + classes)) + F.coalesce(F.col(f"_{c}"), F.lit(0.0))
        for c in range(classes)
    ]
    return rows.select(key).join(sums, key, "left").select(key, F.array(*raw).alias("raw"))


def objective_history(spark: SparkSession, history: Sequence[float], run: str) -> DataFrame:
    """Training loss per iteration as (run, epoch, metric, value)."""
    rows = [(run, i, "train_loss", float(v)) for i, v in enumerate(history)]
    return spark.createDataFrame(rows, "run string, epoch int, metric string, value double")


def fit_multi_label(
    df: DataFrame, labels: str, width: int, features: str = "features", **settings
) -> list:
    """One binary model per position of a multi-hot label, on shared features."""
    return [
        LogisticRegression(featuresCol=features, labelCol="_y", **settings).fit(
            df.select(features, F.col(labels)[i].cast("double").alias("_y"))
        )
        for i in range(width)
    ]


def score_multi_label(
    df: DataFrame, models: Sequence, output: str = "scores", features: str = "features"
) -> DataFrame:
    """Add the list of probabilities, one per position."""
    parts = []
    for i, model in enumerate(models):
        names = {"probability": f"_p{i}", "prediction": f"_l{i}", "rawPrediction": f"_r{i}"}
        model = model.copy()
        model.setFeaturesCol(features).setProbabilityCol(names["probability"])
        model.setPredictionCol(names["prediction"]).setRawPredictionCol(names["rawPrediction"])
        df = model.transform(df).drop(names["prediction"], names["rawPrediction"])
        parts.append(names["probability"])
    scores = F.array(*[vector_to_array(p)[1] for p in parts])
    return df.withColumn(output, scores).drop(*parts)


def fit_two_targets(
    df: DataFrame, targets: Sequence[str], features: str = "features", **settings
) -> dict:
    """One classifier per target column, on one shared feature column."""
    return {
        t: LogisticRegression(
            featuresCol=features,
            labelCol=t,
            probabilityCol=f"{t}_probability",
            predictionCol=f"{t}_prediction",
            rawPredictionCol=f"{t}_raw",
            **settings,
        ).fit(df)
        for t in targets
    }


def score_two_targets(df: DataFrame, models: Mapping) -> DataFrame:
    """Add `<target>_scores` and `<target>_pred` per target."""
    for target, model in models.items():
        df = (
            model.transform(df)
            .withColumn(f"{target}_scores", vector_to_array(f"{target}_probability"))
            .withColumn(f"{target}_pred", F.col(f"{target}_prediction").cast("int"))
            .drop(f"{target}_probability", f"{target}_prediction", f"{target}_raw")
        )
    return df


def boosted_student(
    classes: int,
    features: str = "features",
    weight: str | None = None,
    held_out: str | None = None,
    **settings,
):
    """Boosted trees with row weights.

    Early stopping on held-out rows is there for two classes; asking for it with more raises.
    """
    trees = GBTClassifier(featuresCol=features, **settings)
    if weight:
        trees = trees.setWeightCol(weight)
    if classes <= 2:
        return trees.setValidationIndicatorCol(held_out) if held_out else trees
    if held_out:
        raise ValueError("no early stopping with more than two classes")
    several = OneVsRest(classifier=trees, featuresCol=features)
    return several.setWeightCol(weight) if weight else several


def teach(
    rows: DataFrame, shares: DataFrame, key: str, kind: str = LINEAR, **settings
) -> DataFrame:
    """(key, label, held_out, counts, teacher_pred, weight): one teacher's verdict on all rows.

    The teacher learns from the rows not held out, on their counts and the student's last
    probabilities; its errors weigh ten times for the next student.
    """
    joined = with_probabilities(rows, shares, key, "counts", "features")
    teacher = classifier(kind, **settings).fit(joined.where(~F.col("held_out")))
    judged = teacher.transform(joined).select(
        key,
        "label",
        "held_out",
        "counts",
        F.col("prediction").alias("teacher_pred"),
        error_weight(F.col("prediction"), F.col("label")).alias("weight"),
    )
    return materialize(judged, "co-train")


def co_train(
    train: DataFrame,
    valid: DataFrame,
    key: str,
    classes: int,
    counter: Transformer,
    rounds: int = 3,
    kind: str = LINEAR,
    tree_settings: Mapping | None = None,
    **settings,
) -> tuple[DataFrame, list[DataFrame]]:
    """Two models that teach each other.

    Gives the accuracies per round as (run, epoch, metric, value), and for each round its
    written rows (key, label, held_out, teacher_pred, weight, student_pred). Each round fits a teacher
    on word counts plus the student's last probabilities, weighs its errors
    ten times, fits boosted trees on the weighted rows and hands their probabilities
    back. `counter` makes the column `counts` out of the rows: `hashed_counts`, which takes in all
    words, or a fitted vocabulary. The rows' outcomes are written
    after each round, so lineage does not grow. Keys must be unique.
    """
    flag = F.lit(False)
    both = train.withColumn("held_out", flag).unionByName(valid.withColumn("held_out", ~flag))
    counted = counter.transform(both)
    rows = materialize(counted.select(key, "label", "held_out", "counts"), "co-train")
    shares = uniform(rows, key, classes)
    out, written = [], []
    for epoch in range(1, rounds + 1):
        judged = teach(rows, shares, key, kind, **settings)
        held_out = "held_out" if classes <= 2 else None
        trees = boosted_student(classes, "counts", "weight", held_out, **dict(tree_settings or {}))
        student = trees.fit(judged if classes <= 2 else judged.where(~F.col("held_out")))
        scored = student.transform(judged)
        # with several classes one margin each, mapped to a distribution
        shares_of = (
            softmax(vector_to_array("rawPrediction"))
            if classes > 2
            else vector_to_array("probability")
        )
        kept = scored.select(
            key,
            "label",
            "held_out",
            "teacher_pred",
            "weight",
            F.col("prediction").alias("student_pred"),
            shares_of.alias("_shares"),
        )
        kept = materialize(kept, "co-train")
        shares = kept.select(key, _to_vector("_shares").alias("probability"))
        written.append(kept.drop("_shares"))
        out.append(_accuracies(kept, epoch))
    return _accuracy_lines(out), written


def _accuracies(kept: DataFrame, epoch: int) -> DataFrame:
    """(held_out, teacher, student, epoch): shares of right verdicts."""
    right = [F.avg((F.col(f"{who}_pred") == F.col("label")).cast("int")).alias(who) for who in ("teacher", "student")]
    return kept.groupBy("held_out").agg(*right).withColumn("epoch", F.lit(epoch))


def _accuracy_lines(epochs: Sequence[DataFrame]) -> DataFrame:
    """(run, epoch, metric, value)."""
    part = F.when(F.col("held_out"), "valid").otherwise("train")
    lines = F.array(
        *[
            F.struct(
                F.concat(F.lit(f"{who}_"), part, F.lit("_accuracy")).alias("metric"),
                F.col(who).alias("value"),
            )
            for who in ("teacher", "student")
        ]
    )
    history = reduce(DataFrame.unionByName, epochs)
    return history.select(
        F.lit("co-training").alias("run"), "epoch", F.explode(lines).alias("l")
    ).select("run", "epoch", "l.*")


def cell_bayes(rows: DataFrame, cells: DataFrame, key: str, classes: int) -> Callable[[DataFrame], DataFrame]:
    """Multinomial naive Bayes over words and a few shares per row: a function of the shares giving (key, raw).

    Learned from the rows (key, label, held_out) that are not held out, in closed form with one smoothing count; words that these
    do not have count nothing. `cells` is (key, word, value): counts, or any other amounts, of words however many. They are
    summed once: a row keeps the sum of its values and of their logarithms by class, and shares (key, _shares), words of
    their own, change nothing of these but the width and the totals.
    """
    train = rows.where(~F.col("held_out")).select(key, "label")
    found = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    docs = [found.get(c, 0) for c in range(classes)]
    sides = [F.sum(F.when(F.col("label") == c, F.col("value")).otherwise(0.0)).alias(f"_{c}") for c in range(classes)]
    known = materialize(cells.join(train, key).groupBy("word").agg(*sides), "bayes-words")
    width, *totals = known.agg(
        F.count("*"), *[F.coalesce(F.sum(f"_{c}"), F.lit(0.0)) for c in range(classes)]
    ).first()
    logs = [F.ln(F.col(f"_{c}") + 1.0).alias(f"_{c}") for c in range(classes)]
    joined = cells.join(known.select("word", *logs), "word")
    sums = joined.groupBy(key).agg(
        F.sum("value").alias("_n"), *[F.sum(F.col("value") * F.col(f"_{c}")).alias(f"_{c}") for c in range(classes)]
    )
    kept = materialize(rows.select(key).join(sums, key, "left"), "bayes-sums")

    def raw(shares: DataFrame) -> DataFrame:
        own = shares.groupBy(key).agg(*[F.sum(F.get("_shares", F.lit(j))).alias(f"_s{j}") for j in range(classes)])
        own = materialize(own, "bayes-shares")
        sides = [
            F.coalesce(F.sum(F.when(F.col("label") == c, F.col(f"_s{j}")).otherwise(0.0)), F.lit(0.0))
            for c in range(classes)
            for j in range(classes)
        ]
        trained, *flat = own.join(train, key).agg(F.count("*"), *sides).first()
        taught = [flat[c * classes : (c + 1) * classes] for c in range(classes)] if trained else [[]] * classes
        scores = []
        for c in range(classes):
            whole = math.log(max(totals[c] + sum(taught[c]) + width + len(taught[c]), 1))
            start = F.lit(math.log(docs[c] + 1) - math.log(sum(docs) + classes))
            of_words = F.coalesce(F.col(f"_{c}") - F.col("_n") * F.lit(whole), F.lit(0.0))
            of_shares = [
                F.coalesce(F.col(f"_s{j}"), F.lit(0.0)) * F.lit(math.log(x + 1.0) - whole) for j, x in enumerate(taught[c])
            ]
            scores.append(reduce(lambda a, b: a + b, of_shares, start + of_words))
        return kept.join(own, key, "left").select(key, F.array(*scores).alias("raw"))

    return raw


def co_teach(
    rows: DataFrame,
    cells: DataFrame,
    key: str,
    classes: int,
    rounds: int = 3,
    trees: int = 5,
    depth: int = 3,
    learning_rate: float = 0.3,
    patience: int | None = None,
) -> tuple[DataFrame, list[DataFrame]]:
    """Two models on all words that teach each other, for any number of classes.

    Each round fits naive Bayes on the words and the student's last probabilities, weighs the rows it
    gets wrong ten times, goes on boosting the student for `trees` rounds on the weighted rows, and hands
    its probabilities back. `rows` is (key, label, held_out), `cells` (key, word, value); pass both written. Gives the
    accuracies as `co_train` does, and for each round its written rows (key, label, held_out, teacher_pred,
    weight, student_pred).
    """
    teacher = cell_bayes(rows, cells, key, classes)
    shares = rows.select(key, F.array_repeat(F.lit(1.0 / classes), F.lit(classes)).alias("_shares"))
    features = cells.withColumnRenamed("word", "feature")
    binned = boosting.binned(features, rows.where(~F.col("held_out")), key)
    student, out, written = None, [], []
    for epoch in range(1, rounds + 1):
        judged = rows.join(teacher(shares), key).withColumn("teacher_pred", argmax(F.col("raw"))).drop("raw")
        judged = judged.withColumn("weight", error_weight(F.col("teacher_pred"), F.col("label")))
        judged = materialize(judged, "co-teach")
        student = boosting.boost(
            judged.drop("teacher_pred"), features, key, classes, trees, depth, learning_rate, patience=patience,
            start=student, features=binned,
        )
        scored = boosting.with_margins(judged, features, key, student)
        kept = scored.withColumns({"student_pred": argmax(F.col("margins")), "_shares": softmax(F.col("margins"))})
        kept = materialize(kept.drop("margins"), "co-teach")
        shares = kept.select(key, "_shares")
        written.append(kept.drop("_shares"))
        out.append(_accuracies(kept, epoch))
    return _accuracy_lines(out), written


def _to_vector(column: str) -> Column:
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(F.col(column))


def uniform(df: DataFrame, key: str, classes: int) -> DataFrame:
    """Equal probabilities for every row, as before the first student."""
    equal = F.array_repeat(F.lit(1.0 / classes), F.lit(classes))
    return df.select(key, equal.alias("_equal")).select(
        key, _to_vector("_equal").alias("probability")
    )


def soft_rows(
    df: DataFrame, label: str, teacher: str, classes: int, alpha: float, temperature: float
) -> DataFrame:
    """Each row once per class, weighted by the cooled teacher score and the truth.

    A weighted classifier on these rows minimises the mixed soft and hard
    cross-entropy.
    """
    cooled = softmax(F.transform(F.col(teacher), lambda x: x / temperature))
    each = items(df, df.columns, cooled, "_p", "_class")
    hard = (F.col("_class") == F.col(label)).cast("double")
    return (
        each.withColumn("soft_weight", alpha * F.col("_p") + (1.0 - alpha) * hard)
        .withColumn("soft_label", F.col("_class").cast("double"))
        .where((F.col("_class") < classes) & (F.col("soft_weight") > 0))
        .drop("_class", "_p")
    )


def distil(
    df: DataFrame,
    label: str,
    teacher: str,
    classes: int,
    alpha: float,
    temperature: float,
    features: str = "features",
    **settings,
):
    """A student trained on a teacher's scores."""
    rows = soft_rows(df, label, teacher, classes, alpha, temperature)
    return LogisticRegression(
        featuresCol=features, labelCol="soft_label", weightCol="soft_weight", **settings
    ).fit(rows)
