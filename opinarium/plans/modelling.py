"""Train, evaluate, explain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.functions import fixed_values as fixed
from opinarium.functions.losses import cross_entropy
from opinarium.functions.text import clean_train
from opinarium.operators import evaluate, explain, training
from opinarium.operators.features import word_bag
from opinarium.operators.frames import first_rows
from opinarium.runtime import materialize
from opinarium.sources.warehouse import read_day


def with_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows with a text, plus their tokens; rows without one belong in `rejected`."""
    return df.where(F.col(text).isNotNull()).withColumn(
        "tokens", word_bag(clean_train(F.col(text)))
    )


def rejected(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text is missing."""
    return df.where(F.col(text).isNull())


def train(df: DataFrame, size: int, text: str = "text", **settings) -> PipelineModel:
    """A text classifier on the `size` most frequent words.

    Words are cut once, as training passes over them many times.
    """
    rows = materialize(with_tokens(df, text).select("label", "tokens"), "tokens")
    return training.text_classifier(size, **settings).fit(rows)


def evaluate_model(
    model: PipelineModel, df: DataFrame, key: str, text: str = "text"
) -> dict[str, DataFrame]:
    """Predictions, accuracy, loss, class report and confusion matrix on held-out rows."""
    scored = training.predictions(model, with_tokens(df, text).select(key, "label", "tokens"), key)
    # five reports read the predictions: score once
    rows = materialize(scored, "predictions")
    return {
        "predictions": rows,
        "accuracy": evaluate.accuracy(rows),
        "loss": evaluate.mean_loss(rows, cross_entropy(F.col("scores"), F.col("label"), "probs")),
        "report": evaluate.class_report(rows),
        "confusion": evaluate.confusion_matrix(rows),
    }


def explain_day(
    opinions: DataFrame,
    day: str,
    key: str,
    tokens: Column,
    score: Callable[[Column], Column],
    rows: int = fixed.EXPLAINED_ROWS,
    samples: int = 200,
    target: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(all word rows, best row per word) for the first rows of a scored day.

    `target` names the column with the class of each row that is to be explained.
    """
    picked = first_rows(read_day(opinions, day), rows, [key])
    weights = explain.local_weights(picked, key, tokens, score, samples, target=target)
    every = explain.word_rows(weights)
    return every, explain.best_words(every, "word", "weight")
