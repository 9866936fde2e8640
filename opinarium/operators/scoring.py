"""Batch scoring and label decoding.

A model is a factory: called once per Python worker, it returns a function from a batch
of inputs to one vector per row. A row the model fails on is a failed prediction: its vector is NULL
and the rest of its batch is scored. NULL inputs are NULL without reaching the model.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.functions.labels import argmax
from opinarium.runtime import broadcast_if_small

Factory = Callable[[], Callable[[np.ndarray], np.ndarray]]
VECTOR = T.ArrayType(T.DoubleType())


def recovered(predict: Callable[[Sequence], Sequence], rows: Sequence) -> list:
    """One outcome per row, None for the rows on which `predict` raises.

    A batch that fails is halved until the failing rows are alone. Where the first half of a failing
    batch passes, the second is halved without being tried, so a failing row among n costs about two
    calls per halving. Another number of outcomes than rows raises.
    """
    out: list = [None] * len(rows)

    def score(start: int, stop: int, fails: bool = False) -> bool:
        if not fails or stop - start == 1:
            try:
                found = predict(rows[start:stop])
            except Exception:  # whatever a model raises is about the rows it was given
                found = None
            if found is not None:
                if len(found) != stop - start:
                    raise ValueError(f"{len(found)} outcomes for {stop - start} rows")
                out[start:stop] = found
                return True
        if stop - start > 1:
            middle = (start + stop) // 2
            passed = score(start, middle)
            score(middle, stop, fails=passed)
        return False

    if len(rows):
        score(0, len(rows))
    return out


def _scorer(factory, heads, batch_size, input_shape, failures):
    names = list(heads or ["scores"])
    returns = T.StructType([T.StructField(h, VECTOR) for h in names]) if heads else VECTOR

    def vectors(model, rows) -> list[tuple]:
        inputs = rows if input_shape is None else np.stack(list(rows)).reshape(-1, *input_shape)
        found = model(inputs)
        parts = [found[h] for h in names] if heads else [found]
        return list(zip(*parts, strict=True))

    loaded: list = []

    def score(batch):
        if not loaded:
            loaded.append(factory())
        out = [(None,) * len(names)] * len(batch)
        present = np.flatnonzero(batch.notna().to_numpy())
        values = batch.to_numpy()
        for start in range(0, len(present), batch_size):
            places = present[start : start + batch_size]
            found = recovered(lambda rows: vectors(loaded[0], rows), values[places])
            for place, row in zip(places.tolist(), found, strict=True):
                if row is not None:
                    out[place] = row
                elif failures is not None:
                    failures.add(1)
        columns = [pd.Series([row[i] for row in out], dtype=object) for i in range(len(names))]
        return pd.DataFrame(dict(zip(names, columns, strict=True))) if heads else columns[0]

    # By batch, not by an iterator: all scorers of a select then run in one Python worker per task, not one each.
    score.__annotations__ = {"batch": pd.Series, "return": pd.DataFrame if heads else pd.Series}
    # A filter on a deterministic score is pushed below it together with a second run of
    # the model; a non-deterministic one is computed once and filtered afterwards.
    return F.pandas_udf(score, returns).asNondeterministic()


def batch_scorer(
    factory: Factory,
    batch_size: int = 1024,
    input_shape: Sequence[int] | None = None,
    failures: Accumulator | None = None,
) -> Callable[[Column], Column]:
    """Column function giving one probability vector per row, NULL where the model fails.

    `failures` counts the rows that failed; like any accumulator, it counts those of a repeated task again. NaN
    counts as NULL for inputs that are numbers.
    """
    return _scorer(factory, None, batch_size, input_shape, failures)


def two_head_scorer(
    factory: Factory,
    heads: Sequence[str],
    batch_size: int = 1024,
    input_shape: Sequence[int] | None = None,
    failures: Accumulator | None = None,
) -> Callable[[Column], Column]:
    """Column function giving a struct with one vector per head, from one pass.

    The model returns a dictionary by head. All heads of a row it fails on are NULL.
    """
    return _scorer(factory, heads, batch_size, input_shape, failures)


def two_model_scorer(
    first: Callable[[Column], Column], second: Callable[[Column], Column], heads: Sequence[str]
) -> Callable[[Column], Column]:
    """Column function giving a struct of the vectors of two models run in sequence."""
    one, two = heads

    def score(column: Column) -> Column:
        return F.struct(first(column).alias(one), second(column).alias(two))

    return score


def linear_factory(weights: Sequence[Sequence[float]]) -> Factory:
    """Linear scores of an input vector: one weight row per class."""
    matrix = [list(map(float, row)) for row in weights]

    def load():
        import numpy as np

        w = np.array(matrix)

        def predict(vectors):
            return vectors.astype("float64") @ w.T

        return predict

    return load


def cue_factory(cues: Sequence[str]) -> Factory:
    """Class probabilities of a text from how often each class's cue string occurs in it."""
    cues = list(cues)

    def load():
        import numpy as np

        def predict(texts):
            counts = np.array(
                [[float((t or "").count(c)) for c in cues] for t in texts]
            ).reshape(len(texts), len(cues))
            powers = np.exp(counts - counts.max(axis=1, keepdims=True))
            return powers / powers.sum(axis=1, keepdims=True)

        return predict

    return load


def two_heads(first: Factory, second: Factory, names: Sequence[str]) -> Factory:
    """One model with two outputs out of two models on the same input."""
    one, two = names

    def load():
        f, g = first(), second()

        def predict(batch):
            return {one: f(batch), two: g(batch)}

        return predict

    return load


def save_linear(spark: SparkSession, weights: Sequence[Sequence[float]], path: str) -> None:
    """Write a linear model as a table (class, weights), one row per class."""
    rows = [(k, [float(w) for w in row]) for k, row in enumerate(weights)]
    spark.createDataFrame(rows, "class int, weights array<double>").write.parquet(path)


def load_linear(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """Column function of a saved linear model: a vector to one score per class, in the JVM."""
    rows = spark.read.parquet(path).orderBy("class").collect()  # a row per class
    matrix = [F.array(*[F.lit(w) for w in r["weights"]]) for r in rows]

    def score(column: Column) -> Column:
        vector = column.cast("array<double>")
        products = [F.zip_with(vector, row, lambda x, w: x * w) for row in matrix]
        return F.array(*[F.aggregate(p, F.lit(0.0), lambda a, b: a + b) for p in products])

    return score


def score_with_pipeline(df: DataFrame, model: PipelineModel, output: str) -> DataFrame:
    """Score with a fitted Spark ML pipeline: stays in the JVM."""
    drop = [c for c in model.transform(df.limit(0)).columns if c not in df.columns]
    scored = model.transform(df)
    return scored.withColumn(output, vector_to_array("probability")).drop(
        *[c for c in drop if c != output]
    )


def label_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(label_id, label_name)."""
    return spark.createDataFrame(
        list(enumerate(names)), "label_id int, label_name string"
    )


def decode_label(vector: Column, names: Sequence[str]) -> Column:
    """Name of the most probable class; NULL, a failed row, when it has no name."""
    listed = F.array(*[F.lit(n) for n in names])
    return F.get(listed, argmax(vector))


def decode_by_table(
    df: DataFrame, names: DataFrame, vector: str, output: str
) -> DataFrame:
    """The same with the label map as a table (label_id, label_name), one row per id."""
    listed = names.select(F.col("label_id").alias("_id"), F.col("label_name").alias(output))
    decided = df.withColumn("_id", argmax(F.col(vector)))
    return decided.join(broadcast_if_small(listed), "_id", "left").drop("_id")


def label_ids(df: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Add `label_id` for a label name; NULL for an unknown one."""
    return df.join(
        names.withColumnRenamed("label_name", column), column, "left"
    )
