"""Class vectors and label texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """`body(value)`, with the value computed once instead of once per array element."""
    return F.transform(F.array(value), body)[0]


def _doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def argmax(vector: Column) -> Column:
    """Zero-based index of the first maximum; NULL for a NULL or empty vector."""
    at = F.array_position(vector, F.array_max(vector))
    return F.when(at > 0, (at - 1).cast("int"))


def log_sum_exp(vector: Column) -> Column:
    vector = _doubles(vector)
    return let(
        F.array_max(vector),
        lambda top: top
        + F.ln(F.aggregate(vector, F.lit(0.0), lambda a, x: a + F.exp(x - top))),
    )


def softmax(vector: Column) -> Column:
    vector = _doubles(vector)
    return let(
        log_sum_exp(vector), lambda lse: F.transform(vector, lambda x: F.exp(x - lse))
    )


def sigmoid(vector: Column) -> Column:
    return F.transform(_doubles(vector), lambda x: 1.0 / (1.0 + F.exp(-x)))


def threshold(probabilities: Column, at: float = 0.5) -> Column:
    """1 where the probability reaches the threshold, else 0."""
    return F.transform(probabilities, lambda p: F.when(p >= at, 1).otherwise(0))


def class_probabilities(vector: Column) -> Column:
    """Map class id -> probability."""
    probs = softmax(vector)
    return F.map_from_arrays(F.sequence(F.lit(0), F.size(vector) - 1), probs)


def one_hot(index: Column, classes: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: F.when(i == index, 1).otherwise(0)
    )


def parse_multi_hot(label: Column) -> Column:
    """`"[1,0,0]"` as an array of doubles; NULL for anything that is no such list."""
    parsed = F.from_json(label, "array<double>")
    return F.when(F.forall(parsed, lambda x: x.isNotNull()), parsed)
