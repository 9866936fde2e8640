"""Per-row losses on score vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinarium.functions.labels import let, log_sum_exp, softmax


def cross_entropy(scores: Column, label: Column, scale: str = "logits") -> Column:
    """Cross-entropy of one row.

    `scale` says what the scores are: "logits", "probs" (already normalised), or
    "probs_as_logits" (probabilities put through softmax once more, as the training
    scripts this engine replaces did).
    """
    at = label.cast("int") + 1
    if scale == "probs":
        return -F.ln(F.element_at(scores.cast("array<double>"), at))
    if scale == "probs_as_logits":
        scores = softmax(scores)
    elif scale != "logits":
        raise ValueError(f"unknown scale {scale!r}")
    return log_sum_exp(scores) - F.element_at(scores.cast("array<double>"), at)


def binary_cross_entropy(probs: Column, truth: Column) -> Column:
    """Mean over the positions of one row; logarithms are clamped at -100."""

    def clamped(p: Column) -> Column:
        # ln(0) is NULL, and greatest() skips NULL
        return F.greatest(F.ln(p), F.lit(-100.0))

    cells = F.zip_with(
        probs.cast("array<double>"),
        truth.cast("array<double>"),
        lambda p, t: -(t * clamped(p) + (1.0 - t) * clamped(1.0 - p)),
    )
    return F.aggregate(cells, F.lit(0.0), lambda a, b: a + b) / F.size(truth)


def distillation_loss(
    scores: Column, teacher: Column, label: Column, alpha: float, temperature: float
) -> Column:
    """`alpha * T^2 * KL(teacher || student) + (1 - alpha) * cross-entropy`, KL per cell."""

    def cooled(v: Column) -> Column:
        return F.transform(v.cast("array<double>"), lambda x: x / temperature)

    def divergence(lse: Column) -> Column:
        cells = F.zip_with(
            softmax(cooled(teacher)),
            cooled(scores),
            lambda p, s: F.when(p == 0, 0.0).otherwise(p * (F.ln(p) - (s - lse))),
        )
        return F.aggregate(cells, F.lit(0.0), lambda a, b: a + b) / F.size(scores)

    soft = let(log_sum_exp(cooled(scores)), divergence)
    return (alpha * temperature * temperature) * soft + (1.0 - alpha) * cross_entropy(
        scores, label
    )
