"""Selecting a day's articles, and joins by row id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.runtime import materialize

# Copies a single joined row fans out to at most; more copies come as more rows.
FAN_OUT = 10_000

def _copies(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def _pairs(relevant: DataFrame, classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _n): pairs of filter rows per key."""
    return (
        _copies(relevant, keys, "_a")
        .join(_copies(classified, keys, "_b"), list(keys))
        .select(*keys, (F.col("_a") * F.col("_b")).alias("_n"))
    )


def selected_copies(
    articles: DataFrame,
    relevant: DataFrame,
    classified: DataFrame,
    keys: Sequence[str] = ("news_uuid",),
) -> DataFrame:
    """(keys, n): how many rows the plain join makes of each article, without making them."""
    both = materialize(_pairs(relevant, classified, keys), "selected")
    return articles.select(*keys).join(both, list(keys)).select(*keys, F.col("_n").alias("n"))


def select_articles(
    articles: DataFrame,
    relevant: DataFrame,
    classified: DataFrame,
    keys: Sequence[str] = ("news_uuid",),
    semi: bool = False,
) -> DataFrame:
    """Articles with a row in both filter tables, already filtered to day and label.

    Plain: an inner join, so an article comes out once per pair of filter rows.
    `semi`: once per article row.

    The filter tables carry no columns out, so each is first counted per key, which
    combines on the map side and leaves one row per key however
    often it occurs. Both counts and their join share one partitioning. That small table is
    written: then both sides are shuffled right below the join with the articles, which lets
    adaptive execution split a hot key. The articles are shuffled once.
    """
    keys = list(keys)
    if semi:
        both = relevant.select(*keys).distinct().join(classified.select(*keys).distinct(), keys)
        return articles.join(materialize(both, "selected"), keys, "left_semi")
    both = _pairs(relevant, classified, keys)
    # a key with very many copies becomes several rows of at most FAN_OUT copies
    slices = F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / FAN_OUT))
    both = both.select(*keys, "_n", F.explode(slices).alias("_slice")).select(
        *keys, F.least(F.lit(FAN_OUT), F.col("_n") - F.col("_slice") * FAN_OUT).alias("_n")
    )
    joined = articles.join(materialize(both, "selected"), keys)
    # list out the copies; with one copy this is a plain row
    return joined.select(
        *articles.columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")
    ).drop("_copy")


def attach_predictions(truth: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Truth and prediction side by side, matched by row id."""
    return truth.join(predictions, key)
