"""Keep-first and best-of-group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group of equal `by` values, in the given order.

    An aggregate, not a window: each task folds its copies into one row before
    the shuffle, so a group holding a third of all rows costs one row per task. The
    hash in front of the key lets the sort compare longs instead of whole texts.
    """
    rest = [c for c in df.columns if c not in by]
    ordered = list(order) + [c for c in rest if c not in order]
    picked = (
        df.groupBy(F.xxhash64(*by).alias("_hash"), *by)
        .agg(F.min(F.struct(*ordered)).alias("_row"))
        .select(*by, "_row.*")
    )
    return picked.select(*df.columns)


def best_words(df: DataFrame, word: str, weight: str) -> DataFrame:
    """The row with the highest weight per word; ties go to the larger remaining columns."""
    rest = [c for c in df.columns if c not in (word, weight)]
    return (
        df.groupBy(word)
        .agg(F.max(F.struct(weight, *rest)).alias("_row"))
        .select(word, "_row.*")
        .select(*df.columns)
    )


def top_rows(df: DataFrame, by: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """The first n rows of each group in a given total order.

    With n up to the group-limit threshold of the session, tasks cut
    their groups to n rows before the shuffle.
    """
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
