"""Projection, filter, explode, counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, columns: Sequence[str], position: str | None = None) -> DataFrame:
    """One row per list item; an empty or NULL list gives one row with NULL.

    Several columns give every combination of their items per row. `position`
    names a column for the place in the list; it goes with a single column.
    """
    if position is not None:
        (column,) = columns
        others = [c for c in df.columns if c != column]
        return df.select(*others, F.posexplode_outer(column).alias(position, column))
    for column in columns:
        df = df.withColumn(column, F.explode_outer(column))
    return df


def items(
    df: DataFrame, keep: Sequence[str], values: Column, name: str, position: str | None = None
) -> DataFrame:
    """The columns `keep` and one row per list item; rows without items fall out.

    An outer explode with the filter behind it. For an inner explode the optimizer adds
    a filter on the list itself, which computes a derived list a second
    time, and pushes it down to the scan.
    """
    if position is None:
        rows = df.select(*keep, F.explode_outer(values).alias(name))
    else:
        rows = df.select(*keep, F.posexplode_outer(values).alias(position, name))
    return rows.where(F.col(position or name).isNotNull())


def once(column: Column) -> Column:
    """The same value, computed in one place: the row number in it, which is always there, keeps
    the optimizer from copying the expression into those that read it, or a filter from going below."""
    return F.when(F.monotonically_increasing_id() >= 0, column)


def any_flag(columns: Sequence[str], value: int = 1) -> Column:
    """Whether at least one of the columns equals the value."""
    return reduce(lambda a, b: a | b, [F.col(c) == value for c in columns])


def drop_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every prediction is present."""
    return df.dropna("any", subset=list(columns))


def failure_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows in all, rows with a failed prediction, rows that stay."""
    failed = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(failed).alias("failed_rows"),
        F.count_if(~failed).alias("kept_rows"),
    )


def counted(df: DataFrame) -> DataFrame:
    """One row `row_count`."""
    return df.agg(F.count("*").alias("row_count"))


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(stage, rows) for named stages. Meant for written or cheap stages."""
    counts = [counted(df).select(F.lit(name).alias("stage"), "row_count") for name, df in stages.items()]
    return reduce(DataFrame.unionByName, counts)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows in a given order; each task keeps n at most."""
    return df.orderBy(*order).limit(n)
