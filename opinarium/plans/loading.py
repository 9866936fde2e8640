"""Relational table to warehouse day, without passing the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession

from opinarium.sinks.tables import overwrite_day
from opinarium.sources.relational import day_query, read_relational
from opinarium.sources.warehouse import data_day


def load_day(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    source: str,
    target: str,
    run_day: str,
    split: tuple[str, int, int, int] | None = None,
) -> str:
    """Replace the day before `run_day` in the target table; returns that day."""
    day = data_day(run_day)
    rows = read_relational(spark, url, day_query(source, day), properties, split)
    overwrite_day(rows, target, day)
    return day
