"""Reading the warehouse: queries and day partitions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run a query; `{name}` in its text stands for the frame given under that name."""
    return spark.sql(sql, **frames)


def day_before(day: Column) -> Column:
    """The day before a `yyyy-MM-dd` day string."""
    return F.date_format(F.date_sub(F.to_date(day, "yyyy-MM-dd"), 1), "yyyy-MM-dd")


def data_day(run_day: str) -> str:
    """The day a run of `run_day` works on: the one before. Shifted here and nowhere else."""
    day = datetime.date.fromisoformat(run_day) - datetime.timedelta(days=1)
    return day.isoformat()


def read_day(table: DataFrame, day: str, partition: str = "dt") -> DataFrame:
    """One day of a day-partitioned table; the filter prunes partitions."""
    return table.where(F.col(partition) == day)
