"""Relational tables over JDBC. URL and credentials come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinarium.functions import fixed_values as fixed


def day_query(table: str, day: str, day_column: str = "datatime") -> str:
    """The pushed-down day filter."""
    day = day.replace("'", "''")
    return f"select * from {table} where {day_column} = '{day}'"


def read_relational(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str],
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Rows of a query that the database runs; NULL text becomes empty.

    `split` = (numeric column, lower, upper, parts) reads in parallel. Without it
    one task reads the result, which only suits a small one.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    if split is None:
        reader = reader.option("query", query)
    else:
        column, lower, upper, parts = split
        reader = reader.option("dbtable", f"({query}) t").options(
            partitionColumn=column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=parts,
        )
    return reader.load().fillna("")


def replace_relational(
    df: DataFrame, url: str, table: str, properties: dict[str, str]
) -> None:
    """Drop and re-create the table: only the last run stays."""
    df.write.mode("overwrite").options(**properties).option(
        "batchsize", fixed.WRITE_BATCH
    ).jdbc(url, table)


def append_relational(
    df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 16
) -> None:
    """Append in batches over a bounded number of connections."""
    df.write.mode("append").options(**properties).option(
        "batchsize", fixed.WRITE_BATCH
    ).option("numPartitions", connections).jdbc(url, table)
