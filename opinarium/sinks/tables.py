"""Day-partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinarium.functions import fixed_values as fixed


def create_day_table(
    spark: SparkSession,
    table: str,
    columns: Sequence[str] = fixed.OPINION_COLUMNS,
    location: str | None = None,
    layout: str = "orc",
) -> None:
    """Table of string columns partitioned by `dt`: "orc", or "text" (tab-separated).

    A text table has a row per line: write it with `one_line` rows, read it with `unescaped`.

    With a location the table is external: dropping it leaves the files.
    """
    fields = ", ".join(f"`{c}` STRING" for c in columns)
    if layout == "orc":
        using = "orc"
    elif layout == "text":
        using = "csv OPTIONS (sep '\\t', quote '\"', escape '\"')"
    else:
        raise ValueError(f"unknown layout {layout!r}")
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({fields}, dt STRING) "
        f"USING {using} PARTITIONED BY (dt){place}"
    )


def overwrite_day(df: DataFrame, table: str, day: str) -> None:
    """Replace exactly one day of a table, also by nothing; other days stay.

    Columns go by name, in the order of the table. Spark stages the files and
    moves them on commit, so a failed write leaves the old day.
    """
    spark = df.sparkSession
    names = [c for c in spark.table(table).columns if c != "dt"]
    fields = ", ".join(f"`{c}`" for c in names)
    day = day.replace("'", "''")
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (dt = '{day}') "
        f"SELECT {fields} FROM {{rows}}",
        rows=df,
    )


def overwrite_days(df: DataFrame, path: str, layout: str = "orc") -> None:
    """Replace the days present in the frame under a path; other days stay.

    Rows are spread by day before writing so that a day is a few large files;
    adaptive execution splits a day too big for one task.
    """
    spread = df.hint("rebalance", F.col("dt"))
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if layout == "text":
        writer = writer.option("sep", "\t").option("escape", '"')
        layout = "csv"
    writer.partitionBy("dt").format(layout).save(path)
