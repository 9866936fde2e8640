"""File exports and metric documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def escaped(column: Column) -> Column:
    r"""Line ends as `\n` and `\r`, and `\` doubled, so that a row stays on one line."""
    doubled = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def one_line(df: DataFrame) -> DataFrame:
    """All texts of a frame with escaped line ends."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: escaped(F.col(f"`{c}`")) for c in texts})


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one file per task, no byte-order mark; a row per line."""
    one_line(df).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def export_tsv(df: DataFrame, path: str) -> None:
    one_line(df).write.mode("overwrite").csv(path, sep="\t", header=True, quote='"', escape='"')


def export_delimited(df: DataFrame, path: str, sep: str = "\u0001") -> None:
    r"""Plain delimited lines without header or quoting; NULL is written as `\N`."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in df.columns]
    df.select(F.concat_ws(sep, *cells)).write.mode("overwrite").text(path)


def best_and_last(metrics: DataFrame) -> DataFrame:
    """Two rows from the metrics per epoch: the best (ties: later epoch) and the last one."""
    row = F.struct(*metrics.columns)
    picked = metrics.agg(
        F.max_by(row, F.struct("accuracy", "epoch")).alias("best"),
        F.max_by(row, F.col("epoch")).alias("last"),
    )
    kinds = F.array(
        F.struct(F.lit("best").alias("kind"), F.col("best").alias("m")),
        F.struct(F.lit("last").alias("kind"), F.col("last").alias("m")),
    )
    return picked.select(F.explode(kinds).alias("k")).select("k.kind", "k.m.*")


def write_metric_documents(metrics: DataFrame, path: str) -> None:
    """The best and the last metrics as JSON documents, one folder per kind."""
    best_and_last(metrics).write.mode("overwrite").partitionBy("kind").json(path)
