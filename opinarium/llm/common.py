"""Helpers of this package: folds, bounded labelled samples, chunks of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinarium.runtime import materialize


def fold(doc_id: str | Column, folds: int) -> Column:
    """Remainder of crc32 of the id's digits; a NULL id has none."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % folds


def is_held_out(folds: int, held_out: int) -> Column:
    """Whether a document is kept from training; one without id is not, nor does it train."""
    return F.coalesce(fold("doc_id", folds) == held_out, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int
) -> DataFrame:
    """About `rows` labelled training documents at most: (doc_id, text, label), written.

    The sample is drawn by hash from the labels alone, so it is bounded before it
    meets a text: it is broadcast to the documents and no text is shuffled. Repeated
    labels of one id count once, the larger wins; labels other than 0 and 1 are left out.
    """
    drawn = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & (fold("doc_id", folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    total = drawn.count()
    if total > rows:
        share = F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1_000_000)) / 1e6
        drawn = drawn.where(share < rows / total)
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return materialize(sample.join(F.broadcast(drawn), "doc_id"), "labelled")


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """The whole row as one struct `row` next to some columns, so that no name can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    return df.select(row, *columns)


def texts_with_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, text) for Python workers, ids as digits: a batch with a NULL id would turn
    numbers into floating point and lose the last digits of long ones."""
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def ids_back(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


def chunks(sizes: Sequence[int], limit: int) -> Iterator[slice]:
    """Slices of neighbours whose sizes add up to `limit` at most, or of one larger row."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside sends this many rows at once to Python workers: for rows that are large themselves."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def kept(parts: Broadcast, make: Callable) -> object:
    """What `make` builds of a broadcast value, built once per worker process.

    A worker holds one object per broadcast for as long as the broadcast lives, so what is
    built can stay with it and serve the next tasks too.
    """
    if not hasattr(parts, "made"):
        parts.made = make(parts.value)
    return parts.made
