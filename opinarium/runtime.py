"""Session helpers: shared folder, written stages, checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A frame of at most this many rows and characters may be broadcast.
SMALL_ROWS = 200_000
SMALL_CHARS = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir`, else one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stages"


# The folder of the run that is going on, if there is one.
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{_RUN.get() or shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Stages written inside go to one folder, which is deleted at the end.

    Write the results that are to stay elsewhere before leaving: frames read from stages are gone
    with them.
    """
    path = new_folder(spark, name)
    outer = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(outer)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a stage to the shared folder and go on from the written table.

    Cuts the lineage, keeps column pruning and filter pushdown, and outlives
    lost executors.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_chars: int = SMALL_CHARS) -> bool:
    """Whether the frame keeps both bounds: rows, and characters over its text columns.

    Looks at one row more than allowed, and no further.
    """
    texts = [c for c, kind in df.dtypes if kind == "string"]
    chars = [F.coalesce(F.sum(F.length(c).cast("long")), F.lit(0)) for c in texts]
    counts = df.limit(max_rows + 1).agg(F.count("*"), *chars).first()
    return counts[0] <= max_rows and sum(counts[1:]) <= max_chars


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """The frame with a broadcast hint when its checked size allows it, else as it is.

    Without the hint the join shuffles, and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if is_small(df) else df
