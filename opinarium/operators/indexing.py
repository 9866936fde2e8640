"""A global row number without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinarium.runtime import materialize


def with_row_index(
    df: DataFrame, order: Sequence[str | Column], name: str = "row_index"
) -> DataFrame:
    """Add the zero-based position of each row in the given total order.

    Rows are range-partitioned and sorted; a row's position is its place in its
    range plus the sizes of the ranges before. Only the table of range sizes,
    one row per task, is ever in one place. The numbered stage is written once and both
    steps read the written one. The ranges are sampled first, which runs the input twice:
    pass a written stage when it is costly.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # a generated id holds the partition in its upper bits, the place in the lower 33
    ranged = ranged.withColumn("_range", F.shiftright("_place", 33)).withColumn(
        "_place", F.col("_place").bitwiseAND((1 << 33) - 1)
    )
    written = materialize(ranged, "row-index")
    sizes = written.groupBy("_range").agg(F.count("*").alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        written.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_range", "_place", "_offset")
    )
