"""Strata and the capped sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.functions import fixed_values as fixed
from opinarium.operators.dedup import top_rows


def strata(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per distinct stratum."""
    return df.groupBy(*by).agg(F.count("*").alias("row_count"))


def stratum_cap(df: DataFrame, by: Sequence[str], total: int = fixed.SAMPLE_TOTAL) -> int:
    """Rows a stratum may keep: the total shared evenly, rounded down.

    More strata than the total would keep nothing of any, which raises.
    """
    n = df.select(*by).distinct().count()
    if n > total:
        raise ValueError(f"{n} strata cannot share a sample of {total} rows")
    return total // n if n else 0


# A stratum is cut within parts, then within groups of parts, then as a whole.
PARTS, GROUPS = 1024, 32


def capped_sample(
    df: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    total: int = fixed.SAMPLE_TOTAL,
    seed: int = fixed.SAMPLE_SEED,
    order: Sequence | None = None,
) -> DataFrame:
    """At most floor(total / strata) rows of each stratum, drawn without replacement.

    A stratum within the cap stays whole. The draw ranks rows by a seeded hash of
    the key, or by `order`; `key` must identify a row, so equal seeds draw
    equal rows. A row that ranks within the cap does so in every part of its stratum, so each
    stratum is cut in `PARTS` parts, then in `GROUPS` groups of them: no task ranks more rows
    of a hot stratum than its share of a part, or `PARTS` / `GROUPS` caps. The input is
    read twice (strata, then rows): pass a written stage when it is costly.
    """
    cap = stratum_cap(df, by, total)
    ranking = list(order or [F.xxhash64(F.lit(seed), *key)]) + list(key)
    part = F.pmod(F.xxhash64(*key), F.lit(PARTS))
    cut = top_rows(df.withColumn("_part", part), [*by, "_part"], ranking, cap)
    cut = top_rows(cut.withColumn("_part", F.col("_part") % GROUPS), [*by, "_part"], ranking, cap)
    return top_rows(cut.drop("_part"), by, ranking, cap)
