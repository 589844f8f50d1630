"""Top rows of a table, per group and per window.

A ranking filter against a constant lets the optimizer keep the best rows of each input partition
before the shuffle, so a hot group sends n rows per partition and not all of its rows. It does so up to
``spark.sql.optimizer.windowGroupLimitThreshold``, which is 1000 by default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.windows import slide


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n_per_group(
    df: DataFrame, part: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1; ``order`` should break ties."""
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    return numbered.filter(F.col(rank) <= n)


def top_by_rank(
    df: DataFrame, part: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The rows of rank ``n`` or better in each group; ties share a rank and stay."""
    ranked = df.withColumn(rank, F.rank().over(Window.partitionBy(*part).orderBy(*order)))
    return ranked.filter(F.col(rank) <= n)


def window_top_n(
    df: DataFrame, ts: str, size: str, every: str, item: str, n: int, count: str = "count"
) -> DataFrame:
    """The ``n`` most frequent items of each sliding window; equal counts go by item."""
    counts = slide(df, ts, size, every, [item], {count: ("count", "*")})
    return top_n_per_group(counts, ["window_start", "window_end"], [F.desc(count), F.asc(item)], n)
