"""Keyed and global aggregates, counters per kind, exact and approximate distinct counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.functions.hashing import poly_hash
from clickloom.times import micros


def word_count(words: DataFrame, word: str = "word") -> DataFrame:
    return words.groupBy(word).agg(F.count("*").alias("count"))


def count_by_value(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("count"))


def int_avg(df: DataFrame, keys: Sequence[str], val: str, name: str = "avg") -> DataFrame:
    """Average in whole numbers, as a sum divided by a count without remainder."""
    return df.groupBy(*keys).agg(F.expr(f"sum(`{val}`) div count(`{val}`)").alias(name))


def two_stage_agg(
    df: DataFrame, keys: Sequence[str], inner: Sequence[str], within: Column, across: Column
) -> DataFrame:
    """Aggregate inside (keys, inner) groups, then the results across each key.

    ``within`` names its result; ``across`` is an aggregate of that name.
    """
    return df.groupBy(*keys, *inner).agg(within).groupBy(*keys).agg(across)


def kind_counts(df: DataFrame, key: str, kind: str, kinds: dict[str, str]) -> DataFrame:
    """Rows per key and kind, one column per kind, in one pass."""
    return df.groupBy(key).agg(*[F.count_if(F.col(kind) == value).alias(name) for name, value in kinds.items()])


def action_counts(
    df: DataFrame, kinds: dict[str, Column], key: str = "category", weight: str | None = None
) -> DataFrame:
    """Count keys that each row names per kind, singly or as an array, in one shuffle.

    ``kinds`` maps a counter's name to an array column of keys. One row may raise several counters, by
    one or by its ``weight``, if rows are counts.
    """
    raised = F.col(weight) if weight else F.lit(1).cast("long")
    named = F.array(*[F.struct(F.lit(name).alias("kind"), keys.alias("keys")) for name, keys in kinds.items()])
    given = df.select(raised.alias("_n"), F.inline(named)).filter(F.col("keys").isNotNull())
    flat = given.select("_n", "kind", F.explode("keys").alias(key)).filter(F.col(key).isNotNull())
    per_kind = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("_n"))), F.lit(0).cast("long")).alias(k) for k in kinds]
    return flat.groupBy(key).agg(*per_kind)


def windowed_distinct(
    df: DataFrame, ts: str, size: str, col: str | Column, keys: Sequence[str] = (), name: str = "distinct"
) -> DataFrame:
    """Exact distinct values per tumbling window.

    Values are made unique per window first, so a hot value or window is spread before it is counted.
    """
    value = F.col(col) if isinstance(col, str) else col
    if df.isStreaming:
        first = df.groupBy(F.window(ts, size).alias("_u"), *keys, value.alias("_value")).agg(F.count("*"))
        unique = first.withColumn("_w", F.window(F.window_time("_u"), size))
    else:
        unique = df.select(F.window(ts, size).alias("_w"), *keys, value.alias("_value")).distinct()
    counted = unique.groupBy("_w", *keys).agg(F.count("_value").alias(name))
    return counted.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, name)


def bitmap_distinct(
    df: DataFrame,
    ts: str,
    size: str,
    col: str,
    seed: int = 61,
    bits: int = 29,
    keys: Sequence[str] = (),
    name: str = "distinct",
) -> DataFrame:
    """Distinct values per window as one hash into a bitmap of 2^bits sees them: collisions count once."""
    offset = poly_hash(F.col(col).cast("string"), seed, bits)
    return windowed_distinct(df, ts, size, offset, keys, name)


def approx_distinct(df: DataFrame, keys: Sequence[str], col: str, rsd: float = 0.02, name: str = "distinct") -> DataFrame:
    """Distinct values per key by a sketch of fixed size."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(col, rsd).alias(name))


def sketch_panes(df: DataFrame, ts: str, size: str, every: str, col: str, keys: Sequence[str] = (), lg: int = 12) -> DataFrame:
    """A sketch of the distinct values of each pane of a sliding window and key, of at most 2^lg bytes.

    A pane is as long as the greatest length that divides both ``size`` and ``every``. Sketches of the same
    pane from several batches may stand side by side, also a replayed batch's: a union counts a value once.
    Panes of nothing but nulls have an empty sketch; rows without a time are in no pane.
    """
    pane = f"{math.gcd(micros(size), micros(every))} microseconds"
    made = df.groupBy(F.window(ts, pane).alias("_pane"), *keys).agg(F.hll_sketch_agg(col, lg).alias("sketch"))
    return made.select(F.col("_pane.start").alias("pane_start"), *keys, "sketch")


def distinct_of_panes(panes: DataFrame, size: str, every: str, keys: Sequence[str] = (), name: str = "distinct") -> DataFrame:
    """The distinct values of each sliding window over ``sketch_panes``, off by 1.04 / 2^(lg/2) in one deviation.

    Panes are united first, so that what is copied into the windows that cover it is one sketch a pane and key.
    """
    united = panes.groupBy("pane_start", *keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    windows = united.groupBy(F.window("pane_start", size, every).alias("_w"), *keys)
    counted = windows.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
    return counted.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, name)


def with_metrics(df: DataFrame, name: str = "metrics", **aggs: Column) -> tuple[DataFrame, Observation]:
    """Count on the side: the observation holds the values after the first action on the table."""
    seen = Observation(name)
    return df.observe(seen, *[agg.alias(n) for n, agg in aggs.items()]), seen
