"""Row-wise transforms: words, routes, side outputs, unions of two schemas, block lists."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordered import HOT_ROWS, over_preceding


def explode_words(df: DataFrame, col: str, sep: str = " ", word: str = "word") -> DataFrame:
    """One row per word of ``col``; empty words are dropped."""
    words = F.split(F.col(col), re.escape(sep))
    return df.withColumn(word, F.explode(words)).filter(F.col(word) != "")


def route(df: DataFrame, rules: dict[str, Column], default: str | None = None, name: str = "route") -> DataFrame:
    """Name the first rule that holds; rows without one get ``default``."""
    chosen = F.lit(default).cast("string")
    for label, rule in reversed(rules.items()):
        chosen = F.when(rule, F.lit(label)).otherwise(chosen)
    return df.withColumn(name, chosen)


def select_routes(df: DataFrame, *labels: str, name: str = "route") -> DataFrame:
    """The rows of one or several routes, without the route column."""
    return df.filter(F.col(name).isin(*labels)).drop(name)


def side_output(df: DataFrame, to_side: Column) -> tuple[DataFrame, DataFrame]:
    """(main, side); a condition that is null keeps the row in the main output."""
    aside = F.coalesce(to_side, F.lit(False))
    return df.filter(~aside), df.filter(aside)


def co_map(
    a: DataFrame,
    b: DataFrame,
    map_a: Callable[[DataFrame], DataFrame],
    map_b: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Map two tables of different schemas into one; columns only one side has are null on the other."""
    return map_a(a).unionByName(map_b(b), allowMissingColumns=True)


def adjacent_pairs(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    col: str,
    names: tuple[str, str] = ("first", "second"),
    max_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Each value with the next one of its group; the last row of a group has no pair."""
    first, second = names
    slim = df.select(*part, *[c for c in order if c not in part], F.col(col).alias(first))
    # A null value still takes part in a pair, so the end of a group is told by the row, not the value.
    nxt = over_preceding(
        slim,
        part,
        order,
        1,
        lambda w: {"_next": F.lag(F.struct(F.col(first).alias("v"))).over(w)},
        reverse=True,
        max_rows=max_rows,
    )
    return nxt.filter(F.col("_next").isNotNull()).withColumn(second, F.col("_next.v")).drop("_next")


def exclude_keys(df: DataFrame, blocked: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is in the block list; rows without a key stay.

    The list is computed once, in the join; its true size decides at run time whether it is broadcast.
    """
    return df.join(blocked.select(key).distinct(), key, "left_anti")


def route_partitions(
    df: DataFrame, key: str, rules: dict[str, int], default: int, n: int, tasks_each: int = 1, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Send rows to the partition their key names; other keys go to ``default``.

    With ``tasks_each`` a partition is dealt to that many tasks, by the hash of ``spread_by`` (all columns
    by default): route ``r`` has the tasks from ``r * tasks_each`` on.
    """
    target = F.lit(default)
    for value, number in rules.items():
        target = F.when(F.col(key) == value, F.lit(number)).otherwise(target)
    part = F.pmod(F.xxhash64(*(spread_by or df.columns)), F.lit(tasks_each)).cast("int")
    return df.repartitionById(n * tasks_each, target * tasks_each + part)
