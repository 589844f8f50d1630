"""Tumbling, sliding and rolling windows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordered import HOT_ROWS, over_preceding
from clickloom.times import micros

# An aggregate by name, over a column: ("count", "*"), ("sum", "value"), ...
Aggs = dict[str, tuple[str, str | Column]]

_DIRECT = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}
_PANE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _bounds(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, *names)


def tumble(df: DataFrame, ts: str | Column, size: str, keys: Sequence[str], aggs: Aggs) -> DataFrame:
    """Aggregate per tumbling window and key; without keys all rows share a window."""
    columns = [_DIRECT[kind](col).alias(name) for name, (kind, col) in aggs.items()]
    return _bounds(df.groupBy(F.window(ts, size).alias("_w"), *keys).agg(*columns), keys, list(aggs))


def slide(
    df: DataFrame, ts: str, size: str, every: str, keys: Sequence[str], aggs: Aggs, updates: bool = False
) -> DataFrame:
    """Aggregate per sliding window and key.

    Rows are first aggregated into panes, as long as the greatest length that divides both ``size`` and
    ``every``, and only panes are copied into the windows that cover them: one copy per pane and key
    instead of size/every copies of each row. A stream in ``update`` mode may have only one
    aggregation, so ``updates`` gives up the panes: late rows then change a window as long as the
    watermark allows. For long windows use ``pane_counts`` and ``windows_of_panes``.
    """
    if updates:
        columns = [_DIRECT[kind](col).alias(name) for name, (kind, col) in aggs.items()]
        return _bounds(df.groupBy(F.window(ts, size, every).alias("_w"), *keys).agg(*columns), keys, list(aggs))

    pane = f"{math.gcd(micros(size), micros(every))} microseconds"
    parts: Aggs = {}
    for name, (kind, col) in aggs.items():
        if kind == "avg":
            parts[f"_sum_{name}"], parts[f"_count_{name}"] = ("sum", col), ("count", col)
        else:
            parts[name] = (kind, col)
    panes = df.groupBy(F.window(ts, pane).alias("_pane"), *keys).agg(
        *[_DIRECT[kind](col).alias(name) for name, (kind, col) in parts.items()]
    )
    merged = [_PANE[kind](name).alias(name) for name, (kind, _) in parts.items()]
    if df.isStreaming:
        window = F.window(F.window_time("_pane"), size, every)
        out = _bounds(panes.groupBy(window.alias("_w"), *keys).agg(*merged), keys, list(parts))
    else:
        covering = F.window(F.col("_pane.start"), size, every)
        out = _bounds(panes.groupBy(covering.alias("_w"), *keys).agg(*merged), keys, list(parts))
    results = [
        (F.col(f"_sum_{name}") / F.col(f"_count_{name}") if kind == "avg" else F.col(name)).alias(name)
        for name, (kind, _) in aggs.items()
    ]
    return out.select("window_start", "window_end", *keys, *results)


def pane_counts(df: DataFrame, ts: str, size: str, every: str, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per pane of a sliding window and key, for ``update`` mode: late rows change one pane, not all windows.

    Keep them in a keyed table by ``pane_start`` and the keys; ``windows_of_panes`` reads the windows.
    """
    pane = f"{math.gcd(micros(size), micros(every))} microseconds"
    counted = df.groupBy(F.window(ts, pane).alias("_pane"), *keys).agg(F.count("*").alias(name))
    return counted.select(F.col("_pane.start").alias("pane_start"), *keys, name)


def windows_of_panes(panes: DataFrame, size: str, every: str, keys: Sequence[str], name: str = "count") -> DataFrame:
    """The sliding windows over a table of ``pane_counts``."""
    covering = F.window("pane_start", size, every)
    return _bounds(panes.groupBy(covering.alias("_w"), *keys).agg(F.sum(name).alias(name)), keys, [name])


def rolling(
    df: DataFrame, part: Sequence[str], order: Sequence[str], n: int, aggs: Aggs, max_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Aggregates over the current row and the ``n`` rows before it."""
    return over_preceding(
        df,
        part,
        order,
        n,
        lambda w: {name: _DIRECT[kind](col).over(w.rowsBetween(-n, 0)) for name, (kind, col) in aggs.items()},
        max_rows=max_rows,
    )
