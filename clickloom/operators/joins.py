"""Lookups, cogroups, interval joins and two-sided reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.matching import in_pieces, match_in_pieces, open_at_start
from clickloom.times import interval, micros, position

#: Bytes of a table that may be broadcast, as Spark keeps rows: eight for a number and more for texts.
BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> int:
    """Bytes that a row of ``df`` takes in memory, by Spark's own estimate for its types."""
    return int(df._jdf.queryExecution().analyzed().schema().defaultSize()) + 8


def broadcast_if_small(
    df: DataFrame, max_bytes: int = BROADCAST_BYTES, rows_of: DataFrame | None = None
) -> DataFrame:
    """Hint a broadcast after finding that ``df`` is small in bytes; otherwise the join may shuffle.

    Texts are counted with their true lengths where ``df`` itself is counted. ``rows_of`` is counted in
    its place: a table that is cheaper to count and has no fewer rows.
    """
    if df.isStreaming:
        return df
    if rows_of is not None:
        size = rows_of.count() * row_bytes(df)
    else:
        texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
        fixed = row_bytes(df.select(*[f"`{f.name}`" for f in df.schema if f.dataType.typeName() not in ("string", "binary")]))
        size = df.agg(F.sum(reduce(lambda a, b: a + b, texts, F.lit(fixed + 8 * len(texts))).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, default, name: str | None = None) -> DataFrame:
    """Add the value a small table holds for the key, or ``default``. ``dim`` has one row per key."""
    side = dim.select(F.col(key).alias("_dim_key"), F.col(value).alias("_dim_value"))
    joined = df.join(broadcast_if_small(side), F.col(key) == F.col("_dim_key"), "left")
    return joined.withColumn(name or value, F.coalesce("_dim_value", F.lit(default))).drop("_dim_key", "_dim_value")


class Dim(NamedTuple):
    """A dimension: its table, the fact's column, its own key, and what to count for its size."""

    table: DataFrame
    column: str
    key: str
    rows_of: DataFrame | None = None


def _left_joins(fact: DataFrame, dims: Sequence[Dim]) -> DataFrame:
    return reduce(lambda out, d: out.join(d.table, F.col(d.column) == F.col(d.key), "left"), dims, fact)


def _checked(dims: Sequence[Dim]) -> list[Dim]:
    return [d._replace(table=broadcast_if_small(d.table, rows_of=d.rows_of)) for d in dims]


def star_left_join(fact: DataFrame, dims: Sequence[Dim]) -> DataFrame:
    """Left join dimensions, each with one row per key.

    Small dimensions are broadcast; for others the fact is shuffled, and the runtime splits the
    partitions of its hot keys.
    """
    return _left_joins(fact, _checked(dims))


def star_counts(fact: DataFrame, dims: Sequence[Dim], keep: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Left join dimensions to the fact's key and ``keep`` columns, with rows counted in ``name``.

    When every dimension can be broadcast the fact is joined as it is, each row counting 1. Otherwise
    its combinations of these columns are counted first, so that the joins shuffle each one once and a
    hot key is no longer hot. Sum ``name`` to count rows.
    """
    sides = _checked(dims)
    columns = [*keep, *[d.column for d in dims]]
    if all(side.table is not dim.table for side, dim in zip(sides, dims)):
        rows = fact.select(*columns, F.lit(1).cast("long").alias(name))
    else:
        rows = fact.groupBy(*columns).agg(F.count("*").alias(name))
    return _left_joins(rows, sides)


def cogroup_counts(tables: dict[str, DataFrame], key: str, weight: str | None = None) -> DataFrame:
    """Rows per key of several tables side by side, 0 where a table lacks the key.

    Every table is counted before the join, so the join sees one row per key. ``weight`` is added up
    where rows are counts.
    """
    n = F.sum(weight) if weight else F.count("*")
    counted = [df.groupBy(key).agg(n.alias(name)) for name, df in tables.items()]
    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), counted)
    return joined.fillna(0, list(tables))


def _bounds(lts: str, rts: str, lo: str, hi: str) -> Column:
    return F.col(rts).between(F.col(lts) + interval(micros(lo)), F.col(lts) + interval(micros(hi)))


def _keys_equal(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_r_{k}") for k in keys])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    lts: str,
    rts: str,
    lo: str,
    hi: str,
    how: str = "inner",
) -> DataFrame:
    """Join rows of equal keys with ``rts`` in [``lts`` + lo, ``lts`` + hi], both ends included.

    Time buckets as wide as the interval become part of the equi key. A right row is written to the
    at most two buckets whose left rows it can meet, a left row to one, so a hot key is spread over its
    buckets and only neighbours in time are compared. ``how`` may be inner, left, right, left_semi or
    left_anti. As a left row is in one bucket only, that bucket tells whether it has a partner; for right
    the sides change places. Streams need a watermark on both sides and go by buckets as well; there a row
    without a partner comes out once the watermarks have passed its interval, and left_anti is unknown.
    """
    if how == "right":
        swapped = interval_join(right, left, keys, rts, lts, _negative(hi), _negative(lo), "left")
        return swapped.select(*keys, *[c for c in (*left.columns, *right.columns) if c not in keys])
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"interval_join does not support {how!r}")
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = _keys_equal(keys) & _bounds(lts, rts, lo, hi)
    width = max(micros(hi) - micros(lo), 1)
    l_bucket = F.floor(position(left, lts) / width)
    r_pos = position(renamed, rts)
    first, last = F.floor((r_pos - micros(hi)) / width), F.floor((r_pos - micros(lo)) / width)
    spread = renamed.withColumn("_r_bucket", F.explode(F.sequence(first, last)))
    joined = left.withColumn("_bucket", l_bucket).join(spread, on & (F.col("_bucket") == F.col("_r_bucket")), how)
    return joined.drop("_bucket", "_r_bucket", *[f"_r_{k}" for k in keys])


def _negative(duration: str) -> str:
    return f"{-micros(duration)} microseconds"


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    lts: str,
    rts: str,
    tolerance: str,
    reaches: int | None = None,
) -> DataFrame:
    """Match rows one to one: each is used up by its first partner within ``tolerance``.

    The rows of both sides of a key are taken in time order, at equal times left ones first, then by
    their other columns. A row meets the earliest open row of the other side that is no further back
    than the tolerance, or stays open itself. ``status`` is ``matched``, ``left_only`` or ``right_only``;
    columns of a missing partner are null. A row without a time meets nobody, null keys are a key of their
    own. ``interval_join`` gives all pairs; ``streaming.stateful.reconcile`` is the form for streams.

    A key is cut into pieces of time, ``reaches`` tolerances long (64 unless given, 3 at least), which are
    matched by themselves (see ``operators.matching``). So a key spreads over tasks however long it goes on
    without a pause; a task's smallest unit is a piece, of which it holds the rows of one tolerance.
    """
    reach = micros(tolerance)
    width = max(3, reaches or 64) * max(reach, 1)
    l_cols, r_cols = ([c for c in df.columns if c not in keys] for df in (left, right))
    none_l = F.lit(None).cast(left.select(F.struct(*l_cols).alias("x")).schema["x"].dataType)
    none_r = F.lit(None).cast(right.select(F.struct(*r_cols).alias("x")).schema["x"].dataType)
    sides = [
        df.select(*keys, position(df, ts).alias("_us"), F.lit(side).alias("_side"), l.alias("_l"), r.alias("_r"))
        for df, ts, side, l, r in (
            (left, lts, 0, F.struct(*l_cols), none_r),
            (right, rts, 1, none_l, F.struct(*r_cols)),
        )
    ]
    both = sides[0].unionByName(sides[1])
    pieces = in_pieces(both.filter(F.col("_us").isNotNull()), width, reach)
    starts = open_at_start(pieces, keys, reach).withColumn("_side", F.lit(-1))
    ordered = (
        pieces.unionByName(starts, allowMissingColumns=True)
        .repartition(*keys, "_piece")
        .sortWithinPartitions(*keys, "_piece", F.col("_us").asc_nulls_first(), "_side", "_l", "_r")
    )
    out = T.StructType([T.StructField(c, both.schema[c].dataType) for c in (*keys, "_l", "_r")]).add("status", T.StringType())
    matched = ordered.mapInArrow(match_in_pieces(list(keys), reach), out)
    untimed = both.filter(F.col("_us").isNull()).select(
        *keys, "_l", "_r", F.when(F.col("_side") == 0, "left_only").otherwise("right_only").alias("status")
    )
    return matched.unionByName(untimed).select(
        *keys, *[F.col("_l")[c].alias(c) for c in l_cols], *[F.col("_r")[c].alias(c) for c in r_cols], "status"
    )
