"""Changes of an aggregate between two states, and reuse of a computed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.windows import Aggs
from clickloom.session import checkpointed


def changelog(prev: DataFrame, cur: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that turn ``prev`` into ``cur``: ``added`` false takes a row back, true adds one.

    Both tables hold one row per key and the same columns.
    """
    values = [c for c in cur.columns if c not in keys]
    old = prev.select(*keys, F.struct(*values).alias("_old"))
    new = cur.select(*keys, F.struct(*values).alias("_new"))
    both = old.join(new, list(keys), "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    rows = F.array(
        F.struct(F.lit(False).alias("added"), F.col("_old").alias("row")),
        F.struct(F.lit(True).alias("added"), F.col("_new").alias("row")),
    )
    steps = both.select(*keys, F.inline(F.filter(rows, lambda r: r["row"].isNotNull())))
    return steps.select("added", *keys, *[F.col("row")[v].alias(v) for v in values])


def net_rows(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What a changelog leaves: each different row of ``columns`` with ``n``, how often it is there.

    Rows with ``added`` true count one, false minus one, in any order; rows that cancel out are gone. This is
    a multiset that adds up, so the net rows of parts of a changelog can be kept and summed. ``n`` is below
    zero for a row that was taken back more often than added.
    """
    counted = changes.groupBy(*columns).agg(F.sum(F.when(F.col("added"), 1).otherwise(-1)).alias("n"))
    return counted.filter(F.col("n") != 0)


def aggregate_net(net: DataFrame, keys: Sequence[str], aggs: Aggs) -> DataFrame:
    """``count``, ``sum``, ``avg``, ``min`` and ``max`` per key over ``net_rows``, as over the table itself.

    Counts and sums are weighted with ``n``; the least and the greatest value are those still there. Equal
    rows are one row here, so a hot key is no longer than its different values. A key whose rows have
    all been taken back is gone; nulls are left out as in any aggregate.
    """
    there = F.col("n") > 0
    columns = []
    for name, (kind, col) in aggs.items():
        value = F.lit(1) if col == "*" else F.col(col) if isinstance(col, str) else col
        n = F.sum(F.when(value.isNotNull(), F.col("n")))
        if kind == "count":
            out = F.coalesce(n, F.lit(0))
        elif kind in ("sum", "avg"):
            total = F.sum(value * F.col("n"))
            out = F.when(n != 0, total if kind == "sum" else total / n)
        elif kind in ("min", "max"):
            out = (F.min if kind == "min" else F.max)(F.when(there, value))
        else:
            raise ValueError(f"unknown aggregate: {kind!r}")
        columns.append(out.alias(name))
    out = net.groupBy(*keys).agg(*columns, F.sum("n").alias("_n"))
    return out.filter(F.col("_n") != 0).drop("_n")


def top_of_net(net: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """The ``n`` greatest values of each key over ``net_rows``, repeated ones as often as they are there.

    ``rank`` counts from 1. A task passes on at most ``n`` different values of a key. Nulls take no part.
    """
    there = net.filter((F.col("n") > 0) & F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum("n").alias("n"))
    greatest = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    few = there.withColumn("_place", F.row_number().over(greatest)).filter(F.col("_place") <= n)
    before = F.sum("n").over(greatest.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    ranked = few.withColumn("_before", before).filter(F.col("_before") < n)
    ranks = F.sequence(F.col("_before") + 1, F.least(F.col("_before") + F.col("n"), F.lit(n).cast("long")))
    return ranked.select(*keys, value, F.explode(ranks.cast("array<int>")).alias("rank"))


def materialize(df: DataFrame, how: str = "persist") -> DataFrame:
    """Keep a table that is used several times: ``persist`` or ``checkpoint``."""
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        return checkpointed(df)
    raise ValueError(f"unknown way to keep a table: {how!r}")
