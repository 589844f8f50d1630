"""Ordered work per key that does not need one key to fit into one task.

Window functions put all rows of a key into one task. That is the right plan for nearly every key and
the wrong one for a key that holds a large part of the table. The functions here count rows per key
first. Keys above ``max_rows`` are cut into chunks at quantiles of their whole order, so that rows of
equal time are cut too; the window runs per (key, chunk), and what a chunk needs to know of earlier
ones comes in from the side: the last rows before it (``Ordered.look_back``) or the aggregate of all
earlier chunks (``Ordered.running``). Without a key all rows are one, and are always cut.

The result has the same columns and types either way.

Hot keys number at most rows/max_rows, and so do their chunks, which bounds the side tables that are
broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from clickloom.session import checkpointed

HOT_ROWS = 10_000_000
#: Rows of a chunk that are drawn to find where it ends.
DRAWN = 64

_CHUNK = "_chunk"
_HALO = "_halo"
_ALL = "_all_rows"

_FOLD: dict[str, Callable[..., Column]] = {"sum": F.sum, "min": F.min, "max": F.max}


def _join_keys(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a bounded side table on keys that may be null; the side's keys are dropped."""
    renamed = side.select(*[F.col(k).alias(f"_side_{k}") if k in keys else F.col(k) for k in side.columns])
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_side_{k}"))
    return df.join(F.broadcast(renamed), match, how).drop(*[f"_side_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """The keys above ``max_rows``; at most rows/max_rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > max_rows).select(*keys)


def split_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int, hot: DataFrame | None = None
) -> DataFrame | None:
    """Add ``_chunk``, null for keys of normal size; None when no key is above ``max_rows``.

    ``order`` must be a total order within each key, of any types that sort. Chunks are numbered in
    that order and have about ``max_rows`` rows. ``hot`` names the hot keys where they are known, and
    spares the count.
    """
    hot = checkpointed(hot_keys(df, keys, max_rows) if hot is None else hot.select(*keys).distinct())
    if hot.isEmpty():
        return None
    # The rows drawn are those of some hashes of their place in the order, so that every run draws the same.
    place = F.struct(*order)
    every = max(1, max_rows // DRAWN)
    per_chunk = max(1, max_rows // every)
    slim = df.select(*keys, *[c for c in order if c not in keys])
    drawn = _join_keys(slim, hot, keys, "inner").filter(F.pmod(F.xxhash64(*order), F.lit(every)) == 0)
    in_order = F.sort_array(F.collect_list(place))
    chosen = F.expr(f"transform(sequence({per_chunk}, size(_drawn), {per_chunk}), i -> _drawn[i - 1])")
    enough = F.size("_drawn") >= per_chunk
    bounds = drawn.groupBy(*keys).agg(in_order.alias("_drawn")).select(*keys, F.when(enough, chosen).alias("_bounds"))
    # A chunk ends before the bound that the next one starts with.
    passed = F.size(F.filter("_bounds", lambda b: b <= place))
    placed = _join_keys(df, checkpointed(_join_keys(hot.withColumn("_hot", F.lit(True)), bounds, keys)), keys)
    return placed.withColumn(_CHUNK, F.when(F.col("_hot"), F.when(F.col("_bounds").isNull(), 0).otherwise(passed))).drop(
        "_hot", "_bounds"
    )


def _sorts(order: Sequence[str], reverse: bool) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in order]


@dataclass(frozen=True)
class Ordered:
    """A table in key order, with hot keys cut into chunks once for all the steps that follow."""

    rows: DataFrame
    keys: list[str]
    order: list[str]
    split: bool

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        max_rows: int | None = HOT_ROWS,
        hot: DataFrame | None = None,
    ) -> Ordered:
        """``order`` must be a total order within each key; without keys all rows are one key.

        ``max_rows=None`` takes it as known that no key is hot. ``hot`` names the hot keys if known.
        """
        parts, whole = (list(keys), df) if keys else ([_ALL], df.withColumn(_ALL, F.lit(0)))
        chunked = None
        if max_rows is not None:
            if not keys:
                # Enough chunks for all tasks, however few rows there are.
                tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                max_rows = max(1, min(max_rows, -(-df.count() // tasks)))
                hot = df.sparkSession.range(1).select(F.lit(0).alias(_ALL))
            chunked = split_hot(whole, parts, order, max_rows, hot)
        if chunked is None:
            return cls(df, list(keys), list(order), False)
        return cls(chunked, parts, list(order), True)

    @property
    def _parts(self) -> list[str]:
        return [*self.keys, _CHUNK] if self.split else self.keys

    def _with(self, rows: DataFrame) -> Ordered:
        return Ordered(rows, self.keys, self.order, self.split)

    def table(self) -> DataFrame:
        return self.rows.drop(_CHUNK, _ALL)

    def filter(self, condition: Column | str) -> Ordered:
        return self._with(self.rows.filter(condition))

    def look_back(
        self, n: int, columns: Callable[[WindowSpec], dict[str, Column]], reverse: bool = False
    ) -> Ordered:
        """Add window columns that look back at most ``n`` rows in the key's order.

        ``columns`` gets the window and returns the new columns by name. ``reverse`` turns the order
        round, so ``lag`` then means the next row.
        """
        window = Window.partitionBy(*self._parts).orderBy(*_sorts(self.order, reverse))
        if not self.split:
            return self._with(self.rows.withColumns(columns(window)))

        # Each chunk is given the last n rows of the ones before it, which leave again afterwards.
        chunk_sort = F.col(_CHUNK).desc() if reverse else F.col(_CHUNK).asc()
        from_end = Window.partitionBy(*self._parts).orderBy(*_sorts(self.order, not reverse))
        ends = (
            self.rows.filter(F.col(_CHUNK).isNotNull())
            .withColumn("_from_end", F.row_number().over(from_end))
            .filter(F.col("_from_end") <= n)
        )
        row = F.struct(*[F.col(c) for c in self.rows.columns if c != _CHUNK])
        recent = Window.partitionBy(*self.keys).orderBy(chunk_sort, F.col("_from_end").desc())
        handed = (
            ends.withColumn("_row", row)
            .withColumn("_rows", F.collect_list("_row").over(recent.rowsBetween(1 - n, 0)))
            .filter(F.col("_from_end") == 1)
            .withColumn("_next", F.lead(_CHUNK).over(Window.partitionBy(*self.keys).orderBy(chunk_sort)))
            .filter(F.col("_next").isNotNull())
            .select(F.col("_next").alias(_CHUNK), F.explode("_rows").alias("_row"))
        )
        halo = handed.select("_row.*", _CHUNK, F.lit(True).alias(_HALO))
        both = self.rows.withColumn(_HALO, F.lit(False)).unionByName(halo)
        return self._with(both.withColumns(columns(window)).filter(~F.col(_HALO)).drop(_HALO))

    def running(
        self, folds: dict[str, tuple[str, Column]], reverse: bool = False, inclusive: bool = True
    ) -> Ordered:
        """Add running ``sum``, ``min`` or ``max`` columns from the key's first row on.

        ``inclusive=False`` leaves the current row out; ``reverse`` folds from the last row back. The
        last digits of a sum of doubles depend on where a hot key is cut; sum decimals if they matter.
        """
        here = Window.partitionBy(*self._parts).orderBy(*_sorts(self.order, reverse))
        here = here.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        out = self.rows.withColumns({name: _FOLD[kind](col).over(here) for name, (kind, col) in folds.items()})
        if not self.split:
            return self._with(out)

        # Each chunk is given the folds of all the ones before it.
        plain = {name: out.schema[name].dataType for name in folds}
        totals = (
            self.rows.filter(F.col(_CHUNK).isNotNull())
            .groupBy(*self._parts)
            .agg(*[_FOLD[kind](col).alias(f"_total_{name}") for name, (kind, col) in folds.items()])
        )
        chunk_sort = F.col(_CHUNK).desc() if reverse else F.col(_CHUNK).asc()
        earlier = Window.partitionBy(*self.keys).orderBy(chunk_sort).rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select(
            *self._parts,
            *[_FOLD[k](f"_total_{name}").over(earlier).alias(f"_in_{name}") for name, (k, _) in folds.items()],
        )
        out = _join_keys(out, carried, self._parts)
        merged = {
            name: _merge(kind, F.col(f"_in_{name}"), F.col(name)).cast(plain[name]) for name, (kind, _) in folds.items()
        }
        return self._with(out.withColumns(merged).drop(*[f"_in_{name}" for name in folds]))


def over_preceding(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    reverse: bool = False,
    max_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``Ordered.look_back`` as a single step."""
    return Ordered.of(df, keys, order, max_rows).look_back(n, columns, reverse).table()


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: dict[str, tuple[str, Column]],
    reverse: bool = False,
    inclusive: bool = True,
    max_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``Ordered.running`` as a single step."""
    return Ordered.of(df, keys, order, max_rows).running(folds, reverse, inclusive).table()


def _merge(kind: str, carried: Column, here: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carried + here, carried, here)
    return F.least(carried, here) if kind == "min" else F.greatest(carried, here)
