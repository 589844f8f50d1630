"""One-to-one matching in time order, spread over pieces of time.

Open rows of a key are always the last ones of one side: the earliest is used up first and expires first.
So all that a row must know of the past is one signed number, the count of open rows, positive for the left
side. A row first clips that number to the rows of each side within reach, then adds or takes one. Clipping
and adding compose: what a piece of time does to the number is ``min(max(d + add, low), high)``, three
numbers whatever its rows. Pieces are summed up by themselves, one walk over the summaries of a key tells
the number at the start of each piece, and pieces are then matched by themselves too.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: More open rows than a key can have.
_MANY = 1 << 62


def in_pieces(df: DataFrame, width: int, reach: int) -> DataFrame:
    """Rows by ``_us`` in pieces ``_piece`` of ``width``, with a copy in the next piece if they reach it.

    ``_halo`` marks the copies, ``_next`` the rows that have one. ``width`` must be above twice the reach.
    """
    number = "({0} - pmod({0}, {1}L)) div {1}L"
    first, last = F.expr(number.format("_us", width)), F.expr(number.format(f"(_us + {reach}L)", width))
    spread = df.withColumns({"_first": first, "_last": last}).withColumn("_piece", F.explode(F.sequence("_first", "_last")))
    return spread.withColumns({"_halo": F.col("_piece") > F.col("_first"), "_next": F.col("_last") > F.col("_piece")}).drop("_first", "_last")


def open_at_start(pieces: DataFrame, keys: Sequence[str], reach: int) -> DataFrame:
    """For each key and ``_piece`` the number ``_open`` of rows still open where it starts; negative for right ones."""
    by_piece = Window.partitionBy(*keys, "_piece").orderBy("_us", "_side")
    slim = pieces.select(*keys, "_piece", "_us", "_side", "_halo", F.row_number().over(by_piece).alias("_n"))
    long = [T.StructField(c, T.LongType()) for c in ("_add", "_low", "_high")]
    named = [T.StructField(c, slim.schema[c].dataType) for c in (*keys, "_piece")]
    summed = slim.mapInArrow(_sum_up([*keys, "_piece"], reach), T.StructType([*named, *long]))
    by_key = Window.partitionBy(*keys).orderBy("_piece")
    return summed.withColumn("_n", F.row_number().over(by_key)).mapInArrow(
        _carry([*keys, "_piece"]), T.StructType([*named, T.StructField("_open", T.LongType())])
    )


def _sum_up(names: list[str], reach: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        within: tuple[deque, deque] = (deque(), deque())  # times of each side's rows that are not out of reach
        heads, add, low, high, begun = None, 0, 0, 0, False

        def summed(done: list[tuple[int, int, int]]) -> list[pa.RecordBatch]:
            nonlocal heads
            out, heads = heads.slice(0, len(done)), heads.slice(len(done))
            for i, name in enumerate(("_add", "_low", "_high")):
                out = out.append_column(name, pa.array([d[i] for d in done], pa.int64()))
            return out.combine_chunks().to_batches()

        for batch in batches:
            place = batch.column("_n").to_numpy()
            first = pa.Table.from_batches([batch]).select(names).take(pa.array(np.flatnonzero(place == 1)))
            heads = first if heads is None else pa.concat_tables([heads, first])
            done = []
            columns = [batch.column(c).to_pylist() for c in ("_us", "_side", "_halo")]
            for n, us, side, halo in zip(place.tolist(), *columns, strict=True):
                if n == 1:
                    if begun:
                        done.append((add, low, high))
                    begun, add, low, high = True, 0, -_MANY, _MANY
                    within[0].clear()
                    within[1].clear()
                if not halo:
                    for times in within:
                        while times and times[0] < us - reach:
                            times.popleft()
                    least, most, step = -len(within[1]), len(within[0]), -1 if side else 1
                    low, high = min(max(low, least), most) + step, min(max(high, least), most) + step
                    add += step
                within[side].append(us)
            if done:
                yield from summed(done)
        if begun:
            yield from summed([(add, low, high)])

    return walk


def _carry(names: list[str]):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = 0
        for batch in batches:
            starts = []
            for n, add, low, high in zip(*(batch.column(c).to_pylist() for c in ("_n", "_add", "_low", "_high")), strict=True):
                now = 0 if n == 1 else now
                starts.append(now)
                now = min(max(now + add, low), high)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(starts, pa.int64())], [*names, "_open"])

    return walk


def match_in_pieces(keys: list[str], reach: int):
    """The walk over pieces in order, each led by a row of ``_side`` -1 that has ``_open``.

    Of the copies at a piece's start the last ``_open`` ones of their side are open. Rows open at its end
    that reach the next piece are told there, all others here, so each row is told once.
    """
    names = [*keys, "_l", "_r"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque = deque()  # (time, place in the rows at hand, reaches the next piece), all of one side
        held, open_side, wanted = None, 0, 0
        lefts: list[int | None] = []
        rights: list[int | None] = []

        def alone(place: int) -> None:
            lefts.append(None if open_side else place)
            rights.append(place if open_side else None)

        def end_piece() -> None:
            for _, place, later in waiting:
                if not later:
                    alone(place)
            waiting.clear()

        def told(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            if lefts:
                key_at = pa.array([r if l is None else l for l, r in zip(lefts, rights, strict=True)], pa.int64())
                status = ["right_only" if l is None else "left_only" if r is None else "matched" for l, r in zip(lefts, rights, strict=True)]
                out = rows.select(keys).take(key_at)
                out = out.append_column("_l", rows.column("_l").take(pa.array(lefts, pa.int64())))
                out = out.append_column("_r", rows.column("_r").take(pa.array(rights, pa.int64())))
                yield from out.append_column("status", pa.array(status, pa.string())).combine_chunks().to_batches()
                lefts.clear()
                rights.clear()

        for batch in batches:
            new = pa.Table.from_batches([batch])
            rows = (new.select(names) if held is None else pa.concat_tables([held, new.select(names)])).combine_chunks()
            base = 0 if held is None else held.num_rows
            columns = [batch.column(c).to_pylist() for c in ("_us", "_side", "_halo", "_next", "_open")]
            for place, (us, side, halo, later, now_open) in enumerate(zip(*columns, strict=True), base):
                if side < 0:
                    end_piece()
                    open_side, wanted = (1 if now_open < 0 else 0), abs(now_open)
                elif halo:
                    if side == open_side and wanted:
                        waiting.append((us, place, False))
                        if len(waiting) > wanted:
                            waiting.popleft()
                else:
                    while waiting and waiting[0][0] < us - reach:
                        alone(waiting.popleft()[1])
                    if waiting and open_side != side:
                        partner = waiting.popleft()[1]
                        lefts.append(partner if side else place)
                        rights.append(place if side else partner)
                    else:
                        open_side = side
                        waiting.append((us, place, later))
            yield from told(rows)
            held = rows.take(pa.array([place for _, place, _ in waiting], pa.int64())).combine_chunks()
            waiting = deque((us, i, later) for i, (us, _, later) in enumerate(waiting))
        if held is not None:
            end_piece()
            yield from told(held)

    return walk
