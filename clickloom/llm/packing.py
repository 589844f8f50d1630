"""Packing of documents into token sequences of a fixed length, by bin completion.

All that the packing depends on is how many pieces there are of each length, and there are never more
lengths than tokens in a sequence. So the search runs over that histogram on the driver, whatever the
size of the corpus, and says how often each filling is used. Pieces find their place by their rank
among the pieces of their length, which Spark counts.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm import arrays as A
from clickloom.llm.shared import staged
from clickloom.llm.token_files import with_end
from clickloom.llm.tokens import STEP_BYTES, encoder

#: A filling: lengths in falling order, and how many sequences are filled that way.
Filling = tuple[tuple[int, ...], int]


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing on a histogram: each length goes to the fullest sequences that still take it."""
    open_bins: dict[int, list[list]] = {}  # room -> [lengths so far, number]
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_bins if r >= size), default=None)
            if room is None:
                each = capacity // size  # copies that a new sequence takes
                whole, rest = divmod(left, each)
                for lengths, number in (((size,) * each, whole), ((size,) * rest, int(rest > 0))):
                    if number:
                        open_bins.setdefault(capacity - sum(lengths), []).append([lengths, number])
                break
            lengths, number = open_bins[room].pop()
            used = min(number, left)
            if used < number:
                open_bins[room].append([lengths, number - used])
            if not open_bins[room]:
                del open_bins[room]
            open_bins.setdefault(room - size, []).append([(*lengths, size), used])
            left -= used
    return [(tuple(lengths), number) for bins in open_bins.values() for lengths, number in bins]


def fewest_possible(counts: np.ndarray) -> int:
    """A number of sequences that no packing of the histogram gets below.

    Pieces over half the capacity need a sequence each, and what these leave only takes so many tokens of
    the smaller ones. The smallest pieces up to each length are left out in turn, as are the sequences of
    pieces that no other one fits beside (Martello and Toth).
    """
    capacity = len(counts) - 1
    half = capacity // 2
    number, tokens = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    k = np.arange(1, half + 1)  # the smallest length that counts
    big = int(number[-1] - number[half])
    inside = big - (number[-1] - number[capacity - k])  # over half, and with room for a piece of k
    room = inside * capacity - (tokens[capacity - k] - tokens[half])
    over = tokens[half] - tokens[k - 1] - room
    return max(big + int(np.maximum(-(-over // capacity), 0).max(initial=0)), -(-int(tokens[-1]) // capacity))


def completions(counts: np.ndarray, room: int) -> Iterator[tuple[int, ...] | None]:
    """All undominated ways to fill ``room`` from the histogram: the least waste first, then the largest pieces.

    Which sums the smaller lengths reach is kept as one bit a sum after each length, so any number of
    pieces of any length is found without trying those that lead nowhere. A filling is dominated if
    something still fits, or if one of its lengths can be exchanged for a larger one that is there: the
    other sequence could only win by taking the smaller one instead. For such a one None is given, so that
    the caller can count it; the first filling is never one.
    """
    have = (np.flatnonzero(counts[1 : room + 1]) + 1).tolist()
    number = [int(counts[x]) for x in have]
    every = (1 << room + 1) - 1
    below = [1]  # the sums that the lengths before each one reach
    for x, n in zip(have, number, strict=True):
        sums, n, step = below[-1], min(n, room // x), 1
        while n and sums != every:
            use = min(step, n)
            sums |= sums << use * x & every
            n, step = n - use, 2 * step
        below.append(sums)

    def fill(first: int, rest: int) -> Iterator[tuple[int, ...]]:
        if not rest:
            yield ()
            return
        for k in range(min(first, bisect_right(have, rest)) - 1, -1, -1):
            if not below[k + 1] >> rest & 1:
                return
            x = have[k]
            for n in range(min(number[k], rest // x), 0, -1):
                if below[k] >> rest - n * x & 1:
                    for more in fill(k, rest - n * x):
                        yield (*(x,) * n, *more)

    def dominated(lengths: tuple[int, ...], waste: int) -> bool:
        if not waste:
            return False
        spare = counts.copy()
        np.subtract.at(spare, list(lengths), 1)
        return bool((spare[1 : waste + 1] > 0).any()) or any((spare[x + 1 : x + waste + 1] > 0).any() for x in set(lengths))

    for total in range(room, -1, -1):
        if below[-1] >> total & 1:
            for lengths in fill(len(have), total):
                yield None if dominated(lengths, room - total) else lengths


def pack_lengths(counts: dict[int, int], capacity: int, nodes: int | None = None) -> list[Filling]:
    """Fillings that use every length as often as it is there, in as few sequences as the search finds.

    Bin completion: the largest length left is completed by undominated fillings, the best first, and
    a filling is used as often as the histogram allows first, then half as often, down to once. A branch
    is cut when its sequences and the bound on what is left reach the best packing so far, which starts
    as best-fit decreasing. The search ends when that packing meets the bound, when all
    has been tried, or after ``nodes`` fillings. A complete packing takes no more of these than there are
    lengths if each is used as often as it can be, so unless ``nodes`` is given there are four times as
    many as lengths, and 1,500 at least. Dominated fillings count too.
    """
    counts = {int(s): int(n) for s, n in counts.items() if n > 0}
    if any(s < 1 or s > capacity for s in counts):
        raise ValueError("lengths must be between 1 and the capacity")
    nodes = max(1_500, 4 * len(counts)) if nodes is None else nodes
    best = best_fit(counts, capacity)
    n_best = sum(n for _, n in best)
    left = np.zeros(capacity + 1, np.int64)
    for s, n in counts.items():
        left[s] = n
    least = fewest_possible(left)
    taken: list[Filling] = []
    # A level holds the fillings still to try; taking one opens the next level.
    levels: list[Iterator[Filling]] = []

    def options() -> Iterator[Filling]:
        top = int(np.flatnonzero(left)[-1])

        def fills() -> Iterator[tuple[int, ...] | None]:
            rest = left.copy()
            rest[top] -= 1
            return completions(rest, capacity - top)

        def uses(fill: tuple[int, ...] | None) -> Iterator[Filling]:
            if fill is None:
                yield (), 0
                return
            lengths = (top, *fill)
            use, each = np.unique(lengths, return_counts=True)
            times = int((left[use] // each).min())
            while times:
                yield lengths, times
                times //= 2

        # Most levels are asked once. The sums are made again for the others, not held in every level.
        yield from uses(next(fills()))
        for fill in islice(fills(), 1, None):
            yield from uses(fill)

    n_taken = 0
    levels.append(options() if left.any() else iter(()))
    while levels and nodes > 0 and n_best > least:
        filling = next(levels[-1], None)
        if filling is None:
            levels.pop()
            if taken and levels:
                lengths, times = taken.pop()
                n_taken -= times
                np.add.at(left, list(lengths), times)
            continue
        nodes -= 1
        lengths, times = filling
        if not times:
            continue
        np.subtract.at(left, list(lengths), times)
        if n_taken + times + fewest_possible(left) >= n_best:
            np.add.at(left, list(lengths), times)
            continue
        taken.append(filling)
        n_taken += times
        if left.any():
            levels.append(options())
        else:
            best, n_best = list(taken), n_taken
            levels.append(iter(()))
    return best


@dataclass(frozen=True)
class Places:
    """For each length, in order: ranks from ``rank`` on go to sequences from ``sequence`` on, ``each`` to a sequence."""

    size: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, fillings: list[Filling]) -> Places:
        rows, used, sequence = [], {}, 0
        for lengths, times in fillings:
            use, each = np.unique(lengths, return_counts=True)
            offset = 0
            for s, k in zip(use[::-1].tolist(), each[::-1].tolist(), strict=True):
                rows.append((s, used.get(s, 0), sequence, k, offset))
                used[s] = used.get(s, 0) + k * times
                offset += s * k
            sequence += times
        rows.sort()
        return cls(*(np.array([r[i] for r in rows], np.int64) for i in range(5)))

    def look_up(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence of each piece and its place there."""
        order = np.lexsort((rank, size))
        at = np.empty(len(size), np.int64)
        starts = np.concatenate((self.size, size[order])), np.concatenate((self.rank, rank[order]))
        merged = np.lexsort((np.concatenate((np.zeros(len(self.size)), np.ones(len(size)))), starts[1], starts[0]))
        before = np.cumsum(merged < len(self.size)) - 1
        of_piece = merged >= len(self.size)
        at[order[merged[of_piece] - len(self.size)]] = before[of_piece]
        after = rank - self.rank[at]
        return self.sequence[at] + after // self.each[at], self.offset[at] + after % self.each[at] * size


PIECES = "part int, doc_id long, row long, piece int, start long, length long, ids_crc32 long, local long"


def _cut_pieces(path: str, capacity: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, row0 = encoder(path), TaskContext.get().partitionId(), 0
        seen = np.zeros(capacity + 1, np.int64)  # pieces of each length that this task has met
        for batch in batches:
            for some in A.slices(batch, "text", STEP_BYTES):
                flat, first = with_end(*encode.ids(A.texts_of(some.column("text"))), end_id)
                size = np.diff(first)
                number = -(-size // capacity)
                text = np.repeat(np.arange(len(size)), number)
                piece = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
                short = size - (number - 1) * capacity  # the first piece takes what is over
                start = np.where(piece > 0, short[text] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, short[text])
                raw = flat.astype("<u4")
                crc = [zlib.crc32(raw[a : a + n].tobytes()) for a, n in zip(first[text] + start, length, strict=True)]
                order = np.argsort(length, kind="stable")
                edges = A.group_edges(length[order])
                local = np.empty(len(text), np.int64)
                local[order] = np.arange(len(text)) - np.repeat(edges[:-1], np.diff(edges)) + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(text), part), pa.int32()),
                        some.column("doc_id").take(pa.array(text)),
                        pa.array(row0 + text, pa.int64()),
                        pa.array(piece, pa.int32()),
                        *(pa.array(c, pa.int64()) for c in (start, length, crc, local)),
                    ],
                    names=["part", "doc_id", "row", "piece", "start", "length", "ids_crc32", "local"],
                )
                row0 += len(size)

    return cut


def _place(places: Places):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.look_up(np.asarray(batch.column("length")), np.asarray(batch.column("rank")))
            columns = [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return place


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Place every document in a sequence of at most ``capacity`` tokens, in as few sequences as found.

    A document is its ids and ``end_id``. One that is longer is cut into pieces of ``capacity`` tokens,
    of which the first may be shorter. Returns a row for each piece: ``doc_id``, ``piece`` from 0,
    ``start`` in the document, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` in the sequence.

    A null text is empty, its only id is ``end_id``. Null and equal document ids are kept, each row is a
    document of its own. Other columns do not come back, whatever their names. An empty table gives an
    empty result. Among pieces of one length it makes no difference which goes where.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Written, so that every later step sees the same pieces with the same numbers.
    pieces = staged(texts.mapInArrow(_cut_pieces(tokenizer, capacity, end_id), PIECES))
    # One number for each task and length, and for each length.
    here = staged(pieces.groupBy("part", "length").count())
    counts = {r["length"]: r["n"] for r in here.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    places = Places.of(pack_lengths(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = here.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local"))
    return ranked.mapInArrow(
        _place(places),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
