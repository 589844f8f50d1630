"""Numpy helpers for whole batches of texts: words, hashes, packed arrays. Used inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that the numpy steps take at a time; a longer text is taken alone.
SLICE_BYTES = 1 << 20
_PAD = 16

U = np.uint64


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true in the given closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words between blanks: all but 0x20 and 0x09 to 0x0D.
NOT_BLANK = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of letters and digits: all but 0x00-0x2F, 0x3A-0x60, 0x7B-0x7F (after lower-casing).
ALNUM = ~byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@lru_cache(maxsize=1)
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another libc
        return None


def trim() -> None:
    """Give memory that is free back to the system; a worker lives on for other stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc(), "malloc_trim"):
        _libc().malloc_trim(0)


@dataclass
class Texts:
    """Texts as one array of bytes; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``. Null is empty."""

    data: np.ndarray  # with _PAD zero bytes behind the last text
    offsets: np.ndarray
    null: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def texts_of(column: pa.Array | pa.ChunkedArray | Sequence) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not isinstance(column, pa.Array):
        column = pa.array(column, pa.large_string())
    null = np.asarray(column.is_null())
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else np.zeros(0, np.uint8)
    padded = np.zeros(len(raw) + _PAD, np.uint8)
    padded[: len(raw)] = raw
    return Texts(padded, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64), null)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows, so that each part has at most ``limit`` bytes of text or a single row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)
    trim()


@dataclass
class Words:
    """The words of ``Texts``: number of the text, first byte, byte behind the last."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # number of the first word of each text, and the total

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: Texts, table: np.ndarray) -> Words:
    """Maximal runs of bytes in ``table``; no word goes across texts."""
    n = int(texts.offsets[-1])
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = table[texts.data[:n]]
    opens = inside[1:] & ~inside[:-1]  # at byte i: i is inside, i - 1 is not
    closes = inside[:-1] & ~inside[1:]  # at byte i: i - 1 is inside, i is not
    cut = texts.offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    both = inside[cut] & inside[cut + 1]
    opens[cut[both]] = True
    closes[cut[both]] = True
    start, end = np.flatnonzero(opens), np.flatnonzero(closes)
    first = np.searchsorted(start, texts.offsets)
    return Words(np.repeat(np.arange(len(texts)), np.diff(first)), start, end, first)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others (the murmur3 finalizer)."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def _eights(data: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit number that starts at each byte."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)
_VECTOR_BYTES = 512


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    eights, length = _eights(data), end - start
    h = mix(length.astype(U) + U(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) + U(0x2545F4914F6CDD1D))
    at = 0
    rest = None  # all
    while True:
        s, n = (start, length) if rest is None else (start[rest], length[rest])
        word = eights[np.minimum(s + at, len(eights) - 1)] & _KEEP[np.clip(n - at, 0, 8)]
        if rest is None:
            h = mix(h ^ word)
        else:
            h[rest] = mix(h[rest] ^ word)
        at += 8
        rest = np.flatnonzero(length > at) if rest is None else rest[n > at]
        if not len(rest):
            return h
        if at >= _VECTOR_BYTES:
            break
    for i in rest:  # very long ones, one by one
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]], seed) ^ int(h[i])
    return h


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def rolling(values: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """The hash of every ``width`` consecutive values, by its first; shorter input gives none."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    base = _BASES[which]
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    return mix((total[width:] - total[:-width]) * powers(_inverse(base), n))


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers as runs of consecutive ones: first and length."""
    if not len(starts):
        return starts, starts
    edge = np.flatnonzero(np.diff(starts) != 1)
    first = np.concatenate(([0], edge + 1))
    return starts[first], np.diff(np.concatenate((first, [len(starts)])))


def group_edges(*columns: np.ndarray) -> np.ndarray:
    """Where a new group starts in sorted columns, and the total."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    change = np.zeros(n - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.concatenate(([0], np.flatnonzero(change) + 1, [n]))


def pack(*arrays: np.ndarray) -> bytes:
    """Number arrays as bytes: differences, laid out byte by byte, so that high bytes of small numbers compress away."""
    out = [np.array([len(arrays)], "<i8").tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        b = a.astype("<i8").view("<u8") if a.dtype.kind == "i" else a
        if a.dtype.kind == "i" and len(b):
            b = np.concatenate((b[:1], b[1:] - b[:-1]))
            b = (b << U(1)) ^ (U(0) - (b >> U(63)))  # small negative numbers are small too
        size = b.dtype.itemsize
        planes = np.ascontiguousarray(b).view(np.uint8).reshape(-1, size).T if len(b) else np.zeros((size, 0), np.uint8)
        used = max([i + 1 for i in range(size) if planes[i].any()], default=0)
        out += [np.array([len(b), size, used, a.dtype.kind == "i"], "<i8").tobytes(), planes[:used].tobytes()]
    return b"".join(out)


def unpack(packed: bytes) -> list[np.ndarray]:
    at, out = 8, []
    for _ in range(int(np.frombuffer(packed, "<i8", 1)[0])):
        n, size, used, signed = (int(x) for x in np.frombuffer(packed, "<i8", 4, at))
        at += 32
        planes = np.zeros((n, size), np.uint8)
        planes[:, :used] = np.frombuffer(packed, np.uint8, used * n, at).reshape(used, n).T
        at += used * n
        b = planes.view(f"<u{size}").reshape(n)
        if signed:
            b = (b >> U(1)) ^ (U(0) - (b & U(1)))
            b = np.cumsum(b, dtype=U).view(np.int64)
        out.append(b)
    return out


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Cuts the space of 64-bit hashes evenly; the lower half of a key is free for telling keys of a bucket apart."""
    return ((keys >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def spark_hash(ids: np.ndarray, buckets: int) -> np.ndarray:
    """``pmod(xxhash64(id), buckets)`` as Spark computes it for a long (the public xxHash64 of 8 bytes, seed 42)."""

    def turn(x: np.ndarray, by: int) -> np.ndarray:
        return (x << U(by)) | (x >> U(64 - by))

    p1, p2, p3, p4, p5 = (
        U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )
    x = ids.astype(np.int64).view(U)
    h = (U(42 + 8) + p5) ^ (turn(x * p2, 31) * p1)
    h = turn(h, 27) * p1 + p4
    h ^= h >> U(33)
    h *= p2
    h ^= h >> U(29)
    h *= p3
    h ^= h >> U(32)
    return h.view(np.int64) % buckets
