"""Fill-in-the-middle over texts that are kept as seekable compressed frames.

A text is stored as independent zstandard frames of a fixed number of code points, with the number of
code points up to the end of each. A cut finds its frame in these numbers; that frame alone is
decompressed and becomes two, all others are handed on as they are. Frames one after the other are a
zstandard stream again, so a formatted text is the frames of its parts in another order, with a small
frame for each sentinel between them. Digests stream the frames in order; a text is never put together.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.llm import arrays as A

#: Code points of a frame, which bound what is decompressed at a time.
FRAME_UNITS = 1 << 15
#: Bytes of frames after which a task hands its rows on.
STEP_BYTES = 4 << 20

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The order of the parts in each form, by the sentinel in front of them.
ORDER = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _open(frame: bytes) -> bytes:
    return _codec()[1].decompress(frame)


def _starts(text: bytes) -> np.ndarray:
    """Where each code point begins. Bytes that go on a character are not counted, valid or not."""
    raw = np.frombuffer(text, np.uint8)
    return np.flatnonzero((raw & 0xC0) != 0x80)


@dataclass(frozen=True)
class Frames:
    """``until[i]``: code points up to the end of ``data[i]``."""

    until: list[int]
    data: list[bytes]

    @classmethod
    def of(cls, text: bytes, units: int = FRAME_UNITS) -> Frames:
        starts = _starts(text)
        ends = [*range(units, len(starts), units), len(starts)] if len(starts) else []
        if not ends and text:
            ends = [0]  # no code point begins in it
        edges = [0, *(int(starts[e]) for e in ends[:-1]), len(text)]
        press = _codec()[0].compress
        return cls(ends, [press(text[a:b]) for a, b in zip(edges, edges[1:])] if ends else [])

    @property
    def units(self) -> int:
        return self.until[-1] if self.until else 0

    def cut(self, at: int) -> tuple[Frames, Frames]:
        """The first ``at`` code points and the rest. Only the frame that the cut goes through is opened."""
        i = bisect_left(self.until, at)
        before = self.until[i - 1] if i else 0
        if i == len(self.until):
            return self, Frames([], [])
        if at == before:
            return Frames(self.until[:i], self.data[:i]), self._behind(i, at)
        if at == self.until[i]:
            return Frames(self.until[: i + 1], self.data[: i + 1]), self._behind(i + 1, at)
        text = _open(self.data[i])
        middle = int(_starts(text)[at - before])
        press = _codec()[0].compress
        left = Frames([*self.until[:i], at], [*self.data[:i], press(text[:middle])])
        return left, Frames([u - at for u in self.until[i:]], [press(text[middle:]), *self.data[i + 1 :]])

    def _behind(self, i: int, at: int) -> Frames:
        return Frames([u - at for u in self.until[i:]], self.data[i:])

    def __add__(self, other: Frames) -> Frames:
        return Frames([*self.until, *(self.units + u for u in other.until)], [*self.data, *other.data])

    def stream(self, first: int = 0, last: int | None = None) -> Iterator[bytes]:
        """The bytes from ``first`` up to ``last``; frames outside are not opened."""
        at = 0
        for frame in self.data:
            size = zstandard.frame_content_size(frame)
            if at + size > first and (last is None or at < last):
                yield _open(frame)[max(0, first - at) : None if last is None else last - at]
            at += size

    def find(self, mark: bytes, first: int = 0) -> int:
        """The first byte from ``first`` on at which ``mark`` stands, whatever frames it lies in; -1 if nowhere."""
        at, rest = first, b""
        for piece in self.stream(first):
            rest += piece
            found = rest.find(mark)
            if found >= 0:
                return at + found
            keep = min(len(rest), len(mark) - 1)
            at += len(rest) - keep
            rest = rest[len(rest) - keep :]
        return -1


def arrange(text: Frames, form: str, first: int, second: int) -> Frames:
    """The formatted text: parts up to ``first``, up to ``second`` and behind, in the order of ``form``."""
    if form == PLAIN:
        return text
    prefix, rest = text.cut(first)
    middle, suffix = rest.cut(second - first)
    out = Frames([], [])
    for mark in ORDER[form]:
        out = out + Frames.of(mark.encode()) + {PREFIX: prefix, MIDDLE: middle, SUFFIX: suffix}[mark]
    return out


def restore(output: Frames, form: str) -> Iterator[bytes]:
    """The text that was formatted, piece by piece, from the output alone."""
    if form == PLAIN:
        yield from output.stream()
        return
    marks = ORDER[form]
    at = [output.find(marks[0].encode())]
    for mark in marks[1:]:
        at.append(output.find(mark.encode(), at[-1] + len(mark)))
    if at[0] != 0 or min(at) < 0:
        raise ValueError(f"not a text of the form {form}")
    ends = [*at[1:], None]
    part = {mark: (a + len(mark), b) for mark, a, b in zip(marks, at, ends, strict=True)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.stream(*part[mark])


def sha256_of(pieces: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


_STORED = [T.StructField("until", T.ArrayType(T.LongType())), T.StructField("data", T.ArrayType(T.BinaryType()))]


def _in_steps(convert: Callable[[tuple], tuple[int, tuple]], schema: pa.Schema, keep: list[str], use: list[str]):
    """``convert`` turns the ``use`` columns of a row into bytes held and new columns; the ``keep`` columns go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = [f for f in schema if f.name not in keep]
        for batch in batches:
            kept, used = batch.select(keep), [batch.column(c) for c in use]
            start, held, rows = 0, 0, []
            for i in range(len(batch)):
                size, row = convert(tuple(c[i].as_py() for c in used))
                rows.append(row)
                held += size
                if held >= STEP_BYTES or i + 1 == len(batch):
                    columns = [pa.array(list(c), f.type) for f, c in zip(new, zip(*rows, strict=True), strict=True)]
                    part = {f.name: c for f, c in zip(new, columns, strict=True)}
                    part |= {c: kept.column(c).slice(start, len(rows)) for c in keep}
                    yield pa.RecordBatch.from_arrays([part[f.name] for f in schema], schema=schema)
                    start, held, rows = i + 1, 0, []
        pa.default_memory_pool().release_unused()

    return run


def to_frames(docs: DataFrame, text_col: str = "text", units: int = FRAME_UNITS) -> DataFrame:
    """The frame store: ``row`` (all columns of ``docs`` but the text), ``n``, ``until``, ``data``, ``marked``.

    ``n`` counts the text's code points. ``marked`` tells whether the text holds a sentinel itself. A null or
    empty text has no frames and no code points. Repeated rows stay, each with its own frames. An empty table
    gives an empty store. Other columns are in ``row``, so that no name can clash.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(others.alias("row"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    out = T.StructType([rows.schema["row"], T.StructField("n", T.LongType()), *_STORED, T.StructField("marked", T.BooleanType())])
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def convert(row: tuple) -> tuple[int, tuple]:
        (text,) = row
        frames = Frames.of(text, units)
        return sum(map(len, frames.data)), (frames.units, frames.until, frames.data, any(m in text for m in marks))

    return rows.mapInArrow(_in_steps(convert, to_arrow_schema(out), ["row"], ["text"]), out)


def drawn(id_col: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the digest of seed and id, the same on every run. A null id is an empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    store: DataFrame, id_col: str = "doc_id", seed: int = 1, transformed_percent: int = 90, spm_percent: int = 20
) -> DataFrame:
    """``row``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the output's frames ``until``, ``data``.

    Both cuts and the form depend on seed and id alone, so a row of a lost executor is made again as it was,
    and rows of one id and one length are cut alike. A text that is empty or holds a sentinel stays as it is
    (``plain``), as do those beyond ``transformed_percent``; ``prefix_chars`` and ``middle_chars`` are then null.
    Both cuts may fall together or at either end; the parts there are empty. An empty store gives no rows.
    """
    h = drawn(F.col(f"row.`{id_col}`"), seed)
    cuts = [x % (F.col("n") + 1) for x in h[:2]]
    plain = (F.size("data") == 0) | F.col("marked") | (h[2] % 100 >= transformed_percent)
    form = F.when(plain, PLAIN).when(h[3] % 100 < spm_percent, SPM).otherwise(PSM)
    told = store.select("row", "n", "until", "data", form.alias("form"), F.least(*cuts).alias("first"), F.greatest(*cuts).alias("second"))

    def convert(row: tuple) -> tuple[int, tuple]:
        until, data, form, first, second = row
        output = arrange(Frames(until, data), form, first, second)
        return sum(map(len, output.data)), (output.until, output.data)

    used = ["until", "data", "form", "first", "second"]
    cut = F.col("form") != PLAIN
    told = told.withColumns({"prefix_chars": F.when(cut, F.col("first")), "middle_chars": F.when(cut, F.col("second") - F.col("first"))})
    kept = ["row", "n", "form", "prefix_chars", "middle_chars"]
    out = T.StructType([*(told.schema[c] for c in kept), *_STORED])
    return told.mapInArrow(_in_steps(convert, to_arrow_schema(out), kept, used), out)


def digests(outputs: DataFrame) -> DataFrame:
    """Adds ``output_sha256`` and ``restored_sha256``, the latter of the text rebuilt from output and form."""
    kept = [c for c in outputs.columns if c not in ("until", "data")]
    out = T.StructType([*(outputs.schema[c] for c in kept), *(T.StructField(n, T.StringType()) for n in ("output_sha256", "restored_sha256"))])

    def convert(row: tuple) -> tuple[int, tuple]:
        output = Frames(row[0], row[1])
        return 128, (sha256_of(output.stream()), sha256_of(restore(output, row[2])))

    return outputs.mapInArrow(_in_steps(convert, to_arrow_schema(out), kept, ["until", "data", "form"]), out)


def texts(outputs: DataFrame) -> DataFrame:
    """The formatted texts as strings in ``output``, for texts that fit a row; ``row`` and ``form`` as they are."""
    out = T.StructType([outputs.schema["row"], outputs.schema["form"], T.StructField("output", T.StringType())])

    def convert(row: tuple) -> tuple[int, tuple]:
        text = b"".join(Frames(row[0], row[1]).stream()).decode("utf-8", "replace")
        return len(text), (text,)

    return outputs.mapInArrow(_in_steps(convert, to_arrow_schema(out), ["row", "form"], ["until", "data"]), out)
