"""Benchmark decontamination by winnowing.

Of the grams of five words in each window of ten the one of the smallest hash is selected, once for all
the windows that share it. Whoever has a whole window in common has selected the same gram in it, so a join
of the selected grams of documents and benchmark finds every shared window, and every longer span. A hit
is then extended word by word on both sides, as far as a window reaches, and windows are what lies in
the extended span. Items of fewer than ten words are one window, whose hash is looked up as a whole.

Most of a corpus meets no benchmark. A bitmap of fixed size, with a bit for each benchmark
fingerprint, goes to all tasks and drops most grams before anything is shuffled. A benchmark of any
size fits: the fuller the bitmap, the more goes to the join, which decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import arrays as A
from clickloom.llm.bitmap import bitmap_of, passes
from clickloom.llm.shared import staged


#: What stands in a context where a text has no word; no two of these are equal.
_NO_WORD, _NO_ITEM_WORD = A.U(0), A.U(1)


def _hashes(texts: A.Texts) -> tuple[A.Words, np.ndarray]:
    """The words of texts and a hash of each."""
    lowered = A.Texts(A.LOWER[texts.data], texts.offsets, texts.null)
    words = A.words_of(lowered, A.ALNUM)
    return words, np.maximum(A.hash_spans(lowered.data, words.start, words.end), A.U(2))


def selected(words: A.Words, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the grams that winnowing selects, and their hashes: of each window the last of the smallest."""
    grams = A.rolling(hashes, gram)
    start = np.arange(max(0, len(hashes) - window + 1))
    start = start[start + window <= words.first[1:][words.text[start]]]
    at = start.copy()
    for k in range(1, window - gram + 1):
        at = np.where(grams[start + k] <= grams[at], start + k, at)
    at = np.unique(at)
    return at, A.mix(grams[at] + A.U(0x9E3779B97F4A7C15))  # small hashes, spread again


def _whole_windows(words: A.Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of ``n`` words, and their hashes."""
    h = A.rolling(hashes, n)
    start = np.arange(len(h))
    start = start[start + n <= words.first[1:][words.text[: len(h)]]]
    return start, A.mix(h[start] + A.U(n))


def _contexts(words: A.Words, hashes: np.ndarray, at: np.ndarray, before: int, width: int, none: np.uint64) -> list[bytes]:
    """The hashes of ``width`` words for each place, from ``before`` words before it; ``none`` beyond its text."""
    place = at[:, None] + np.arange(-before, width - before)
    text = words.text[at]
    there = (place >= words.first[text][:, None]) & (place < words.first[text + 1][:, None])
    out = np.where(there, hashes[np.clip(place, 0, max(len(hashes) - 1, 0))], none)
    return [row.tobytes() for row in out.astype("<u8")]


def _marked(words: A.Words, hashes: np.ndarray, n: int, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Places, marks, words of context before a place and in all. ``n`` 0: selected grams, else windows of ``n`` words."""
    if n:
        return *_whole_windows(words, hashes, n), 0, n
    return *selected(words, hashes, window, gram), window - gram, 2 * window - gram


_ITEM = "item string, n int, mark long, context binary"
_FOUND = "kind int, doc long, tie long, n_words long, start long, n int, mark long, context binary"
_SPANS = "doc long, tie long, start long, end long, n int, mark long, context binary"


def _item_marks(window: int, gram: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text", 1 << 20):
                words, hashes = _hashes(A.texts_of(part.column("text")))
                count = np.minimum(words.counts(), window)
                for size in sorted({int(c) for c in count if c}):
                    n = 0 if size == window > gram else size
                    at, mark, before, width = _marked(words, hashes, n, window, gram)
                    own = np.flatnonzero(count[words.text[at]] == size)
                    at, mark = at[own], mark[own]
                    columns = [pa.array(np.full(len(at), n), pa.int32()), pa.array(mark.view(np.int64)), pa.array(_contexts(words, hashes, at, before, width, _NO_ITEM_WORD), pa.binary())]
                    yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(words.text[at])), *columns], names=["item", "n", "mark", "context"])

    return cut


def _doc_marks(window: int, gram: int, kinds: list[int], bitmap: np.ndarray):
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text"):
                words, hashes = _hashes(A.texts_of(part.column("text")))
                rows = part.num_rows
                none, nothing = pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary())
                stats = [pa.array([0] * rows, pa.int32()), part.column("doc"), part.column("tie"), pa.array(words.counts(), pa.int64()), none, pa.nulls(rows, pa.int32()), none, nothing]
                yield pa.RecordBatch.from_arrays(stats, names=names)
                for n in kinds:
                    at, mark, before, width = _marked(words, hashes, n, window, gram)
                    may = np.flatnonzero(passes(bitmap, mark))
                    at, mark = at[may], mark[may]
                    text, size = words.text[at], len(at)
                    of = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.ones(size), pa.int32()),
                            part.column("doc").take(of),
                            part.column("tie").take(of),
                            pa.nulls(size, pa.int64()),
                            pa.array(at - words.first[text], pa.int64()),
                            pa.array(np.full(size, n), pa.int32()),
                            pa.array(mark.view(np.int64)),
                            pa.array(_contexts(words, hashes, at, before, width, _NO_WORD), pa.binary()),
                        ],
                        names=names,
                    )

    return cut


def _extend(window: int, gram: int):
    """Each hit as the span of equal words around it, if a window fits in."""
    names = [f.split()[0] for f in _SPANS.split(", ")]

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, start = np.asarray(batch.column("n")), np.asarray(batch.column("start"))
            first, last = start.copy(), start + n
            fits = np.zeros(len(n), bool)
            for kind in np.unique(n):
                rows = np.flatnonzero(n == kind)
                mine, theirs = (np.frombuffer(b"".join(batch.column(c).take(pa.array(rows)).to_pylist()), "<u8").reshape(len(rows), -1) for c in ("context", "theirs"))
                same = mine == theirs
                if kind:
                    fits[rows] = same.all(1)
                    continue
                reach = window - gram
                left = np.cumprod(same[:, reach - 1 :: -1], 1).sum(1) if reach else np.zeros(len(rows), np.int64)
                right = np.cumprod(same[:, reach + gram :], 1).sum(1)
                fits[rows] = same[:, reach : reach + gram].all(1) & (left + gram + right >= window)
                first[rows], last[rows] = start[rows] - left, start[rows] + gram + right
            keep = np.flatnonzero(fits)
            rest = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([rest.column("doc"), rest.column("tie"), pa.array(first[keep]), pa.array(last[keep]), rest.column("n"), rest.column("mark"), rest.column("theirs")], names=names)

    return extend


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    gram: int = 5,
) -> DataFrame:
    """For each row of ``docs``: ``doc``, ``tie`` (a hash of the text), ``n_words``, ``n_hit``, ``items``.

    Words are lower-cased runs of letters, digits and all that is not ASCII. A window is ``window``
    consecutive words of an item; an item with fewer, but some, is one window. A word of a document is
    hit if it is inside any occurrence of a window. ``items`` are the sorted ids, as text, of the items
    with windows that occur.

    Null and empty texts have no words; a null item id is left out of ``items``, its words still hit.
    Null and equal document ids are told apart by their texts; equal rows get equal results. An empty
    benchmark hits nothing, an empty table gives an empty result. Other columns do not come back,
    whatever their names.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    marked = staged(items.mapInArrow(_item_marks(window, gram), _ITEM))
    place = ["n", "mark", "context"]  # of a fingerprint in an item; passages that items share are one
    marks = marked.select("n", "mark").distinct()
    kinds = sorted(r["n"] for r in marks.select("n").distinct().collect())  # ``window`` numbers at most
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("string").alias("text"))
    found = staged(texts.mapInArrow(_doc_marks(window, gram, kinds, bitmap_of(marks)), _FOUND), "kind")

    # Fingerprints are joined; words around them tell how far a hit goes.
    mine = found.filter("kind = 1").select("doc", "tie", "start", "n", "mark", "context").distinct()
    met = mine.join(marked.select("n", "mark", F.col("context").alias("theirs")).distinct(), ["n", "mark"])
    hits = staged(met.select("doc", "tie", "start", "n", "mark", "context", "theirs").mapInArrow(_extend(window, gram), _SPANS))
    spans = F.array_sort(F.collect_list(F.struct("start", "end")))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    union = F.aggregate(
        spans,
        none,
        lambda so_far, span: F.struct(
            (so_far["n"] + F.greatest(span["end"] - F.greatest(so_far["end"], span["start"]), F.lit(0))).alias("n"),
            F.greatest(so_far["end"], span["end"]).alias("end"),
        ),
    )
    covered = hits.select("doc", "tie", "start", "end").distinct().groupBy("doc", "tie").agg(union["n"].alias("n_hit"))
    named = hits.select("doc", "tie", *place).distinct().join(marked.filter("item IS NOT NULL"), place).select("doc", "tie", "item").distinct()
    items_of = named.groupBy("doc", "tie").agg(F.array_sort(F.collect_list("item")).alias("items"))
    both = F.col("c.doc").eqNullSafe(F.col("i.doc")) & (F.col("c.tie") == F.col("i.tie"))
    by_doc = covered.alias("c").join(items_of.alias("i"), both, "left").select("c.doc", "c.tie", "n_hit", "items")
    same = F.col("d.doc").eqNullSafe(F.col("h.doc")) & (F.col("d.tie") == F.col("h.tie"))
    return found.filter("kind = 0").alias("d").join(by_doc.alias("h"), same, "left").select(
        "d.doc",
        "d.tie",
        "d.n_words",
        F.coalesce("h.n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("h.items", F.array().cast("array<string>")).alias("items"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a hit word, with all their columns."""
    hit = find_contamination(docs, benchmark, id_col, text_col, **how).filter("n_hit > 0").select("doc", "tie")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("tie"))
    same = F.col("r.doc").eqNullSafe(F.col("h.doc")) & (F.col("r.tie") == F.col("h.tie"))
    return row.alias("r").join(hit.alias("h"), same, "left_anti").select("r.row.*")
