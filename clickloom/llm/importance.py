"""Importance resampling towards a target distribution, on hashed counts of words and word pairs.

Words come from the tokenizers library's pre-tokenisation: a split by a regular expression, with nothing
trained, over text whose ASCII letters are lowered. It gives each word with its place; windows over these
places are the features, and the checksum of a feature's bytes is its bucket. A task adds up one histogram
of fixed size. What a bucket gains when it is frequent in the target and rare in the corpus is summed
over a document's features, and noise that depends on the document's id alone turns the order of the
weights into a draw without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.llm import arrays as A
from clickloom.llm.shared import staged

#: Words of letters, digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text in one step, and of a stretch that the library splits at a time.
STEP_BYTES = 2 << 20
STRETCH_BYTES = 1 << 20
_BETWEEN = ~A.ALNUM
_BETWEEN[0x41:0x5B] = False  # capitals are lowered before


@lru_cache(maxsize=1)
def _split():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


def _stretches(text: bytes) -> Iterator[tuple[int, bytes]]:
    """The text in stretches that end between words, so that the library's memory is bounded; a word stays whole."""
    at = 0
    while len(text) - at > STRETCH_BYTES:
        between = np.flatnonzero(_BETWEEN[np.frombuffer(text, np.uint8, offset=at + STRETCH_BYTES)])
        if not len(between):
            break
        end = at + STRETCH_BYTES + int(between[0])
        yield at, text[at:end]
        at = end
    yield at, text[at:]


def word_places(text: bytes) -> list[tuple[int, int]]:
    """First byte and end of each word; ``text`` is UTF-8 with its ASCII letters lowered."""
    from tokenizers import PreTokenizedString

    out: list[tuple[int, int]] = []
    for at, stretch in _stretches(text):
        if not stretch:
            continue
        told = PreTokenizedString(stretch.decode("utf-8", "surrogateescape"))
        _split().pre_tokenize(told)
        places = [s[1] for s in told.get_splits("original", "byte")]
        out += places if not at else [(a + at, b + at) for a, b in places]
    return out


def feature_hashes(text: bytes, longest: int) -> tuple[int, np.ndarray]:
    """The number of words, and the checksums of all runs of 1 to ``longest`` words joined by one space."""
    words = [text[a:b] for a, b in word_places(text)]
    runs = list(map(zlib.crc32, words))
    out = [runs]
    for n in range(1, longest):
        runs = list(map(zlib.crc32, words[n:], map(zlib.crc32, repeat(b" "), runs)))
        out.append(runs)
    return len(words), np.fromiter(chain.from_iterable(out), np.int64, sum(map(len, out)))


def _number(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(docs: DataFrame, buckets: int, longest: int, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs`` but the text), ``n_words``, ``n_features`` and the packed ``buckets`` of the features."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(others.alias("row"), F.col(text_col).cast("string").alias("text"))
    out = T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()), T.StructField("buckets", T.BinaryType())])
    schema, kind = to_arrow_schema(out), _number(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text", STEP_BYTES):
                found = []
                for text in pc.cast(part.column("text"), pa.binary()).to_pylist():
                    n, hashes = feature_hashes((text or b"").lower(), longest)  # of bytes: A-Z only
                    found.append((n, len(hashes), (hashes % buckets).astype(kind).tobytes()))
                words, n, packed = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(words, pa.int64()), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], schema=schema)

    return rows.mapInArrow(count, out)


def histogram(counted: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, over all rows. A task adds up its own; ``buckets`` numbers come to the driver."""
    kind = _number(buckets)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("buckets").to_pylist()), kind), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in counted.select("buckets").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much more frequent each bucket is in the target, all buckets counted once more."""
    size, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = ((float(t) + 1) * (s_all + size) / ((float(s) + 1) * (t_all + size)) for s, t in zip(corpus, target, strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from seed and id alone. A null id is an empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _weighed(counted: DataFrame, gain: np.ndarray) -> DataFrame:
    shared = counted.sparkSession.sparkContext.broadcast(gain)  # one number for each bucket
    kind = _number(len(gain))
    kept = ["row", "n_words", "n_features"]
    out = T.StructType([*(counted.schema[c] for c in kept), T.StructField("weight", T.LongType())])
    schema = to_arrow_schema(out)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            found = (np.frombuffer(p, kind) for p in batch.column("buckets").to_pylist())
            weights = [int(gain[f].sum()) // len(f) if len(f) else 0 for f in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(weights, pa.int64())], schema=schema)

    return counted.select(*kept, "buckets").mapInArrow(weigh, out)


def _ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """``rank`` of the ``drawn`` highest scores among the rows that take part, ties to the smaller ``id``; else null.

    Scores are whole numbers within the logarithm of a count, whatever the number of rows, so a table of
    how many rows each score has is small. It tells the score below which nothing is drawn; the rest is
    sorted in ranges, and a range begins with the number of rows in those before it.
    """
    per_score = {r["score"]: r["count"] for r in scored.filter("takes_part").groupBy("score").count().collect()}
    least, so_far = None, 0
    for score in sorted(per_score, reverse=True):
        if so_far >= drawn:
            break
        least, so_far = score, so_far + per_score[score]
    can = F.col("takes_part") & (F.col("score") >= least) if least is not None and drawn else F.lit(False)
    can = F.coalesce(can, F.lit(False))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("at").asc()]
    place = F.monotonically_increasing_id()  # the number of the range, and the place in it
    sorted_ = staged(scored.filter(can).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place))
    part = F.shiftright("place", 33)
    # One row for each range.
    sizes = sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    numbered = sorted_.withColumn("part", part).join(F.broadcast(starts), "part").select(*scored.columns, F.when(nth <= drawn, nth).alias("rank"))
    return numbered.unionByName(scored.filter(~can).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    buckets: int = 10_000,
    longest: int = 2,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Draw ``percent`` of the documents with at least ``least_words`` words, as alike to ``target`` as chance allows.

    Returns for every document ``row`` (all columns of ``docs`` but the text, so that no name can clash),
    ``n_words``, ``n_features`` (runs of 1 to ``longest`` words), ``weight`` (the floored mean gain of its
    features, 0 without any), ``score`` (weight and noise) and ``rank``, from 1 by falling score; not drawn is
    null. Texts that are null, empty or without a word have no features and are never drawn unless
    ``least_words`` is 0. Ties go to the smaller id, a null id last; rows with one id get the same noise
    and, if their scores are equal too, ranks in the order in which they are stored. Texts are used
    whole, whatever their length. An empty target makes every gain depend on the corpus alone; without documents the result is empty.
    """
    counted = staged(features(docs, buckets, longest, text_col))
    gain = gains(histogram(counted, buckets), histogram(features(target, buckets, longest, text_col), buckets))
    id_of = F.col(f"row.`{id_col}`")
    weighed = _weighed(counted, gain).withColumn("score", F.col("weight") + noise(id_of, seed))
    takes_part = F.col("n_words") >= least_words
    scored = staged(weighed.withColumns({"id": id_of, "takes_part": takes_part, "at": F.monotonically_increasing_id()}))
    n = scored.filter("takes_part").count()
    told = _ranked(scored, percent * n // 100)
    return told.select("row", "n_words", "n_features", "weight", "score", "rank")
