import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import arrays as A

any_text = st.text(st.sampled_from("ab Z\t\n\x0b\x0c\r\x1cé 9_-"), max_size=20)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | any_text, max_size=6))
def test_words(strings):
    texts = A.texts_of(strings)
    for table, pattern in ((A.NOT_BLANK, rb"[^\x20\x09-\x0D]+"), (A.ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = A.words_of(texts, table)
        got = [(int(t), texts.data[a:b].tobytes()) for t, a, b in zip(words.text, words.start, words.end, strict=True)]
        assert got == [(i, w) for i, s in enumerate(strings) for w in re.findall(pattern, (s or "").encode())]
        assert words.counts().tolist() == [len(re.findall(pattern, (s or "").encode())) for s in strings]


def test_hash_tells_spans_apart():
    spans = [b"", b"a", b"b", b"a\0", b"abcdefgh", b"abcdefghi", b"x" * 600, b"x" * 601, b"y" + b"x" * 600]
    texts = A.texts_of([s.decode() for s in spans])
    hashes = A.hash_spans(texts.data, texts.offsets[:-1], texts.offsets[1:])
    assert len(set(hashes.tolist())) == len(spans)
    moved = A.texts_of(["pad", *[s.decode() for s in spans]])
    assert (A.hash_spans(moved.data, moved.offsets[1:-1], moved.offsets[2:]) == hashes).all()


def test_rolling_depends_on_the_window_alone():
    values = np.array([5, 7, 9, 1, 5, 7, 9, 2], np.uint64)
    hashes = A.rolling(values, 3)
    assert hashes[0] == hashes[4] and len(set(hashes.tolist())) == 5
    assert len(A.rolling(values[:2], 3)) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1)), st.lists(st.integers(0, 2**32 - 1)), st.binary())
def test_pack(signed, unsigned, raw):
    arrays = [np.array(signed, np.int64), np.array(unsigned, np.uint32), np.frombuffer(raw, np.uint8), np.array(unsigned, np.uint64)]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(A.unpack(A.pack(*arrays)), arrays, strict=True))


def test_slices_keep_rows_whole():
    batch = pa.record_batch({"text": ["aa", None, "bbbbbb", "", "c"]})
    parts = [p.column("text").to_pylist() for p in A.slices(batch, "text", 3)]
    assert sum(parts, []) == ["aa", None, "bbbbbb", "", "c"] and parts[1] == ["bbbbbb", ""] or len(parts) == 3


def test_spark_hash(spark):
    ids = [0, 1, -1, 2**63 - 1, -(2**63), 123456789]
    rows = spark.createDataFrame([(i,) for i in ids], "id long").select(F.pmod(F.xxhash64("id"), F.lit(97)).alias("h")).collect()
    assert [r["h"] for r in rows] == A.spark_hash(np.array(ids), 97).tolist()
