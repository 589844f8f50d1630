import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import arrays as A
from clickloom.llm import decontamination as D

from .conftest import sentence

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER).encode())


def brute(rows, items, window):
    out = []
    cut = []
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        cut += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    for doc, text in rows:
        w = words(text)
        hit, found = [False] * len(w), set()
        for item, t in cut:
            for i in range(len(w) - len(t) + 1):
                if tuple(w[i : i + len(t)]) == t:
                    hit[i : i + len(t)] = [True] * len(t)
                    found.add(item)
        found.discard(None)
        out.append((doc, len(w), sum(hit), tuple(sorted(str(f) for f in found))))
    return Counter(out)


def got(df):
    return Counter((r["doc"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in df.collect())


ITEMS = "item_id long, text string, n_words string"


def benchmark_rows(texts):
    rng = random.Random(2)
    long = texts[6].split()
    rows = [(0, texts[3]), (1, " ".join(long[20:34])), (2, "word"), (10, "WORD!"), (3, None), (4, " .,; "), (5, " ".join(long[100:107])), (6, sentence(rng, 30))]
    return [*rows, (7, " ".join(long[24:60])), (None, " ".join(long[200:215])), (8, "Zwölf boxkämpfer, jagen"), (1, "x y z"), (9, sentence(rng, 3))]


@pytest.mark.parametrize(("window", "gram"), [(10, 5), (3, 2), (1, 1)])
def test_messy_rows(spark, messy, window, gram):
    rows = [(r["doc_id"], r["text"]) for r in messy.filter("text IS NULL OR length(text) < 20000").select("doc_id", "text").collect()]
    few = messy.filter("text IS NULL OR length(text) < 20000")
    items = benchmark_rows([t for i, t in rows if i is not None and 0 <= i < 7])
    benchmark = spark.createDataFrame([(*r, "x") for r in items], ITEMS)
    assert got(D.find_contamination(few, benchmark, window=window, gram=gram)) == brute(rows, items, window)


def test_full_bitmap(spark, messy, monkeypatch):
    """A bitmap that is full of the benchmark's marks lets all pass, and the join alone decides."""
    monkeypatch.setattr(D, "bitmap_of", lambda marks: np.full(1 << 19, 0xFF, np.uint8))
    few = messy.filter("length(text) < 3000")
    rows = [(r["doc_id"], r["text"]) for r in few.select("doc_id", "text").collect()]
    items = [(1, rows[5][1]), (2, "no such words")]
    assert got(D.find_contamination(few, spark.createDataFrame(items, "item_id long, text string"))) == brute(rows, items, 10)


def test_empty_tables(spark, messy, nothing):
    none = spark.createDataFrame([], ITEMS)
    assert D.find_contamination(nothing, none).collect() == []
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in D.find_contamination(messy, none).collect())
    assert D.clean(messy, none).count() == messy.count()


def test_clean_keeps_whole_rows(spark, messy):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    kept = D.clean(messy, items)
    assert kept.columns == messy.columns
    want = [tuple(r) for r in messy.collect() if b"word" not in words(r["text"])]
    assert Counter(map(tuple, kept.collect())) == Counter(want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=10, max_size=40), st.integers(0, 30), st.integers(1, 5))
def test_shared_windows_share_fingerprints(document, skip, gram):
    """Of every window of ten words that two texts share both have selected the same gram, at the same place."""
    window = document[skip : skip + 10]
    if len(window) < 10:
        return
    chosen = []
    for first, text in ((skip, " ".join(document)), (2, " ".join(["x", "y", *window, "z"]))):
        found, hashes = D._hashes(A.texts_of([text]))
        at, mark = D.selected(found, hashes, 10, gram)
        inside = (at >= first) & (at + gram <= first + 10)
        chosen.append(set(zip((at[inside] - first).tolist(), mark[inside].tolist(), strict=True)))
    assert chosen[0] & chosen[1]


def test_fewer_rows_than_windows(spark):
    """A long text is joined by its selected grams only, and without these nothing is found."""
    text = sentence(random.Random(1), 4_000, 3_000)
    found, hashes = D._hashes(A.texts_of([text]))
    at, _ = D.selected(found, hashes, 10, 5)
    windows, _ = D._whole_windows(found, hashes, 10)
    assert len(windows) == 3_991 and 0.2 < len(at) / len(windows) < 0.4
    # Every window holds a selected gram.
    assert all(((at >= s) & (at + 5 <= s + 10)).any() for s in windows)


def test_hits_come_from_fingerprints(spark, monkeypatch):
    passage = sentence(random.Random(2), 40)
    docs = spark.createDataFrame([(1, "a b c " + passage + " d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(7, passage)], "item_id long, text string")
    assert [tuple(r)[2:] for r in D.find_contamination(docs, items).collect()] == [(46, 40, ["7"])]
    both = D._extend
    # Marks that agree by chance: only the words around them decide.
    other = spark.createDataFrame([(8, " ".join(reversed(passage.split())))], "item_id long, text string")
    monkeypatch.setattr(D.A, "mix", lambda h: h * D.A.U(0) + D.A.U(5))
    assert [tuple(r)[2:] for r in D.find_contamination(docs.limit(1), other).collect()] == [(46, 0, [])]
    monkeypatch.undo()
    assert D._extend is both


def test_one_fingerprint_in_many_items(spark):
    """Items that share a passage are one place of a fingerprint until they are named."""
    passage = sentence(random.Random(3), 12)
    items = spark.createDataFrame([(i, f"{passage}") for i in range(300)] + [(1000 + i, f"n{i} {passage} m{i}") for i in range(50)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"q {passage} r") for i in range(40)], "doc_id long, text string")
    told = D.find_contamination(docs, items).collect()
    assert all(r["n_hit"] == 12 and len(r["items"]) == 350 for r in told) and len(told) == 40
