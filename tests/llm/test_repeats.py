"""Both removals of repeats against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import arrays as A
from clickloom.llm.substring_dedup import remove_repeated_words
from clickloom.llm.suffix_dedup import BlindTrie, SuffixAnchors, remove_repeated_bytes, sort_suffixes

from .conftest import CLASHING, sentence

LARGEST = 2**63 - 1


def words_left(rows, window):
    starts = {}
    for i, text in rows:
        w = (text or "").encode().split()
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            starts[key] = min(starts.get(key, LARGEST), LARGEST if i is None else i)
    out = []
    for i, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if starts[tuple(w[s : s + window])] < (LARGEST if i is None else i):
                gone[s : s + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return Counter(out)


def bytes_left(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    starts = Counter(t[s : s + length] for _, t in raw for s in range(len(t) - length + 1))
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if starts[t[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for x in bytes(gone).split(b"\0") if x)
        out.append((i, len(t), sum(gone), spans, bytes(x for x, g in zip(t, gone, strict=True) if not g)))
    return Counter(out)


def got(df, *columns):
    rows = df.select("row.doc_id", *columns, "kept").collect()
    return Counter((*r[:-1], bytes(r["kept"])) for r in rows)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("window", [1, 2, 7, 50])
def test_words_of_messy_rows(messy, window):
    assert got(remove_repeated_words(messy, window=window), "n_units", "n_removed") == words_left(pairs(messy), window)


@pytest.mark.parametrize(("length", "gram"), [(2, 1), (9, 4), (200, 64), (200, 199)])
def test_bytes_of_messy_rows(messy, length, gram):
    rows = [r for r in pairs(messy) if length > 2 or len(r[1] or "") < 3_000]
    few = messy if length > 2 else messy.filter("text IS NULL OR length(text) < 3000")
    assert got(remove_repeated_bytes(few, length=length, gram=gram), "n_units", "n_removed", "n_spans") == bytes_left(rows, length)


def test_other_columns_come_back(messy):
    kept = remove_repeated_words(messy).select("row.*").select("doc_id", "lang", *CLASHING)
    assert Counter(map(tuple, kept.collect())) == Counter(map(tuple, messy.select("doc_id", "lang", *CLASHING).collect()))


@pytest.mark.parametrize("remove", [remove_repeated_words, remove_repeated_bytes])
def test_empty_table(nothing, remove):
    assert remove(nothing).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_passages_many_texts_share(spark, seed):
    """Overlapping passages in many texts, near copies, and repeats within a text."""
    rng = random.Random(seed)
    passages = [sentence(rng, rng.randrange(40, 90)) for _ in range(5)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else sentence(rng, rng.randrange(1, 60), 40) for _ in range(rng.randrange(1, 5))]
        rows.append((rng.randrange(100), " ".join(parts)))
    near = passages[0].split()
    for i in range(60):
        changed = list(near)
        changed[rng.randrange(len(near))] = f"c{i}"
        rows.append((200 + i, " ".join(changed)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(remove_repeated_words(df), "n_units", "n_removed") == words_left(rows, 50)
    assert got(remove_repeated_bytes(df), "n_units", "n_removed", "n_spans") == bytes_left(rows, 200)


texts = st.lists(st.text("abc", max_size=40), min_size=1, max_size=6)


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(2, 6), st.integers(1, 5))
def test_anchors_meet_in_every_repeat(strings, length, gram):
    """Each repeated string has an anchor at the same offset wherever it is, and anchors settle to brute force."""
    method = SuffixAnchors(length, min(gram, length - 1), shallow=2)
    given_texts = A.texts_of(strings)
    text, place, key, _ = method.anchors(given_texts)
    times = Counter(key.tolist())
    hit = np.array([times[k] > 1 for k in key.tolist()], bool)
    details = method.details(given_texts, text[hit], place[hit])
    covered = [bytearray(len(s)) for s in strings]
    if len(details["text"]):
        details["doc"], details["row"] = details["text"], np.zeros(len(details["text"]), np.int64)
        here, sent = method.settle_here([details], 1)
        for doc, _, start, count in zip(*(np.concatenate(c) for c in zip(here, method.settle(list(sent.values())), strict=True)), strict=True):
            end = start + count - 1 + length
            covered[doc][start:end] = b"\1" * (end - start)
    want = bytes_left(list(enumerate(strings)), length)
    assert Counter((i, len(s), sum(c)) for i, (s, c) in enumerate(zip(strings, covered, strict=True))) == Counter((w[0], w[1], w[2]) for w in want.elements())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=5, max_size=5), min_size=1, max_size=30))
def test_blind_trie_orders(strings):
    trie = BlindTrie()
    for i, s in enumerate(strings):
        trie.add(s, i)
    found = list(trie.in_order(5))
    ordered = [strings[i] for i, _ in found]
    assert ordered == sorted(strings)
    for (a, b), (_, shared) in zip(zip(ordered, ordered[1:], strict=False), found[1:], strict=False):
        assert shared == next((k for k in range(5) if a[k] != b[k]), 5)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab\0", max_size=30), min_size=1, max_size=20), st.sampled_from([0, 8, 16, 64]))
def test_suffix_order(strings, shallow):
    raw = [s.encode() for s in strings]
    data = np.frombuffer(b"".join(raw) + bytes(16), np.uint8)
    size = np.array([len(r) for r in raw])
    start = np.cumsum(size) - size
    order, shared = sort_suffixes(data, start, size, 24, np.zeros(len(raw), np.uint32), shallow)
    filled = [r[:24].ljust(24, b"\0") for r in raw]
    ordered = [filled[i] for i in order]
    assert ordered == sorted(filled)
    for k in range(1, len(ordered)):
        a, b = ordered[k - 1], ordered[k]
        assert shared[k] == next((j for j in range(24) if a[j] != b[j]), 24)
