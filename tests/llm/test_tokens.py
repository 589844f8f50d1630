"""Token files and packing: ids against the library, exact round trips, and every packing's rules."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import arrays as A
from clickloom.llm import packing as P
from clickloom.llm import token_files as F
from clickloom.llm.queries import byte_bpe
from clickloom.llm.shared import shared_folder
from clickloom.llm.tokens import Encoder, bits_for, encoder


#: What borders between pieces hang on: letters, blanks in a row, apostrophes, special tokens, other scripts.
PIECE = st.sampled_from([*"abÉ  \n\t\r.'1_!<|>sT漢×\x85\x1c\u0301", "'s", "'re", "  ", "\n\n", "<|endoftext|>", " '", "word"])


def library(text):
    return encoder(byte_bpe()).tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | st.lists(PIECE, max_size=25).map("".join), max_size=4))
def test_ids_are_the_library_s(strings):
    flat, first = encoder(byte_bpe()).ids(A.texts_of(strings))
    assert [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [library(s) for s in strings]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr("clickloom.llm.tokens.KEPT_PIECES", 5)
    own, texts = Encoder(byte_bpe()), ["some words and\nmore words", "again some words"]
    for _ in range(3):
        flat, first = own.ids(A.texts_of(texts))
        assert flat[first[1] :].tolist() == library(texts[1])


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=200), st.integers(0, 50), st.integers(0, 50))
def test_bits(bits, numbers, skip, n):
    ids = np.array(numbers, np.uint32) & np.uint32((1 << bits) - 1)
    packed = F.pack_bits(ids, bits)
    assert len(packed) <= len(ids) * bits // 8 + 16
    some = ids[skip : skip + n]
    assert (F.unpack_bits(packed, bits, min(skip, len(ids)), len(some)) == some).all()


def test_fewest_bits():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]


def test_files_of_messy_rows(spark, messy):
    folder = shared_folder(spark)
    F.write_token_files(messy, folder, byte_bpe())
    rows = [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    found = sorted(F.read_documents(spark, folder).collect(), key=lambda r: r["start"])
    assert {r["bits"] for r in found} == {16}
    at = 0
    for r in found:  # gapless, in ascending order, null last
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
    want = Counter((i, len(library(t)) + 1, crc([*library(t), 0])) for i, t in rows)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want
    some = found[len(found) // 2]
    read = F.read_ids(spark, folder, some["start"], some["n_tokens"])
    assert crc(read) == some["ids_crc32"] and read[-1] == 0
    assert len(F.read_ids(spark, folder, 0, at)) == at
    assert len(F.read_ids(spark, folder, at, 5)) == 0


def test_small_blocks(spark, messy, monkeypatch):
    """Other block sizes and an odd number of bits give the same documents."""
    monkeypatch.setattr(F, "BLOCK_IDS", 64)
    monkeypatch.setattr(F, "bits_for", lambda n: 17)
    folder = shared_folder(spark)
    few = messy.filter("length(text) < 1000").coalesce(1)
    F.write_token_files(few, folder, byte_bpe())
    found = Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in F.read_documents(spark, folder).collect())
    assert found == Counter((r["doc_id"], len(library(r["text"])) + 1, crc([*library(r["text"]), 0])) for r in few.collect())


def test_empty_table(spark, nothing):
    folder = shared_folder(spark)
    F.write_token_files(nothing, folder, byte_bpe())
    assert F.read_documents(spark, folder).collect() == [] and len(F.read_ids(spark, folder, 0, 9)) == 0
    assert P.pack_documents(nothing, byte_bpe()).collect() == []


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing_of_messy_rows(messy, capacity):
    found = P.pack_documents(messy, byte_bpe(), capacity).collect()
    sequences: dict = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    want = Counter()
    for doc, text in [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]:
        ids = [*library(text), 0]
        short = (len(ids) - 1) % capacity + 1
        for k, start in enumerate([0, *range(short, len(ids), capacity)]):
            end = short if k == 0 else start + capacity
            want[doc, k, start, end - start, crc(ids[start:end])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    assert len(sequences) <= -(-sum(k[3] * n for k, n in want.items()) // capacity) * 1.05 + 1


def used(fillings):
    out = Counter()
    for lengths, times in fillings:
        for s in lengths:
            out[s] += times
    return out


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 4), max_size=6))
def test_all_lengths_are_packed(counts):
    for fillings in (P.best_fit(counts, 20), P.pack_lengths(counts, 20)):
        assert used(fillings) == Counter(counts)
        assert all(sum(lengths) <= 20 for lengths, _ in fillings)


def fewest(lengths, capacity):
    """The fewest sequences, by trying everything."""
    best = [len(lengths)]

    def place(left, rooms):
        if len(rooms) >= best[0]:
            return
        if not left:
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= left[0]:
                rest = list(rooms)
                rest.remove(room)
                place(left[1:], [*rest, room - left[0]])
        place(left[1:], [*rooms, capacity - left[0]])

    place(sorted(lengths, reverse=True), [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_search_finds_the_fewest(lengths):
    assert sum(n for _, n in P.pack_lengths(Counter(lengths), 20)) == fewest(lengths, 20)


def test_search_beats_best_fit():
    counts = Counter([10, 7, 7, 6, 5, 5, 4, 4, 3, 3, 3, 3])
    few, fit = (sum(n for _, n in f(counts, 20)) for f in (P.pack_lengths, P.best_fit))
    assert few == 3 <= fit


def test_search_over_all_lengths():
    """Best-fit misses the bound on 2,048 lengths; the search has the budget for whole packings and meets it."""
    u, n = np.unique(np.clip(np.random.default_rng(0).lognormal(5.5, 1, 100_000).astype(int), 1, 2048), return_counts=True)
    counts = {**dict.fromkeys(range(1, 2049), 1), **dict(zip(u.tolist(), (n * 20).tolist(), strict=True))}
    fillings = P.pack_lengths(counts, 2048)
    assert used(fillings) == Counter(counts) and all(sum(lengths) <= 2048 for lengths, _ in fillings)
    bound = P.fewest_possible(np.array([counts.get(s, 0) for s in range(2049)]))
    assert sum(n for _, n in P.best_fit(counts, 2048)) > bound == sum(n for _, n in fillings)


def test_completions_of_many_small_pieces():
    """More than four pieces, none of them among the twelve largest."""
    counts = np.zeros(2049, np.int64)
    counts[1500:1520], counts[101] = 1, 20
    assert next(P.completions(counts, 1010)) == (101,) * 10


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_no_packing_gets_below_the_bound(lengths):
    counts = np.bincount(lengths, minlength=21)
    assert P.fewest_possible(counts) <= fewest(lengths, 20)


def test_places():
    counts = Counter(random.Random(1).choices(range(1, 30), k=400))
    places = P.Places.of(P.pack_lengths(counts, 30))
    size = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()])
    mixed = np.random.default_rng(1).permutation(len(size))
    sequence, offset = places.look_up(size[mixed], rank[mixed])
    taken: dict = {}
    for q, o, s in zip(sequence.tolist(), offset.tolist(), size[mixed].tolist(), strict=True):
        taken.setdefault(q, []).append((o, s))
    for pieces in taken.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0, *[s for _, s in pieces]])[:-1]) and sum(s for _, s in pieces) <= 30
