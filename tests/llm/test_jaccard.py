"""The Jaccard join against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import arrays as A
from clickloom.llm import jaccard as J
from clickloom.llm.graph import components

from .conftest import CLASHING, sentence

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n):
    w = (text or "").translate(_LOWER).encode().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, n, percent):
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1 :]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return Counter((i, len(s), None if i is None else root(i)) for i, s in sets)


def got(df, n, percent):
    return Counter(map(tuple, J.similar_groups(df, words=n, percent=percent).collect()))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 50), (2, 100)])
def test_messy_rows(messy, n, percent):
    rows = [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    assert got(messy, n, percent) == brute(rows, n, percent)


def family(rng, first, size, words, changes):
    """Texts that differ from one another in so many places that only some of them link."""
    base = sentence(rng, words).split()
    out = []
    for k in range(size):
        text = list(base)
        for _ in range(rng.randrange(changes)):
            text[rng.randrange(words)] = f"c{rng.randrange(10**6)}"
        out.append((first + k, " ".join(text)))
    return out


@pytest.mark.parametrize("block", [8, 256])
def test_near_copies_around_the_limit(spark, monkeypatch, block):
    """Tiles with many sets of which only some link, whole and cut into blocks."""
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(block)
    rows = [*family(rng, 0, 70, 150, 12), *family(rng, 200, 60, 40, 4), *family(rng, 400, 40, 12, 3), *family(rng, 600, 30, 4, 2)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for n, percent in ((3, 90), (5, 80)):
        assert got(df, n, percent) == brute(rows, n, percent)


def test_chains(spark):
    """Each text links with the next one only."""
    words = [f"w{k}" for k in range(260)]
    rows = [(1000 - i, " ".join(words[4 * i : 4 * i + 100])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, 1, 90) == brute(rows, 1, 90)


def test_empty_table(nothing):
    assert J.similar_groups(nothing).collect() == []
    assert J.one_of_each(nothing).columns == nothing.columns


def test_one_of_each(messy):
    """Rows without an id, or with one that others have too, are documents of their own and come last."""
    kept = J.one_of_each(messy)
    assert kept.columns == messy.columns and set(CLASHING) < set(kept.columns)
    given = messy.collect()
    ids = Counter(r["doc_id"] for r in given)
    numbers = [r["doc_id"] if r["doc_id"] is not None and ids[r["doc_id"]] == 1 else 10**9 + k for k, r in enumerate(given)]
    groups = {k[0]: k[2] for k in brute([(n, r["text"]) for n, r in zip(numbers, given, strict=True)], 5, 80)}
    first = [(n, r) for n, r in zip(numbers, given, strict=True) if groups[n] == n]
    # Which of several rows of the last kind stays is a matter of storage.
    assert Counter(r["text"] for r in kept.collect()) == Counter(r["text"] for _, r in first)
    assert {tuple(r) for n, r in first if n < 10**9} <= set(map(tuple, kept.collect())) <= set(map(tuple, given))


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=8), st.integers(0, 8), st.sampled_from([50, 80, 90, 100]), st.sampled_from([1, 2**50]))
def test_similar_sets_share_a_tile(common, added, left, percent, spread):
    """``spread`` crowds all hashes into one part, so that most parts are empty."""
    a = np.unique(np.array(sorted(common | added), np.uint64) // np.uint64(spread))
    b = np.unique(np.array(sorted(common), np.uint64) // np.uint64(spread))[left:]
    if not len(b):
        return
    both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
    similar = 100 * both >= percent * union
    assert J.linked(a, J.bitmap(a), b, J.bitmap(b), percent) == similar
    (text, step, key), (who, of_step, need) = J.tile_keys(np.repeat([3, 7], [len(a), len(b)]), np.concatenate((a, b)), percent)
    if similar:
        shared = set(key[text == 3].tolist()) & set(key[text == 7].tolist())
        assert shared
        for t in (3, 7):  # and as many of one step as a set must share
            in_step = {s: n for w, s, n in zip(who.tolist(), of_step.tolist(), need.tolist(), strict=True) if w == t}
            met = Counter(s for w, s, k in zip(text.tolist(), step.tolist(), key.tolist(), strict=True) if w == t and k in shared)
            assert any(met[s] >= n for s, n in in_step.items())


def test_shingles():
    strings = ["a b c a b c", "A b", "", None, "x", "a  b\tc"]
    text, key = J.shingles(A.texts_of(strings), 3)
    sizes = Counter(text.tolist())
    assert [sizes[i] for i in range(6)] == [len(shingle_set(s, 3)) for s in strings]
    assert set(key[text == 5].tolist()) < set(key[text == 0].tolist())


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(999, k) for k in range(500, 560)]
    parent = {n: n for link in links for n in link}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {n: root(n) for n in parent if any(n in k and k[0] != k[1] for k in links)}
    assert {r["node"]: r["component"] for r in found} == want and len(found) == len(want)
