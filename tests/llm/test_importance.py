"""Features, gains and ranks against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import importance

from .conftest import sentence

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def features_of(text, longest=2):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=25, least=20, size=10_000, seed=7):
    """Rows of (id, n_features, weight, score, rank), in the order of ``docs``."""
    bucket = lambda f: zlib.crc32(f.encode()) % size
    s, t = (Counter(bucket(f) for _, text in rows for f in features_of(text)) for rows in (docs, target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + size) / ((s[b] + 1.0) * (t_all + size))))
    out = []
    for i, text in docs:
        f = features_of(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    part = [k for k, (_, text) in enumerate(docs) if len(words_of(text)) >= least]
    part.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0))
    for r, k in enumerate(part[: percent * len(part) // 100]):
        out[k][4] = r + 1
    return [tuple(o) for o in out]


def run(spark, docs, target, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    t = spark.createDataFrame(target, "item_id long, text string")
    return importance.resample(d, t, **kw).select("row.doc_id", "n_features", "weight", "score", "rank").collect()


def key(r):
    return tuple((v is None, v or 0) for v in r)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBc1é€\U0001f600 .\n\t[\x7f", max_size=80))
def test_words_by_place(text):
    raw = text.encode().lower()
    assert [raw[a:b].decode() for a, b in importance.word_places(raw)] == words_of(text)
    n, hashes = importance.feature_hashes(raw, 3)
    assert n == len(words_of(text)) and hashes.tolist() == [zlib.crc32(f.encode()) for f in features_of(text, 3)]


def test_long_texts_are_split_between_words(monkeypatch):
    monkeypatch.setattr(importance, "STRETCH_BYTES", 10)
    for text in ("abc def ghi jkl mno pqr", "x" * 35 + " y " + "z" * 40, "é" * 30, "a.b" * 9, " " * 40):
        raw = text.encode()
        assert [raw[a:b].decode() for a, b in importance.word_places(raw)] == words_of(text)


def test_against_brute_force(spark):
    rng = random.Random(3)
    docs = [(i, sentence(rng, rng.randrange(60), 50)) for i in range(200)] + [(500, None), (501, ""), (502, "!?"), (503, "Ünï " * 30)]
    target = [(i, sentence(rng, 30, 20)) for i in range(10)] + [(99, None)]
    got = run(spark, docs, target)
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs, target), key=key)
    small = run(spark, docs, target, percent=100, least_words=0, buckets=16, seed=9)
    assert sorted(map(tuple, small), key=key) == sorted(brute(docs, target, 100, 0, 16, 9), key=key)


def test_ties_and_one_hot_id(spark):
    """A third of the rows are one row: equal ids and texts have equal scores and gapless ranks."""
    rng = random.Random(4)
    same = sentence(rng, 40)
    docs = [(None, same)] * 100 + [(7, same)] * 100 + [(100 + i, sentence(rng, 30)) for i in range(100)]
    got = run(spark, docs, [(1, same)], percent=70)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 211))
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs, [(1, same)], percent=70), key=key)


def test_messy_rows(messy, nothing, spark):
    target = spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string")
    told = importance.resample(messy, target)
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    got = told.select("row.doc_id", "n_features", "weight", "score", F.col("rank").isNotNull()).collect()
    want = [(*w[:4], w[4] is not None) for w in brute(rows, [(1, "w1 w2 w3")])]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert set(told.schema["row"].dataType.names) == set(messy.columns) - {"text"}
    assert importance.resample(nothing, target).collect() == []
    assert len(importance.resample(messy, target.limit(0)).collect()) == len(rows)


def test_a_hot_score_is_dealt_over_ranges(spark):
    n = 4_000
    rows = spark.range(n).select(F.lit(None).cast("long").alias("id"), F.lit(5).cast("long").alias("score"), F.lit(True).alias("takes_part"), F.col("id").alias("at"))
    ranked = importance._ranked(rows.repartition(6), n // 2)
    assert sorted(r["rank"] for r in ranked.collect() if r["rank"]) == list(range(1, n // 2 + 1))


def test_gains_are_floored():
    g = importance.gains(np.array([3, 0]), np.array([0, 5]))
    assert g.tolist() == [math.floor(1000 * math.log(1 * 5 / (4 * 7))), math.floor(1000 * math.log(6 * 5 / (1 * 7)))]
