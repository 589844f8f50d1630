"""The graph and its search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import neighbours as N
from clickloom.sources.tables import load

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    """{query: [(vec_id, score)]} over the rows that take part."""
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            kept[i] = np.array(v, np.float32).astype(np.float64)
    out = {}
    for q, v in kept.items():
        if q % every == 0:
            near = [(-float(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)), i) for i, w in kept.items() if i != q]
            out[q] = sorted(near)[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


def run(spark, rows, every=50, k=5, **kw):
    index = N.build(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw)
    return found(N.search(index, F.col("id") % every == 0, k=k))


def recall(got, want):
    hits = sum(len({i for _, i in near} & {i for _, i in got.get(q, [])}) for q, near in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_on_noise(spark, monkeypatch):
    """Vectors without any structure are the hardest; blocks small enough that the rounds must do the work."""
    monkeypatch.setattr(N, "BLOCK", 32)
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((3_000, 24)).astype(np.float32))]
    index = N.build(spark.createDataFrame(rows, SCHEMA).repartition(4), starts=2, settled=0.01)
    got, want = found(N.search(index, F.col("id") % 50 == 0)), brute(rows)
    assert got.keys() == want.keys() and all(len(g) == 5 for g in got.values())
    assert recall(got, want) >= 0.95
    for q, near in got.items():
        exact = {i: -s for s, i in brute([rows[q], *(rows[i] for _, i in near)])[q]}
        assert all(abs(exact[i] - s) < 1e-12 for s, i in near)
        assert near == sorted(near, key=lambda x: (-x[0], x[1]))


def test_given_table(spark, sf_dir):
    from clickloom.llm.queries import op13_nearest_neighbours

    rows = [(r["vec_id"], r["embedding"]) for r in load(spark, sf_dir, "embeddings").collect()]
    assert recall(found(op13_nearest_neighbours(spark, sf_dir)), brute(rows)) >= 0.9


@pytest.mark.parametrize("share", [3, 2])
def test_one_vector_many_rows(spark, share):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0, 0.0] if i % share == 0 else rng.standard_normal(4).astype(np.float32).tolist()) for i in range(900)]
    got, want = run(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert np.allclose([s for s, _ in got[q]], [-s for s, _ in near])
        if q % share == 0:
            assert [i for _, i in got[q]] == [i for i in range(0, 900, share) if i != q][:5]


def test_near_copies(spark):
    """A third of all vectors differ by little."""
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(i, ((base + 0.01 * rng.standard_normal(16)) if i % 3 == 0 else rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(1_500)]
    assert recall(run(spark, rows), brute(rows)) >= 0.9


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7 + 1), float(i % 5), 1.0]) for i in range(120)]
    bad = [(150, None), (200, []), (250, [0.0, 0.0, -0.0]), (300, [1.0, None, 2.0]), (350, [nan, 1.0, 1.0]), (400, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (450, [1.0, 2.0])]
    got = run(spark, good + bad + good[:60])  # some rows twice
    assert got.keys() == {0, 50, 100}
    want = brute(good)
    for q in got:
        assert [i for _, i in got[q]] == [i for _, i in sorted((round(s, 12), i) for s, i in brute(good, 119)[q])[:5]]
        assert np.allclose([s for s, _ in got[q]], [-s for s, _ in want[q]])


def test_few_rows_and_other_columns(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 2.0])]) == {}
    got = run(spark, [(0, [1.0, 0.0]), (3, [1.0, 1.0]), (4, [0.0, 2.0])])
    assert [i for _, i in got[0]] == [3, 4]
    clash = spark.createDataFrame([(i, [float(i), 1.0], "x", 1) for i in range(60)], "vec_id long, embedding array<double>, node string, key int")
    assert {q: len(n) for q, n in found(N.search(N.build(clash), F.col("id") % 50 == 0)).items()} == {0: 5, 50: 5}


def test_of_one_id_one_vector_takes_part(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(20)] + [(5, [-1.0, 7.0])]
    got = run(spark, rows)
    assert len(got[0]) == 5 and len({i for _, i in got[0]}) == 5


def test_codes_keep_directions():
    x = np.random.default_rng(4).standard_normal((50, 9))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert np.abs(N._floats(N._codes(x * 1e200)) - unit).max() < 2e-5
