"""One-to-one matching cut into pieces of time, against a walk over all rows of a key."""

import random
from collections import deque

import pytest
from clickloom.operators import joins, matching
from clickloom.sources.text import from_rows
from pyspark.sql import functions as F

REACH = 5_000_000


def _walk(rows):
    """(left, right) of all rows [(key, time, side, number)], None for a missing one."""
    out, keys = [], {}
    for key, us, side, i in rows:
        keys.setdefault(key, []).append((us is None, us or 0, side, i))
    for mine in keys.values():
        waiting = deque()
        for untimed, us, side, i in sorted(mine):
            if untimed:
                out.append((None, i) if side else (i, None))
                continue
            while waiting and waiting[0][0] < us - REACH:
                _, s, j = waiting.popleft()
                out.append((None, j) if s else (j, None))
            if waiting and waiting[0][1] != side:
                j = waiting.popleft()[2]
                out.append((j, i) if side else (i, j))
            else:
                waiting.append((us, side, i))
        out += [(None, j) if s else (j, None) for _, s, j in waiting]
    return sorted(out, key=str)


def _tables(spark, rows):
    l = from_rows(spark, [(k, u, i) for k, u, s, i in rows if s == 0], "k string, lt long, l long")
    r = from_rows(spark, [(k, u, i) for k, u, s, i in rows if s == 1], "k string, rt long, r long")
    return l, r


def _rows(seed, n, step, keys=("a",), untimed=0.0, lefts=0.5):
    draw, us, rows = random.Random(seed), -3 * REACH, []
    for i in range(n):
        us += draw.choice([0, 1, step, 2 * step])
        rows.append((draw.choice(keys), None if draw.random() < untimed else us, int(draw.random() >= lefts), i))
    return rows


@pytest.mark.parametrize("batch", [10_000, 3])
@pytest.mark.parametrize("seed", range(3))
def test_pieces_agree_with_one_walk(spark, seed, batch):
    # Rows come faster than they expire, so open ones pile up and cross from piece to piece.
    rows = _rows(seed, 400, REACH // (2, 9, 40)[seed], ("a", "b", None), 0.05, (0.5, 0.7, 0.45)[seed])
    l, r = _tables(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        for reaches in (None, 3):
            got = joins.reconcile(l, r, ["k"], "lt", "rt", "5 seconds", reaches)
            assert sorted(((x.l, x.r) for x in got.collect()), key=str) == _walk(rows)
            assert got.filter("(status = 'matched') <> (l IS NOT NULL AND r IS NOT NULL)").isEmpty()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_stretch_is_many_tasks(spark):
    """A key without a pause: no piece holds more than its share of the rows."""
    rows = _rows(7, 2_000, REACH // 4)
    l, r = _tables(spark, rows)
    both = l.select("k", F.col("lt").alias("_us"), F.lit(0).alias("_side")).unionByName(r.select("k", F.col("rt").alias("_us"), F.lit(1).alias("_side")))
    pieces = matching.in_pieces(both, 3 * REACH, REACH)
    share = pieces.groupBy("k", "_piece").count()
    assert share.count() > 50 and share.agg(F.max("count")).first()[0] < 100
    assert pieces.filter("NOT _halo").count() == 2_000
    got = joins.reconcile(l, r, ["k"], "lt", "rt", "5 seconds", 3)
    assert sorted(((x.l, x.r) for x in got.collect()), key=str) == _walk(rows)


def test_rows_open_at_a_piece_s_start(spark):
    rows = _rows(11, 500, REACH // 6, lefts=0.6)
    l, r = _tables(spark, rows)
    both = l.select("k", F.col("lt").alias("_us"), F.lit(0).alias("_side")).unionByName(r.select("k", F.col("rt").alias("_us"), F.lit(1).alias("_side")))
    width = 3 * REACH
    starts = {x["_piece"]: x["_open"] for x in matching.open_at_start(matching.in_pieces(both, width, REACH), ["k"], REACH).collect()}
    waiting, last, want = deque(), None, {}
    for _, us, side, _ in sorted(rows, key=lambda x: x[1:]):
        if us // width != last:
            last = us // width
            want[last] = sum(-1 if s else 1 for _, s in waiting)
        while waiting and waiting[0][0] < us - REACH:
            waiting.popleft()
        if waiting and waiting[0][1] != side:
            waiting.popleft()
        else:
            waiting.append((us, side))
    assert {p: n for p, n in starts.items() if p in want} == want


def test_nothing_to_match(spark):
    rows = [("a", None, 0, 1), (None, None, 1, 2), ("a", 5, 0, 3), ("b", 5, 1, 4), (None, 9, 0, 5), (None, 9, 1, 6)]
    l, r = _tables(spark, rows)
    got = {(x.k, x.l, x.r, x.status) for x in joins.reconcile(l, r, ["k"], "lt", "rt", "5 seconds").collect()}
    assert got == {("a", 1, None, "left_only"), (None, None, 2, "right_only"), ("a", 3, None, "left_only"), ("b", None, 4, "right_only"), (None, 5, 6, "matched")}
    assert joins.reconcile(l.limit(0), r.limit(0), ["k"], "lt", "rt", "5 seconds").isEmpty()
