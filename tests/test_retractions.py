"""Aggregates that consume changes, and sketches that are united."""

import random
from collections import Counter

import pytest
from clickloom.operators import aggs, changes
from clickloom.sinks.keyed import read_keyed
from clickloom.sources.text import from_rows
from clickloom.streaming import run
from pyspark.sql import functions as F

KINDS = {"rows": ("count", "*"), "known": ("count", "v"), "total": ("sum", "v"), "mean": ("avg", "v"), "low": ("min", "v"), "high": ("max", "v")}
SCHEMA = "added boolean, k string, v long"


def _changes(seed, n):
    """A changelog in which most rows are taken back, and the rows that remain."""
    draw, here, log = random.Random(seed), [], []
    for _ in range(n):
        if here and draw.random() < 0.45:
            log.append((False, *here.pop(draw.randrange(len(here)))))
        else:
            here.append((draw.choice(["a", "b", None]), draw.choice([None, 1, 2, 2, 3, 50])))
            log.append((True, *here[-1]))
    # One key loses every row.
    log += [(True, "gone", 9), (True, "gone", 4), (False, "gone", 9), (False, "gone", 4)]
    return log, here


def _plain(spark, here):
    return from_rows(spark, here, "k string, v long").groupBy("k").agg(
        F.count("*").alias("rows"), F.count("v").alias("known"), F.sum("v").alias("total"), F.avg("v").alias("mean"), F.min("v").alias("low"), F.max("v").alias("high")
    )


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _top(here, n):
    out = []
    for key in {k for k, _ in here}:
        best = sorted((v for k, v in here if k == key and v is not None), reverse=True)[:n]
        out += [(key, v, i) for i, v in enumerate(best, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_an_aggregate_over_changes_is_that_over_the_table(spark, seed):
    log, here = _changes(seed, 120)
    random.Random(seed).shuffle(log)  # the order of changes does not matter
    net = changes.net_rows(from_rows(spark, log, SCHEMA), ["k", "v"])
    assert {(r.k, r.v): r.n for r in net.collect()} == dict(Counter(here))
    assert _rows(changes.aggregate_net(net, ["k"], KINDS)) == _rows(_plain(spark, here))
    assert _rows(changes.top_of_net(net, ["k"], "v", 2)) == _top(here, 2)


def test_only_nulls_and_nothing(spark):
    net = changes.net_rows(from_rows(spark, [(True, "a", None), (True, "a", None)], SCHEMA), ["k", "v"])
    assert _rows(changes.aggregate_net(net, ["k"], KINDS)) == [("a", 2, 0, None, None, None, None)]
    assert changes.top_of_net(net, ["k"], "v", 2).isEmpty()
    assert changes.aggregate_net(net.limit(0), ["k"], KINDS).isEmpty()
    with pytest.raises(ValueError):
        changes.aggregate_net(net, ["k"], {"x": ("median", "v")})


def test_a_stream_of_changes(spark, tmp_path):
    log, here = _changes(5, 90)
    source, kept = str(tmp_path / "log"), str(tmp_path / "net")
    for part in (log[60:], log[:30], log[30:60]):  # some rows are taken back before they come
        from_rows(spark, part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    run.run_stream(stream, run.keep_net_rows(kept, ["k", "v"]), str(tmp_path / "checkpoint"), "append")
    net = read_keyed(spark, kept, ["k", "v"], "add")
    assert _rows(changes.aggregate_net(net, ["k"], KINDS)) == _rows(_plain(spark, here))
    assert _rows(changes.top_of_net(net, ["k"], "v", 2)) == _top(here, 2)


def test_sketches_of_batches_are_united(spark):
    rows = [(f"2024-01-01 {h:02d}:{m:02d}:00", "xy"[m % 2], (h * 7 + m * m) % 40 if m else None) for h in range(6) for m in range(0, 60, 3)]
    df = from_rows(spark, rows, "t string, k string, v long").select(F.to_timestamp("t").cast("timestamp_ntz").alias("ts"), "k", "v")
    first, second = df.filter("v < 15 OR v IS NULL"), df.filter("v >= 10")  # some values are in both
    panes = [aggs.sketch_panes(part, "ts", "3 hours", "1 hour", "v", ["k"]) for part in (first, second)]
    got = aggs.distinct_of_panes(panes[0].unionByName(panes[1]).unionByName(panes[1]), "3 hours", "1 hour", ["k"])
    exact = df.groupBy(F.window("ts", "3 hours", "1 hour").alias("w"), "k").agg(F.countDistinct("v").alias("n"))
    want = exact.select("w.start", "w.end", "k", "n")
    assert _rows(got) == _rows(want)  # so few values are counted exactly
