"""Ordered work with keys above the size limit against plain windows, on skewed events."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.operators import ordered, rows, sequences, windows
from clickloom.sources.tables import load

USER, ORDER = ["user_id"], ["ts", "event_id"]
NONE_HOT = 10**9


def same(a, b):
    cols = sorted(b.columns)
    a, b = a.select(cols), b.select(cols)
    assert b.count() > 0
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def is_(kind):
    return F.col("event_type") == kind


@pytest.fixture(scope="module")
def skewed(spark, sf_dir):
    """A third of all events belong to one user and some to no user."""
    hot = F.when(F.col("event_id") % 3 == 0, 7).when(F.col("event_id") % 10 == 1, None).otherwise(F.col("user_id"))
    return load(spark, sf_dir, "events").withColumn("user_id", hot.cast("long")).cache()


CASES = {
    "look_back": lambda df, m: ordered.over_preceding(
        df, USER, ORDER, 3, lambda w: {"x": F.collect_list("event_id").over(w.rowsBetween(-3, 0))}, max_rows=m
    ),
    "look_ahead": lambda df, m: ordered.over_preceding(
        df, USER, ORDER, 2, lambda w: {"x": F.lag("event_id", 2).over(w)}, reverse=True, max_rows=m
    ),
    "running": lambda df, m: ordered.running(
        df, USER, ORDER, {"n": ("sum", F.lit(1)), "top": ("max", F.when(is_("error"), F.col("ts")))}, max_rows=m
    ),
    "running_back": lambda df, m: ordered.running(
        df, USER, ORDER, {"x": ("min", F.when(is_("error"), F.col("ts")))}, reverse=True, inclusive=False, max_rows=m
    ),
    "no_key": lambda df, m: ordered.running(df, [], ORDER, {"n": ("sum", F.lit(1))}, max_rows=m),
    "no_key_back": lambda df, m: ordered.over_preceding(
        df, [], ORDER, 1, lambda w: {"x": F.lag("event_id").over(w)}, max_rows=m
    ),
    "pairs": lambda df, m: rows.adjacent_pairs(df, USER, ORDER, "event_type", max_rows=m),
    "rolling": lambda df, m: windows.rolling(df, USER, ORDER, 2, {"n": ("count", "*")}, max_rows=m),
    "jump": lambda df, m: sequences.jump_alert(df, USER, ORDER, "value", 50, max_rows=m),
    "rise": lambda df, m: sequences.rise_alert(df, USER, ORDER, "value", "3 hours", max_rows=m),
    "strict": lambda df, m: sequences.strict_sequence(df, USER, ORDER, [is_("error")] * 2, "6 hours", max_rows=m),
    "followed": lambda df, m: sequences.followed_by(df, USER, ORDER, is_("signup"), is_("purchase"), "12 hours", max_rows=m),
    "marker": lambda df, m: sequences.marker_watermark(df, ["event_id"], "ts", is_("error"), "1 minute", max_rows=m),
    "burst": lambda df, m: sequences.burst_alert(df, USER, ORDER, is_("error"), 1, "6 hours", max_rows=m),
}


@pytest.mark.parametrize("case", CASES)
def test_split_equals_plain(skewed, case):
    same(CASES[case](skewed, 60), CASES[case](skewed, NONE_HOT))


def test_bursts_in_time_are_cut(spark):
    """300 of a key's rows within a second, the others over a month."""
    rare = spark.range(100).selectExpr("1 AS k", "id * 25920L * 1000000L AS us", "id")
    dense = spark.range(300).selectExpr("1 AS k", "1000000000000L + id * 3000L AS us", "1000 + id AS id")
    cold = spark.range(10).selectExpr("2 AS k", "id AS us", "5000 + id AS id")
    df = rare.union(dense).union(cold).withColumn("ts", F.timestamp_micros("us"))
    chunks = ordered.split_hot(df, ["k"], ["ts", "id"], 20)
    sizes = {(r.k, r._chunk): r["count"] for r in chunks.groupBy("k", "_chunk").count().collect()}
    assert sizes.pop((2, None)) == 10
    assert sum(sizes.values()) == 400
    assert max(sizes.values()) <= 40
    plain = ordered.running(df, ["k"], ["ts", "id"], {"n": ("sum", F.lit(1))}, max_rows=None)
    same(ordered.running(df, ["k"], ["ts", "id"], {"n": ("sum", F.lit(1))}, max_rows=20), plain)


@pytest.mark.parametrize("first", ["id % 5", "date_add(DATE'2024-01-01', int(id % 3))", "double(id % 4)", "'same'", "if(id % 2 = 0, null, id % 3)"])
def test_equal_first_values_are_cut(spark, first):
    """2,000 rows of a few first values of any type, cut by the rest of their order."""
    df = spark.range(2_000).selectExpr("1 AS k", f"{first} AS o", "id")
    chunks = ordered.split_hot(df, ["k"], ["o", "id"], 20).groupBy("_chunk").count()
    assert chunks.agg(F.max("count")).first()[0] <= 40 and chunks.count() >= 50
    folds = {"n": ("sum", F.lit(1)), "low": ("min", F.col("id"))}
    for back in (False, True):
        run = lambda m, back=back: ordered.running(df, ["k"], ["o", "id"], folds, reverse=back, max_rows=m)
        same(run(20), run(None))


def test_chunks_of_drawn_rows(spark):
    df = spark.range(20_000).selectExpr("1 AS k", "hash(id) % 7 AS o", "id")
    sizes = ordered.split_hot(df, ["k"], ["o", "id"], 1_000).groupBy("_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2_000 and 10 <= sizes.count() <= 40


def test_types_do_not_depend_on_the_number_of_rows(spark):
    df = spark.range(200).selectExpr("1 AS k", "id", "CAST(id AS DECIMAL(18,2)) AS d", "int(id) AS i", "float(id) AS f")
    folds = {f"{kind}_{c}": (kind, F.col(c)) for kind in ("sum", "min", "max") for c in "dif"}
    cut, plain = (ordered.running(df, ["k"], ["id"], folds, max_rows=m) for m in (20, None))
    assert cut.schema.simpleString() == plain.schema.simpleString()
    same(cut, plain)


def test_without_a_key_no_task_has_all_rows(spark):
    df = spark.range(400).selectExpr("id", "id % 3 AS o")
    out = ordered.running(df, [], ["o", "id"], {"n": ("sum", F.lit(1))})
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "Exchange SinglePartition" in line]
    assert all("HashAggregate" in line for line in below)  # only the totals of the chunks meet
    assert out.agg(F.max("n"), F.countDistinct("n")).first() == (400, 400)


def test_known_hot_keys(spark):
    df = spark.range(300).selectExpr("id % 2 AS k", "id")
    hot = spark.range(1).selectExpr("1L AS k")
    cut = ordered.Ordered.of(df, ["k"], ["id"], 30, hot)
    assert {r.k for r in cut.rows.filter("_chunk > 0").collect()} == {1}
    run = cut.running({"n": ("sum", F.lit(1))}).table()
    same(run, ordered.running(df, ["k"], ["id"], {"n": ("sum", F.lit(1))}, max_rows=None))


def test_high_caps_number_rows_with_hot_keys_split(spark):
    df = spark.range(1200).selectExpr("1 AS k", "timestamp_micros(id * 1000) AS ts", "id")
    passed, alerts = sequences.daily_cap(df, ["k"], ["ts", "id"], 1000, max_rows=100)
    assert passed.agg(F.count("*"), F.max("id")).first() == (1000, 999)
    assert [r.id for r in alerts.collect()] == [1000]


def test_missing_times_come_first(spark):
    df = spark.range(100).selectExpr("1 AS k", "id", "if(id % 10 = 3, null, timestamp_seconds(id * 7 % 100)) AS ts")
    folds = {"n": ("sum", F.lit(1)), "low": ("min", F.col("id"))}
    for back in (False, True):
        run = lambda m, back=back: ordered.running(df, ["k"], ["ts", "id"], folds, reverse=back, max_rows=m)
        same(run(15), run(None))


def _bursts(times, n, us):
    """(start, count) by hand: times of failures and, negative, of successes."""
    found, window = [], []
    for t in sorted(times, key=abs):
        if window and abs(t) > window[0] + us:
            if len(window) >= n:
                found.append((window[0], len(window)))
            window = []
        if t < 0:
            window = []
        else:
            window.append(t)
    if len(window) >= n:
        found.append((window[0], len(window)))
    return found


@pytest.mark.parametrize("fold", [0, 1_000])
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(1, 300), st.integers(0, 9)), min_size=1, max_size=80, unique_by=lambda x: x[0]))
def test_bursts_by_hand(spark, monkeypatch, fold, data):
    monkeypatch.setattr(sequences, "FOLD_ROWS", fold)
    times = [-t if kind == 0 else t for t, kind in data]
    df = spark.createDataFrame([(1, abs(t), t > 0) for t in times], "k int, s long, fail boolean")
    df = df.select("k", F.timestamp_seconds("s").alias("ts"), "fail")
    got = sequences.burst_alert(df, ["k"], ["ts"], F.col("fail"), 2, "7 seconds", max_rows=20)
    rows_ = got.select(F.unix_seconds("start_ts").alias("s"), "n_fails").collect()
    assert sorted((r.s, r.n_fails) for r in rows_) == _bursts(times, 2, 7)
