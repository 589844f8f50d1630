"""Operators on small hand-made cases, with the choices made where more than one result is possible."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.functions import hashing, udfs
from clickloom.operators import aggs, changes, joins, rows, sequences, topn, windows
from clickloom.sources.text import from_rows


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def got(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def events(spark, *rows_):
    """Rows of (key, second, kind or value)."""
    kind = "string" if isinstance(rows_[0][2], str) else "double"
    data = [(k, at(s), i, v) for i, (k, s, v) in enumerate(rows_)]
    return from_rows(spark, data, f"k string, ts timestamp, id long, v {kind}")


KEY, ORDER = ["k"], ["ts", "id"]


def test_word_count_drops_empty_words(spark):
    df = from_rows(spark, [("pear  plum",), ("pear quince",), ("pear",)], "value string")
    assert got(aggs.word_count(rows.explode_words(df, "value"))) == [("pear", 3), ("plum", 1), ("quince", 1)]


def test_routes(spark):
    df = from_rows(spark, [(1, 35.0), (2, 10.0), (3, None)], "id long, t double")
    routed = rows.route(df, {"High": F.col("t") > 30, "Low": F.col("t") <= 30})
    assert got(rows.select_routes(routed, "High"), "id") == [(1,)]
    assert got(rows.select_routes(routed, "High", "Low"), "id") == [(1,), (2,)]
    main, side = rows.side_output(df, F.col("t") < 32)
    assert got(main, "id") == [(1,), (3,)] and got(side, "id") == [(2,)]


def test_adjacent_pairs_keep_null_values(spark):
    df = events(spark, ("a", 1, "1"), ("a", 2, None), ("a", 3, "3"), ("b", 1, "9"))
    assert got(rows.adjacent_pairs(df, KEY, ORDER, "v"), "first", "second") == [("1", None), (None, "3")]


def test_exclude_keys_keeps_rows_without_key(spark):
    df = from_rows(spark, [("a",), ("b",), (None,)], "k string")
    blocked = from_rows(spark, [("a", 1), ("a", 2)], "k string, n long")
    assert got(rows.exclude_keys(df, blocked, "k")) == [("b",), (None,)]


def test_route_partitions(spark):
    df = from_rows(spark, [("north",), ("south",), ("west",), ("east",)], "k string")
    placed = rows.route_partitions(df, "k", {"north": 0, "south": 1}, 2, 3).withColumn("p", F.spark_partition_id())
    assert got(placed) == [("east", 2), ("north", 0), ("south", 1), ("west", 2)]


def test_lookup_with_default_by_broadcast_and_by_shuffle(spark, monkeypatch):
    df = from_rows(spark, [("a", 1), ("b", 1), (None, 1)], "k string, n long")
    dim = from_rows(spark, [("a", 2)], "k string, v long")
    want = [("a", 1, 2), ("b", 1, 0), (None, 1, 0)]
    assert got(joins.lookup(df, dim, "k", "v", 0)) == want
    big = joins.broadcast_if_small(from_rows(spark, [("a", 2), ("c", 1)], "k string, v long"), 40)
    assert "broadcast" not in big._jdf.queryExecution().logical().toString().lower()
    monkeypatch.setattr(joins, "broadcast_if_small", lambda d, **_: d)
    assert got(joins.lookup(df, dim, "k", "v", 0)) == want


def test_star_counts_with_large_and_small_dimensions(spark, monkeypatch):
    fact = from_rows(spark, [(1, 1), (1, 1), (1, 2), (9, None)], "a long, b long")
    dims = [
        joins.Dim(from_rows(spark, [(1, "x")], "pa long, p string"), "a", "pa"),
        joins.Dim(from_rows(spark, [(1, "y"), (2, "z")], "qb long, q string"), "b", "qb"),
    ]
    want = [("x", "y", 2), ("x", "z", 1), (None, None, 1)]
    total = lambda: got(joins.star_counts(fact, dims).groupBy("p", "q").agg(F.sum("n")))
    assert total() == want
    monkeypatch.setattr(joins, "broadcast_if_small", lambda d, **_: d)
    assert total() == want


def test_cogroup_counts(spark):
    a = from_rows(spark, [("x",), ("x",), ("y",)], "k string")
    b = from_rows(spark, [("y",), ("z",)], "k string")
    c = from_rows(spark, [("z",)], "k string")
    assert got(joins.cogroup_counts({"a": a, "b": b, "c": c}, "k")) == [
        ("x", 2, 0, 0), ("y", 1, 1, 0), ("z", 0, 1, 1),
    ]


def _sides(spark, left, right):
    schema = "k string, {0} long, {0}_ts timestamp"
    make = lambda data, n: from_rows(spark, [(k, i, at(s)) for i, (k, s) in enumerate(data)], schema.format(n))
    return make(left, "l"), make(right, "r")


def test_interval_join_includes_both_ends(spark):
    left, right = _sides(spark, [("a", 10)], [("a", 5), ("a", 15), ("a", 4), ("a", 16), ("b", 10)])
    joined = joins.interval_join(left, right, KEY, "l_ts", "r_ts", "-5 seconds", "5 seconds")
    assert got(joined, "l", "r") == [(0, 0), (0, 1)]


seconds = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), min_size=1, max_size=15)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=seconds, right=seconds, lo=st.integers(-7, 3), width=st.integers(0, 6))
def test_interval_join_by_hand(spark, left, right, lo, width):
    l, r = _sides(spark, left, right)
    joined = joins.interval_join(l, r, KEY, "l_ts", "r_ts", f"{lo} seconds", f"{lo + width} seconds")
    want = [
        (i, j)
        for i, (ka, a) in enumerate(left)
        for j, (kb, b) in enumerate(right)
        if ka == kb and a + lo <= b <= a + lo + width
    ]
    assert got(joined, "l", "r") == sorted(want, key=str)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=seconds, right=seconds)
def test_reconcile_uses_rows_up(spark, left, right):
    l, r = _sides(spark, left, right)
    want, waiting = [], {}
    order = sorted([(t, 0, i, k) for i, (k, t) in enumerate(left)] + [(t, 1, i, k) for i, (k, t) in enumerate(right)])
    for t, side, i, k in order:
        queue = waiting.setdefault(k, [])
        open_ = [q for q in queue if q[0] >= t - 5]
        if open_ and open_[0][1] != side:
            queue.remove(open_[0])
            want.append((open_[0][2], i, "matched") if side else (i, open_[0][2], "matched"))
        else:
            waiting[k] = [*open_, (t, side, i)]
            want += [_alone(q) for q in queue if q not in open_]
    want += [_alone(q) for queue in waiting.values() for q in queue]
    for max_rows in (None, 4):
        out = joins.reconcile(l, r, KEY, "l_ts", "r_ts", "5 seconds", max_rows)
        assert got(out, "l", "r", "status") == sorted(want, key=str)


def _alone(open_row):
    _, side, i = open_row
    return (None, i, "right_only") if side else (i, None, "left_only")


def test_keyed_aggregates(spark):
    df = from_rows(spark, [("p", 7), ("p", 2), ("q", 9), ("q", 4), ("q", 6), ("p", 10)], "k string, v long")
    assert got(aggs.int_avg(df, KEY, "v")) == [("p", 6), ("q", 6)]
    halves = from_rows(spark, [("p", 0, 3), ("p", 0, 8), ("p", 1, 5), ("q", 0, 4)], "k string, part long, v long")
    total = aggs.two_stage_agg(halves, KEY, ["part"], F.max("v").alias("top"), F.sum("top").alias("s"))
    assert got(total) == [("p", 13), ("q", 4)]


def test_action_counts_count_each_kind_by_itself(spark):
    data = [("5", None, None), (None, ["5", "6"], None), ("6", ["7"], ["5", "5"]), (None, None, None)]
    df = from_rows(spark, data, "click string, orders array<string>, pays array<string>")
    kinds = {
        "clicks": F.when(F.col("click").isNotNull(), F.array("click")),
        "orders": F.col("orders"),
        "pays": F.col("pays"),
    }
    assert got(aggs.action_counts(df, kinds)) == [("5", 1, 1, 2), ("6", 1, 1, 0), ("7", 0, 1, 0)]


def test_metrics_on_the_side(spark):
    df, seen = aggs.with_metrics(spark.range(1, 5), total=F.sum("id"))
    assert df.count() == 4
    assert seen.get["total"] == 10


def test_bitmap_counts_collisions_once(spark):
    # With two bits "1" (49) and "5" (53) fall together: 49 & 3 == 53 & 3.
    df = from_rows(spark, [(at(0), "1"), (at(1), "5"), (at(2), "2")], "ts timestamp, u string")
    assert aggs.bitmap_distinct(df, "ts", "1 hour", "u", bits=2).first()["distinct"] == 2
    assert aggs.windowed_distinct(df, "ts", "1 hour", "u").first()["distinct"] == 3


def test_hashes(spark):
    df = from_rows(spark, [("12",), ("sensor_1",), ("é",), ("a\U0001f600",), ("",)], "s string")
    hashed = df.select(hashing.poly_hash(F.col("s"), 61, 29), hashing.hash_code(F.col("s"))).collect()
    assert hashed[0][0] == 49 * 61 + 50 == 3039

    def by_hand(text):
        units = memoryview(text.encode("utf-16-le")).cast("H")
        h = 0
        for u in units:
            h = (h * 31 + u) & 0xFFFFFFFF
        return h - (1 << 32) if h >= 1 << 31 else h

    words = [r.s for r in df.collect()]
    assert [r[1] for r in hashed] == [float(by_hand(w)) for w in words]
    udfs.register_hash_code(spark, 1.0)
    assert [r[0] for r in spark.sql("SELECT hash_code(s) FROM {d}", d=df).collect()] == [r[1] for r in hashed]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 4000), st.integers(-9, 9)), min_size=1, max_size=30))
def test_panes_equal_direct_windows(spark, data):
    df = from_rows(spark, [(k, at(s), v) for k, s, v in data], "k string, ts timestamp, v long")
    given_aggs = {"n": ("count", "*"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")}
    args = (df, "ts", "20 minutes", "5 minutes", KEY, given_aggs)
    assert got(windows.slide(*args)) == got(windows.slide(*args, updates=True))


def test_slide_that_is_no_multiple(spark):
    df = events(spark, ("a", 0, 1.0), ("a", 8, 2.0))
    out = windows.slide(df, "ts", "10 seconds", "4 seconds", KEY, {"n": ("count", "*")})
    assert got(out, "window_start", "n") == sorted(
        [(at(-8), 1), (at(-4), 1), (at(0), 2), (at(4), 1), (at(8), 1)], key=str
    )


def test_processing_time_window(spark):
    out = windows.tumble(spark.range(10), F.current_timestamp(), "1 day", [], {"n": ("count", "*")})
    assert [r.n for r in out.collect()] == [10]


def test_top_n_and_rank(spark):
    df = from_rows(spark, [("g", "a", 3), ("g", "b", 3), ("g", "c", 1), ("g", "d", 1)], "g string, i string, n long")
    first = topn.top_n_per_group(df, ["g"], [F.desc("n"), F.asc("i")], 3)
    assert got(first, "i", "rank") == [("a", 1), ("b", 2), ("c", 3)]
    assert got(topn.top_by_rank(df, ["g"], [F.desc("n")], 3), "i", "rank") == [("a", 1), ("b", 1), ("c", 3), ("d", 3)]
    assert got(udfs.top2(from_rows(spark, [("x", 1.0)], "k string, v double"), KEY, "v")) == [("x", 1.0, 1)]


def test_city_remark(spark):
    cities = ["p"] * 5 + ["q"] * 3 + ["r"] * 2 + ["s"]
    data = [("n", "shoe", c) for c in cities] + [("n", "hat", "p"), ("n", "hat", "q")]
    out = udfs.city_remark(from_rows(spark, data, "area string, product string, city string"), ["area", "product"], "city")
    assert got(out) == [("n", "hat", 2, "p 50 %,q 50 %"), ("n", "shoe", 11, "p 45 %,q 27 %,其它 28 %")]


def test_changelog(spark):
    schema = "k string, n long"
    old = from_rows(spark, [("a", 1), ("b", 2), ("d", None)], schema)
    new = from_rows(spark, [("a", 1), ("b", 3), ("c", 1), ("d", None)], schema)
    assert got(changes.changelog(old, new, KEY)) == [(False, "b", 2), (True, "b", 3), (True, "c", 1)]
    assert got(changes.changelog(new, old, KEY)) == [(False, "b", 3), (False, "c", 1), (True, "b", 2)]


def test_materialize(spark):
    df = spark.range(5)
    assert changes.materialize(df, "persist").is_cached
    assert changes.materialize(df, "checkpoint").count() == 5
    with pytest.raises(ValueError):
        changes.materialize(df, "elsewhere")


def test_jump_alert_is_silent_on_the_first_reading(spark):
    df = events(spark, ("a", 0, 35.0), ("a", 1, 46.0), ("a", 2, 40.0), ("b", 0, 90.0))
    assert got(sequences.jump_alert(df, KEY, ORDER, "v", 10), "k", "v", "previous") == [("a", 46.0, 35.0)]


def test_rise_alert_is_a_timer(spark):
    run = lambda *r: got(sequences.rise_alert(events(spark, *[("a", s, v) for s, v in r]), KEY, ORDER, "v", "10 seconds"))
    # Armed at 4, fired at 14, armed again by the rise at 20.
    assert run((0, 5.0), (4, 6.0), (8, 6.0), (12, 7.0), (20, 8.0), (21, 1.0), (40, 1.0)) == [("a", at(4), at(14))]
    # A fall at the very end still clears; a key that is silent after its rise is told.
    assert run((0, 1.0), (1, 2.0), (11, 1.5), (12, 2.0)) == [("a", at(12), at(22))]
    assert run((0, 1.0)) == []
    assert run((0, 1.0), (1, None), (2, 5.0)) == []
    # A rise of 35 seconds fires three times.
    assert run(*[(s, float(s)) for s in range(36)]) == [("a", at(s), at(s + 10)) for s in (1, 12, 23, 34)]


def test_burst_is_cleared_by_success_and_closes_on_time(spark):
    fails = lambda *s: [("a", x, "fail") for x in s]
    run = lambda *r: got(
        sequences.burst_alert(events(spark, *r), KEY, ORDER, F.col("v") == "fail", 2, "2 seconds"), "start_ts", "n_fails"
    )
    assert run(*fails(42, 43, 44)) == [(at(42), 3)]
    assert run(*fails(82, 86)) == []
    assert run(*fails(1, 2), ("a", 3, "success"), *fails(9)) == []
    assert run(*fails(1, 2), ("a", 4, "success")) == [(at(1), 2)]
    assert run(*fails(1, 2, 4, 5)) == [(at(1), 2), (at(4), 2)]


def test_strict_sequence_breaks_on_other_events(spark):
    steps = [F.col("v") == "fail"] * 2
    run = lambda *r: got(sequences.strict_sequence(events(spark, *r), KEY, ORDER, steps, "2 seconds"), "step_1.ts", "step_2.ts")
    assert run(("a", 1, "fail"), ("a", 2, "fail")) == [(at(1), at(2))]
    assert run(("a", 1, "fail"), ("a", 2, "success"), ("a", 2.5, "fail")) == []
    assert run(("a", 1, "fail"), ("a", 3, "fail")) == []
    assert run(("a", 1, "fail"), ("b", 2, "fail")) == []


def test_order_pay(spark):
    df = events(
        spark, ("1", 0, "create"), ("1", 5, "other"), ("1", 10, "pay"),
        ("2", 0, "create"), ("2", 301, "pay"), ("3", 4, "pay"), ("4", 0, "create"), ("5", 0, "create"), ("5", 300, "pay"),
    )
    out = sequences.followed_by(df, KEY, ORDER, F.col("v") == "create", F.col("v") == "pay", "5 minutes")
    assert got(out, "k", "then_row.ts") == [("1", at(10)), ("2", None), ("4", None), ("5", None)]


def test_daily_cap_by_event_day(spark):
    day = 86400
    df = events(spark, *[("a", s, "x") for s in (1, 2, 3, 4, day + 1, day + 2)], ("b", 1, "x"))
    passed, alerts = sequences.daily_cap(df, KEY, ORDER, 2)
    assert got(passed, "k", "ts") == sorted(
        [("a", at(1)), ("a", at(2)), ("a", at(day + 1)), ("a", at(day + 2)), ("b", at(1))], key=str
    )
    assert got(alerts, "k", "ts") == [("a", at(3))]


def test_marker_watermark(spark):
    df = events(spark, ("x", 100, "m"), ("x", 30, "o"), ("x", 60, "o"), ("x", 90, "m"), ("x", 41, "o"))
    out = sequences.marker_watermark(df, ["id"], "ts", F.col("v") == "m", "1 minute")
    assert got(out, "id", "watermark", "late") == [
        (0, at(40), False), (1, at(40), True), (2, at(40), False), (3, at(40), False), (4, at(40), False),
    ]


def test_conversion_counts_direct_steps(spark):
    from clickloom.plans.traffic import conversion

    df = events(spark, *[("s1", i, p) for i, p in enumerate("1213")], ("s2", 0, "1"), ("s2", 1, "2"), ("s2", 2, "3"))
    out = conversion(df, KEY, ORDER, "v", ["1", "2", "3"])
    assert got(out) == [("1", "2", 2, 3, 2 / 3), ("2", "3", 1, 2, 0.5)]
