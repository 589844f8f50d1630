"""Streams in several micro-batches against the table form of the same operator."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom.operators import aggs, joins, rows, sequences, topn, windows
from clickloom.sinks.keyed import read_keyed
from clickloom.sources import tables, text
from clickloom.sources.tables import load
from clickloom.streaming import run, stateful

USER, ORDER = ["user_id"], ["ts", "event_id"]
LAST = dt.datetime(2024, 6, 1)
FILES = 3


def same(a, b):
    cols = sorted(b.columns)
    a, b = a.select(cols), b.select(cols)
    assert b.count() > 0
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def is_(kind):
    return F.col("event_type") == kind


@pytest.fixture(scope="module", autouse=True)
def two_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("long")).drop("props").cache()


@pytest.fixture(scope="module")
def folder(table, tmp_path_factory):
    """Files, each with rows of its own stretch of time in mixed order, then a row far ahead."""
    path = str(tmp_path_factory.mktemp("events"))
    n = table.count()
    for i in range(FILES):
        part = table.filter((F.col("event_id") >= i * n // FILES) & (F.col("event_id") < (i + 1) * n // FILES))
        part.orderBy(F.hash("event_id")).coalesce(1).write.mode("append").parquet(path)
    ahead = table.limit(1).withColumns(
        {"ts": F.lit(LAST), "user_id": F.lit(-1).cast("long"), "event_type": F.lit("flush")}
    )
    ahead.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture
def stream(spark, table, folder):
    events = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return run.with_event_time(events, "ts", "1 minute")


@pytest.fixture
def finished(spark, tmp_path):
    def finish(df, mode="append"):
        out = str(tmp_path / "out")
        run.run_stream(df, out, str(tmp_path / "checkpoint"), mode)
        return spark.read.parquet(out)

    return finish


def no_flush(df):
    return df.filter(F.col("user_id") != -1)


def test_tumble(stream, table, finished):
    got = finished(windows.tumble(stream, "ts", "1 hour", ["event_type"], {"low": ("min", "value")}))
    same(got.filter("event_type != 'flush'"), windows.tumble(table, "ts", "1 hour", ["event_type"], {"low": ("min", "value")}))


def test_slide_by_panes(stream, table, finished):
    args = ("ts", "1 hour", "10 minutes", ["event_type"], {"n": ("count", "*"), "avg": ("avg", "k")})
    got = finished(windows.slide(stream, *args))
    same(got.filter("event_type != 'flush'"), windows.slide(table, *args))


def test_slide_updates(spark, stream, table, tmp_path):
    args = ("ts", "1 hour", "30 minutes", ["event_type"], {"n": ("count", "*")})
    keys = ["window_start", "window_end", "event_type"]
    path = str(tmp_path / "keyed")
    run.run_stream(
        windows.slide(stream, *args, updates=True), run.keep_keyed(path, keys), str(tmp_path / "cp"), "update"
    )
    same(read_keyed(spark, path, keys).filter("event_type != 'flush'"), windows.slide(table, *args))


def test_window_top_n(spark, stream, table, tmp_path):
    views = stream.filter(is_("view") | is_("flush"))
    counts = windows.slide(views, "ts", "6 hours", "1 hour", ["k"], {"count": ("count", "*")})
    sink = run.keep_top_n(str(tmp_path / "top"), ["window_start", "window_end"], [F.desc("count"), F.asc("k")], 3)
    run.run_stream(counts, sink, str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "top")).drop("batch").filter(F.col("window_end") < F.lit(dt.datetime(2024, 3, 1)))
    same(got, topn.window_top_n(table.filter(is_("view")), "ts", "6 hours", "1 hour", "k", 3))


def test_windowed_distinct(stream, table, finished):
    got = finished(aggs.windowed_distinct(stream, "ts", "1 hour", "user_id"))
    same(got.filter(F.col("window_end") < F.lit(dt.datetime(2024, 3, 1))), aggs.windowed_distinct(table, "ts", "1 hour", "user_id"))


def test_distinct_by_bitmap_is_up_to_date_per_batch(spark, stream, table, tmp_path):
    new = run.new_in_window(stream.filter(is_("view")), "ts", "1 hour", "user_id")
    run.run_stream(new, run.keep_distinct(str(tmp_path / "uv")), str(tmp_path / "cp"))
    got = read_keyed(spark, str(tmp_path / "uv"), ["window_start", "window_end"], "add")
    same(got, aggs.bitmap_distinct(table.filter(is_("view")), "ts", "1 hour", "user_id", name="uv"))


def test_running_counts(spark, stream, table, tmp_path):
    counts = run.running_counts(stream, ["event_type"])
    run.run_stream(counts, run.keep_keyed(str(tmp_path / "n"), ["event_type"]), str(tmp_path / "cp"), "update")
    got = read_keyed(spark, str(tmp_path / "n"), ["event_type"]).filter("event_type != 'flush'")
    same(got, table.groupBy("event_type").count())


def test_changelog_of_running_counts(spark, stream, table, tmp_path):
    sink = run.keep_changelog(str(tmp_path / "log"), str(tmp_path / "state"), ["event_type"])
    run.run_stream(run.running_counts(stream, ["event_type"]), sink, str(tmp_path / "cp"), "update")
    log = spark.read.parquet(str(tmp_path / "log")).filter("event_type != 'flush'")
    assert log.filter("not added").count() == 5 * (FILES - 1)
    net = log.groupBy("event_type").agg(F.sum(F.when(F.col("added"), F.col("count")).otherwise(-F.col("count"))).alias("count"))
    same(net, table.groupBy("event_type").count())


def test_per_batch(spark, stream, table, tmp_path):
    sink = run.per_batch(lambda b: b.groupBy("event_type").count(), str(tmp_path / "n"))
    run.run_stream(stream, sink, str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "n"))
    assert got.select("batch").distinct().count() == FILES + 1
    total = got.filter("event_type != 'flush'").groupBy("event_type").agg(F.sum("count").alias("count"))
    same(total, table.groupBy("event_type").count())


def test_blacklist(spark, stream, table, tmp_path):
    path, keys = str(tmp_path / "black"), ["day", "user_id", "event_type"]
    run.run_stream(stream, run.keep_blacklist(path, "ts", "user_id", "event_type", 2), str(tmp_path / "cp"))
    got = read_keyed(spark, path, keys, "add").filter("event_type != 'flush'")
    n = table.count()
    seen = table.collect()
    counts, blocked = {}, set()
    for i in range(FILES):
        lo, hi = i * n // FILES, (i + 1) * n // FILES
        for r in seen:
            if lo <= r.event_id < hi and r.user_id not in blocked:
                key = (r.ts.date(), r.user_id, r.event_type)
                counts[key] = counts.get(key, 0) + 1
        blocked = {key[1] for key, c in counts.items() if c >= 2}
    assert {(r.day, r.user_id, r.event_type): r["count"] for r in got.collect()} == counts


def test_marker_watermark(spark, stream, table, tmp_path):
    sink = run.keep_marked(
        str(tmp_path / "rows"), str(tmp_path / "state"), ["event_id"], "ts", is_("error"), "1 minute"
    )
    run.run_stream(stream, sink, str(tmp_path / "cp"))
    got = no_flush(spark.read.parquet(str(tmp_path / "rows"))).drop("batch")
    same(got, sequences.marker_watermark(table, ["event_id"], "ts", is_("error"), "1 minute"))


def _sides(df):
    pay = df.filter(is_("purchase")).select("user_id", F.col("event_id").alias("pay"), F.col("ts").alias("pay_ts"))
    receipt = df.filter(is_("click")).select("user_id", F.col("event_id").alias("rec"), F.col("ts").alias("rec_ts"))
    return pay, receipt


def _stream_sides(spark, table, folder):
    events = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    # The row far ahead goes to both sides, since the slower side sets the watermark.
    pay = events.filter(is_("purchase") | is_("flush")).select(
        "user_id", F.col("event_id").alias("pay"), F.col("ts").alias("pay_ts")
    )
    receipt = events.filter(is_("click") | is_("flush")).select(
        "user_id", F.col("event_id").alias("rec"), F.col("ts").alias("rec_ts")
    )
    return run.with_event_time(pay, "pay_ts", "1 minute"), run.with_event_time(receipt, "rec_ts", "1 minute")


def test_interval_join(spark, table, folder, finished):
    pay, receipt = _stream_sides(spark, table, folder)
    args = (USER, "pay_ts", "rec_ts", "-5 hours", "5 hours")
    got = no_flush(finished(joins.interval_join(pay, receipt, *args)))
    same(got, joins.interval_join(*_sides(table), *args))


@pytest.mark.parametrize("how", ["left", "right", "left_semi"])
def test_interval_join_with_rows_without_a_partner(spark, table, folder, finished, how):
    pay, receipt = _stream_sides(spark, table, folder)
    args = (USER, "pay_ts", "rec_ts", "-1 hour", "2 hours", how)
    joined = joins.interval_join(pay, receipt, *args)
    # A hot key is spread: the state is dealt out by key and bucket.
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "_bucket" in plan.split("Join ")[1].splitlines()[0]
    same(no_flush(finished(joined)), joins.interval_join(*_sides(table), *args))


def test_reconcile(spark, table, folder, finished):
    pay, receipt = _stream_sides(spark, table, folder)
    args = (USER, "pay_ts", "rec_ts", "5 hours")
    got = no_flush(finished(stateful.reconcile(pay, receipt, *args)))
    same(got, joins.reconcile(*_sides(table), *args))


def test_rolling(stream, table, finished):
    got = finished(stateful.rolling(stream, USER, ORDER, 2, "k"))
    want = windows.rolling(table, USER, ORDER, 2, {"count": ("count", "*"), "avg": ("avg", "k")})
    same(got, want.select("user_id", "ts", "event_id", "count", "avg"))


def test_rolling_reduce(stream, table, finished):
    got = finished(stateful.rolling_reduce(stream, USER, ORDER, "k", "max"))
    want = sequences.rolling_reduce(table, USER, ORDER, {"max": ("max", F.col("k"))})
    same(got, want.select("user_id", "ts", "event_id", "max"))


def test_jump_alert(stream, table, finished):
    got = finished(stateful.jump_alert(stream, USER, ORDER, "value", 50.0))
    same(got, sequences.jump_alert(table, USER, ORDER, "value", 50.0).select(got.columns))


def test_rise_alert(stream, table, finished):
    got = finished(stateful.rise_alert(stream, USER, ORDER, "value", "12 hours"))
    same(got, sequences.rise_alert(table, USER, ORDER, "value", "12 hours"))


@pytest.mark.parametrize("kind, n, span", [("error", 2, "12 hours"), ("view", 1, "1 hour")])
def test_burst_alert(stream, table, finished, kind, n, span):
    got = finished(stateful.burst_alert(stream, USER, ORDER, is_(kind), n, span))
    same(got, sequences.burst_alert(table, USER, ORDER, is_(kind), n, span))


def test_strict_sequence(stream, table, finished):
    steps = [is_("error"), is_("error")]
    got = finished(stateful.strict_sequence(stream, USER, ORDER, steps, "12 hours"))
    want = sequences.strict_sequence(table, USER, ORDER, steps, "12 hours")
    same(got, want.select("user_id", F.col("step_1.ts").alias("start_ts"), F.col("step_2.ts").alias("end_ts")))


def test_followed_by(stream, table, finished):
    # The row far ahead counts as a first event, since only such rows reach the watermark.
    args = (USER, ORDER, is_("signup") | is_("flush"), is_("purchase"), "12 hours")
    want = sequences.followed_by(table, *args)
    got = finished(stateful.followed_by(stream, *args))
    same(no_flush(got), want.select("user_id", F.col("first_row.ts").alias("first_ts"), F.col("then_row.ts").alias("then_ts")))


def test_windows_of_capped_rows(stream, table, finished):
    """The cap keeps the event time, so windows per place follow."""
    place = table.sparkSession.range(0, 2_000).selectExpr("id AS place_of", "concat('place ', id % 5) AS place")

    def windows_of(passed):
        placed = passed.join(place, F.col("user_id") == F.col("place_of"))
        return windows.slide(placed, "ts", "1 hour", "10 minutes", ["place"], {"n": ("count", "*")})

    got = finished(windows_of(stateful.daily_cap(stream, USER, ORDER, 1).filter("not alert")))
    passed, _ = sequences.daily_cap(table, USER, ORDER, 1)
    same(got, windows_of(passed))


@pytest.mark.parametrize("case", ["rolling", "reduce", "jump", "rise"])
def test_missing_values(spark, table, tmp_path, finished, case):
    """Nulls in values and in what breaks ties are treated as in tables."""
    gaps = table.withColumns({"value": F.when(F.col("event_id") % 4 > 0, F.col("value")), "tie": F.when(F.col("event_id") % 3 > 0, F.col("event_id"))})
    gaps = gaps.withColumn("k", F.when(F.col("event_id") % 5 > 0, F.col("k"))).drop("event_type")
    path = str(tmp_path / "gaps")
    gaps.unionByName(gaps.limit(1).withColumns({"ts": F.lit(LAST), "user_id": F.lit(-1).cast("long")})).coalesce(1).write.parquet(path)
    stream = run.with_event_time(spark.readStream.schema(gaps.schema).parquet(path), "ts", "1 minute")
    order = ["ts", "tie"]
    if case == "rolling":
        got, want = stateful.rolling(stream, USER, order, 2, "k"), windows.rolling(gaps, USER, order, 2, {"count": ("count", "*"), "avg": ("avg", "k")})
    elif case == "reduce":
        got, want = stateful.rolling_reduce(stream, USER, order, "k", "max"), sequences.rolling_reduce(gaps, USER, order, {"max": ("max", F.col("k"))})
    elif case == "jump":
        got, want = stateful.jump_alert(stream, USER, order, "value", 50.0), sequences.jump_alert(gaps, USER, order, "value", 50.0)
    else:
        got, want = stateful.rise_alert(stream, USER, order, "value", "12 hours"), sequences.rise_alert(gaps, USER, order, "value", "12 hours")
    found = no_flush(finished(got))
    same(found, want.select(found.columns))


def test_running_stream_with_an_interval(spark, table, folder, tmp_path):
    events = spark.readStream.schema(table.schema).parquet(folder)
    path = str(tmp_path / "n")
    query = run.start_stream(run.running_counts(events, ["event_type"]), run.keep_keyed(path, ["event_type"]), str(tmp_path / "cp"), "update", every="1 second")
    assert query.isActive
    query.processAllAvailable()
    query.stop()
    same(read_keyed(spark, path, ["event_type"]).filter("event_type != 'flush'"), table.groupBy("event_type").count())
    with pytest.raises(ValueError):
        run.start_stream(events, path, "")


def test_late_rows_change_panes(spark, stream, table, tmp_path):
    """120 windows over each row, by panes in a keyed table."""
    keys = ["pane_start", "event_type"]
    panes = windows.pane_counts(stream, "ts", "10 minutes", "5 seconds", ["event_type"], "n")
    run.run_stream(panes, run.keep_keyed(str(tmp_path / "panes"), keys), str(tmp_path / "cp"), "update")
    kept = read_keyed(spark, str(tmp_path / "panes"), keys).filter("event_type != 'flush'")
    got = windows.windows_of_panes(kept, "10 minutes", "5 seconds", ["event_type"], "n")
    same(got, windows.slide(table, "ts", "10 minutes", "5 seconds", ["event_type"], {"n": ("count", "*")}))


def test_daily_cap(stream, table, finished):
    got = finished(stateful.daily_cap(stream, USER, ORDER, 1))
    passed, alerts = sequences.daily_cap(table, USER, ORDER, 1)
    cols = ["user_id", "ts", "event_id"]
    same(got.filter("not alert").drop("alert"), passed.select(cols))
    same(got.filter("alert").drop("alert"), alerts.select(cols))


def test_stream_word_count_goes_on_after_a_restart(spark, tmp_path):
    folder, keyed, checkpoint = tmp_path / "lines", str(tmp_path / "words"), str(tmp_path / "cp")
    folder.mkdir()

    def count():
        words = rows.explode_words(text.stream_lines(spark, str(folder), files_per_batch=1), "value")
        run.run_stream(run.running_counts(words, ["word"]), run.keep_keyed(keyed, ["word"]), checkpoint, "update")
        return dict(map(tuple, read_keyed(spark, keyed, ["word"]).collect()))

    (folder / "1.txt").write_text("pear plum\npear quince")
    (folder / "2.txt").write_text("pear sloe")
    assert count() == {"pear": 3, "plum": 1, "quince": 1, "sloe": 1}
    (folder / "3.txt").write_text("pear fig")
    assert count() == {"pear": 4, "plum": 1, "quince": 1, "sloe": 1, "fig": 1}


def test_stream_to_csv_file_table(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "sensor.txt").write_text("m_4, 1700000004, 21.5\nm_9, 1700000011, 9.25")
    readings = text.parse_delimited(
        text.stream_lines(spark, str(folder)), "id string, timestamp long, temperature double"
    )
    run.run_stream(readings.select("id", "temperature"), str(tmp_path / "out"), str(tmp_path / "cp"), fmt="csv")
    assert sorted(r.value for r in text.read_lines(spark, str(tmp_path / "out")).collect()) == ["m_4,21.5", "m_9,9.25"]


def test_clicks_per_area_add_up_over_batches(spark, stream, table, tmp_path):
    keys = ["day", "event_type"]
    daily = lambda df: df.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("count"))
    add = run.keep_keyed(str(tmp_path / "n"), keys, "add")
    run.run_stream(stream, lambda batch, i: add(daily(batch), i), str(tmp_path / "cp"))
    got = read_keyed(spark, str(tmp_path / "n"), keys, "add").filter("event_type != 'flush'")
    same(got, daily(table))


def test_given_table_as_stream(spark, sf_dir, finished):
    events = run.with_event_time(tables.stream(spark, sf_dir, "events"), "ts")
    got = finished(windows.tumble(events, "ts", "1 day", [], {"n": ("count", "*")}))
    whole = windows.tumble(load(spark, sf_dir, "events"), "ts", "1 day", [], {"n": ("count", "*")})
    last = whole.agg(F.max("window_start")).first()[0]
    # The last day stays open, since nothing later moves the watermark.
    assert got.count() == whole.count() - 1
    same(got.select("n"), whole.filter(F.col("window_start") < F.lit(last)).select("n"))
