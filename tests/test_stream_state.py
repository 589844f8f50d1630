"""What the ordered streams keep: typed rows in slots, and timers that touch what is due."""

import datetime as dt
import decimal
from types import SimpleNamespace

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators import sequences, windows
from clickloom.streaming import run, stateful

MINUTE = 60_000_000


class Value:
    def __init__(self, counts):
        self.counts, self.value = counts, None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Map(dict):
    def __init__(self, counts, name):
        self.counts, self.name = counts, name

    def getValue(self, key):
        self.counts[self.name] = self.counts.get(self.name, 0) + 1
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Handle:
    def __init__(self):
        self.counts, self.timers = {}, set()

    def getValueState(self, name, schema):
        return Value(self.counts)

    def getMapState(self, name, key, value):
        return Map(self.counts, name)

    def registerTimer(self, ms):
        self.timers.add(ms)


def processor(step, queued="bigint"):
    row = T.StructType.fromDDL("n bigint, at_us bigint")
    p = stateful.InOrder(step, row, "seen bigint", queued, ["at_us", "n"], ["k", "n"], [], ["k"], 10_000_000)
    p.handle_ = Handle()
    p.init(p.handle_)
    return p


def fire(p, watermark_us):
    times = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark_us // 1000)
    return [r["n"] for r in p.handleExpiredTimer(("a",), times, None)]


def echo(memory, rows, watermark, queue):
    memory["seen"] = (memory.get("seen") or 0) + len(rows)
    return [{"n": r["n"]} for r in rows], None


def put(p, at):
    list(p.handleInputRows(("a",), iter([Row(n=n, at_us=us) for n, us in at]), None))


def test_a_timer_reads_what_is_due(spark):
    """Ten minutes of waiting rows cost a timer nothing."""
    for minutes in (1, 10):
        p = processor(echo)
        put(p, [(i, 1_000_000 + i) for i in range(50)])
        put(p, [(1_000 + i, 30_000_000 + i * 1_000) for i in range(minutes * 60_000)])
        p.handle_.counts.clear()
        assert fire(p, 5_000_000) == list(range(50))
        assert p.handle_.counts == {"waiting": 1}
        assert fire(p, 5_000_000) == [] and p.handle_.counts == {"waiting": 1}


def test_rows_of_one_slot_leave_when_they_are_due(spark):
    p = processor(echo)
    put(p, [(3, 3_000_000), (1, 1_000_000)])
    put(p, [(2, 2_000_000), (9, 25_000_000), (8, 3_000_000)])
    assert p.handle_.timers == {1_001}
    assert fire(p, 2_500_000) == [1, 2] and 3_001 in p.handle_.timers
    put(p, [(4, 4_000_000)])
    assert fire(p, 60_000_000) == [3, 8, 4, 9]
    assert not p.index.exists() and not p.waiting
    assert p.memory.get() == (None, None, 6)


def test_queue_takes_one_entry_at_a_time(spark):
    def keep(memory, rows, watermark, queue):
        for r in rows:
            queue.push(r["n"])
        out = [{"n": queue.pop()}] if queue else []
        return out, None

    p = processor(keep)
    put(p, [(i, i) for i in range(100)])
    assert fire(p, 1_000_000) == [0]
    p.handle_.counts.clear()
    assert [fire(p, 1_000_000 + i)[0] for i in range(5)] == [1, 2, 3, 4, 5]
    assert p.handle_.counts == {"queue": 5} and len(p.queue) == 94


def test_order_of_what_is_missing():
    nan = float("nan")
    values = [3.0, None, nan, -1.0]
    assert [str(v) for v in sorted(values, key=stateful._rank)] == ["None", "-1.0", "3.0", "nan"]
    assert sorted([[1, None], [None, 2], None, [1, 0]], key=stateful._rank) == [None, [None, 2], [1, None], [1, 0]]


def test_whole_rows_of_any_type(spark, tmp_path):
    """The cap passes whole rows on, with every column as it was, nulls and large numbers too."""
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    schema = "user long, ts timestamp, n long, province string, price decimal(20,4), day date, place struct<lat: double, name: string>, tags array<string>, more map<string,long>, seen timestamp, raw binary"
    rows = []
    for i in range(40):
        full = i % 3 > 0
        rows.append(
            (i % 4 if i % 7 else None, base + dt.timedelta(seconds=i), 2**60 + i, f"p{i % 2}" if full else None, decimal.Decimal("0.1") + i if full else None,
             dt.date(2024, 1, 1) if full else None, (i / 3, None) if full else None, ["a", None] if full else None, {"k": i} if full else None,
             base - dt.timedelta(microseconds=i) if full else None, b"\x00\xff" if full else None)
        )
    rows.append((-1, base + dt.timedelta(days=90), 0, *[None] * 8))
    table = spark.createDataFrame(rows, schema)
    table.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = run.with_event_time(spark.readStream.schema(table.schema).parquet(str(tmp_path / "in")), "ts", "1 second")
    run.run_stream(stateful.daily_cap(stream, ["user"], ["ts", "n"], 3), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    passed, alerts = sequences.daily_cap(table.filter("n <> 0"), ["user"], ["ts", "n"], 3)
    want = passed.withColumn("alert", F.lit(False)).unionByName(alerts.drop("day_").withColumn("alert", F.lit(True)), allowMissingColumns=True)

    def plain(df):
        return sorted(str({k: v for k, v in r.asDict(recursive=True).items() if k != "day"}) for r in df.select(*sorted(got.columns)).collect())

    assert got.columns == ["user", *[c for c in table.columns if c != "user"], "alert"]
    assert plain(got) == plain(want) and got.count() > 15
    assert {r["day"] for r in got.filter("NOT alert").collect()} == {None, dt.date(2024, 1, 1)}


def test_windows_close_by_markers(spark, tmp_path):
    """Only markers move the watermark: windows up to the last one close, however far other rows are ahead."""
    schema, path = "id long, ts timestamp, kind string", str(tmp_path / "in")
    minutes = [[0, 1, 2, 501], [3, 4, 20], [21, 22, 40], [38, 39, 61], [62, 63, 64]]
    for i, some in enumerate(minutes):
        rows = [(100 * i + m, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=m), "mark" if m % 20 == 0 and m else "row") for m in some]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    marked = run.with_marker_time(stream, "ts", F.col("kind") == "mark", "2 minutes")
    assert marked.columns == table.columns
    sums = {"n": ("count", "*"), "last": ("max", "id")}
    query = run.run_stream(windows.tumble(marked, "ts", "10 minutes", [], sums), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    # The last marker is at 40; minute 501 is no marker and its window stays open.
    whole = windows.tumble(table, "ts", "10 minutes", [], sums)
    closed = whole.filter(F.col("window_end") <= F.lit(dt.datetime(2024, 1, 1, 0, 38, tzinfo=dt.timezone.utc)))
    assert sorted(map(tuple, got.select(sorted(closed.columns)).collect())) == sorted(map(tuple, closed.select(sorted(closed.columns)).collect()))
    assert got.count() == 2 and query.exception() is None


def test_no_marker_closes_nothing(spark, tmp_path):
    schema, path = "id long, ts timestamp, kind string", str(tmp_path / "in")
    rows = [(m, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=m), None if m % 2 else "row") for m in range(60)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    marked = run.with_marker_time(spark.readStream.schema(schema).parquet(path), "ts", F.col("kind") == "mark", "0 seconds")
    run.run_stream(windows.tumble(marked, "ts", "10 minutes", [], {"n": ("count", "*")}), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.schema("n long").parquet(str(tmp_path / "out")).count() == 0
