"""Parsers, payloads, files and keyed tables on small hand-made rows."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.sinks import files, keyed, payloads
from clickloom.sources import tables, text

SENSOR = "id string, timestamp long, temperature double"


def lines(spark, *values):
    return text.from_rows(spark, [(v,) for v in values], "value string")


def test_delimited_lines_are_trimmed_and_bad_fields_are_null(spark):
    df = lines(spark, "m_4, 1700000004, 21.5", "some text", "s_2,x,1.5", "s_3,1,2,3")
    rows = text.parse_delimited(df, SENSOR).collect()
    assert [tuple(r) for r in rows] == [
        ("m_4", 1700000004, 21.5),
        ("some text", None, None),
        ("s_2", None, 1.5),
        ("s_3", 1, 2.0),
    ]


def test_sentinels_become_null(spark):
    df = lines(spark, "u1_-1_null_3", "u2_5_1,2_")
    rows = text.parse_delimited(df, "u string, click long, orders string, city long", "_", ["-1", "null", ""])
    assert [tuple(r) for r in rows.collect()] == [("u1", None, None, 3), ("u2", 5, "1,2", None)]


@pytest.mark.parametrize("sep", ["\t", "|", ".", " "])
def test_any_separator(spark, sep):
    rows = text.parse_delimited(lines(spark, sep.join("abc")), "x string, y string, z string", sep).collect()
    assert [tuple(r) for r in rows] == [("a", "b", "c")]


def test_access_log(spark):
    df = lines(spark, "83.1.2.3 - u7 17/05/2015:10:05:03 +0000 GET /blog/x.html", "broken line")
    first, second = text.parse_access_log(df).collect()
    assert tuple(first) == ("83.1.2.3", "u7", dt.datetime(2015, 5, 17, 10, 5, 3), "GET", "/blog/x.html")
    assert second.event_time is None and second.url is None


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_messages_there_and_back(spark, fmt):
    df = text.from_rows(spark, [("a,b", 1, 2.5), ('q"', None, -1.0)], "id string, n long, x double")
    sent = payloads.to_messages(df, "id", fmt)
    assert sent.columns == ["key", "value"]
    back = text.parse_messages(sent.withColumn("value", F.encode("value", "utf-8")), df.schema, fmt, ",")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_click_messages(spark):
    df = lines(spark, "1623916800000 north peking 4 12")
    row = text.parse_messages(df, "ts long, area string, city string, userid string, adid string").first()
    assert tuple(row) == (1623916800000, "north", "peking", "4", "12")


def test_documents_hold_strings(spark):
    df = text.from_rows(spark, [("s1", 5, 1.5)], "id string, n long, t double")
    row = payloads.to_documents(df, "id").first()
    assert row.id == "s1" and json.loads(row.source) == {"id": "s1", "n": "5", "t": "1.5"}


def test_text_and_csv_files(spark, tmp_path):
    df = text.from_rows(spark, [("m_4", 21.5), ("m_4", 32.0)], "id string, temperature double")
    files.write_csv(df, str(tmp_path / "csv"))
    files.write_csv(df.limit(1), str(tmp_path / "csv"))
    table = tables.register_table(spark, "outputs", str(tmp_path / "csv"), "id string, temperature double")
    assert table.count() == 3
    assert spark.sql("SELECT sum(temperature) AS s FROM outputs").first().s == pytest.approx(75.0)
    files.write_text(df.select("id"), str(tmp_path / "text"))
    assert sorted(r.value for r in text.read_lines(spark, str(tmp_path / "text")).collect()) == ["m_4", "m_4"]


def test_declared_table_trims(spark, tmp_path):
    (tmp_path / "sensor.txt").write_text("m_4, 1700000004, 21.5\nm_9, 1700000011, 9.25")
    table = tables.register_table(spark, "sensor", str(tmp_path / "sensor.txt"), SENSOR)
    renamed = tables.as_table(table, "id", view="renamed", ts="timestamp", temp="temperature")
    assert renamed.columns == ["id", "ts", "temp"]
    assert spark.table("renamed").filter("id = 'm_4'").first().temp == 21.5


def test_upsert_replaces_and_adds(spark, tmp_path):
    schema = "k string, v long"
    for mode, want in (("replace", {"a": 5, "b": 2, "c": 7}), ("add", {"a": 6, "b": 2, "c": 7})):
        path = str(tmp_path / mode)
        assert keyed.read_keyed(spark, path, ["k"], mode) is None
        keyed.upsert_keyed(text.from_rows(spark, [("a", 1), ("b", 2)], schema), 0, path, ["k"], mode)
        second = text.from_rows(spark, [("a", 5), ("c", 7)], schema)
        keyed.upsert_keyed(second, 1, path, ["k"], mode)
        keyed.upsert_keyed(second, 1, path, ["k"], mode)
        read = lambda: dict(map(tuple, keyed.read_keyed(spark, path, ["k"], mode).collect()))
        assert read() == want
        keyed.compact_keyed(spark, path, ["k"], mode)
        assert read() == want
        keyed.upsert_keyed(text.from_rows(spark, [("b", 10)], schema), 2, path, ["k"], mode)
        assert read()["b"] == (10 if mode == "replace" else 12)


def test_compacted_now_and_then(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in [0, 1, 2, 1, 2, 3, 3]:
        batch = text.from_rows(spark, [("a", i), ("b", 1)], "k string, v long")
        keyed.upsert_keyed(batch, i, path, ["k"], "add", compact_every=2)
    # The newest two bases stay, with the batches behind the older one; a replay of the last batch needs no more.
    assert keyed._finished(spark, path, "base") == [2, 3]
    assert keyed._finished(spark, path, "delta") == [3]
    assert got_dict(keyed.read_keyed(spark, path, ["k"], "add")) == {"a": 6, "b": 4}
    assert got_dict(keyed.read_keyed(spark, path, ["k"], "add", before=3)) == {"a": 3, "b": 3}


def test_only_touched_buckets_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    whole = spark.range(200).selectExpr("id AS k", "id AS v")
    keyed.upsert_keyed(whole, 0, path, ["k"])
    keyed.upsert_keyed(spark.range(3).selectExpr("id AS k", "id + 1000 AS v"), 1, path, ["k"])
    few = spark.range(2).selectExpr("id AS k")
    some = keyed.read_keyed(spark, path, ["k"], of=few)
    read = {f.split("_bucket=")[1].split("/")[0] for f in some.inputFiles()}
    assert len(read) <= 2 and 2 <= some.count() < 100
    assert {r.k: r.v for r in some.collect() if r.k < 2} == {0: 1000, 1: 1001}
    assert keyed.read_keyed(spark, path, ["k"], of=few.limit(0)).count() == 0
    keyed.upsert_keyed(whole.limit(0), 2, path, ["k"])
    assert keyed.read_keyed(spark, path, ["k"]).count() == 200


def got_dict(df):
    return dict(map(tuple, df.collect()))


def test_upsert_keeps_the_newest_of_a_batch(spark, tmp_path):
    rows = text.from_rows(spark, [("a", 1, 9), ("a", 3, 4), ("a", 2, 8)], "k string, at long, v long")
    keyed.upsert_keyed(rows, 0, str(tmp_path / "t"), ["k"], order="at")
    keyed.upsert_keyed(rows.filter("at = 1"), 1, str(tmp_path / "t"), ["k"], order="at")
    assert [r.asDict() for r in keyed.read_keyed(spark, str(tmp_path / "t"), ["k"]).collect()] == [
        {"k": "a", "at": 1, "v": 9}
    ]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    batches=st.lists(st.lists(st.tuples(st.sampled_from("abc"), st.integers(-5, 5)), min_size=1), min_size=1, max_size=3),
    again=st.integers(0, 2),
)
def test_replayed_batches_change_nothing(spark, tmp_path_factory, batches, again):
    path = str(tmp_path_factory.mktemp("t") / "add")
    for i in [*range(len(batches)), min(again, len(batches) - 1)]:
        batch = text.from_rows(spark, batches[i], "k string, v long")
        keyed.upsert_keyed(batch, i, path, ["k"], "add")
    want = {}
    for k, v in (row for b in batches for row in b):
        want[k] = want.get(k, 0) + v
    assert dict(map(tuple, keyed.read_keyed(spark, path, ["k"], "add").collect())) == want


def test_jdbc_goes_through_the_batch_writer():
    calls = []

    class Fake:
        write = property(lambda self: self)

        def jdbc(self, url, table, mode, properties):
            calls.append((url, table, mode, properties))

    files.write_jdbc(Fake(), "jdbc:x", "t", user="u")
    assert calls == [("jdbc:x", "t", "append", {"numPartitions": "8", "user": "u"})]
