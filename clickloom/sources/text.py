"""Lines, delimited records, access logs and message payloads as typed rows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of an access log line, by position, and its time format.
ACCESS_LOG_FIELDS = {"ip": 0, "user_id": 2, "event_time": 3, "method": 5, "url": 6}
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def _schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)


def from_rows(spark: SparkSession, rows: Iterable, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the files that appear in a folder; one file per batch replays a queue of batches."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def delimited(line: Column, schema: T.StructType, sep: str, nulls: Sequence[str] = ()) -> list[Column]:
    """The fields of a line by position, trimmed and typed; what cannot be read is null."""
    parts = F.split(line, re.escape(sep), -1)
    fields = []
    for i, field in enumerate(schema.fields):
        text = F.trim(F.get(parts, F.lit(i)))
        if nulls:
            text = F.when(~text.isin(*nulls), text)
        typed = text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)
        fields.append(typed.alias(field.name))
    return fields


def parse_delimited(
    df: DataFrame, schema: str | T.StructType, sep: str = ",", nulls: Sequence[str] = (), col: str = "value"
) -> DataFrame:
    """Delimited lines as rows. Texts in ``nulls``, such as ``-1`` or ``null``, mean a missing value."""
    return df.select(*delimited(F.col(col), _schema(schema), sep, nulls))


def parse_access_log(df: DataFrame, col: str = "value") -> DataFrame:
    """Blank-separated access log lines: address, user, time, method and URL."""
    parts = F.split(F.col(col), " ")
    fields = {name: F.trim(F.get(parts, F.lit(i))) for name, i in ACCESS_LOG_FIELDS.items()}
    fields["event_time"] = F.try_to_timestamp(fields["event_time"], F.lit(ACCESS_LOG_TIME))
    return df.select(*[column.alias(name) for name, column in fields.items()])


def parse_messages(
    df: DataFrame, schema: str | T.StructType, fmt: str = "split", sep: str = " ", nulls: Sequence[str] = ()
) -> DataFrame:
    """Payloads of a queue table (``key``, ``value``, ...) as rows, by ``split``, ``csv`` or ``json``."""
    shape, payload = _schema(schema), F.col("value").cast("string")
    if fmt == "split":
        return df.select(*delimited(payload, shape, sep, nulls))
    if fmt == "csv":
        record = F.from_csv(payload, shape.simpleString()[len("struct<") : -1].replace(":", " "), {"sep": sep})
    elif fmt == "json":
        record = F.from_json(payload, shape)
    else:
        raise ValueError(f"unknown message format: {fmt!r}")
    return df.select(record.alias("_r")).select("_r.*")
