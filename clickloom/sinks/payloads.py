"""Rows as message payloads and documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def to_messages(df: DataFrame, key: str | None = None, fmt: str = "csv", sep: str = ",") -> DataFrame:
    """``key`` and ``value`` strings, the shape a queue sink takes; ``fmt`` is csv, json or text.

    ``text`` joins the values with ``sep`` and quotes nothing; null values are empty.
    """
    columns = df.columns
    if fmt == "csv":
        value = F.to_csv(F.struct(*columns), {"sep": sep})
    elif fmt == "json":
        value = F.to_json(F.struct(*columns))
    elif fmt == "text":
        value = F.concat_ws(sep, *[F.coalesce(_text(c), F.lit("")) for c in columns])
    else:
        raise ValueError(f"unknown message format: {fmt!r}")
    name = F.lit(None).cast("string") if key is None else _text(key)
    return df.select(name.alias("key"), value.alias("value"))


def to_documents(df: DataFrame, id_col: str, fields: Sequence[str] | None = None) -> DataFrame:
    """``id`` and a JSON ``source`` in which every value is a string."""
    names = fields or df.columns
    return df.select(_text(id_col).alias("id"), F.to_json(F.struct(*[_text(c).alias(c) for c in names])).alias("source"))
