"""Text, CSV and database output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_text(df: DataFrame, path: str, mode: str = "error") -> None:
    """One file per partition; ``df`` has one string column."""
    df.write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "append") -> None:
    df.write.mode(mode).option("sep", sep).csv(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 8, **properties: str
) -> None:
    """Batched inserts, one connection per partition and at most ``connections`` of them."""
    df.write.jdbc(url, table, mode=mode, properties={"numPartitions": str(connections), **properties})
