"""Parquet tables, declared file tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream; event times without zone become timestamps, which watermarks need."""
    schema = load(spark, folder, name).schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    naive = [f.name for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in naive})


def register_table(spark: SparkSession, name: str, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Declare a delimited file as a table of the session's catalog."""
    quoted = path.replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW `{name}` ({schema}) USING csv "
        f"OPTIONS (path '{quoted}', sep '{sep}', header 'false', "
        "ignoreLeadingWhiteSpace 'true', ignoreTrailingWhiteSpace 'true')"
    )
    return spark.table(name)


def as_table(df: DataFrame, *columns: str, view: str | None = None, **renames: str) -> DataFrame:
    """Select columns, then renamed ones given as new_name=old_name; optionally name a view."""
    table = df.select(*columns, *[F.col(old).alias(new) for new, old in renames.items()])
    if view is not None:
        table.createOrReplaceTempView(view)
    return table
