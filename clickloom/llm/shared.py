"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any, TypeVar

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.arrays import trim
from clickloom.session import checkpointed

_T = TypeVar("_T")
#: Bytes of text that one bucket of an exchange is meant to hold.
BUCKET_BYTES = 64 << 20

#: Rows of a batch that goes to a Python worker: texts may be long, and a batch is held on both sides.
BATCH_ROWS = 2_000
#: Bytes that a writer holds before they go to its file; a task may have several writers.
ROW_GROUP_BYTES = 16 << 20

_made: list[str] = []
_resident: list[tuple[Any, Any]] = []


def resident(key: Hashable, make: Callable[[], _T]) -> _T:
    """What ``make`` returns, kept in a worker process until it asks for something else.

    A worker serves one operator after the other; what an earlier one has kept would add up.
    """
    if not _resident or _resident[0][0] != key:
        _resident.clear()
        trim()
        _resident.append((key, make()))
    return _resident[0][1]


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path below the one that the session names in ``spark.checkpoint.dir``.

    Only a local session that names none (a test) gets a folder of its own.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        checkpointed(spark.range(0))  # a local session gets its folder; a cluster is told what is missing
        root = sc.getCheckpointDir()
    path = f"{root}/{uuid.uuid4().hex}"
    _made.append(path)
    return path


def tables_made() -> int:
    """How many tables have been written between steps so far, for ``release``."""
    return len(_made)


def release(spark: SparkSession, since: int = 0, but: int = 0) -> None:
    """Remove the tables between steps made after the first ``since``, all but the last ``but`` of them.

    Results that read them and are not written yet end too.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    gone = _made[since : len(_made) - but]
    del _made[since : len(_made) - but]
    for name in gone:
        path = hadoop.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _with(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """While this holds, the session has the ``settings`` that it knows."""
    before = {}
    for name, value in settings.items():
        was = spark.conf.get(name, None)
        try:
            spark.conf.set(name, value)
        except Exception:  # a Spark that lacks the setting
            continue
        before[name] = was
    try:
        yield
    finally:
        for name, was in before.items():
            spark.conf.set(name, was) if was is not None else spark.conf.unset(name)


def written_in_steps(spark: SparkSession):
    """For the time of a write: its shuffle files are removed once it is over, and batches for Python are small."""
    return _with(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)})


def staged(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back; this cuts the lineage.

    The table is committed by Spark's writer, so a lost executor costs only its running tasks, and
    later steps read what is on disk.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    with written_in_steps(spark):
        writer = df.write.option("compression", "zstd").option("parquet.block.size", str(ROW_GROUP_BYTES))
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    read = spark.read.schema(df.schema) if not partition_by else spark.read.schema(_moved_last(df, partition_by))
    return read.parquet(path)


def _moved_last(df: DataFrame, names: tuple[str, ...]):
    return df.select(*[c for c in df.columns if c not in names], *names).schema


def running(df: DataFrame, order: list[str], counts: list[str]) -> DataFrame:
    """``df`` with ``<c>_upto`` for each of ``counts``, its sum over the rows up to this one in ``order``, which has no ties.

    Rows are sorted in ranges, and a range begins with the sums of those before it, so no task has all rows.
    """
    placed = staged(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("part").agg(*[F.sum(c).alias(c) for c in counts])  # one row for each range
    starts = sums.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in counts])
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    upto = [(F.col(f"{c}_before") + F.sum(c).over(within)).alias(f"{c}_upto") for c in counts]
    return placed.join(F.broadcast(starts), "part").select(*df.columns, *upto)


def at_ranks(totals: DataFrame, count: str, ranks: Iterable[int]) -> dict[int, Row]:
    """The row of ``running`` totals that holds each of a few ranks, from 1."""
    ranks = sorted(set(ranks))
    if not ranks:
        return {}
    first = F.col(f"{count}_upto") - F.col(count)
    some = F.exists(F.array(*[F.lit(r).cast("long") for r in ranks]), lambda r: (r > first) & (r <= F.col(f"{count}_upto")))
    rows = totals.filter(some).collect()
    return {r: row for row in rows for r in ranks if row[f"{count}_upto"] - row[count] < r <= row[f"{count}_upto"]}


def buckets_for(df: DataFrame, text: str) -> int:
    """How many buckets an exchange over ``df`` needs: by its bytes of text, twice the shuffle partitions at least."""
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    return max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
