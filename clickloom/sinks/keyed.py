"""A keyed table fed by batches: each key is replaced by, or adds up, what the batches bring.

A batch is written once, to a folder named by its id, so a replayed batch overwrites its own rows and
changes nothing. Rows lie in buckets by the hash of their key, and a reader that names the keys it needs
reads their buckets only. Reading merges the batches per key. ``compact_keyed`` merges all batches so far
into one, so that a long-lived table stays short to read, and removes what no replay can need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ORDER = "_batch"
_BUCKET = "_bucket"

#: Buckets of a keyed table; a table keeps the number it was begun with.
BUCKETS = 32


def _in_buckets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def _write(rows: DataFrame, keys: Sequence[str], folder: str) -> None:
    # One file for each bucket; without any row the folder still marks the batch.
    _in_buckets(rows, keys).repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(folder)


def _fold(rows: DataFrame, keys: Sequence[str], mode: str, newest: str | None) -> DataFrame:
    values = [c for c in rows.columns if c not in keys and c not in (newest, _ORDER)]
    if mode == "add":
        return rows.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    if mode != "replace":
        raise ValueError(f"unknown upsert mode: {mode!r}")
    # The values break a tie of the order, so that every run picks the same row.
    kept = values if newest in (None, _ORDER) else [newest, *values]
    order = F.struct(*[F.col(c) for c in ([newest] if newest else []) + values])
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*kept), order).alias("_last"))
    return last.select(*keys, "_last.*")


def upsert_keyed(
    batch: DataFrame,
    batch_id: int,
    path: str,
    keys: Sequence[str],
    mode: str = "replace",
    order: str | None = None,
    compact_every: int | None = None,
) -> None:
    """Write one batch: ``replace`` keeps a key's last row, by ``order`` within a batch; ``add`` sums."""
    _write(_fold(batch, keys, mode, order), keys, f"{path}/delta={batch_id:012d}")
    if compact_every is not None and (batch_id + 1) % compact_every == 0:
        compact_keyed(batch.sparkSession, path, keys, mode)


def _files(spark: SparkSession, path: str):
    """Spark's file system for a path, and the path, as Hadoop's classes."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _finished(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Ids of the completely written folders ``kind=<id>``."""
    files, marks = _files(spark, f"{path}/{kind}=*/_SUCCESS")
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in files.globStatus(marks) or [])


def read_keyed(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    mode: str = "replace",
    before: int | None = None,
    of: DataFrame | None = None,
) -> DataFrame | None:
    """The table's present state, or the one ``before`` a batch; None when there was no batch.

    With ``of`` only the buckets of that table's keys are read: at least its keys, and some others.
    """
    bases, deltas = (
        [i for i in _finished(spark, path, kind) if before is None or i < before] for kind in ("base", "delta")
    )
    base = bases[-1] if bases else -1
    folders = [f"{path}/delta={i:012d}" for i in deltas if i > base]
    if base >= 0:
        folders.insert(0, f"{path}/base={base:012d}")
    if of is not None:
        touched = sorted(r[0] for r in _in_buckets(of.select(*keys), keys).select(_BUCKET).distinct().collect())
        named = [f"{f}/{_BUCKET}={b}" for f in folders for b in touched]
        some = [f for f in named if _exists(spark, f)]
        folders = some or folders[-1:]
    if not folders:
        return None
    found = [f for f in folders if _has_rows(spark, f)]
    if not found:
        return None
    # Folders of buckets are read as such; the bucket's number is not a column of the table.
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*found)
    number = F.regexp_extract(F.input_file_name(), r"(?:delta|base)=(\d+)", 1).cast("long")
    state = _fold(rows.withColumn(_ORDER, number), keys, mode, _ORDER)
    return state if of is None or some else state.limit(0)


def _exists(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)


def _has_rows(spark: SparkSession, folder: str) -> bool:
    """A batch without rows leaves a folder without buckets."""
    if f"/{_BUCKET}=" in folder:
        return True
    files, buckets = _files(spark, f"{folder}/{_BUCKET}=*")
    return bool(files.globStatus(buckets))


def compact_keyed(spark: SparkSession, path: str, keys: Sequence[str], mode: str = "replace") -> None:
    """Merge everything up to the newest batch into one folder; readers then start from it.

    A stream replays its last batch at most, which needs the state before it. So the newest two bases
    stay, with the batches behind the older one, and all that lies before is removed.
    """
    deltas, state = _finished(spark, path, "delta"), read_keyed(spark, path, keys, mode)
    if not deltas or state is None:
        return
    _write(state, keys, f"{path}/base={deltas[-1]:012d}")
    bases = _finished(spark, path, "base")
    if len(bases) > 1:
        older = bases[-2]
        gone = [f"{path}/base={i:012d}" for i in bases[:-2]] + [f"{path}/delta={i:012d}" for i in deltas if i <= older]
        for folder in gone:
            files, at = _files(spark, folder)
            files.delete(at, True)
