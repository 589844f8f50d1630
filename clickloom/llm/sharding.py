"""Shuffling and sharding in two passes.

The first pass scatters rows by a seeded hash into buckets that are small enough for one task. The
second shuffles each bucket by Fisher-Yates and writes it. Buckets one after the other are then a random
order of all rows, which is cut into shards whose numbers of rows differ by one at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.llm import arrays as A
from clickloom.llm.shared import buckets_for, release, staged, tables_made, written_in_steps


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A random order of ``n`` rows (numpy shuffles by Fisher-Yates), the same for the same seed and bucket."""
    order = np.arange(n)
    np.random.default_rng([seed & 0xFFFFFFFFFFFFFFFF, bucket]).shuffle(order)
    return order


def shard_starts(n: int, shards: int) -> np.ndarray:
    """The place of each shard's first row, and the total."""
    return np.concatenate(([0], np.cumsum([n // shards + (s < n % shards) for s in range(shards)]))).astype(np.int64)


#: Equal rows that may go to one bucket; where there are more, each is scattered by itself.
MANY_EQUAL = 1_000

_PLACE = [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]


def _place(seed: int, first: np.ndarray, starts: np.ndarray, schema: pa.Schema):
    """``first``: the place of each bucket's first row, and the total."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, order = None, np.zeros(0, np.int64)
        for batch in batches:
            buckets, nth = np.asarray(batch.column("bucket")), np.asarray(batch.column("nth"))
            places = np.empty(len(buckets), np.int64)
            edges = A.group_edges(buckets)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if buckets[a] != bucket:
                    bucket = int(buckets[a])
                    order = fisher_yates(int(first[bucket + 1] - first[bucket]), seed, bucket)
                places[a:b] = first[bucket] + order[nth[a:b] - 1]
            shard = np.searchsorted(starts, places, "right") - 1
            slot = places - starts[shard]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(shard, pa.int32()), pa.array(slot, pa.int64())], schema=schema)

    return place


def write_shards(
    docs: DataFrame, folder: str, shards: int = 8, seed: int = 17, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write ``docs`` in random order as ``shard=0`` to ``shard=shards-1``, each by its ``slot`` from 0.

    A row is written once, as the struct ``row`` with all its columns, so that no name can clash. The
    order depends on seed, ids, texts and the number of buckets. Null ids and texts are values of their own;
    repeated rows are all written (and scattered together while they are few, as they are equal). With
    fewer rows than shards some shards are empty. An empty table writes no row. Only row numbers are held
    in memory, eight bytes a row of a bucket.
    """
    spark, since = docs.sparkSession, tables_made()
    buckets = buckets_for(docs, text_col)
    at, a, b = (_unused(docs, name) for name in ("at", "a", "b"))
    rows = docs.withColumns({a: F.xxhash64(id_col), b: F.xxhash64(text_col)})
    tie = F.lit(0).cast("long")
    many = staged(rows.groupBy(a, b).count().filter(F.col("count") > MANY_EQUAL).select(a, b, F.lit(True).alias(at)))
    if not many.isEmpty():
        # Copies by the thousand are dealt out by their places in the input, which only tell equal rows apart.
        rows = rows.join(many, [a, b], "left")
        tie = F.when(F.col(at), F.monotonically_increasing_id()).otherwise(0)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    told = rows.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(a).alias("a"), F.col(b).alias("b"), tie.alias("tie"), row)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "i", "t", "tie"), F.lit(buckets)).cast("int")
    nth = F.row_number().over(Window.partitionBy("bucket").orderBy("a", "b", "tie"))
    kept = staged(told.select(bucket.alias("bucket"), "a", "b", "tie", "row").select("bucket", nth.alias("nth"), "row"))
    # One number for each bucket; buckets are as many as the bytes of text need.
    sizes = {r["bucket"]: r["count"] for r in kept.groupBy("bucket").count().collect()}
    first = np.concatenate(([0], np.cumsum([sizes.get(b, 0) for b in range(buckets)]))).astype(np.int64)
    out = T.StructType([T.StructField("row", kept.schema["row"].dataType), *_PLACE])
    placed = kept.mapInArrow(_place(seed, first, shard_starts(int(first[-1]), shards), to_arrow_schema(out)), out)
    with written_in_steps(spark):
        placed.sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    release(spark, since)


def _unused(docs: DataFrame, name: str) -> str:
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def read_shards(spark: SparkSession, folder: str, docs: DataFrame) -> DataFrame:
    """``row``, ``slot`` and ``shard`` from the files; ``docs`` gives the columns of a row."""
    row = T.StructField("row", docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).schema["row"].dataType)
    return spark.read.schema(T.StructType([row, *_PLACE[::-1]])).parquet(folder)
