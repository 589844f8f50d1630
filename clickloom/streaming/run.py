"""Running a stream, and streams whose result is kept by micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.hashing import poly_hash
from clickloom.operators.changes import changelog, net_rows
from clickloom.operators.joins import broadcast_if_small
from clickloom.operators.ordered import HOT_ROWS
from clickloom.operators.rows import exclude_keys
from clickloom.operators.sequences import marker_watermark
from clickloom.operators.topn import top_n_per_group
from clickloom.sinks.keyed import read_keyed, upsert_keyed
from clickloom.times import interval, micros

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Batches after which a keyed table is merged, so that reading it stays cheap.
COMPACT_EVERY = 100

@contextmanager
def _kept(batch: DataFrame) -> Iterator[DataFrame]:
    """A batch that is used several times is computed once."""
    batch = batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


BatchSink = Callable[[DataFrame, int], None]


def with_event_time(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Declare the event time and how late rows may come; no delay means rising times."""
    return df.withWatermark(ts, delay)


def with_marker_time(df: DataFrame, ts: str, marker: Column, delay: str = "0 seconds") -> DataFrame:
    """Declare the event time of a stream whose watermark only marker rows advance, less ``delay``.

    Windows, joins and state behind it go by the markers, however far ahead other rows are. Of several
    watermarks Spark takes the lowest, so those of other rows are put out of reach. A stream without a marker
    closes nothing. A marker that is not known is none. The source is read once for each of the two kinds.
    """
    is_marker = F.coalesce(marker, F.lit(False))
    marked = df.filter(is_marker).withWatermark(ts, delay)
    far = "far"
    while far in df.columns:
        far += "_"
    others = df.filter(~is_marker).withColumn(far, F.col(ts) + F.expr("INTERVAL '1000' YEAR")).withWatermark(far, "0 seconds")
    return marked.union(others.select(*df.columns))


def use_disk_state(spark: SparkSession) -> None:
    """Keep streaming state on disk, which timers and large state need; once for a session, before its streams."""
    spark.conf.set(_PROVIDER, _ROCKSDB)


def start_stream(
    df: DataFrame,
    sink: BatchSink | str,
    checkpoint: str,
    mode: str = "append",
    fmt: str = "parquet",
    every: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Start a stream and return it while it runs.

    ``sink`` is a function of (batch, batch id) or the path that ``fmt`` writes to. ``every`` is the time
    between micro-batches, such as ``"3 seconds"``; without it one follows the other. The checkpoint
    lets a restart go on.
    """
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder that all machines share")
    return _writer(df, sink, checkpoint, mode, fmt, options).trigger(processingTime=every or "0 seconds").start()


def run_stream(
    df: DataFrame, sink: BatchSink | str, checkpoint: str, mode: str = "append", fmt: str = "parquet", **options: str
) -> StreamingQuery:
    """Process what is there in micro-batches, then stop; the checkpoint lets a restart go on."""
    query = _writer(df, sink, checkpoint, mode, fmt, options).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _writer(df: DataFrame, sink: BatchSink | str, checkpoint: str, mode: str, fmt: str, options: dict[str, str]):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    return writer.foreachBatch(sink) if callable(sink) else writer.format(fmt).option("path", sink)


def running_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Counts per key over all the stream so far, for ``update`` or ``complete`` mode."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def per_batch(change: Callable[[DataFrame], DataFrame], path: str) -> BatchSink:
    """Apply a table function to each batch by itself and write the result under the batch's id."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")

    return sink


def keep_keyed(path: str, keys: Sequence[str], mode: str = "replace", order: str | None = None) -> BatchSink:
    """Feed each batch into a keyed table."""
    return lambda batch, batch_id: upsert_keyed(batch, batch_id, path, keys, mode, order, COMPACT_EVERY)


def keep_changelog(path: str, state: str, keys: Sequence[str]) -> BatchSink:
    """Write what each batch of an ``update`` mode aggregate takes back and adds; see ``changelog``."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch) as batch:
            # Only keys of this batch have changed.
            before = read_keyed(batch.sparkSession, state, keys, before=batch_id, of=batch)
            old = batch.limit(0) if before is None else before.join(batch.select(*keys), list(keys), "left_semi")
            changelog(old, batch, keys).write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")
            upsert_keyed(batch, batch_id, state, keys, compact_every=COMPACT_EVERY)

    return sink


def keep_net_rows(path: str, columns: Sequence[str]) -> BatchSink:
    """Add what each batch of a changelog leaves to a keyed table of ``net_rows``.

    Rows may be taken back in a later batch than they came in, or in an earlier one. ``read_keyed`` and
    ``aggregate_net`` or ``top_of_net`` give the aggregates after any batch.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert_keyed(net_rows(batch, columns), batch_id, path, columns, "add", compact_every=COMPACT_EVERY)

    return sink


def keep_top_n(path: str, part: Sequence[str], order: Sequence[Column], n: int) -> BatchSink:
    """Rank the windows that closed in a batch; in append mode a window's rows all come in one batch."""
    return per_batch(lambda batch: top_n_per_group(batch, part, order, n), path)


def new_in_window(df: DataFrame, ts: str, size: str, col: str, seed: int = 61, bits: int = 29) -> DataFrame:
    """The first row of each window that sets a bit of the window's bitmap; needs a watermark."""
    offset = poly_hash(F.col(col).cast("string"), seed, bits).alias("offset")
    hashed = df.select(F.window(ts, size).alias("window"), offset)
    return hashed.dropDuplicates(["window", "offset"])


def keep_distinct(path: str, name: str = "uv") -> BatchSink:
    """Add the new bits of each batch to the window's count, which is up to date after every batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")
        ).agg(F.count("*").alias(name))
        upsert_keyed(counts, batch_id, path, ["window_start", "window_end"], "add", compact_every=COMPACT_EVERY)

    return sink


def keep_blacklist(path: str, ts: str, user: str, ad: str, limit: int) -> BatchSink:
    """Count clicks per day, user and ad, leaving out users who reached ``limit`` in an earlier batch.

    Blocked users are a keyed table of their own beside ``path``, so a batch reads only the buckets of its
    users there and of its counts here.
    """
    keys, blocked_path = ["day", user, ad], f"{path}_blocked"

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _kept(batch) as batch:
            blocked = read_keyed(spark, blocked_path, [user], before=batch_id, of=batch)
            rest = batch if blocked is None else exclude_keys(batch, blocked, user)
            daily = rest.groupBy(F.to_date(ts).alias("day"), user, ad).agg(F.count("*").alias("count"))
            upsert_keyed(daily, batch_id, path, keys, "add", compact_every=COMPACT_EVERY)
            counted = read_keyed(spark, path, keys, "add", of=daily)
            if counted is not None:
                over = counted.filter(F.col("count") >= limit).select(user, F.lit(True).alias("blocked")).distinct()
                upsert_keyed(over, batch_id, blocked_path, [user], compact_every=COMPACT_EVERY)

    return sink


def keep_marked(
    path: str, state: str, order: Sequence[str], ts: str, marker: Column, delay: str, max_rows: int | None = HOT_ROWS
) -> BatchSink:
    """Write each batch with the watermark of its markers and the greatest one of earlier batches."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch) as batch:
            write(batch, batch_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = marker_watermark(batch, order, ts, marker, delay, max_rows)
        own = batch.agg(F.max(F.when(marker, F.col(ts))).alias("top")).withColumn("id", F.lit(0))
        before = read_keyed(spark, state, ["id"], before=batch_id)
        if before is not None:
            # One row: the greatest marker time of all batches before.
            earlier = before.select((F.col("top") - interval(micros(delay))).alias("_earlier"))
            seen = seen.join(broadcast_if_small(earlier), F.lit(True), "left")
            seen = seen.withColumn("watermark", F.greatest("watermark", "_earlier")).drop("_earlier")
            seen = seen.withColumn("late", F.coalesce(F.col(ts) <= F.col("watermark"), F.lit(False)))
            own = own.unionByName(before.select("top", "id")).groupBy("id").agg(F.max("top").alias("top"))
        seen.write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")
        upsert_keyed(own.select("id", "top"), batch_id, state, ["id"], compact_every=COMPACT_EVERY)

    return sink
