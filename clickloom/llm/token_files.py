"""Token ids in bit-packed blocks: every id takes the fewest bits that the vocabulary allows.

A file is a Parquet table of blocks, so any store that Spark writes to will do and a lost executor
leaves no half file. A row is a block: the part and its place in it, the first id's place in the part,
the number of ids, bits per id, the packed ids, and id and length of each document, which never goes
across blocks. Parts and blocks are in ascending order of documents. With the sizes of the parts
(``part_starts``) any id's place in the stream leads to its block, and there to its bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import arrays as A
from clickloom.llm.shared import written_in_steps, buckets_for
from clickloom.llm.tokens import STEP_BYTES, bits_for, encoder

#: Ids after which a block is closed; a document is never cut.
BLOCK_IDS = 1 << 16

BLOCKS = (
    "part int, block int, start long, n_ids long, bits int, payload binary, doc_ids array<bigint>, lengths array<bigint>"
)
_U = np.uint64


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a stream of ``bits`` bits each, the lowest bit first, in whole 64-bit words."""
    if bits in (8, 16, 32):  # the same layout
        return np.ascontiguousarray(ids).astype(f"<u{bits // 8}").tobytes()
    at = np.arange(len(ids), dtype=np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(_U)
    out = np.zeros((len(ids) * bits + 63) // 64 + 1, "<u8")
    ids = ids.astype(_U)
    edges = A.group_edges(word)[:-1]
    if len(ids):
        out[word[edges]] = np.bitwise_or.reduceat(ids << shift, edges)
        over = np.flatnonzero(shift + _U(bits) > 64)  # one id at most goes over a word's end
        out[word[over] + 1] |= ids[over] >> (_U(64) - shift[over])
    return out.tobytes()


def unpack_bits(payload: bytes, bits: int, first: int, n: int) -> np.ndarray:
    """``n`` ids from the ``first`` on, without touching the bits before."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", n, first * bits // 8).astype(np.uint32)
    words = np.frombuffer(payload, "<u8")
    at = np.arange(first, first + n, dtype=np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(_U)
    low = words[word] >> shift
    high = np.where(shift > 0, words[np.minimum(word + 1, len(words) - 1)] << ((_U(64) - shift) & _U(63)), _U(0))
    return ((low | high) & _U((1 << bits) - 1)).astype(np.uint32)


def with_end(flat: np.ndarray, first: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's ids with ``end_id`` behind."""
    until = first[1:] + np.arange(1, len(first))
    out = np.full(len(flat) + len(until), end_id, np.uint32)
    own = np.ones(len(out), bool)
    own[until - 1] = False
    out[own] = flat
    return out, np.concatenate(([0], until))


def _write_blocks(path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        bits = bits_for(max(encode.vocabulary, end_id + 1))
        part = TaskContext.get().partitionId()
        start, block, docs, lengths, ids, n = 0, 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            payload = pack_bits(np.concatenate(ids), bits)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([n], pa.int64()),
                    pa.array([bits], pa.int32()),
                    pa.array([payload], pa.binary()),
                    pa.array([docs], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                ],
                names=["part", "block", "start", "n_ids", "bits", "payload", "doc_ids", "lengths"],
            )

        for batch in batches:
            for piece in A.slices(batch, "text", STEP_BYTES):
                flat, first = with_end(*encode.ids(A.texts_of(piece.column("text"))), end_id)
                for i, doc in enumerate(piece.column("doc_id").to_pylist()):
                    docs.append(doc)
                    lengths.append(int(first[i + 1] - first[i]))
                    ids.append(flat[first[i] : first[i + 1]])
                    n += lengths[-1]
                    if n >= BLOCK_IDS:
                        yield close()
                        start, block, docs, lengths, ids, n = start + n, block + 1, [], [], [], 0
        if docs:
            yield close()

    return write


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every whole text, put ``end_id`` behind it, and write all ids in ascending order of documents.

    ``tokenizer`` is the path of a tokenizers file that every machine has. A null text is empty: its
    only id is ``end_id``. A null document id comes last. Rows of equal id are documents of their own,
    in the order of their texts. Other columns are not written, whatever their names. An empty table
    writes no block. A text is encoded whole and must fit into a task.
    """
    spark = docs.sparkSession
    # Many range parts keep a task's texts small; a part's number tells its place.
    parts = buckets_for(docs, text_col)
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text")
    )
    with written_in_steps(spark):
        ordered.mapInArrow(_write_blocks(tokenizer, end_id), BLOCKS).write.option("compression", "zstd").parquet(folder)


def blocks_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(folder)


def part_starts(spark: SparkSession, folder: str) -> dict[int, int]:
    """The place of each part's first id in the whole stream: one number for each part, as many as tasks wrote."""
    sizes = blocks_of(spark, folder).groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    starts, total = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in sizes):
        starts[part], total = total, total + n
    return starts


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``, ``bits`` from the blocks."""
    starts = part_starts(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                length = np.array(row["lengths"], np.int64)
                until = np.cumsum(length)
                ids = unpack_bits(row["payload"], row["bits"], 0, row["n_ids"]).astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(until - length, until, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts[row["part"]] + row["start"] + until - length, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array([row["bits"]] * len(length), pa.int32()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "bits"],
                )

    return blocks_of(spark, folder).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, bits int")


def read_ids(spark: SparkSession, folder: str, first: int, n: int) -> np.ndarray:
    """``n`` ids of the stream from the ``first`` on: only the blocks that hold them are read, and only their bits."""
    starts = part_starts(spark, folder)
    base = F.create_map(*[F.lit(x) for item in starts.items() for x in item])[F.col("part")] if starts else F.lit(0)
    at = base + F.col("start")
    rows = blocks_of(spark, folder).withColumn("at", at).filter((F.col("at") < first + n) & (F.col("at") + F.col("n_ids") > first))
    parts = []
    for row in rows.select("at", "n_ids", "bits", "payload").sort("at").toLocalIterator():
        skip = max(0, first - row["at"])
        parts.append(unpack_bits(bytes(row["payload"]), row["bits"], skip, min(row["n_ids"], first + n - row["at"]) - skip))
    return np.concatenate([*parts, np.zeros(0, np.uint32)])
