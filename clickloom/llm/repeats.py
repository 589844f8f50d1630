"""Removal of repeated spans in three rounds, shared by the two operators that differ in how they find them.

1. Every text gives *anchors*: keys of short pieces, so chosen that each long repeat has an anchor whose
   key is found at both of its places. Keys are exchanged by hash. A key found twice makes its places
   *hits*.
2. Hits go back to their texts, which give *details* of all long pieces around a hit. Details are
   exchanged by hash and settled: which long pieces are repeated.
3. The settled spans go back to the texts that had hits and are cut out.

What leaves a task is packed: one row per bucket with arrays of numbers, a few bytes per anchor. A
bucket is bounded in bytes of text, whatever the number of copies: before each exchange a task marks
equal keys of its own rows and sends one of them on. No pairs are formed. The tables between the rounds
are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm import arrays as A
from clickloom.llm.shared import buckets_for, staged

#: Anchors that a task gathers before it sends them on.
GATHER = 300_000

#: Numbers for rows without an id, the largest that there are. Ids as large count as missing.
NAMELESS = 1 << 20

Spans = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # doc, which of its rows, first start, number of starts


class Method(Protocol):
    slice_bytes: int  # of text in one numpy step
    gather: int  # details that a task gathers before it sends them on

    def anchors(self, texts: A.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of the text, place in it, key, and whether the key may be a reference."""

    def details(self, texts: A.Texts, text: np.ndarray, place: np.ndarray) -> dict[str, np.ndarray]:
        """Details around hits; ``text`` holds the number of the text of each."""

    def settle_here(self, parts: list[dict[str, np.ndarray]], buckets: int) -> tuple[Spans, dict[int, bytes]]:
        """What a task can settle by itself, and what it sends on to each bucket."""

    def settle(self, payloads: list[bytes]) -> Spans:
        """The repeated pieces among all details of a bucket."""

    def cut(self, text: bytes, starts: np.ndarray, counts: np.ndarray) -> tuple[bytes, int, int, int]:
        """What is kept, units in all, units removed, runs removed."""


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    edges = A.group_edges(bucket[order])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def pack_spans(spans: Spans, buckets: int) -> Iterator[tuple[int, bytes]]:
    doc, row, start, count = spans
    if len(doc):
        for dest, at in by_bucket(A.spark_hash(doc, buckets)):
            at = at[np.lexsort((start[at], row[at], doc[at]))]
            yield dest, A.pack(doc[at], row[at], start[at], count[at])


def _concat(parts: list[tuple[np.ndarray, ...]], width: int) -> list[np.ndarray]:
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(width)]


_PACKED = T.StructType([T.StructField("dest", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("payload", T.BinaryType())])
_PACKED_ARROW = pa.schema([("dest", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])


def _packed_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    dest, kind, payload = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(dest, pa.int32()), pa.array(kind, pa.int32()), pa.array(payload, pa.binary())], schema=_PACKED_ARROW)


def _send_anchors(method: Method, buckets: int):
    def flush(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, place, key, flag = _concat(parts, 4)
        order = np.lexsort((~flag, key))  # a reference first
        edges = A.group_edges(key[order])
        alone = np.diff(edges) == 1
        first = np.sort(order[edges[:-1]])
        again = np.sort(order[np.repeat(~alone, np.diff(edges))])
        rows = [(d, 1, p) for d, p in pack_spans((doc[again], np.zeros(len(again), np.int64), place[again], np.ones(len(again), np.int64)), buckets)]
        for bucket, at in by_bucket(A.bucket_of(key[first], buckets)):
            at = first[at]
            edge = A.group_edges(doc[at])
            rows.append((bucket, 0, A.pack(doc[at][edge[:-1]], np.diff(edge), place[at], (key[at] & A.U(0xFFFFFFFF)).astype("<u4"), flag[at].astype(np.uint8))))
        return _packed_batch(rows)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for part in A.slices(batch, "text", method.slice_bytes):
                docs = np.asarray(part.column("doc"))
                text, place, key, flag = method.anchors(A.texts_of(part.column("text")))
                parts.append((docs[text], place, key, flag))
                n += len(key)
                if n >= GATHER:
                    yield flush(parts)
                    parts, n = [], 0
        if n:
            yield flush(parts)

    return send


def _find_hits(buckets: int):
    def find(table: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes]] = []
        parts = []
        for dest, kind, payload in zip(*(table.column(c).to_pylist() for c in ("dest", "kind", "payload")), strict=True):
            if kind == 1:
                rows.append((dest, 0, payload))
            else:
                doc, count, place, key, flag = A.unpack(payload)
                parts.append((np.repeat(doc, count), place, key, flag))
        if parts:
            doc, place, key, flag = _concat(parts, 4)
            order = np.argsort(key, kind="stable")
            edges = A.group_edges(key[order])
            size = np.diff(edges)
            hit = (size > 1) & (np.maximum.reduceat(flag[order], edges[:-1]) > 0)
            at = order[np.repeat(hit, size)]
            rows += [(d, 0, p) for d, p in pack_spans((doc[at], np.zeros(len(at), np.int64), place[at], np.ones(len(at), np.int64)), buckets)]
        return pa.Table.from_batches([_packed_batch(rows)])

    return find


class _SpansOf:
    """Spans of one bucket of documents, by document."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.ready: list[np.ndarray] | None = None

    def add(self, payload: bytes) -> None:
        self.parts.append(tuple(A.unpack(payload)))
        self.ready = None

    def of(self, doc: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.ready is None:
            columns = _concat(self.parts, 4)
            order = np.lexsort((columns[2], columns[1], columns[0]))
            self.ready = [c[order] for c in columns]
        a, b = np.searchsorted(self.ready[0], [doc, doc], "left")[0], np.searchsorted(self.ready[0], doc, "right")
        return tuple(c[a:b] for c in self.ready[1:])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_SpansOf, int, pa.RecordBatch]]:
    """Rows with documents, each with the spans of its bucket, which come first in a partition's order."""
    spans, dest = _SpansOf(), None
    for batch in batches:
        dests, kinds = np.asarray(batch.column("dest")), np.asarray(batch.column("kind"))
        edges = A.group_edges(dests, kinds)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if dest != dests[a]:
                spans, dest = _SpansOf(), dests[a]
            if kinds[a] == 0:
                for payload in batch.column("payload").slice(a, b - a).to_pylist():
                    spans.add(payload)
            elif b > a:
                yield spans, int(dests[a]), batch.slice(a, b - a)


def _send_details(method: Method, buckets: int, schema: pa.Schema):
    def rows_of(kind: int, dest: list[int], payload: list[bytes]) -> pa.RecordBatch:
        n = len(dest)
        have = {"kind": pa.array([kind] * n, pa.int32()), "dest": pa.array(dest, pa.int32()), "payload": pa.array(payload, pa.binary())}
        return pa.RecordBatch.from_arrays([have.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def flush(parts: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        settled, sent = method.settle_here(parts, buckets)
        yield rows_of(0, list(sent), list(sent.values()))
        packed = list(pack_spans(settled, buckets))
        yield rows_of(1, [d for d, _ in packed], [p for _, p in packed])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        last, row = None, 0
        for spans, dest, whole in _in_order(batches):
            for part in A.slices(whole, "text", method.slice_bytes):
                docs = np.asarray(part.column("doc"))
                rows = np.zeros(len(docs), np.int64)
                for i, d in enumerate(docs):  # rows of one id are told apart by their order
                    row = row + 1 if d == last else 0
                    last = d
                    rows[i] = row
                found = [spans.of(d)[1] for d in docs]
                texts = A.texts_of(part.column("text"))
                text = np.repeat(np.arange(len(docs)), [len(f) for f in found])
                details = method.details(texts, text, np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64))
                has = np.zeros(len(docs), bool)
                if len(details["text"]):
                    has[details["text"]] = True
                    details["doc"], details["row"] = docs[details["text"]], rows[details["text"]]
                    parts.append(details)
                    n += len(details["text"])
                for kind, at in ((2, np.flatnonzero(has)), (3, np.flatnonzero(~has))):
                    if len(at):
                        none = np.zeros(0, np.int64)
                        raw = [texts.bytes_of(i) for i in at]
                        units = [None] * len(at)
                        if kind == 3:
                            raw, units, _, _ = zip(*(method.cut(t, none, none) for t in raw), strict=True)
                        have: dict[str, Any] = {
                            "kind": pa.array([kind] * len(at), pa.int32()),
                            "dest": pa.array([dest] * len(at), pa.int32()),
                            "doc": pa.array(docs[at], pa.int64()),
                            "ord": pa.array(rows[at], pa.int64()),
                            "kept": pa.array(raw, pa.binary()),
                            "units": pa.array(units, pa.int64()),
                            "row": part.column("row").take(pa.array(at)),
                        }
                        yield pa.RecordBatch.from_arrays([have.get(f.name, pa.nulls(len(at), f.type)) for f in schema], schema=schema)
                if n >= method.gather:
                    yield from flush(parts)
                    parts, n = [], 0
        if n:
            yield from flush(parts)

    return send


def _settle(method: Method, buckets: int):
    def settle(table: pa.Table) -> pa.Table:
        spans = method.settle(table.column("payload").to_pylist())
        return pa.Table.from_batches([_packed_batch([(d, 0, p) for d, p in pack_spans(spans, buckets)])])

    return settle


def _cut(method: Method, schema: pa.Schema):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for spans, _, batch in _in_order(batches):
            for part in A.slices(batch, "kept", method.slice_bytes):
                out = []
                for doc, row, text in zip(*(part.column(c).to_pylist() for c in ("doc", "ord", "kept")), strict=True):
                    rows, start, count = spans.of(doc)
                    here = rows == row
                    out.append(method.cut(text, start[here], count[here]))
                kept, units, removed, n_spans = zip(*out, strict=True)
                columns = [part.column("row"), pa.array(kept, pa.binary()), *(pa.array(c, pa.int64()) for c in (units, removed, n_spans))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return cut


def without_repeats(docs: DataFrame, method: Method, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns of ``docs`` but the text), ``kept`` (binary), ``n_units``, ``n_removed``, ``n_spans``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    # Rows without an id come last, dealt out by their texts.
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1) - F.pmod(F.xxhash64(text_col), F.lit(NAMELESS)))
    buckets = buckets_for(docs, text_col)
    texts = docs.select(doc.alias("doc"), F.col(text_col).cast("string").alias("text"), F.struct(*others).alias("row"))
    dest = F.pmod(F.xxhash64("doc"), F.lit(buckets)).cast("int")

    anchors = texts.select("doc", "text").mapInArrow(_send_anchors(method, buckets), _PACKED)
    hits = staged(anchors.groupBy("dest").applyInArrow(_find_hits(buckets), _PACKED))

    with_hits = (
        texts.select(dest.alias("dest"), F.lit(1).alias("kind"), F.xxhash64("text").alias("tie"), "doc", "text", "row")
        .unionByName(hits.select("dest", F.lit(0).alias("kind"), "payload"), allowMissingColumns=True)
        .repartition("dest")
        .sortWithinPartitions("dest", "kind", "doc", "tie")
    )
    row = T.StructField("row", texts.schema["row"].dataType)
    out = T.StructType(
        [
            *(T.StructField(n, T.IntegerType()) for n in ("kind", "dest")),
            T.StructField("payload", T.BinaryType()),
            *(T.StructField(n, T.LongType()) for n in ("doc", "ord", "units")),
            T.StructField("kept", T.BinaryType()),
            row,
        ]
    )
    details = staged(with_hits.mapInArrow(_send_details(method, buckets, to_arrow_schema(out)), out), "kind")

    settled = details.filter("kind = 0").select("dest", "payload").groupBy("dest").applyInArrow(_settle(method, buckets), _PACKED)
    spans = settled.select("dest", "payload").unionByName(details.filter("kind = 1").select("dest", "payload"))
    to_cut = (
        details.filter("kind = 2").select("dest", F.lit(1).alias("kind"), "doc", "ord", "kept", "row")
        .unionByName(spans.select("dest", F.lit(0).alias("kind"), "payload"), allowMissingColumns=True)
        .repartition("dest")
        .sortWithinPartitions("dest", "kind", "doc", "ord")
    )
    result = T.StructType([row, T.StructField("kept", T.BinaryType()), *(T.StructField(n, T.LongType()) for n in ("n_units", "n_removed", "n_spans"))])
    cut = to_cut.mapInArrow(_cut(method, to_arrow_schema(result)), result)
    none = F.lit(0).cast("long")
    whole = details.filter("kind = 3").select("row", "kept", F.col("units").alias("n_units"), none.alias("n_removed"), none.alias("n_spans"))
    return cut.unionByName(whole)
