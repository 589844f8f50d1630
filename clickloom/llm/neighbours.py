"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node, so that a vector which a third of all rows share is searched once. A node
starts with the nearest of a few blocks of nodes that lie on the same side of random planes. Then, round
by round, the neighbours of each node (those it links to, and a bounded draw of those that link to it)
are joined and shown to each other, and each keeps the nearest it has seen, until hardly any link
changes. A query starts at its own node, if it is in the index, and at the best of some entry points,
and opens the links of all nodes in its beam until none is left unopened.

The graph is made of 16-bit vectors of length one. The nodes at the head of a beam are compared again
by their original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.llm import arrays as A
from clickloom.llm.shared import staged

#: Planes whose sides make a node's place in an ordering, and nodes of a block in it.
PLANES = 32
BLOCK = 512
#: Neighbourhoods that are compared in one numpy step.
_TOGETHER = 256


_KINDS = {"long": T.LongType(), "int": T.IntegerType(), "binary": T.BinaryType(), "float": T.FloatType(), "boolean": T.BooleanType(), "longs": T.ArrayType(T.LongType())}


def _schema(fields: str) -> tuple[T.StructType, pa.Schema]:
    out = T.StructType([T.StructField(n, _KINDS[kind]) for n, kind in (f.split() for f in fields.split(", "))])
    return out, to_arrow_schema(out)


_GRAPH, _GRAPH_ARROW = _schema("node long, kind int, code binary, links binary, sims binary, fresh binary, worst float")
_SEEN_BY, _SEEN_BY_ARROW = _schema("node long, kind int, links binary, fresh binary, back long, new boolean, draw long")
_MEET, _MEET_ARROW = _schema("at long, link long, fresh boolean")
_STATE, _STATE_ARROW = _schema("node long, kind int, code binary, beam binary, sims binary, opened binary, seen binary, todo longs")


def _rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _whole_keys(batches: Iterator[pa.RecordBatch], key: str, limit: int = 20_000) -> Iterator[pa.Table]:
    """Sorted rows in tables of about ``limit`` rows that never end inside a key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for start in range(0, len(batch), limit):
            held.append(batch.slice(start, limit))
            if sum(map(len, held)) < limit:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        if len(table):
            yield table


def _floats(codes: list[bytes]) -> np.ndarray:
    """Vectors of length one, from 16-bit numbers with a factor in front."""
    if not codes:
        return np.zeros((0, 0), np.float32)
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    factor = np.ascontiguousarray(raw[:, :4]).view("<f4")
    return np.ascontiguousarray(raw[:, 4:]).view("<i2").astype(np.float32) * factor


def _codes(vectors: np.ndarray) -> list[bytes]:
    unit = vectors / np.abs(vectors).max(1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    factor = (np.abs(unit).max(1, keepdims=True) / 32767).astype("<f4")
    raw = np.concatenate((factor.view(np.uint8), np.rint(unit / factor).astype("<i2").view(np.uint8)), axis=1)
    return [r.tobytes() for r in raw]


def _lists(column: pa.ChunkedArray | pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Packed numbers one after the other, and how many each row has."""
    packed = [p or b"" for p in column.to_pylist()]
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(packed), kind), np.array([len(p) // size for p in packed], np.int64)


def _packed(values: np.ndarray, edges: np.ndarray, kind: str) -> list[bytes]:
    raw, size = np.ascontiguousarray(values).astype(kind).tobytes(), np.dtype(kind).itemsize
    return [raw[a * size : b * size] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def _nearest(node: np.ndarray, link: np.ndarray, sim: np.ndarray, fresh: np.ndarray, links: int) -> tuple[np.ndarray, ...]:
    """The ``links`` nearest different links of each node; one that was there before stays as it was. Sorted."""
    order = np.lexsort((fresh, link, node))
    node, link, sim, fresh = node[order], link[order], sim[order], fresh[order]
    keep = np.ones(len(node), bool)
    keep[1:] = (node[1:] != node[:-1]) | (link[1:] != link[:-1])
    node, link, sim, fresh = node[keep], link[keep], sim[keep], fresh[keep]
    order = np.lexsort((link, -sim, node))
    node, link, sim, fresh = node[order], link[order], sim[order], fresh[order]
    keep = np.arange(len(node)) - np.searchsorted(node, node) < links
    return node[keep], link[keep], sim[keep], fresh[keep]


def _link_rows(node: np.ndarray, link: np.ndarray, sim: np.ndarray, fresh: np.ndarray) -> pa.RecordBatch:
    edges = A.group_edges(node)
    first = node[edges[:-1]]
    return _rows(_GRAPH_ARROW, node=first, kind=np.ones(len(first), np.int32), links=_packed(link, edges, "<i8"), sims=_packed(sim, edges, "<f4"), fresh=_packed(fresh, edges, "u1"))


def _start(dim: int, rounds: int, seed: int):
    """Each node once for each round, with its place: on which side of the planes it lies."""
    planes = np.random.default_rng(seed).standard_normal((dim, rounds * PLANES)).astype(np.float32)
    weight = 1 << np.arange(PLANES - 1, -1, -1, dtype=np.int64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                part = batch.slice(at, 2_000)
                sides = (_floats(part.column("code").to_pylist()) @ planes > 0).reshape(len(part), rounds, PLANES)
                place = sides @ weight
                for r in range(rounds):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), r), pa.int32()), pa.array(place[:, r], pa.int64()), part.column("node"), part.column("code")], names=["round", "place", "node", "code"])

    return spread


def _blocks(links: int):
    """The nearest of each node's block; a block is consecutive nodes of one round."""

    def near(node: np.ndarray, codes: list[bytes]) -> pa.RecordBatch:
        x = _floats(codes)
        sim = x @ x.T
        np.fill_diagonal(sim, -2)
        n = min(links, len(node) - 1)
        best = np.argpartition(-sim, n - 1, axis=1)[:, :n]
        return _link_rows(*_nearest(np.repeat(node, n), node[best].ravel(), np.take_along_axis(sim, best, 1).ravel(), np.ones(n * len(node), np.uint8), links))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, node, codes = None, np.zeros(0, np.int64), []
        for batch in batches:
            rounds = np.asarray(batch.column("round"))
            edges = A.group_edges(rounds)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if rounds[a] != last:
                    if len(node) > 1:
                        yield near(node, codes)
                    last, node, codes = rounds[a], np.zeros(0, np.int64), []
                node = np.concatenate((node, np.asarray(batch.column("node"))[a:b]))
                codes += batch.column("code").slice(a, b - a).to_pylist()
                while len(node) >= 2 * BLOCK:  # what is left at the end is never a small block
                    yield near(node[:BLOCK], codes[:BLOCK])
                    node, codes = node[BLOCK:], codes[BLOCK:]
        if len(node) > 1:
            yield near(node, codes)

    return run


def _merge(links: int):
    """One row for each node: its code, and the nearest of all its links (kind 0: the node with its old ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_keys(batches, "node", 4_000):
            node, kind = table.column("node").to_numpy(), table.column("kind").to_numpy()
            own = np.flatnonzero(kind == 0)
            link, size = _lists(table.column("links"), "<i8")
            sim, _ = _lists(table.column("sims"), "<f4")
            fresh, _ = _lists(table.column("fresh"), "u1")
            of, link, sim, fresh = _nearest(np.repeat(node, size), link, sim, fresh, links)
            ids = node[own]
            edges = np.searchsorted(of, np.concatenate((ids, [np.iinfo(np.int64).max])))
            full = np.diff(edges) >= links
            worst = np.full(len(ids), -2, np.float32)
            worst[full] = sim[edges[1:][full] - 1]
            yield _rows(
                _GRAPH_ARROW, node=ids, kind=np.zeros(len(ids), np.int32), code=table.column("code").take(pa.array(own)).to_pylist(),
                links=_packed(link, edges, "<i8"), sims=_packed(sim, edges, "<f4"), fresh=_packed(fresh, edges, "u1"), worst=worst,
            )

    return run


def _seen_by(reverse: int, seed: int):
    """Each node's own links (kind 0), and itself to those it links to (kind 1), a bounded draw from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.asarray(batch.column("node"))
            link, size = _lists(batch.column("links"), "<i8")
            fresh, _ = _lists(batch.column("fresh"), "u1")
            yield _rows(_SEEN_BY_ARROW, node=node, kind=np.zeros(len(node), np.int32), links=batch.column("links").to_pylist(), fresh=batch.column("fresh").to_pylist())
            if not len(link):
                continue
            of = np.repeat(node, size)
            draw = (A.mix(of.view(np.uint64) * A.U(0x9E3779B97F4A7C15) + A.mix(link.view(np.uint64) + A.U(seed))) >> A.U(32)).astype(np.int64)
            order = np.lexsort((draw, 1 - fresh, link))
            order = order[np.arange(len(link)) - np.searchsorted(link[order], link[order]) < reverse]
            yield _rows(_SEEN_BY_ARROW, node=link[order], kind=np.ones(len(order), np.int32), back=of[order], new=fresh[order].astype(bool), draw=draw[order])

    return run


def _neighbourhoods(table: pa.Table, reverse: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node, neighbour and whether the link is new: all own links and ``reverse`` of those from elsewhere."""
    node, kind = table.column("node").to_numpy(), table.column("kind").to_numpy()
    own = np.flatnonzero(kind == 0)
    mine = table.take(pa.array(own))
    link, size = _lists(mine.column("links"), "<i8")
    fresh, _ = _lists(mine.column("fresh"), "u1")
    back = np.flatnonzero(kind == 1)
    theirs = table.take(pa.array(back))
    from_, new = theirs.column("back").to_numpy().astype(np.int64), theirs.column("new").to_numpy(zero_copy_only=False).astype(np.uint8)
    order = np.lexsort((theirs.column("draw").to_numpy(), 1 - new, node[back]))
    to = node[back][order]
    order = order[np.arange(len(to)) - np.searchsorted(to, to) < reverse]
    of, link, fresh = (np.concatenate(c) for c in ((np.repeat(node[own], size), node[back][order]), (link, from_[order]), (fresh, new[order])))
    order = np.lexsort((1 - fresh, link, of))
    of, link, fresh = of[order], link[order], fresh[order]
    keep = np.ones(len(of), bool)
    keep[1:] = (of[1:] != of[:-1]) | (link[1:] != link[:-1])
    return of[keep], link[keep], fresh[keep].astype(bool)


def _choose(reverse: int):
    """Who meets at each node, where any link is new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_keys(batches, "node", 100_000):
            of, link, fresh = _neighbourhoods(table, reverse)
            edges = A.group_edges(of)
            any_new = np.add.reduceat(fresh, edges[:-1]) > 0 if len(of) else np.zeros(0, bool)
            keep = np.repeat(any_new, np.diff(edges))
            for a in range(0, len(of), 100_000):
                k = np.flatnonzero(keep[a : a + 100_000]) + a
                yield _rows(_MEET_ARROW, at=of[k], link=link[k], fresh=fresh[k])

    return run


def _introduce(links: int):
    """New links among those who meet at a node: each pair with a new link that is nearer than what one of the two has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_keys(batches, "at"):
            edges = A.group_edges(table.column("at").to_numpy())
            link, fresh = table.column("link").to_numpy(), table.column("fresh").to_numpy(zero_copy_only=False)
            worst, codes = table.column("worst").to_numpy(), table.column("code").to_pylist()
            found: list[tuple[np.ndarray, ...]] = []
            for g in range(0, len(edges) - 1, _TOGETHER):
                here = edges[g : g + _TOGETHER + 1]
                first, size = here[:-1], np.diff(here)
                wide = int(size.max())
                slot = first[:, None] + np.minimum(np.arange(wide), size[:, None] - 1) - here[0]
                there = np.arange(wide) < size[:, None]
                x = _floats(codes[here[0] : here[-1]])[slot]
                sim = x @ x.transpose(0, 2, 1)
                new = fresh[here[0] : here[-1]][slot]
                ids, floor = link[here[0] : here[-1]][slot], worst[here[0] : here[-1]][slot]
                good = (sim > floor[:, :, None]) & (new[:, :, None] | new[:, None, :]) & there[:, :, None] & there[:, None, :]
                good &= ids[:, :, None] != ids[:, None, :]
                b, i, j = np.nonzero(good)
                found.append((ids[b, i], ids[b, j], sim[b, i, j]))
            u, w, s = (np.concatenate(c) for c in zip(*found, strict=True))
            yield _link_rows(*_nearest(u, w, s, np.ones(len(u), np.uint8), links))

    return run


def _adjacent(reverse: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_keys(batches, "node", 100_000):
            of, link, _ = _neighbourhoods(table, reverse)
            edges = A.group_edges(of)
            yield pa.RecordBatch.from_arrays([pa.array(of[edges[:-1]], pa.int64()), pa.array(_packed(link, edges, "<i8"), pa.binary())], names=["node", "links"])

    return run


@dataclass(frozen=True)
class Index:
    """``rows``: id and key of every row that takes part. ``nodes``: node, key, code, vec, members (the smallest
    ids). ``adjacent``: node and its packed links both ways. ``entries``: codes of some nodes, a bounded number."""

    rows: DataFrame
    nodes: DataFrame
    adjacent: DataFrame
    entries: list[tuple[int, bytes]]


def _usable(vec: Column) -> Column:
    """Not null, with finite components that are not all zero."""
    broken = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vec.isNotNull() & ~broken & F.exists(vec, lambda x: x != 0), F.lit(False))


def _coded(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``key`` (a digest of the vector), ``code`` and ``vec`` of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).filter(F.col("id").isNotNull() & _usable(F.col("vec")))
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    rows = rows.join(F.broadcast(common.select("n")), F.size("vec") == F.col("n"), "left_semi")
    out = T.StructType([T.StructField("id", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("code", T.BinaryType()), rows.schema["vec"]])
    schema = to_arrow_schema(out)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                part = batch.slice(at, 2_000)
                vec = part.column("vec")
                x = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), -1) + 0.0  # no minus zero
                keys = [xxhash.xxh3_128_digest(r.tobytes()) for r in x]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(keys, pa.binary()), pa.array(_codes(x), pa.binary()), vec.cast(schema.field("vec").type)], schema=schema)

    return rows.mapInArrow(code, out)


def _by_node(df: DataFrame, *sort: str) -> DataFrame:
    return df.repartition("node").sortWithinPartitions("node", *sort)


def _fresh_links(graph: DataFrame) -> tuple[DataFrame, int, int]:
    """The graph as a table, with the numbers of its new links and of its nodes."""
    seen = Observation()
    new = F.length(F.regexp_replace(F.hex("fresh"), "0", ""))
    kept = staged(graph.observe(seen, F.coalesce(F.sum(new), F.lit(0)).alias("new"), F.count("*").alias("n")))
    told = seen.get
    return kept, told["new"], told["n"]


def build(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    keep: int = 6,
    links: int = 40,
    reverse: int = 24,
    starts: int = 12,
    entries: int = 256,
    settled: float = 0.03,
    rounds: int = 12,
    seed: int = 11,
) -> Index:
    """The neighbour graph of all vectors by cosine.

    A node has ``links`` links, and is shown to its neighbours' neighbours through these and ``reverse`` links
    that lead to it. The rounds end when fewer than ``settled`` of the links are new, or after ``rounds``.
    Vectors that are null, zero or hold a null or non-finite component take no part, nor do rows without an id
    or with a length other than the most common one. Equal vectors are one node, which remembers its ``keep``
    smallest ids; of rows with one id and different vectors one takes part, that of the smallest digest.
    A table of no or one vector gives a graph without links.
    """
    coded = staged(_coded(vectors, id_col, vec_col))
    rows = coded.groupBy("id").agg(F.min("key").alias("key"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    members = rows.withColumn("nth", rank).filter(F.col("nth") <= keep)
    classes = members.groupBy("key").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("members"))
    first = coded.select(F.col("id").alias("node"), "key", "code", "vec")
    # Repeated rows of a node are equal; one is taken.
    nodes = staged(classes.join(first, ["node", "key"]).groupBy("node").agg(*[F.first(c).alias(c) for c in ("key", "members", "code", "vec")]))
    some = nodes.select("node", "code").orderBy(F.xxhash64("node")).limit(entries).collect()
    if not some:
        none = nodes.select("node", F.lit(b"").alias("links"))
        return Index(rows, nodes, none, [])
    dim = (len(some[0]["code"]) - 4) // 2
    placed = nodes.select("node", "code").mapInArrow(_start(dim, starts, seed), "round int, place long, node long, code binary")
    order = ["round", "place", "node"]
    found = placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(16), _GRAPH)
    empty = F.lit(b"")
    bare = nodes.select("node", F.lit(0).alias("kind"), "code", empty.alias("links"), empty.alias("sims"), empty.alias("fresh"), F.lit(-2).cast("float").alias("worst"))
    graph, new, n = _fresh_links(_by_node(bare.unionByName(found), "kind").mapInArrow(_merge(links), _GRAPH))
    for r in range(rounds):
        if new <= settled * n * links:
            break
        shown = _by_node(graph.select("node", "links", "fresh").mapInArrow(_seen_by(reverse, seed + r), _SEEN_BY), "kind")
        meet = shown.mapInArrow(_choose(reverse), _MEET)
        known = graph.select(F.col("node").alias("link"), "code", "worst")
        together = meet.join(known, "link").repartition("at").sortWithinPartitions("at", "link")
        old = graph.withColumn("fresh", F.to_binary(F.repeat(F.lit("00"), F.length("fresh").cast("int")), F.lit("hex")))
        found = together.mapInArrow(_introduce(links), _GRAPH)
        graph, new, n = _fresh_links(_by_node(old.unionByName(found), "kind").mapInArrow(_merge(links), _GRAPH))
    shown = _by_node(graph.select("node", "links", "fresh").mapInArrow(_seen_by(reverse, seed), _SEEN_BY), "kind")
    adjacent = staged(shown.mapInArrow(_adjacent(reverse), "node long, links binary"))
    return Index(rows, nodes, adjacent, [(r["node"], bytes(r["code"])) for r in some])


def _state_row(node: int, code: bytes, beam: np.ndarray, sims: np.ndarray, opened: np.ndarray, seen: np.ndarray) -> dict:
    todo = beam[~opened].tolist()
    return {
        "node": node, "kind": 0, "code": code, "beam": beam.astype("<i8").tobytes(), "sims": sims.astype("<f4").tobytes(),
        "opened": opened.astype("u1").tobytes(), "seen": np.sort(seen).astype("<i8").tobytes(), "todo": todo,
    }


def _enter(entries: list[tuple[int, bytes]], best: int):
    ids, x = np.array([e[0] for e in entries], np.int64), _floats([e[1] for e in entries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for node, code, inside in zip(*(batch.column(c).to_pylist() for c in ("node", "code", "inside")), strict=True):
                sim = (x @ _floats([code])[0]) if len(ids) else np.zeros(0, np.float32)
                at = np.argsort(-sim, kind="stable")[:best]
                at = at[ids[at] != node] if inside else at
                own = [node] if inside else []
                beam = np.concatenate((np.array(own, np.int64), ids[at]))
                sims = np.concatenate((np.ones(len(own), np.float32), sim[at]))
                out.append(_state_row(node, code, beam, sims, np.zeros(len(beam), bool), beam))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_STATE_ARROW)

    return run


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a query's state (kind 0) and the links of the nodes that it opens: those it has not met."""
    for table in _whole_keys(batches, "node", 2_000):
        node = table.column("node").to_numpy()
        seen, links = table.column("seen"), table.column("links")
        edges = A.group_edges(node)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            met = np.frombuffer(seen[a].as_py(), "<i8")
            led = np.frombuffer(b"".join(p or b"" for p in links.slice(a, b - a).to_pylist()), "<i8")
            new = np.setdiff1d(led, met)
            if len(new):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(new), node[a]), pa.int64()), pa.array(new, pa.int64())], names=["node", "met"])


def _advance(width: int):
    """A query's next state: the best ``width`` of its beam and of the nodes it has just met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_keys(batches, "node", 4_000):
            node, met, codes = table.column("node").to_numpy(), table.column("met").to_numpy(), table.column("code")
            edges = A.group_edges(node)
            out = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = table.slice(a, 1).to_pylist()[0]
                beam, sims, seen = (np.frombuffer(own[c], k) for c, k in (("beam", "<i8"), ("sims", "<f4"), ("seen", "<i8")))
                new = met[a + 1 : b].astype(np.int64)
                found = _floats(codes.slice(a + 1, b - a - 1).to_pylist()) @ _floats([own["code"]])[0] if len(new) else np.zeros(0, np.float32)
                ids, near = np.concatenate((beam, new)), np.concatenate((sims, found))
                opened = np.concatenate((np.ones(len(beam), bool), np.zeros(len(new), bool)))
                best = np.lexsort((ids, -near))[:width]
                out.append(_state_row(own["node"], own["code"], ids[best], near[best], opened[best], np.concatenate((seen, new))))
            yield pa.RecordBatch.from_pylist(out, schema=_STATE_ARROW)

    return run


def _walk(index: Index, queries: DataFrame, width: int, best: int) -> DataFrame:
    """``node`` and ``beam`` for each of ``queries(node, code, inside)``, all of whose beam is opened."""
    codes = index.nodes.select(F.col("node").alias("met"), "code")
    state = staged(queries.mapInArrow(_enter(index.entries, best), _STATE))
    ended = [state.filter(F.size("todo") == 0)]
    active = state.filter(F.size("todo") > 0)
    while not active.isEmpty():
        opening = active.select("node", F.explode("todo").alias("at"))
        led = opening.join(index.adjacent.select(F.col("node").alias("at"), "links"), "at").select("node", F.lit(1).alias("kind"), "links")
        both = _by_node(active.select("node", "kind", "seen").unionByName(led, allowMissingColumns=True), "kind")
        met = both.mapInArrow(_unseen, "node long, met long").join(codes, "met").withColumn("kind", F.lit(1))
        both = _by_node(active.drop("todo").unionByName(met, allowMissingColumns=True), "kind", "met")
        state = staged(both.mapInArrow(_advance(width), _STATE))
        ended.append(state.filter(F.size("todo") == 0))
        active = state.filter(F.size("todo") > 0)
    out = ended[0]
    for e in ended[1:]:
        out = out.unionByName(e)
    return out.select("node", "beam")


def _heads(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            beam = [np.frombuffer(p, "<i8")[:count] for p in batch.column("beam").to_pylist()]
            sizes = [len(b) for b in beam]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(batch.column("node")), sizes), pa.int64()), pa.array(np.concatenate([*beam, np.zeros(0, np.int64)]).astype(np.int64), pa.int64())], names=["node", "near"])

    return run


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two arrays in double precision, components added from the first on."""

    def added(products: Column) -> Column:
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    def squares(v: Column) -> Column:
        return added(F.transform(v, lambda x: x.cast("double") * x.cast("double")))

    return added(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))) / F.sqrt(squares(a)) / F.sqrt(squares(b))


def search(index: Index, wanted: Column, k: int = 5, width: int = 96, best: int = 8, again: int = 32) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``k`` nearest found of each row whose ``id`` is ``wanted``.

    Candidates are all rows of the index but the query's own; ties go to the smaller id. Rows that took no part
    in ``build`` are no queries and no candidates. Queries with equal vectors are searched once. ``width`` is the
    beam, whose ``again`` first nodes are compared by their original vectors; ``k`` is less than ``build``'s
    ``keep``. Fewer than ``k`` candidates give all of them, an empty index nothing.
    """
    asked = index.rows.filter(wanted).join(index.nodes.select("key", "node"), "key").select(F.col("id").alias("query_id"), "node")
    codes = index.nodes.select("node", "code", F.lit(True).alias("inside"))
    beams = _walk(index, codes.join(asked.select("node").distinct(), "node"), width, best)
    near = beams.mapInArrow(_heads(max(again, k + 1)), "node long, near long")
    theirs = index.nodes.select(F.col("node").alias("near"), "members", F.col("vec").alias("there"))
    own = index.nodes.select("node", F.col("vec").alias("here"))
    scored = near.join(theirs, "near").join(own, "node").select("node", cosine(F.col("here"), F.col("there")).alias("score"), F.explode("members").alias("vec_id"))
    order = [F.desc("score"), F.asc("vec_id")]
    # One more than asked for, as the query itself may be among them.
    first = scored.withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy(*order))).filter(F.col("nth") <= k + 1).drop("nth")
    told = asked.join(first, "node").filter("vec_id <> query_id")
    told = told.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return told.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
