"""Removal of repeated byte strings by sorting suffixes, shallow first and deep where needed.

Sorting every suffix of a corpus would move the corpus once per byte. Anchors thin the suffixes out
without losing a repeat: in each string of ``length`` bytes the place with the smallest hash of
``gram`` bytes is its anchor, so equal strings have equal anchors at equal offsets. Anchors whose gram
occurs once are in no repeat. Of the rest, the suffixes from the anchor on and, read backwards, those
before it are sorted: by a multikey sort, eight bytes a round, to a shallow depth, and then each group
that is still equal goes through a blind trie. The longest common prefixes of neighbours tell, for each
offset of the anchor, which strings are equal on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from clickloom.llm import arrays as A
from clickloom.llm.repeats import Spans, by_bucket, without_repeats
from clickloom.llm.substring_dedup import covered, n_runs

_SPREAD = A.mix(np.arange(1, 257, dtype=np.uint64))
_AGAIN = np.uint64(0x9E3779B97F4A7C15)


class BlindTrie:
    """Strings of one length, told apart by the bytes at which they branch; only a leaf is compared whole."""

    def __init__(self) -> None:
        self.root: list | None = None  # a leaf: [string, ids]; a branch: [depth, {byte: node}]

    def add(self, string: bytes, i: int) -> None:
        node = self.root
        if node is None:
            self.root = [string, [i]]
            return
        while type(node[0]) is int:  # blind: any leaf below will do
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        other, size = node[0], len(string)
        differ = int.from_bytes(string, "big") ^ int.from_bytes(other, "big")
        if not differ:
            node[1].append(i)
            return
        depth = size - (differ.bit_length() + 7) // 8
        above, node = None, self.root
        while type(node[0]) is int and node[0] < depth:
            above, node = node, node[1][string[node[0]]]
        if type(node[0]) is int and node[0] == depth:
            node[1][string[depth]] = [string, [i]]
            return
        branch = [depth, {other[depth]: node, string[depth]: [string, [i]]}]
        if above is None:
            self.root = branch
        else:
            above[1][string[above[0]]] = branch

    def in_order(self, size: int) -> Iterator[tuple[int, int]]:
        """Ids in the order of their strings, each with the bytes it shares with the one before."""
        todo = [(self.root, 0)]
        while todo:
            node, shared = todo.pop()
            if type(node[0]) is int:
                children = [node[1][b] for b in sorted(node[1])]
                todo += [(c, node[0]) for c in children[:0:-1]]
                todo.append((children[0], shared))
            else:
                yield node[1][0], shared
                for i in node[1][1:]:
                    yield i, size


def _equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes that two big-endian 64-bit numbers share."""
    differ = a ^ b
    return sum((differ < A.U(1 << (8 * i))).astype(np.int64) for i in range(1, 8)) + (differ == 0)


def sort_suffixes(data: np.ndarray, start: np.ndarray, size: np.ndarray, depth: int, key: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``data[start:start + size]``, filled up with zeros to ``depth``, and what neighbours share.

    Strings of different ``key`` share nothing. ``data`` has eight bytes behind the last string.
    """
    n = len(start)
    order = np.argsort(key, kind="stable")
    shared = np.full(n, depth, np.int64)  # with the one before, as far as is known
    group = np.zeros(n, np.int64)
    edges = A.group_edges(key[order])
    shared[edges[:-1]] = 0
    eights = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    keep = np.array([0] + [((1 << (8 * i)) - 1) << (64 - 8 * i) for i in range(1, 9)], np.uint64)
    at = 0
    while at < min(shallow, depth):
        new = shared < depth
        group = np.cumsum(new)
        alone = np.diff(np.concatenate((np.flatnonzero(new), [n]))) == 1
        todo = np.flatnonzero(~alone[group - 1])
        if not len(todo):
            break
        who = order[todo]
        word = eights[np.minimum(start[who] + at, len(eights) - 1)].astype(np.uint64) & keep[np.clip(size[who] - at, 0, min(8, depth - at))]
        again = np.lexsort((word, group[todo]))
        order[todo], word = who[again], word[again]
        same = _equal_bytes(word[1:], word[:-1])
        differs = np.flatnonzero((group[todo][1:] == group[todo][:-1]) & (same < 8))
        shared[todo[1:][differs]] = at + same[differs]
        at += 8
    if at < depth:
        edges = np.concatenate((np.flatnonzero(shared < depth), [n]))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a < 2:
                continue
            trie = BlindTrie()
            for i in order[a:b]:
                rest = data[start[i] + at : start[i] + min(size[i], depth)].tobytes() if size[i] > at else b""
                trie.add(rest.ljust(depth - at, b"\0"), i)
            who, with_last = zip(*trie.in_order(depth - at), strict=True)
            order[a:b] = who
            shared[a + 1 : b] = at + np.array(with_last[1:], np.int64)
    return order, shared


@dataclass(frozen=True)
class SuffixAnchors:
    length: int = 200
    gram: int = 64
    shallow: int = 96
    slice_bytes: int = 1 << 19  # a byte takes some eight numbers on the way
    gather: int = 40_000
    whole_characters: bool = False

    def __post_init__(self) -> None:
        if not 0 < self.gram < self.length:
            raise ValueError("a gram must be shorter than the repeated string")

    def _chosen(self, texts: A.Texts) -> tuple[np.ndarray, ...]:
        """Text, place, key of each anchor, and its smallest and largest offset in the strings it stands for."""
        n, span = int(texts.offsets[-1]), self.length - self.gram + 1
        none = np.zeros(0, np.int64)
        if n < self.length:
            return none, none, np.zeros(0, np.uint64), none, none
        hashes = A.rolling(_SPREAD[texts.data[:n]], self.gram)
        # 32 bits of hash, then the place: the smallest is the leftmost of the smallest hashes.
        ranked = (hashes >> A.U(32) << A.U(32)) | np.arange(len(hashes), dtype=np.uint64)
        rows = -(-len(ranked) // span)
        table = np.full(rows * span, 0xFFFFFFFFFFFFFFFF, np.uint64)
        table[: len(ranked)] = ranked
        table = table.reshape(rows, span)
        left = np.minimum.accumulate(table, 1).ravel()
        right = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
        anchor = (np.minimum(right[: n - self.length + 1], left[span - 1 : n - self.length + span]) & A.U(0xFFFFFFFF)).astype(np.int64)
        long = np.diff(texts.offsets) >= self.length
        whole = covered(len(anchor), texts.offsets[:-1][long], texts.offsets[1:][long] - self.length + 1)
        start = np.flatnonzero(whole)
        edges = A.group_edges(anchor[start])
        if not len(start):
            return none, none, np.zeros(0, np.uint64), none, none
        at, first, last = anchor[start[edges[:-1]]], start[edges[:-1]], start[edges[1:] - 1]
        text = np.searchsorted(texts.offsets, first, "right") - 1
        # Anchors have small hashes; mixed once more, their keys spread evenly over the buckets.
        return text, at - texts.offsets[text], A.mix(hashes[at] + _AGAIN), at - last, at - first

    def anchors(self, texts: A.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        text, place, key, _, _ = self._chosen(texts)
        return text, place, key, np.ones(len(text), bool)

    def details(self, texts: A.Texts, text: np.ndarray, place: np.ndarray) -> dict[str, np.ndarray]:
        found, at, key, least, most = self._chosen(texts)
        hit = np.isin(texts.offsets[found] + at, texts.offsets[text] + place)
        found, at, key, least, most = (c[hit] for c in (found, at, key, least, most))
        start = texts.offsets[found] + at - most
        size = most + self.length - least
        blob = texts.data[_gather(start, size)] if len(start) else np.zeros(0, np.uint8)
        same = A.hash_spans(texts.data, start, start + size)
        return {"text": found, "place": at, "key": key, "least": least, "most": most, "same": same, "blob": blob}

    def settle_here(self, parts: list[dict[str, np.ndarray]], buckets: int) -> tuple[Spans, dict[int, bytes]]:
        doc, row, place, key, least, most, same, blob = (np.concatenate([p[c] for p in parts]) for c in ("doc", "row", "place", "key", "least", "most", "same", "blob"))
        size = most + self.length - least
        start = np.concatenate(([0], np.cumsum(size)))[:-1]
        # Equal anchors with equal surroundings are repeats of one another; one of them speaks for all.
        columns = (same, key, most, least)
        order = np.lexsort(columns)
        edges = A.group_edges(*(c[order] for c in columns))
        again = order[np.repeat(np.diff(edges) > 1, np.diff(edges))]
        first = np.sort(order[edges[:-1]])
        settled = doc[again], row[again], (place - most)[again], (most - least + 1)[again]
        sent = {}
        for bucket, at in by_bucket(A.bucket_of(key[first], buckets)):
            at = first[at]
            own = (key[at] & A.U(0xFFFFFFFF)).astype("<u4")
            sent[bucket] = A.pack(doc[at], row[at], place[at], least[at], most[at], own, blob[_gather(start[at], size[at])])
        return settled, sent

    def settle(self, payloads: list[bytes]) -> Spans:
        doc, row, place, least, most, key, blob = (np.concatenate(c) for c in zip(*map(A.unpack, payloads), strict=True))
        size, n = most + self.length - least, len(doc)
        start = np.concatenate(([0], np.cumsum(size)))[:-1] + 8
        data = np.zeros(len(blob) + 16, np.uint8)
        data[8:-8] = blob
        anchor, span = start + most, self.length - self.gram + 1
        ahead, shared_ahead = sort_suffixes(data, anchor, self.length - least, self.length, key, self.shallow)
        back, shared_back = sort_suffixes(np.ascontiguousarray(data[::-1]), len(data) - anchor, most, span - 1, key, self.shallow)
        repeated = np.zeros((n, span + 1), bool)
        here, there = np.empty(n, np.int64), np.empty(n, np.int64)
        for offset in range(span):
            at = np.flatnonzero((least <= offset) & (offset <= most))
            if len(at) < 2:
                continue
            here[ahead] = np.cumsum(shared_ahead < self.length - offset)
            there[back] = np.cumsum(shared_back < max(offset, 1))
            if not offset:  # nothing stands before the anchor, but keys still differ
                there[:] = 0
            both = here[at] * (n + 1) + there[at]
            order = np.argsort(both, kind="stable")
            edges = A.group_edges(both[order])
            repeated[at[order[np.repeat(np.diff(edges) > 1, np.diff(edges))]], offset] = True
        edge = np.diff(np.concatenate((np.zeros((n, 1), np.int8), repeated.astype(np.int8)), 1), axis=1)
        who, first = np.nonzero(edge == 1)
        _, behind = np.nonzero(edge == -1)
        return doc[who], row[who], place[who] - behind + 1, behind - first

    def cut(self, text: bytes, starts: np.ndarray, counts: np.ndarray) -> tuple[bytes, int, int, int]:
        if not len(starts):
            return text, len(text), 0, 0
        gone = covered(len(text), starts, starts + counts - 1 + self.length)
        if self.whole_characters:
            character = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
            gone = (np.bincount(character, gone, character[-1] + 1) > 0)[character]
        return np.frombuffer(text, np.uint8)[~gone].tobytes(), len(text), int(gone.sum()), n_runs(gone)


def _gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all spans, one span after the other."""
    before = np.concatenate(([0], np.cumsum(size)))
    kind = np.int32 if max(before[-1], start.max(initial=0) + size.max(initial=0)) < 1 << 31 else np.int64
    return np.arange(before[-1], dtype=kind) + np.repeat((start - before[:-1]).astype(kind), size)


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, gram: int = 64, whole_characters: bool = False) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts anywhere else.

    Texts are UTF-8 bytes. Both places lose their bytes, also within one text; overlapping strings
    count, and strings are judged on the input. Matches never cross texts. Returns ``row`` (a struct
    with all other columns of ``docs``, so that no name can clash), ``kept`` (binary), ``n_units``
    (bytes), ``n_removed``, ``n_spans`` (maximal removed runs).

    Null or empty text has no bytes; a text below ``length`` bytes keeps all. Ids only tell rows apart:
    rows of equal or null id are rows of their own, and equal rows remove each other. An empty table
    gives an empty result. With ``whole_characters`` a character that loses a byte goes as a whole, so that
    what is kept of a text is text.
    """
    return without_repeats(docs, SuffixAnchors(length, min(gram, max(1, length - 1)), whole_characters=whole_characters), id_col, text_col)
