"""Substring dedup by fixed-block anchors.

Every text is cut into non-overlapping blocks of half a window, which are the index. Every rolling
window of a block's size probes it. A window of ``window`` words always holds a whole block, so two
equal windows share a hit: the block of the one text and the rolling probe in the other. Around each
hit the whole windows are compared, which extends it to the maximal exact repeat.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from clickloom.llm import arrays as A
from clickloom.llm.repeats import NAMELESS, Spans, by_bucket, without_repeats

#: Rows without an id are not smaller than one another.
_NO_ID = 2**63 - NAMELESS


@dataclass(frozen=True)
class FixedBlocks:
    window: int = 50
    slice_bytes: int = 1 << 20
    gather: int = 500_000

    @property
    def block(self) -> int:
        # Among window - block + 1 starts one is a multiple of block.
        return (self.window + 1) // 2

    def anchors(self, texts: A.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        words = A.words_of(texts, A.NOT_BLANK)
        key = A.rolling(A.hash_spans(texts.data, words.start, words.end), self.block)
        first, text = words.first[:-1][words.text[: len(key)]], words.text[: len(key)]
        place = np.arange(len(key)) - first
        # Windows too short to hold a repeat are left out: those of texts below one whole window.
        whole = (np.arange(len(key)) + self.block <= words.first[1:][text]) & (words.counts()[text] >= self.window)
        return text[whole], place[whole], key[whole], (place % self.block == 0)[whole]

    def details(self, texts: A.Texts, text: np.ndarray, place: np.ndarray) -> dict[str, np.ndarray]:
        words = A.words_of(texts, A.NOT_BLANK)
        n = len(words.start)
        near = np.zeros(n + 1, np.int64)  # starts of windows that hold a hit
        at = words.first[text] + place
        inside = (place >= 0) & (at + self.block <= words.first[text + 1])
        at, lead = at[inside], np.minimum(place[inside], self.window - self.block)
        np.add.at(near, at - lead, 1)
        np.add.at(near, at + 1, -1)
        start = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        start = start[start + self.window <= words.first[1:][words.text[start]]]
        out = {"text": words.text[start], "place": start - words.first[words.text[start]]}
        if not len(start):
            return out | {"high": np.zeros(0, np.uint64), "low": np.zeros(0, np.uint64)}
        for which, name in enumerate(("high", "low")):
            out[name] = A.rolling(A.hash_spans(texts.data, words.start, words.end, which), self.window, which)[start]
        return out

    def settle_here(self, parts: list[dict[str, np.ndarray]], buckets: int) -> tuple[Spans, dict[int, bytes]]:
        doc, row, place, high, low = (np.concatenate([p[c] for p in parts]) for c in ("doc", "row", "place", "high", "low"))
        named = np.minimum(doc, _NO_ID)
        least = _least_of_group(named, high, low)
        later, at = named > least, np.flatnonzero(named == least)
        sent = {}
        for bucket, here in by_bucket(A.bucket_of(high[at], buckets)):
            here = at[here]
            sent[bucket] = A.pack(doc[here], row[here], place[here], high[here], (low[here] >> A.U(32)).astype("<u4"))
        return _consecutive(doc[later], row[later], place[later]), sent

    def settle(self, payloads: list[bytes]) -> Spans:
        doc, row, place, high, low = (np.concatenate(c) for c in zip(*map(A.unpack, payloads), strict=True))
        named = np.minimum(doc, _NO_ID)
        later = named > _least_of_group(named, high, low)
        return _consecutive(doc[later], row[later], place[later])

    def cut(self, text: bytes, starts: np.ndarray, counts: np.ndarray) -> tuple[bytes, int, int, int]:
        words = text.split()  # bytes are split at exactly the six blanks
        if not len(starts):
            return b" ".join(words), len(words), 0, 0
        gone = covered(len(words), starts, starts + counts - 1 + self.window)
        kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
        return kept, len(words), int(gone.sum()), n_runs(gone)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


def n_runs(flags: np.ndarray) -> int:
    return int(flags[:1].sum() + (flags[1:] & ~flags[:-1]).sum())


def _least_of_group(doc: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The smallest document of each entry's group of equal windows."""
    order = np.lexsort((low, high))
    edges = A.group_edges(high[order], low[order])
    least = np.empty(len(doc), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(doc[order], edges[:-1]), np.diff(edges)) if len(doc) else 0
    return least


def _consecutive(doc: np.ndarray, row: np.ndarray, place: np.ndarray) -> Spans:
    order = np.lexsort((place, row, doc))
    doc, row, place = doc[order], row[order], place[order]
    if not len(doc):
        return doc, row, place, place
    same = (doc[1:] == doc[:-1]) & (row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1)
    first = np.concatenate(([0], np.flatnonzero(~same) + 1))
    return doc[first], row[first], place[first], np.diff(np.concatenate((first, [len(doc)])))


def remove_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """Remove the words of every ``window``-word sequence that also starts in a document with a smaller id.

    Words are what stands between blanks (space, tab, line breaks). Windows are judged on the input.
    Returns ``row`` (a struct with all other columns of ``docs``, so that no name can clash), ``kept``
    (binary: the kept words with one space between), ``n_units`` (words), ``n_removed``, ``n_spans``.

    Null text has no words; an empty text or one below ``window`` words keeps all. A null id counts as
    the largest. Rows of equal id are one row each, are not smaller than one another, and so do not
    remove each other's words. Equal rows get equal results. An empty table gives an empty result.

    Windows are compared by 96 bits of hash.
    """
    return without_repeats(docs, FixedBlocks(window), id_col, text_col)
