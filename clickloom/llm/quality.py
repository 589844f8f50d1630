"""Quality rules: counts of each text, and an isolation forest that tells which texts have unusual ones.

A tree splits the space at random places until rows stand alone. Unusual rows stand alone early,
so a short path through the trees means an anomaly. Bad texts come in clusters, which stand alone late and
hide each other, so the rows that count are those labelled good, and trees split beyond them too. How short is
too short is set on labelled rows.

Every labelled row counts, in the scale of the features, in the trees and in the threshold. Trees need no rows to
split, so they are drawn first, and each task counts the rows in their leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.llm import arrays as A
from clickloom.llm.shared import at_ranks, running, staged

#: Counted for each text, and columns of the result.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Counted besides for the forest.
MORE = ("n_bytes", "n_lines", "n_upper", "n_digits", "n_marks")

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = A.byte_class((0x41, 0x5A))
_DIGIT = A.byte_class((0x30, 0x39))
_MARK = np.isin(np.arange(256), list(b"!?;:,.\"'()-"))


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def _in_groups(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the entries by group of equal text and key, and the edges of the groups."""
    order = np.lexsort((key, text))
    return order, A.group_edges(text[order], key[order])


def statistics(texts: A.Texts) -> dict[str, np.ndarray]:
    n = int(texts.offsets[-1])
    data = texts.data[:n]
    words = A.words_of(texts, A.NOT_BLANK)
    in_word = A.NOT_BLANK[data]
    out = {
        "n_words": words.counts(),
        "word_chars": _sums(in_word & ((data & 0xC0) != 0x80), texts.offsets),
        "n_symbols": _sums(_SYMBOL[data], texts.offsets),
        "n_bytes": np.diff(texts.offsets),
        "n_upper": _sums(_UPPER[data], texts.offsets),
        "n_digits": _sums(_DIGIT[data], texts.offsets),
        "n_marks": _sums(_MARK[data], texts.offsets),
    }
    # Lines that hold a word; a word's line starts behind the last line break before it.
    lines = A.words_of(texts, ~A.byte_class((0x0A, 0x0A)))
    filled = np.diff(np.searchsorted(words.start, np.concatenate((lines.start, [n + 1])))) > 0 if len(lines.start) else np.zeros(0, bool)
    at = np.flatnonzero(filled)
    order, edges = _in_groups(lines.text[at], A.hash_spans(texts.data, lines.start[at], lines.end[at]))
    out["n_lines"] = np.bincount(lines.text[at], minlength=len(texts))
    again = np.diff(edges) - 1
    out["n_dup_lines"] = np.bincount(lines.text[at][order[edges[:-1]]], again, len(texts)).astype(np.int64) if len(at) else np.zeros(len(texts), np.int64)
    # Words in windows of three that come twice.
    key = A.rolling(A.hash_spans(texts.data, words.start, words.end), 3)
    text = words.text[: len(key)]
    whole = np.flatnonzero(np.arange(len(key)) + 3 <= words.first[1:][text])
    order, edges = _in_groups(text[whole], key[whole])
    twice = whole[order[np.repeat(np.diff(edges) > 1, np.diff(edges))]] if len(whole) else whole
    hit = np.zeros(len(words.start), bool)
    for k in range(3):
        hit[twice + k] = True
    out["n_repeat_words"] = np.bincount(words.text[hit], minlength=len(texts))
    return out


def base_failed(s: dict[str, np.ndarray], min_words: int = 50, max_repeat_percent: int = 50) -> np.ndarray:
    return (s["n_words"] < min_words) | (100 * s["n_repeat_words"] > max_repeat_percent * s["n_words"])


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Shares rather than counts, so that length alone makes nothing unusual."""
    words = np.maximum(s["n_words"], 1)
    chars = np.maximum(s["n_bytes"], 1)
    lines = np.maximum(s["n_lines"], 1)
    columns = [
        s["word_chars"] / words,
        s["n_symbols"] / words,
        s["n_dup_lines"] / lines,
        s["n_repeat_words"] / words,
        s["n_upper"] / chars,
        s["n_digits"] / chars,
        s["n_marks"] / chars,
        np.log1p(words / lines),
    ]
    return np.stack([np.asarray(c, float) for c in columns], 1)


def _mean_path(n: float) -> float:
    """Mean depth at which a search in a random tree of ``n`` rows ends; ``n`` may be a fraction."""
    if n <= 2:
        return max(n - 1, 0.0)
    return 2 * (math.log(n - 1) + 0.5772156649015329 + 1 / (2 * (n - 1)) - 1 / (12 * (n - 1) ** 2)) - 2 * (n - 1) / n


#: Shares of the rows below and above which a feature is out of its usual range.
_EDGES = (0.005, 0.995)


def _stretched(rows: np.ndarray, middle: np.ndarray, half: np.ndarray) -> np.ndarray:
    away = (rows - middle) / half
    return np.sign(away) * np.log1p(np.abs(away))


@dataclass
class Forest:
    """Trees as arrays of nodes; a leaf points to itself and has its depth in ``path``."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    scale: float
    depth: int
    threshold: float = 1.0
    middle: np.ndarray | None = None
    half: np.ndarray | None = None

    @classmethod
    def of_good(cls, rows: np.ndarray, seed: int = 3, reach: float = 3.0) -> Forest:
        """A forest of ``rows`` that are all good, which also isolates what none of them has."""
        forest = cls.drawn(*np.quantile(rows, _EDGES, axis=0), len(rows), seed=seed, reach=reach)
        return forest.settled(forest.leaves(rows))

    @classmethod
    def drawn(cls, low: np.ndarray, high: np.ndarray, n: int, trees: int = 100, sample: int = 256, seed: int = 3, reach: float = 3.0) -> Forest:
        """Full trees whose rows are not counted yet, for ``n`` rows whose features are usual from ``low`` to ``high``.

        Each feature counts from the middle of that range, by the signed logarithm of its distance in halves of
        the range. Trees split from ``-reach`` to ``reach``, where a feature that is the same in all rows has room
        too, to the depth of a tree of ``sample`` rows. Behind node i come 2i + 1 and 2i + 2.
        """
        depth = max(1, math.ceil(math.log2(max(min(sample, n), 2))))
        inner, size, width = (1 << depth) - 1, (2 << depth) - 1, len(low)
        nodes = np.tile(np.arange(size), (trees, 1))
        left, right = nodes.copy(), nodes.copy()
        left[:, :inner], right[:, :inner] = 2 * nodes[:, :inner] + 1, 2 * nodes[:, :inner] + 2
        feature, split = np.zeros((trees, size), np.int64), np.zeros((trees, size))
        number, each = np.arange(trees), -(-trees // width)
        box = np.tile(np.array([-reach, reach]), (trees, size, width, 1))
        for i in range(inner):
            random = np.random.default_rng((seed, i))  # so a deeper forest begins like a shallower one
            # The trees take all features in turn, and the places of a feature spread evenly.
            turn = random.permutation(trees)
            feature[:, i] = f = turn % width
            strata = random.permuted(np.tile(np.arange(each), (width, 1)), axis=1)
            place = (strata[f, turn // width] + random.random(trees)) / each
            least, most = box[number, i, f].T
            split[:, i] = least + place * (most - least)
            box[:, 2 * i + 1], box[:, 2 * i + 2] = box[:, i], box[:, i]
            box[number, 2 * i + 1, f, 1] = box[number, 2 * i + 2, f, 0] = split[:, i]
        middle, half = (low + high) / 2, np.maximum((high - low) / 2, 1e-3)
        return cls(feature, split, left, right, np.zeros((trees, size)), max(_mean_path(min(sample, n)), 1e-9), depth, middle=middle, half=half)

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """How many of ``rows`` each leaf of each full tree holds; these numbers add up over parts of the rows."""
        size = 1 << self.depth
        return np.stack([np.bincount(at - size + 1, minlength=size) for at in self._ends(rows)])

    def settled(self, leaves: np.ndarray, sample: int = 256, less: int = 0) -> Forest:
        """The forest with the rows of all leaves counted.

        A node holds its share of all rows, as rows among ``sample`` of them (or all, if fewer). It stays whole
        with no more than one, as a tree of so many rows would; its path is its depth and the mean of what is left.
        With ``less`` 1 the forest is, for a row that was counted, the one that the other rows make.
        """
        level = [leaves]
        while level[0].shape[1] > 1:
            level.insert(0, level[0].reshape(len(leaves), -1, 2).sum(2))
        n = int(level[0][0, 0])
        own = np.maximum(np.concatenate(level, 1) - less, 0) * (min(sample, n) / max(n, 1))
        depth = np.repeat(np.arange(len(level)), [x.shape[1] for x in level])
        nodes = np.tile(np.arange(own.shape[1]), (len(own), 1))
        whole = own <= 1
        left, right = np.where(whole, nodes, self.left), np.where(whole, nodes, self.right)
        return replace(self, left=left, right=right, path=depth + np.vectorize(_mean_path, otypes=[float])(own))

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 3) -> Forest:
        """A forest of rows in memory, good or not, each tree of ``sample`` of them; splits lie in the range of a node's rows."""
        random = np.random.default_rng(seed)
        sample = min(sample, len(rows))
        most = max(1, math.ceil(math.log2(max(sample, 2))))
        grown = []
        for _ in range(trees):
            nodes: list[tuple[int, float, int, int, float]] = []

            def add(own: np.ndarray, depth: int, nodes: list = nodes) -> int:
                at = len(nodes)
                nodes.append((0, 0.0, at, at, depth + _mean_path(len(own))))
                if depth < most and len(own) > 1:
                    low, high = own.min(0), own.max(0)
                    open_ = np.flatnonzero(high > low)
                    if len(open_):
                        f = int(random.choice(open_))
                        split = float(random.uniform(low[f], high[f]))
                        below = own[:, f] <= split
                        nodes[at] = (f, split, add(own[below], depth + 1), add(own[~below], depth + 1), 0.0)
                return at

            add(rows[random.choice(len(rows), sample, replace=False)] if len(rows) else rows, 0)
            grown.append(nodes)
        size = max(map(len, grown))
        table = [[n[i] for n in nodes] + [0] * (size - len(nodes)) for i in range(5) for nodes in grown]
        feature, split, left, right, path = (np.array(table[i * trees : (i + 1) * trees]) for i in range(5))
        return cls(feature.astype(np.int64), split.astype(float), left.astype(np.int64), right.astype(np.int64), path.astype(float), max(_mean_path(sample), 1e-9), most)

    def _ends(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """For each tree the nodes in which ``rows`` end."""
        if self.middle is not None:
            rows = _stretched(rows, self.middle, self.half)
        number = np.arange(len(rows))
        for t in range(len(self.feature)):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                below = rows[number, self.feature[t, at]] <= self.split[t, at]
                at = np.where(below, self.left[t, at], self.right[t, at])
            yield at

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the higher, the shorter the paths."""
        total = np.zeros(len(rows))
        for t, at in enumerate(self._ends(rows)):
            total += self.path[t, at]
        return np.round(2.0 ** (-total / len(self.feature) / self.scale), 9)


def calibrate(scores: np.ndarray, good: np.ndarray, max_good_lost: float = 0.005) -> float:
    """The threshold that best tells bad from good rows by the shares lost, losing few of the good.

    Rows at the threshold are kept. Without bad or good rows nothing is rejected.
    """
    if not len(scores) or good.all() or not good.any():
        return 1.0
    order = np.argsort(scores, kind="stable")
    scores, good = scores[order], good[order]
    good_above = good.sum() - np.cumsum(good)
    bad_above = (~good).sum() - np.cumsum(~good)
    gain = bad_above / (~good).sum() - good_above / good.sum()
    last = np.append(scores[1:] != scores[:-1], True)  # a threshold takes all rows of its score
    allowed = np.flatnonzero(last & (good_above <= max_good_lost * good.sum()))
    best = allowed[gain[allowed] == gain[allowed].max()][-1]
    return float(scores[best]) if gain[best] > 0 else 1.0


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all columns but the text, so that no name can clash) and the counts of each whole text."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("row"), F.col(text_col).cast("string").alias("text"))
    out = T.StructType([rows.schema["row"], *(T.StructField(c, T.LongType()) for c in (*COUNTS, *MORE))])
    schema = to_arrow_schema(out)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text"):
                s = statistics(A.texts_of(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("row"), *(pa.array(s[c], pa.int64()) for c in (*COUNTS, *MORE))], schema=schema)

    return rows.mapInArrow(count, out)


def _counts_in(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*COUNTS, *MORE)}


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts that pass the base rules."""
    for batch in batches:
        s = _counts_in(batch)
        passed = ~base_failed(s)
        columns = [pa.array(x) for x in features(s)[passed].T]
        yield pa.RecordBatch.from_arrays([batch.column("good").filter(pa.array(passed)), *columns], names=["good", *_FEATURES])


_FEATURES = tuple(f"x{i}" for i in range(8))
_FEATURE_FIELDS = ", ".join(["good boolean", *(f"{x} double" for x in _FEATURES)])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in _FEATURES], 1)


def usual_range(table: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each feature where ``_EDGES`` of all ``n`` rows lie, between rows by their distance."""
    if not n:
        return np.zeros(len(_FEATURES)), np.zeros(len(_FEATURES))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("x"), F.col(x).alias("value")) for i, x in enumerate(_FEATURES)])).alias("e")
    values = running(table.select(each).groupBy("e.x", "e.value").agg(F.count("*").alias("n")), ["x", "value"], ["n"])
    place = [(n - 1) * q for q in _EDGES]
    # Each feature has all rows, so its first comes behind the rows of those before it.
    ranks = {i * n + at + 1 for i in range(len(_FEATURES)) for p in place for at in (math.floor(p), math.ceil(p))}
    found = {rank: r["value"] for rank, r in at_ranks(values, "n", ranks).items()}

    def at(i: int, p: float) -> float:
        below, above = found[i * n + math.floor(p) + 1], found[i * n + math.ceil(p) + 1]
        return below + (above - below) * (p - math.floor(p))

    low, high = (np.array([at(i, p) for i in range(len(_FEATURES))]) for p in place)
    return low, high


def leaves_of(table: DataFrame, forest: Forest) -> np.ndarray:
    """``Forest.leaves`` over a whole table. A task adds up its own; one number for each leaf comes to the driver."""
    shared = table.sparkSession.sparkContext.broadcast(forest)  # bounded by the trees
    shape = len(forest.feature), 1 << forest.depth

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for batch in batches:
            total += shared.value.leaves(_matrix(batch))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total.ravel()[there], pa.int64())], names=["leaf", "n"])

    out = np.zeros(shape, np.int64)
    for r in table.select(*_FEATURES).mapInArrow(add, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect():
        out.flat[r["leaf"]] = r["n"]
    return out


def threshold_of(table: DataFrame, forest: Forest, without: Forest, max_good_lost: float = 0.005) -> float:
    """``calibrate`` over a whole table of labelled rows: rows of each score are counted, then added up from the lowest.

    Good rows, which the forest has counted, have their scores from the forest ``without`` each of them.
    """
    shared = table.sparkSession.sparkContext.broadcast((forest, without))  # bounded by the trees

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, good = _matrix(batch), batch.column("good").to_numpy(zero_copy_only=False)
            scores = np.empty(len(rows))
            scores[good], scores[~good] = shared.value[1].score(rows[good]), shared.value[0].score(rows[~good])
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(scores)], names=["good", "score"])

    good = F.col("good").cast("long")
    counted = staged(table.mapInArrow(score, "good boolean, score double").groupBy("score").agg(F.sum(good).alias("good"), F.sum(1 - good).alias("bad")))
    every = counted.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not every["good"] or not every["bad"]:
        return 1.0
    good_above, bad_above = (F.lit(every[c]) - F.col(f"{c}_upto") for c in ("good", "bad"))
    told = running(counted, ["score"], ["good", "bad"]).filter(good_above <= max_good_lost * every["good"])
    gain = bad_above / every["bad"] - good_above / every["good"]
    best = told.select("score", gain.alias("gain")).orderBy(F.desc("gain"), F.desc("score")).first()
    return best["score"] if best["gain"] > 0 else 1.0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    good_col: str = "quality",
    max_good_lost: float = 0.005,
    seed: int = 3,
) -> Forest:
    """``fit_measured`` on texts that are not measured yet."""
    return fit_measured(staged(measure(docs.select(id_col, text_col), text_col)), labels, id_col, good_col, max_good_lost, seed)


def fit_measured(
    measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality", max_good_lost: float = 0.005, seed: int = 3
) -> Forest:
    """Count all rows labelled good in the forest and set its threshold on all labelled rows.

    ``measured`` is what ``measure`` gives. If no row is labelled good, all rows count in the forest and
    nothing is rejected. Texts that fail the base rules are left out. Rows with a null id or label teach nothing;
    an id with several labels has the worst of them, and all rows of an id have its label.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), (F.col(good_col).cast("int") > 0).alias("good")).dropna()
    known = known.groupBy("id").agg(F.min("good").alias("good"))
    rows = measured.select(F.col(f"row.`{id_col}`").cast("long").alias("id"), *COUNTS, *MORE).filter("id IS NOT NULL")
    table = staged(rows.join(known, "id").drop("id").mapInArrow(_features_of, _FEATURE_FIELDS))
    of_good = table.filter("good")
    n = of_good.count()
    if not n:
        of_good = staged(rows.withColumn("good", F.lit(None).cast("boolean")).mapInArrow(_features_of, _FEATURE_FIELDS))
        n = of_good.count()
    trees = Forest.drawn(*usual_range(of_good, n), n, seed=seed)
    leaves = leaves_of(of_good, trees)
    forest = trees.settled(leaves)
    forest.threshold = threshold_of(table, forest, trees.settled(leaves, less=1), max_good_lost)
    return forest


def judge(docs: DataFrame, forest: Forest, text_col: str = "text") -> DataFrame:
    """``row`` (all columns but the text, so that no name can clash), the counts, ``base_failed``, ``anomaly``, ``kept``.

    Counts are of the whole text: words between blanks; code points in words; symbols; lines equal to
    an earlier one that hold a word; words in three-word windows that come twice. A null or empty text
    has no words and fails. ``anomaly`` is the forest's score, and a text above the threshold goes.
    Equal texts get equal answers. An empty table gives an empty result.
    """
    return judge_measured(measure(docs, text_col), forest)


def judge_measured(measured: DataFrame, forest: Forest) -> DataFrame:
    """``judge`` on what ``measure`` gives."""
    fields = [measured.schema["row"], *(T.StructField(c, T.LongType()) for c in COUNTS)]
    out = T.StructType([*fields, T.StructField("base_failed", T.BooleanType()), T.StructField("anomaly", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    schema = to_arrow_schema(out)
    shared = measured.sparkSession.sparkContext.broadcast(forest)  # bounded by the trees

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            s = _counts_in(batch)
            failed, score = base_failed(s), forest.score(features(s))
            columns = [batch.column("row"), *(batch.column(c) for c in COUNTS), pa.array(failed), pa.array(score), pa.array(~failed & (score <= forest.threshold))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return measured.mapInArrow(answer, out)
