"""Language identification, words first.

A word that the model knows counts by its log frequency in each language. One that it does not know
counts by its character n-grams: the longest that the model knows any of, then shorter ones. The edge of a
word is no n-gram by itself, as every word has it.

The likelihoods only tell the known languages from each other. Whether a text is in one of them at all is
told by its evidence: the share of its letters in known words, or in words as far as their n-grams of three
characters are known.

A task scores the words of many texts at once, as arrays of code points and of 64-bit hashes.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm import arrays as A
from clickloom.llm.shared import at_ranks, running, staged

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
#: Letters of the longest words that are known as such; longer ones count by their n-grams.
WORD_LETTERS = 64
#: Bytes of text in one step, which bounds a worker's memory.
STEP_BYTES = 1 << 20
#: Tasks that count the n-grams of the different words.
_COUNTING = 32
#: Parts of a language's words and n-grams whose most frequent ones are found by themselves.
_PARTS = 64
_EDGES = (ord("^"), ord("$"))


def words_in(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def ngrams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its edges marked; those of one character without."""
    if n == 1:
        return list(word)
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether words are made of it."""
    table = np.zeros(sys.maxunicode + 1, bool)
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    for found in _WORD.finditer(every):
        table[[ord(c) for c in found.group()]] = True
    return table


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span of code points."""
    data = np.concatenate((codes, np.zeros(8, "<u4"))).view(np.uint8)
    return A.hash_spans(data, 4 * start, 4 * end)


def _gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive code points, by the first."""
    return A.mix(A.rolling(A.mix(codes.astype(np.uint64) + A.U(1)), n) + A.U(n))


def _sorted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes)
    return hashes[order], order


def _find(known: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """The row of each hash, -1 if there is none."""
    keys, rows = known
    if not len(keys):
        return np.full(len(hashes), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, rows[at], -1)


@dataclass
class Model:
    """Log frequencies by language, of words and, for each length, of n-grams; both are found by their hashes."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]  # of all lengths, the key's length tells
    gram_scores: np.ndarray
    longest: int

    @classmethod
    def of(cls, words: dict[str, dict[str, int]], grams: dict[str, dict[str, int]], docs: dict[str, int], longest: int) -> Model:
        """``words`` and ``grams``: counts by language; ``docs``: labelled documents of each language."""
        languages = sorted(docs)
        column = {lang: i for i, lang in enumerate(languages)}

        def table(counts: dict[str, dict[str, int]], names: list[str]) -> np.ndarray:
            out = np.zeros((len(names), len(languages)))
            for i, name in enumerate(names):
                for lang, n in counts[name].items():
                    out[i, column[lang]] = n
            return out

        kept_words, kept = sorted(words), sorted(grams)
        gram_counts = table(grams, kept)
        scores = np.zeros_like(gram_counts)
        for n in range(1, longest + 1):  # frequencies among n-grams of one length
            same = np.array([len(g) == n for g in kept], bool)
            scores[same] = _log_frequency(gram_counts[same])
        total = sum(docs.values())
        prior = np.array([math.log(docs[lang] / total) for lang in languages])
        numbered = ({w: i for i, w in enumerate(names)} for names in (kept_words, kept))
        return cls(languages, prior, next(numbered), _log_frequency(table(words, kept_words)), next(numbered), scores, longest)

    def __post_init__(self) -> None:
        names = list(self.words)
        size = np.array([len(w) for w in names], np.int64)
        end = np.cumsum(size)
        self.known_words = _sorted(_hashes(_codes("".join(names)), end - size, end))
        self.known_grams = {}
        for n in range(1, self.longest + 1):
            same = [g for g in self.grams if len(g) == n]
            keys, order = _sorted(_gram_hashes(_codes("".join(same)), n)[::n])
            self.known_grams[n] = keys, np.array([self.grams[g] for g in same], np.int64)[order]

    def __getstate__(self) -> dict:
        return {name: getattr(self, name) for name in self.__dataclass_fields__}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def _unseen(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, evidence: bool) -> tuple[np.ndarray, np.ndarray]:
        """For each of the words, which are not known, its scores and its letters with evidence."""
        size = end - start
        first = np.cumsum(size + 2) - size - 2  # of each word with its edges
        padded = np.empty(int((size + 2).sum()), np.uint32)
        of = np.repeat(np.arange(len(size)), size + 2)
        inside = np.arange(len(padded)) - first[of] - 1
        letter = (inside >= 0) & (inside < size[of])
        padded[letter] = codes[start[of[letter]] + inside[letter]]
        padded[inside < 0], padded[inside == size[of]] = _EDGES
        scores, told = np.zeros((len(size), len(self.languages))), np.zeros(len(size))
        left = np.ones(len(size), bool)
        for n in range(self.longest, 0, -1):
            key = _gram_hashes(padded, n)
            place = inside[: len(key)]
            # Within one word; n-grams of one character are letters.
            whole = (place + n <= size[of[: len(key)]] + 1) & ((place >= 0) & letter[: len(key)] if n == 1 else True)
            counted = evidence and n == min(3, self.longest)
            if not counted:
                if not left.any():
                    break
                whole &= left[of[: len(key)]]
            which, row = of[: len(key)][whole], _find(self.known_grams[n], key[whole])
            which, row = which[row >= 0], row[row >= 0]
            found = np.bincount(which, minlength=len(size))
            if counted:
                every = size if n == 1 else np.maximum(size + 3 - n, 0)
                told = size * found / np.maximum(every, 1)
            use = left & (found > 0)
            at = use[which]
            for i in range(len(self.languages)):
                mean = np.bincount(which[at], self.gram_scores[row[at], i], len(size))
                scores[use, i] = mean[use] / found[use]
            left &= ~use
        return scores, told

    def predict(self, texts: list[str | None], evidence: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The most likely language of each text, its share of the likelihood, and the evidence if asked for."""
        none = np.zeros(len(texts))
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), none, none
        lowered = [(t or "").lower() for t in texts]
        codes = _codes("\n".join([*lowered, ""]))
        inside = np.concatenate(([False], _letters()[codes], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[::2], edge[1::2]
        until = np.cumsum([len(t) + 1 for t in lowered])
        text = np.searchsorted(until, start, "right")
        letters = np.bincount(text, end - start, len(texts))
        key = _hashes(codes, start, end)
        row = _find(self.known_words, key)
        new = np.flatnonzero(row < 0)
        _, one, which = np.unique(key[new], return_index=True, return_inverse=True)
        scores, told = self._unseen(codes, start[new[one]], end[new[one]], evidence)
        row[new] = len(self.word_scores) + which
        every = np.concatenate((self.word_scores, scores))
        likelihood = self.prior + np.stack([np.bincount(text, every[row, i], len(texts)) for i in range(len(self.languages))], 1)
        best = likelihood.argmax(1)
        has = letters > 0
        share = np.where(has, np.round(1 / np.exp(likelihood - likelihood.max(1, keepdims=True)).sum(1), 6), 0.0)
        if evidence:
            counted = (end - start).astype(float)
            counted[new] = told[which]
            none = np.round(np.bincount(text, counted, len(texts)) / np.maximum(letters, 1), 6)
        return [self.languages[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)], share, none


def _log_frequency(table: np.ndarray, more: float = 0.5) -> np.ndarray:
    if not len(table):
        return table
    return np.log((table + more) / (table.sum(0) + more * len(table)))


_COUNTS = "n int, key string, lang string, count long"


def _flush(counts: Counter) -> pa.RecordBatch:
    kinds, keys, langs = zip(*counts, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.string()), pa.array(langs, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["n", "key", "lang", "count"])


def _count_words(longest: int):
    """Words (``n`` 0) of all texts with their languages and numbers, of those above ``WORD_LETTERS`` the n-grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)

        def told() -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            for lang, of_lang in words.items():
                for word, times in of_lang.items():
                    if len(word) <= WORD_LETTERS:
                        counts[0, word, lang] = times
                    else:
                        for n in range(1, longest + 1):
                            for gram in ngrams(word, n):
                                counts[n, gram, lang] += times
                    if len(counts) > 100_000:
                        yield _flush(counts)
                        counts.clear()
            if counts:
                yield _flush(counts)
            words.clear()

        for batch in batches:
            for part in A.slices(batch, "text", STEP_BYTES):
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
                    words[lang].update(words_in(text or ""))
                if sum(map(len, words.values())) > 50_000:
                    yield from told()
        yield from told()

    return count


def _count_ngrams(longest: int):
    """N-grams of counted words, with their languages and numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for word, lang, times in zip(*(batch.column(c).to_pylist() for c in ("key", "lang", "count")), strict=True):
                for n in range(1, longest + 1):
                    for gram in ngrams(word, n):
                        counts[n, gram, lang] += times
                if len(counts) > 100_000:
                    yield _flush(counts)
                    counts.clear()
        if counts:
            yield _flush(counts)

    return count


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, dict[str, int]]:
    """``id``, ``text`` and ``lang`` of all labelled documents, and how many there are of each language.

    Rows with a null id or language are none; each of equal rows is one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("id IS NOT NULL AND lang IS NOT NULL")
    return rows, {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}


def labelled_sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 10_000
) -> tuple[DataFrame, dict[str, int]]:
    """``id``, ``text`` and ``lang`` of at most ``max_docs`` labelled documents, and how many there are of each of their languages.

    Each language gives as many as any other, or all it has: those of the smallest hashes of id and text.
    Rows with a null id or language are none; equal rows count once in the sample, and each in the numbers.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("id IS NOT NULL AND lang IS NOT NULL").withColumn("h", F.xxhash64("id", "text"))
    per_language = rows.groupBy("lang").agg(F.count("*").alias("all"), F.approx_count_distinct("h").alias("different"))
    # A cut in the space of hashes first, so that no language's rows are all sorted.
    share = F.least(F.lit(1.0), 4.0 * max_docs / F.col("different"))
    place = F.pmod("h", F.lit(1 << 40))
    slim = rows.select("id", "h", "lang").join(F.broadcast(per_language), "lang").filter(place < (share * (1 << 40)).cast("long"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(place, "h", "id"))
    ranked = slim.select("id", "h", "lang", "all").distinct().withColumn("nth", nth).filter(F.col("nth") <= max_docs)
    chosen = ranked.orderBy("nth", "lang").limit(max_docs).select("id", "h", "lang", "all")
    sample = staged(rows.join(F.broadcast(chosen), ["id", "h", "lang"]).dropDuplicates(["id", "h", "lang"]))
    return sample.select("id", "text", "lang").repartition(_COUNTING), {r["lang"]: r["all"] for r in sample.select("lang", "all").distinct().collect()}


def least_evidence(told: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", part: float = 0.8) -> dict[str, float]:
    """For each language the evidence that a text needs: ``part`` of what 99 % of its labelled documents have.

    ``told`` is what ``predict`` gives, with evidence, of all documents. Those with a null id or language or without a
    letter, with a null or empty text, do not count. A language without any other has no limit. Of 1 % of the documents,
    rounded up, the last one by its evidence tells; it is found among all.
    """
    lang = F.col(f"row.`{lang_col}`").cast("string").alias("lang")
    known = told.filter(F.col(f"row.`{id_col}`").isNotNull() & (F.col("lang_pred") != UNKNOWN)).select(lang, "evidence").dropna()
    counted = staged(known.groupBy("lang", "evidence").agg(F.count("*").alias("n")))
    documents = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    ranks, before = {}, 0
    for name in sorted(documents):  # Spark's order too
        ranks[name] = before - (-documents[name] // 100)
        before += documents[name]
    if not ranks:
        return {}
    found = at_ranks(running(counted, ["lang", "evidence"], ["n"]), "n", ranks.values())
    return {name: part * found[rank]["evidence"] for name, rank in ranks.items()}


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int | None = None, **kept: int
) -> Model:
    """``fit`` on all labelled documents or, if asked for, on a sample of at most ``max_docs``, see ``labelled_sample``."""
    if max_docs is None:
        return fit(*labelled(docs, id_col, text_col, lang_col), **kept)
    return fit(*labelled_sample(docs, id_col, text_col, lang_col, max_docs), **kept)


def fit(rows: DataFrame, all_docs: dict[str, int], max_words: int = 30_000, max_ngrams: int = 60_000, longest: int = 4) -> Model:
    """Fit a model on labelled documents.

    Words and n-grams of up to ``longest`` characters are counted over all ``rows``, n-grams in words of
    any length; words of over ``WORD_LETTERS`` letters are known by their n-grams only. Each language keeps
    its most frequent ones, ``max_words`` and ``max_ngrams`` over all languages, which bounds what is sent
    to the tasks; ties go to the smaller string. ``all_docs`` tells how likely each language is beforehand.
    Null and empty texts teach nothing. Without any row the model answers ``und``.
    """
    keys, total = ["n", "key", "lang"], F.sum("count").alias("count")
    words = staged(rows.select("text", "lang").mapInArrow(_count_words(longest), _COUNTS).groupBy(*keys).agg(total))
    # Of each different word once, by its number.
    grams = words.filter("n = 0").repartition(_COUNTING).mapInArrow(_count_ngrams(longest), _COUNTS)
    sums = staged(words.unionByName(grams).groupBy(*keys).agg(total))
    is_word = F.col("n") == 0
    most = F.when(is_word, max_words // max(len(all_docs), 1)).otherwise(max_ngrams // max(len(all_docs), 1))

    def first(counts: DataFrame, *by: Column) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy("lang", is_word, *by).orderBy(F.desc("count"), "key"))
        return counts.withColumn("nth", nth).filter(F.col("nth") <= most).drop("nth")

    # The most frequent ones of a language are among those of its parts, so no task has all of them.
    kept = first(first(sums, F.pmod(F.xxhash64("key"), F.lit(_PARTS)))).select("n", "key").distinct()
    by_key = sums.join(kept, ["n", "key"], "left_semi").groupBy("n", "key").agg(F.map_from_entries(F.collect_list(F.struct("lang", "count"))).alias("by_lang"))
    by_word, by_gram = {}, {}
    for r in by_key.toLocalIterator():  # no more rows than max_words and max_ngrams
        (by_gram if r["n"] else by_word)[r["key"]] = r["by_lang"]
    return Model.of(by_word, by_gram, all_docs, longest)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", evidence: bool = False) -> DataFrame:
    """``row`` (all columns of ``docs``, so that no name can clash), ``lang_pred``, ``score`` and ``evidence`` of each whole text.

    ``score`` is the language's share of the likelihood among the known languages, ``evidence`` the share
    of letters in words or n-grams that are known, 0 unless it is asked for. A text that is null, empty or without a letter is
    ``und`` with score and evidence 0. Ties go to the first language by name. Words of texts of any length count.
    Only the text is looked at; equal texts get equal answers. An empty table gives an empty result.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words and max_ngrams
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    at = docs.columns.index(text_col)
    out = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("evidence", T.DoubleType())])
    schema = to_arrow_schema(out)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            # The text is in the row; it is not sent twice.
            text = pc.struct_field(batch.column("row"), [at]).cast(pa.string())
            batch = pa.RecordBatch.from_arrays([batch.column("row"), text], names=["row", "text"])
            for part in A.slices(batch, "text", STEP_BYTES):
                languages, scores, evident = model.predict(part.column("text").to_pylist(), evidence)
                told = [pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(evident, pa.float64())]
                yield pa.RecordBatch.from_arrays([part.column("row"), *told], schema=schema)

    return rows.mapInArrow(answer, out)
