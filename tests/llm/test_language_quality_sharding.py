"""Held-out accuracy, counts against brute force, and the laws of a sharding."""

import pickle
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import arrays as A
from clickloom.llm import language_id, quality, sharding
from clickloom.llm.queries import op1_language_id
from clickloom.llm.shared import at_ranks, running, shared_folder
from clickloom.sources.tables import load

from .conftest import CLASHING


def test_held_out_accuracy(spark, sf_dir):
    told = op1_language_id(spark, sf_dir).join(load(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    held_out = told[told.held_out]
    assert len(held_out) > 20 and (held_out.lang == held_out.lang_pred).mean() >= 0.97
    assert told.score.between(0, 1).all()


@pytest.fixture(scope="module")
def model(spark):
    said = {"en": "the cat and the dog", "de": "die katze und der hund", "fr": "le chat et le chien"}
    rows = [(i, t, lang) for i, (lang, t) in enumerate(said.items())] + [(9, "ignored words", None), (None, "ignored", "xx")]
    return language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def plain_score(model, word):
    """Word first, then the longest n-grams of which any is known."""
    if word in model.words:
        return model.word_scores[model.words[word]]
    for n in range(model.longest, 0, -1):
        found = [model.grams[g] for g in language_id.ngrams(word, n) if g in model.grams]
        if found:
            return model.gram_scores[found].mean(0)
    return np.zeros(len(model.languages))


def plain_predict(model, text):
    words = language_id.words_in(text or "")
    if not words:
        return "und", 0.0, 0.0
    likelihood = model.prior + sum(plain_score(model, w) for w in words)
    three = [language_id.ngrams(w, 3) for w in words]
    told = sum(len(w) * (1.0 if w in model.words else sum(g in model.grams for g in t) / len(t)) for w, t in zip(words, three, strict=True))
    best = int(likelihood.argmax())
    return model.languages[best], 1 / np.exp(likelihood - likelihood[best]).sum(), told / sum(map(len, words))


def same_answers(model, texts):
    languages, scores, evidence = model.predict(texts, evidence=True)
    for text, lang, score, told in zip(texts, languages, scores, evidence, strict=True):
        want = plain_predict(model, text)
        assert lang == want[0] and abs(score - want[1]) < 2e-6 and abs(told - want[2]) < 2e-6, text


def test_backoff(model):
    assert model.languages == ["de", "en", "fr"]
    assert model.predict(["Der Hund!", "le chien", "THE DOG", "123 ...", "", None])[0] == ["de", "fr", "en", "und", "und", "und"]
    same_answers(model, ["hund", "hunde", "zzuzz", "ßß qq", "a", "the unthedogly katze", "x" * 200, "Ωμέγα 東京 \U0001f600 é", "", None, "1 _ 2", "\u0130stanbul"])
    assert pickle.loads(pickle.dumps(model)).predict(["der hund"])[0] == ["de"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text("thedogcaundßé1_ .\n東Ⅷ²\u0301", max_size=30), min_size=1, max_size=5))
def test_predictions_by_brute_force(model, texts):
    same_answers(model, texts)


def test_given_texts_by_brute_force(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    small = language_id.train(docs, max_docs=60, max_words=200, max_ngrams=800)
    assert len(small.words) <= 200 and len(small.grams) <= 800
    same_answers(small, [r["text"] for r in docs.limit(120).collect()])


def test_counts_of_the_sample(spark):
    """All n-grams of all words of the sample count, also those of long words; equal rows count once."""
    long = "ab" * 300
    rows = [(1, "one two one", "en"), (2, long, "xx"), (3, "drei", "de")] + [(1, "one two one", "en")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(model.words) == {"one", "two", "drei"}
    assert {"abab", "ei$", "^tw"} <= set(model.grams) and np.allclose(np.exp(model.prior), [1 / 4, 2 / 4, 1 / 4])
    assert model.predict([long, "drei", "one"])[0] == ["xx", "de", "en"]


def test_rare_languages_are_known(spark):
    """As many documents of each language, however rare it is, and the most frequent words of each."""
    rng = np.random.default_rng(1)
    words = {"en": "the dog and cat", "fi": "kissa koira talo", "hu": "kutya macska haz"}
    rows = [(i, " ".join(rng.choice(words[lang].split(), 6)) + f" n{i}", lang) for i, lang in enumerate(["en"] * 3000 + ["fi"] * 12 + ["hu"] * 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    sample, _ = language_id.labelled_sample(docs, max_docs=60)
    assert Counter(r["lang"] for r in sample.collect()) == {"en": 41, "fi": 12, "hu": 7}
    model = language_id.train(docs, max_docs=60, max_words=30)
    assert model.predict(["koira kissa talo " * 4, "macska haz kutya " * 4, "the dog", "kissan talossa koiran " * 4])[0] == ["fi", "hu", "en", "fi"]
    assert np.allclose(np.exp(model.prior), [3000 / 3019, 12 / 3019, 7 / 3019])


def test_one_row_a_third_of_all(spark):
    rows = [(1, "same text", "en")] * 500 + [(i, f"texte {i}", "fr") for i in range(2, 1000)]
    sample, all_rows = language_id.labelled_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_docs=100)
    assert Counter(r["lang"] for r in sample.collect()) == {"en": 1, "fr": 99}
    assert all_rows == {"en": 500, "fr": 998}


def test_predict_messy_rows(messy, nothing, model):
    told = language_id.predict(messy, model)
    assert Counter(map(tuple, told.select("row.*").collect())) == Counter(map(tuple, messy.collect()))
    assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["row"]["text"] or "")) for r in told.collect())
    assert language_id.predict(nothing, model).collect() == []
    untaught = language_id.train(nothing)
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(messy, untaught).collect()} == {("und", 0.0)}


def counts(text):
    w = [x.decode() for x in (text or "").encode().split()]
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    three = list(zip(w, w[1:], w[2:], strict=False))
    times, hit = Counter(three), [False] * len(w)
    for i, t in enumerate(three):
        if times[t] > 1:
            hit[i : i + 3] = [True] * 3
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, sum(hit)


line = st.text("ab# \té", max_size=6)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.lists(line, max_size=8).map("\n".join), min_size=1, max_size=4))
def test_counts(strings):
    s = quality.statistics(A.texts_of(strings))
    assert list(zip(*(s[c].tolist() for c in quality.COUNTS), strict=True)) == [counts(t) for t in strings]


def test_judge_messy_rows(spark, messy, nothing):
    labels = messy.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("quality")).unionByName(spark.createDataFrame([(5, None), (None, 1)], "doc_id long, quality int"))
    forest = quality.fit(messy, labels)
    found = quality.judge(messy, forest)
    texts = Counter(counts(r["text"]) for r in messy.collect())
    assert Counter(tuple(r[c] for c in quality.COUNTS) for r in found.collect()) == texts
    for r in found.collect():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["anomaly"] <= forest.threshold) and 0 <= r["anomaly"] <= 1
    others = [c for c in messy.columns if c != "text"]
    assert Counter(map(tuple, found.select("row.*").collect())) == Counter(map(tuple, messy.select(*others).collect()))
    assert quality.judge(nothing, forest).collect() == []
    blank = quality.fit(nothing, labels.limit(0))
    assert blank.threshold == 1.0 and quality.judge(messy, blank).count() == messy.count()


def test_forest_finds_what_is_unusual():
    random = np.random.default_rng(0)
    usual, odd = random.normal(0, 1, (2000, 8)), random.normal(7, 1, (40, 8))
    forest = quality.Forest.grow(np.concatenate((usual, odd)))
    scores = forest.score(np.concatenate((usual, odd)))
    assert scores[-40:].min() > np.quantile(scores[:2000], 0.99)
    threshold = quality.calibrate(scores, np.arange(2040) < 2000)
    assert (scores[:2000] <= threshold).mean() >= 0.995 and (scores[-40:] > threshold).mean() > 0.9
    one = forest.score(usual[:1])[0]
    assert one == scores[0]


def test_given_labels_held_out(spark, sf_dir):
    """Learned on half of the labels, most of the bad rows of the other half that pass the base rules go, and few good ones."""
    docs, labels = load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "labels")
    half = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    forest = quality.fit(docs, labels.filter(half))
    told = quality.judge(docs, forest).select("row.doc_id", "base_failed", "kept").join(labels.filter(~half), "doc_id").toPandas()
    told = told[~told.base_failed]
    bad, good = told[told.quality == 0], told[told.quality == 1]
    assert len(bad) and (~bad.kept.astype(bool)).mean() >= 0.9
    assert (~good.kept.astype(bool)).mean() <= 0.05


def test_every_label_counts(spark, sf_dir):
    """Range, trees and threshold are those of all labelled rows, however many more labels there are."""
    docs, labels = load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "labels").select("doc_id", "quality")
    more = spark.range(10**7, 10**7 + 40_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    forest = quality.fit(docs, labels.unionByName(more))
    told = docs.join(labels, "doc_id").toPandas()
    s = quality.statistics(A.texts_of(told.text.tolist()))
    passed = ~quality.base_failed(s)
    rows, good = quality.features(s)[passed], (told.quality > 0).to_numpy()[passed]
    assert 0 < good.sum() < len(good)
    brute = quality.Forest.of_good(rows[good])
    assert np.allclose(forest.middle, brute.middle) and np.allclose(forest.half, brute.half)
    assert np.allclose(forest.score(rows), brute.score(rows), atol=1e-6)
    # A good row is scored by what the others make of the trees.
    trees = quality.Forest.drawn(*np.quantile(rows[good], quality._EDGES, axis=0), int(good.sum()))
    leaves = trees.leaves(rows[good])
    scores = brute.score(rows)
    scores[good] = [trees.settled(leaves, less=1).score(r[None])[0] for r in rows[good]]
    assert abs(forest.threshold - quality.calibrate(scores, good)) < 1e-6
    assert leaves.sum() == 100 * good.sum()


def test_running_totals(spark):
    """Sums over ranges and the rows at ranks, against plain sums."""
    rng = np.random.default_rng(2)
    rows = [(int(k), float(v), int(n)) for k, v, n in zip(rng.integers(0, 3, 500), rng.permutation(500), rng.integers(1, 9, 500), strict=True)]
    told = running(spark.createDataFrame(rows, "k long, v double, n long").repartition(7), ["k", "v"], ["n"])
    in_order = sorted(rows)
    upto = np.cumsum([r[2] for r in in_order])
    assert [tuple(r) for r in told.orderBy("k", "v").collect()] == [(*r, u) for r, u in zip(in_order, upto.tolist(), strict=True)]
    ranks = [1, 2, 900, int(upto[-1])]
    assert {r: tuple(row)[:3] for r, row in at_ranks(told, "n", ranks).items()} == {r: in_order[int(np.searchsorted(upto, r))] for r in ranks}
    assert at_ranks(told, "n", []) == {}


def test_forest_of_good_rows():
    """Bad rows in a cluster as large as the good, apart by a feature that all good rows share."""
    random = np.random.default_rng(0)
    good, bad = random.normal(0, 1, (1000, 8)), random.normal(0, 1, (1000, 8))
    good[:, 1], bad[:, 1] = 0.0, 0.5
    forest = quality.Forest.of_good(good[:500])
    threshold = np.quantile(forest.score(good[500:]), 0.98)
    assert (forest.score(bad) > threshold).mean() >= 0.95


def test_calibration():
    assert quality.calibrate(np.array([]), np.array([], bool)) == 1.0
    assert quality.calibrate(np.array([0.4, 0.6]), np.array([True, True])) == 1.0
    assert quality.calibrate(np.array([0.4, 0.5, 0.6, 0.7]), np.array([True, True, False, False])) == 0.5
    assert quality.calibrate(np.array([0.7, 0.6, 0.2]), np.array([True, True, False])) == 1.0


@pytest.mark.parametrize("shards", [1, 8, 100])
def test_shards_of_messy_rows(spark, messy, shards):
    folder = shared_folder(spark)
    sharding.write_shards(messy, folder, shards)
    found = sharding.read_shards(spark, folder, messy).collect()
    assert Counter(tuple(r["row"]) for r in found) == Counter(map(tuple, messy.collect()))
    sizes = Counter(r["shard"] for r in found)
    full = [sizes[s] for s in range(shards)]
    assert max(full) - min(full) <= 1 and sum(full) == messy.count()
    for s in range(shards):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sizes[s]))
    assert set(CLASHING) < set(found[0]["row"].asDict())


def test_shards_depend_on_the_seed_alone(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")

    def order(df, seed):
        folder = shared_folder(spark)
        sharding.write_shards(df, folder, 8, seed)
        rows = sharding.read_shards(spark, folder, df).select("row.doc_id", "shard", "slot").collect()
        return {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}

    first = order(docs, 1)
    assert order(docs.repartition(7), 1) == first
    other = order(docs, 2)
    moved = sum(first[d] != other[d] for d in first)
    assert moved > 0.9 * len(first)
    together = sum(first[d][0] == other[d][0] for d in first) / len(first)
    assert 0.05 < together < 0.25  # an eighth by chance


def test_no_rows(spark, nothing):
    folder = shared_folder(spark)
    sharding.write_shards(nothing, folder)
    assert sharding.read_shards(spark, folder, nothing).collect() == []


def test_fisher_yates():
    orders = Counter(tuple(sharding.fisher_yates(3, seed, 5)) for seed in range(6000))
    assert len(orders) == 6 and min(orders.values()) > 850
    assert sharding.fisher_yates(0, 1, 1).tolist() == []


def test_equal_rows_are_scattered(spark, monkeypatch):
    """Half a table of equal rows fills all buckets alike, and every row is written once."""
    monkeypatch.setattr(sharding, "MANY_EQUAL", 100)
    rows = [(7, "same text")] * 3_000 + [(None, None)] * 500 + [(i, f"text {i}") for i in range(2_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder, seen = shared_folder(spark), []
    real = sharding.staged
    monkeypatch.setattr(sharding, "staged", lambda df, *by: seen.append(real(df, *by)) or seen[-1])
    monkeypatch.setattr(sharding, "release", lambda *a, **k: None)
    sharding.write_shards(docs, folder, 8)
    sizes = [r["count"] for r in seen[-1].groupBy("bucket").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 1.5 * min(sizes)
    out = sharding.read_shards(spark, folder, docs)
    assert Counter((r["doc_id"], r["text"]) for r in out.select("row.*").collect()) == Counter(rows)
    assert sorted((r["shard"], r["slot"]) for r in out.collect()) == [(s, k) for s in range(8) for k in range(750)]


def test_types_of_the_contract(spark, sf_dir):
    """Columns and types that each query promises."""
    from clickloom.llm.queries import QUERIES

    want = {
        "op1": "doc_id long, held_out boolean, lang_pred string, score double",
        "op2": "doc_id long, n_words long, n_removed long, kept_sha256 string",
        "op3": "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
        "op4": "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
        "op5": "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        "op6": "doc_id long, n_shingles long, component_id long",
        "op7": "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean",
        "op8": "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int",
        "op9": "doc_id long, start long, n_tokens long, ids_crc32 long",
        "op10": "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        "op11": "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string",
        "op12": "doc_id long, n_features long, weight long, score long, rank long",
        "op13": "query_id long, rank int, vec_id long, score double",
    }
    plain = {"long": "bigint"}
    for name, query in QUERIES.items():
        types = dict(query(spark, sf_dir).dtypes)
        for column in want[name.split("_")[0]].split(", "):
            c, kind = column.split()
            assert types[c] == plain.get(kind, kind), (name, c)
