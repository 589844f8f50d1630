"""The stages against plain versions of what they decide, and that nothing else needs this package."""

import ast
import pathlib
import subprocess
import sys
from collections import Counter

import corpus_pipeline
from clickloom.llm import jaccard, language_id, suffix_dedup
from clickloom.llm.shared import release, staged, tables_made
from clickloom.sources.tables import load

from .test_decontamination import brute as contamination
from .test_jaccard import brute as groups
from .test_repeats import bytes_left

ROOT = pathlib.Path(__file__).parents[2]


def test_stages(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_copies", "repeated_strings", "benchmark", "packing"]
    documents = load(spark, sf_dir, "documents")
    columns = documents.columns
    docs = staged(stages["language_id"](spark, documents, sf_dir))
    assert docs.columns == columns and docs.count() >= 0.98 * documents.count()

    before = {r["doc_id"]: r for r in docs.collect()}
    docs = staged(stages["near_copies"](spark, docs, sf_dir))
    found = {k[0]: k[2] for k in groups([(i, r["text"]) for i, r in before.items()], 5, 80)}
    after = {r["doc_id"]: r for r in docs.collect()}
    assert docs.columns == columns and set(after) == {i for i in before if found[i] == i}
    assert all(after[i] == before[i] for i in after)

    before = after
    docs = staged(stages["repeated_strings"](spark, docs, sf_dir))
    after = {r["doc_id"]: r for r in docs.collect()}
    left = {k[0]: k for k in bytes_left([(i, r["text"]) for i, r in before.items()], 200)}
    assert docs.columns == columns and set(after) == {i for i, k in left.items() if k[2] < k[1] or not k[1]}
    for i, r in after.items():
        assert r["text"] == left[i][4].decode("utf-8", "ignore")
        assert r["n_chars"] == (len(r["text"]) if left[i][2] else before[i]["n_chars"])

    before = after
    docs = staged(stages["benchmark"](spark, docs, sf_dir))
    items = [tuple(r) for r in load(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    hit = {k[0]: k[2] for k in contamination([(i, r["text"]) for i, r in before.items()], items, 10)}
    after = {r["doc_id"]: r for r in docs.collect()}
    assert docs.columns == columns and after == {i: r for i, r in before.items() if not hit[i]}

    pieces = stages["packing"](spark, docs, sf_dir).collect()
    assert {p["doc_id"] for p in pieces} == set(after)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted((p["doc_id"], p["piece"], p["length"], p["ids_crc32"]) for p in pieces)


def test_other_languages_go(spark, sf_dir):
    """Texts of other languages and scripts go, short or long; labelled ones stay, also if all are of one language."""
    other = ["Съешь ещё этих мягких французских булок да выпей чаю", "快速的棕色狐狸跳过懒狗", "слово", "Szybki brązowy lis przeskakuje nad leniwym psem i ucieka przez las"]
    other += [f"{t} " * 40 for t in other]
    for langs in ("lang IN ('en', 'de', 'fr', 'es')", "lang = 'en'"):
        given = load(spark, sf_dir, "documents").select("doc_id", "text", "lang").filter(langs)
        rows = [(-1 - i, t, None) for i, t in enumerate(other)]
        docs = given.unionByName(spark.createDataFrame(rows, given.schema))
        left = [r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, sf_dir).select("doc_id").collect()]
        assert min(left) >= 0 and len(left) >= 0.98 * given.count()


def test_every_labelled_document_teaches(spark, sf_dir):
    """Each of 12,000 documents has a letter of its own, so only a model of all of them knows all."""
    rows = [(i, chr(0x4E00 + i) * 2, "zh") for i in range(12_000)] + [(20_000, "Ж" * 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert len(language_id.train(docs).words) == 12_000
    left = [r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, sf_dir).collect()]
    assert sorted(left) == list(range(12_000))


def test_evidence_needed(spark):
    """Four fifths of the evidence of the last of the least hundredth, in each language by itself."""
    rows = [(f"t{i}", i, lang, lang, i / 1000) for lang, n in (("de", 700), ("en", 101), ("fr", 3)) for i in range(n)]
    rows += [("none", None, "de", "de", 0.0), ("no letter", 5, "de", "und", 0.0), ("no label", 6, None, "de", 0.0)]
    told = spark.createDataFrame([((i, lang), pred, e) for _, i, lang, pred, e in rows], "row struct<doc_id:long,lang:string>, lang_pred string, evidence double")
    least = language_id.least_evidence(told.repartition(5))
    assert {lang: round(e / 0.8, 6) for lang, e in least.items()} == {"de": 0.006, "en": 0.001, "fr": 0.0}
    assert language_id.least_evidence(told.limit(0)) == {}


STAGED = "doc_id long, text string, lang string, source string, n_chars long, row string, score string"


def as_documents(messy):
    return messy.selectExpr("doc_id", "text", "lang", "part AS source", "doc_id AS n_chars", "row", "score")


def rows(df):
    return sorted(map(str, df.collect()))


def test_no_documents(spark, nothing, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, as_documents(nothing), sf_dir).collect() == []


def test_messy_rows_by_language(spark, messy, sf_dir):
    docs = as_documents(messy)
    kept = corpus_pipeline.known_language(spark, docs, sf_dir)
    assert kept.columns == docs.columns and set(rows(kept)) <= set(rows(docs))
    texts = {r["text"] for r in kept.collect()}
    assert None not in texts and "" not in texts and "1 2 3 # $ %" not in texts
    assert len({t for t in texts if t.startswith("w")}) >= 6
    # Equal texts go or stay together.
    assert all(r["text"] not in texts or str(r) in rows(kept) for r in docs.collect())
    unlabelled = docs.withColumn("lang", docs["lang"].substr(0, 0)).selectExpr(*[c if c != "lang" else "CAST(NULL AS STRING) AS lang" for c in docs.columns])
    assert corpus_pipeline.known_language(spark, unlabelled, sf_dir).collect() == []


def test_messy_rows_by_copies(spark, messy, sf_dir):
    """One row of each group, whether its id is shared, missing or its own."""
    docs = as_documents(messy)
    given = docs.collect()
    numbers = [i if i is not None and sum(r["doc_id"] == i for r in given) == 1 else 10**9 + k for k, i in enumerate(r["doc_id"] for r in given)]
    found = {k[0]: k[2] for k in groups([(n, r["text"]) for n, r in zip(numbers, given, strict=True)], 5, 80)}
    kept = corpus_pipeline.one_of_near_copies(spark, docs, sf_dir)
    # Rows without an id of their own come last in any order, so groups of such rows alone are compared by their texts.
    want = sorted(str(r["text"]) for n, r in zip(numbers, given, strict=True) if found[n] == n)
    assert sorted(str(r["text"]) for r in kept.collect()) == want and set(rows(kept)) <= set(rows(docs))
    own = {str(r) for n, r in zip(numbers, given, strict=True) if n < 10**9 and found[n] == n}
    assert own <= set(rows(kept))


def test_messy_rows_without_repeats(spark, messy, sf_dir):
    docs = as_documents(messy)
    kept = corpus_pipeline.without_repeated_strings(spark, docs, sf_dir)
    given = docs.collect()
    left = {k[0]: k for k in bytes_left(list(enumerate(r["text"] for r in given)), 200)}
    want = []
    for i, r in enumerate(given):
        k = left[i]
        if k[2] < k[1] or not k[1]:
            text = None if r["text"] is None else k[4].decode("utf-8", "ignore")
            want.append(r.asDict() | {"text": text, "n_chars": len(text) if k[2] else r["n_chars"]})
    assert kept.columns == docs.columns
    assert sorted(str(r.asDict()) for r in kept.collect()) == sorted(map(str, want))


def test_characters_survive_cuts(spark, sf_dir):
    """U+FFFD of the source stays, and of a character that a cut goes through nothing stays."""
    passage = "é" * 150
    texts = ["A\ufffdB x" + passage + "\u0129 tail \ufffd", "other " + passage + "\u012a end", None, "\ufffd"]
    docs = spark.createDataFrame([(i, t, None, None, 7) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.without_repeated_strings(spark, docs, sf_dir).collect()}
    assert kept == {0: ("A\ufffdB x tail \ufffd", 12), 1: ("other  end", 10), 2: (None, 7), 3: ("\ufffd", 7)}


def test_messy_rows_without_benchmark(spark, messy, sf_dir):
    docs = as_documents(messy)
    items = load(spark, sf_dir, "benchmark").select("item_id", "text")
    some = [tuple(r) for r in items.collect()]
    hit = [(9_001, some[0][1]), (None, "and then " + some[1][1]), (None, "and then " + some[1][1])]
    docs = docs.unionByName(spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in hit], STAGED))
    given = docs.collect()
    by_text = {k[0]: k[2] for k in contamination([(k, r["text"] if len(r["text"] or "") < 20_000 else "") for k, r in enumerate(given)], some, 10)}
    kept = corpus_pipeline.without_benchmark(spark, docs, sf_dir)
    assert sum(map(bool, by_text.values())) >= 3
    assert rows(kept) == sorted(str(r) for k, r in enumerate(given) if not by_text[k])


def test_messy_rows_packed(spark, messy, sf_dir):
    docs = as_documents(messy)
    pieces = corpus_pipeline.packed(spark, docs, sf_dir).collect()
    assert Counter(p["doc_id"] for p in pieces if p["piece"] == 0) == Counter(r["doc_id"] for r in docs.collect())
    filled = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == filled.get(p["sequence_id"], 0)
        filled[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(filled.values()) <= 2048


def test_tables_between_stages_go(spark, sf_dir):
    since = tables_made()
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0
    release(spark, since)
    assert tables_made() == since


def test_nothing_else_imports_this_package():
    for path in [*ROOT.glob("clickloom/**/*.py"), *ROOT.glob("tests/*.py"), ROOT / "oracles.py", ROOT / "bench.py"]:
        if "llm" not in path.relative_to(ROOT).parts:
            names = [n.module or "" for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.ImportFrom)]
            names += [a.name for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.Import) for a in n.names]
            assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names), path


def test_the_rest_works_without_this_package(tmp_path):
    """The entry file in a copy of the repository that lacks the package and the pipeline."""
    for name in ("__spark_entry__.py", "oracles.py"):
        (tmp_path / name).write_text((ROOT / name).read_text())
    (tmp_path / "clickloom").mkdir()
    for path in (ROOT / "clickloom").iterdir():
        if path.name not in ("llm", "__pycache__"):
            (tmp_path / "clickloom" / path.name).symlink_to(path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'word_count' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_defaults():
    assert suffix_dedup.SuffixAnchors().length == 200 and jaccard.similar_groups.__defaults__ == ("doc_id", "text", 5, 80)
