"""A corpus from raw documents to packed token sequences, stage by stage.

Each stage takes the session, the documents its predecessor kept and the folder of tables, and returns a
DataFrame. Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontamination, jaccard, language_id, packing, suffix_dedup
from clickloom.llm.queries import byte_bpe
from clickloom.llm.shared import release, staged, tables_made
from clickloom.sources.tables import load

#: A document stays if its language has at least this share of the likelihood, and the evidence that the
#: labelled documents of that language have.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, in none of the labelled languages, or of which no language is likely, go.

    Null and empty texts have no letter. Rows that are alike share one fate, whatever their ids; a null id or
    label stays as it is. Of equally likely languages the first by name counts. Without any labelled document
    every document goes; no documents give none. All labelled documents teach the model and the evidence needed.
    """
    told = staged(language_id.predict(docs, language_id.train(docs), evidence=True))
    least = language_id.least_evidence(told)
    needed = F.coalesce(*[F.when(F.col("lang_pred") == lang, e) for lang, e in least.items()], F.lit(0.0))
    likely = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return told.filter(likely & (F.col("evidence") >= needed)).select("row.*")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, link by link, the one of the smallest id stays.

    Rows that share an id, or have none, are documents of their own and come after all others. Null, empty and
    blank texts are like no other and stay. No documents give none.
    """
    return jaccard.one_of_each(docs, words=5, percent=80)


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that come again anywhere leave the texts; a document with nothing left goes.

    A character that loses a byte goes as a whole; all others stay, U+FFFD too. ``n_chars`` is counted anew
    where a text has changed. Null texts stay null, texts below 200 bytes as they are. Equal and null ids do not
    matter; rows of equal long texts empty each other. No documents give none.
    """
    no_text = "no_text"
    while no_text in docs.columns:
        no_text += "_"
    marked = docs.withColumn(no_text, F.col("text").isNull())
    out = suffix_dedup.remove_repeated_bytes(marked, length=200, whole_characters=True)
    changed = F.col("n_removed") > 0
    kept = out.filter((F.col("n_removed") < F.col("n_units")) | (F.col("n_units") == 0))
    kept = kept.withColumn("text", F.when(~F.col(f"row.`{no_text}`"), F.col("kept").cast("string")))
    columns = {"text": F.col("text"), "n_chars": F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))}
    return kept.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with a benchmark item, or a whole shorter item, go.

    Null, empty and wordless texts share none and stay, as do all without a benchmark. Equal rows share one
    fate; ids do not matter. No documents give none.
    """
    return decontamination.clean(docs, load(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece with its place in a sequence of 2,048 tokens.

    Null and empty texts are the end token alone. Rows of equal or null id are documents of their own; ties among
    pieces of one length go by their place in the input. No documents give no row.
    """
    return packing.pack_documents(docs, byte_bpe(), capacity=2048, end_id=0)


STAGES = [
    ("language_id", known_language),
    ("near_copies", one_of_near_copies),
    ("repeated_strings", without_repeated_strings),
    ("benchmark", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express a trained model, packing and suffix order; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    since = tables_made()
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
        # What the stage has read and written on the way is not needed any more.
        release(spark, since, but=1)
    return STAGES[-1][1](spark, docs, sf_dir)
