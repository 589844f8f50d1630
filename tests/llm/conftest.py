import random

import pytest
from pyspark.sql import types as T

#: Columns that bear the names of columns which operators add or use inside.
CLASHING = ["row", "kind", "dest", "kept", "n_removed", "score", "lang_pred", "shard", "slot", "part", "doc", "component_id", "n_hit"]

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)


def sentence(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def messy_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and ids, copies and parts."""
    rng = random.Random(5)
    base = [sentence(rng, n) for n in (3, 49, 50, 51, 120, 300, 700)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[4]), (21, base[4]), (21, base[4]), (22, "x " + base[5]), (22, sentence(rng, 80) + "\n" + base[6][:900] + " end")]
    rows += [(30, ""), (31, None), (32, " \t\n\x0b\x0c\r "), (None, base[5]), (None, None), (None, "näïve Ünïcode " * 40), (33, "a" * 900), (34, "ab" * 600)]
    rows += [(35, "zwölf Boxkämpfer jagen \U0001f600 " * 30), (36, sentence(rng, 20_000, 9_000)), (37, "word"), (38, "same same " * 120), (-5, base[3])]
    rows += [(40, "1 2 3 # $ %"), (41, base[6].upper())]
    return [(i, t, None if k % 3 == 0 else "en", *[f"{c}{k}" if k % 2 else None for c in CLASHING]) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
