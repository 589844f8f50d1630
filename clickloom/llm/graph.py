"""Connected components of links between documents, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.llm.shared import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node it is connected with) for every node of ``links(a, b)``.

    Large-star and small-star rounds: each node hands its neighbours the smallest node that it knows.
    A round is two aggregates and two joins on nodes; no neighbourhood is collected. Nodes that many
    others link to are aggregated before the shuffle, and their part of a join is split by Spark.
    Without links the result is empty.
    """
    edges, state = _kept(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        handed = F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), F.col("m")))
        small = large.join(least, "u").select(F.inline(handed)).filter("v <> m")
        before = state
        edges, state = _kept(small.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _kept(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a table, and what tells them from others, seen while they are written."""
    seen = Observation()
    told = edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
    return staged(told), seen.get
