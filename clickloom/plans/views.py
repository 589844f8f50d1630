"""The records of the reports, taken from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.joins import Dim
from clickloom.sources.tables import load

USER_ORDER = ["ts", "event_id"]


def events(spark: SparkSession, sf: str, *types: str) -> DataFrame:
    rows = load(spark, sf, "events")
    return rows.filter(F.col("event_type").isin(*types)) if types else rows


def with_number(df: DataFrame, name: str) -> DataFrame:
    """The event's number ``k``: an item, page or ad."""
    return df.withColumn(name, F.get_json_object("props", "$.k").cast("bigint"))


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as cities with the region as their area."""
    nation, region = load(spark, sf, "nation"), load(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("area")
    )


def user_places(spark: SparkSession, sf: str) -> Dim:
    """The dimension of users: city and area of the customer of the same number."""
    customer = load(spark, sf, "customer")
    placed = customer.join(places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    return Dim(placed.select("c_custkey", "city", "area"), "user_id", "c_custkey", rows_of=customer)
