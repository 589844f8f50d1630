"""Categories, ads and products ranked by province or area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import udfs
from clickloom.operators import aggs, joins, topn
from clickloom.operators.changes import materialize
from clickloom.plans.views import places
from clickloom.sources.tables import load

# The return flags stand for the three kinds of action.
KINDS = {"clicks": "R", "orders": "N", "pays": "A"}


def ad_top3_by_province(spark: SparkSession, sf: str) -> DataFrame:
    """The three most frequent ads of each province; orders are counted per customer first."""
    orders = load(spark, sf, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("ad"))
    per_customer = orders.agg(F.count("*").alias("n"))
    customer, nation = load(spark, sf, "customer"), load(spark, sf, "nation")
    placed = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    counts = placed.groupBy(F.col("n_name").alias("province"), "ad").agg(F.sum("n").alias("times"))
    return topn.top_n_per_group(counts, ["province"], [F.desc("times"), F.asc("ad")], 3)


def _per_part(spark: SparkSession, sf: str) -> DataFrame:
    """Lines counted per part and kind, in one pass, with the part's brand: the fact is counted before it is joined."""
    lines = load(spark, sf, "lineitem").groupBy("l_partkey", "l_returnflag").agg(F.count("*").alias("n"))
    part = load(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("category"))
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey"))


def _per_brand(spark: SparkSession, sf: str) -> DataFrame:
    """Lines counted per category and kind; a few rows, which the forms below arrange in their ways."""
    return _per_part(spark, sf).groupBy("category", "l_returnflag").agg(F.sum("n").alias("n"))


def category_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks, orders and payments per category, counted per part before the join."""
    lines = load(spark, sf, "lineitem").select("l_partkey", "l_returnflag")
    per_part = aggs.kind_counts(lines, "l_partkey", "l_returnflag", KINDS)
    part = load(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("category"))
    joined = per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("category").agg(*[F.sum(k).alias(k) for k in KINDS])


def category_top10(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc("clicks"), F.desc("orders"), F.desc("pays"), F.asc("category")]
    return topn.top_n(category_actions(spark, sf), order, 10)


def category_explode(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts from rows that name categories per kind as arrays."""
    named = {name: F.when(F.col("l_returnflag") == v, F.array("category")) for name, v in KINDS.items()}
    return aggs.action_counts(_per_brand(spark, sf), named, weight="n")


def cogroup_counts(spark: SparkSession, sf: str) -> DataFrame:
    """One table per kind, set side by side by category."""
    counted = materialize(_per_brand(spark, sf), "checkpoint")
    tables = {name: counted.filter(F.col("l_returnflag") == v) for name, v in KINDS.items()}
    return joins.cogroup_counts(tables, "category", weight="n")


def union_counts(spark: SparkSession, sf: str) -> DataFrame:
    """One table per kind, set beside zeros for the other kinds, united and summed."""
    counted, united = materialize(_per_brand(spark, sf), "checkpoint"), None
    for name, value in KINDS.items():
        own = counted.filter(F.col("l_returnflag") == value)
        padded = own.select("category", *[(F.col("n") if k == name else F.lit(0).cast("long")).alias(k) for k in KINDS])
        united = padded if united is None else united.unionByName(padded)
    return united.groupBy("category").agg(*[F.sum(k).alias(k) for k in KINDS])


def _dims(spark: SparkSession, sf: str) -> list[joins.Dim]:
    """Product by part, city and area by supplier."""
    part, supplier = load(spark, sf, "part"), load(spark, sf, "supplier")
    placed = supplier.join(places(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return [
        joins.Dim(part.select("p_partkey", F.col("p_name").alias("product")), "l_partkey", "p_partkey"),
        joins.Dim(placed.select("s_suppkey", "city", "area"), "l_suppkey", "s_suppkey", rows_of=supplier),
    ]


def star_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with product, city and area; a line without a part or supplier stays."""
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    sales = joins.star_left_join(lines, _dims(spark, sf))
    return sales.select("l_orderkey", "l_linenumber", "product", "city", "area")


def area_product_top3(spark: SparkSession, sf: str) -> DataFrame:
    """The products of rank three or better by lines in each area."""
    sales = joins.star_counts(load(spark, sf, "lineitem"), _dims(spark, sf))
    counts = sales.groupBy("area", "product").agg(F.sum("n").alias("click_count"))
    return topn.top_by_rank(counts, ["area"], [F.desc("click_count")], 3)


def city_remark(spark: SparkSession, sf: str) -> DataFrame:
    sales = joins.star_counts(load(spark, sf, "lineitem"), _dims(spark, sf))
    return udfs.city_remark(sales, ["area", "product"], "city", weight="n")


def area_product_remark(spark: SparkSession, sf: str) -> DataFrame:
    """The top products of each area with the shares of their cities; remarks are made for these only."""
    sales = joins.star_counts(load(spark, sf, "lineitem"), _dims(spark, sf))
    per_city = materialize(sales.groupBy("area", "product", "city").agg(F.sum("n").alias("n")), "checkpoint")
    counts = per_city.groupBy("area", "product").agg(F.sum("n").alias("count"))
    best = topn.top_by_rank(counts, ["area"], [F.desc("count")], 3).drop("count")
    same = F.col("s.area").eqNullSafe(F.col("b.area")) & F.col("s.product").eqNullSafe(F.col("b.product"))
    chosen = per_city.alias("s").join(best.alias("b"), same).select("s.*", "b.rank")
    return udfs.city_remark(chosen, ["area", "product", "rank"], "city", weight="n")


def rank_top3(spark: SparkSession, sf: str) -> DataFrame:
    """Part types of rank three or better by number of parts in each brand."""
    counts = load(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("count"))
    return topn.top_by_rank(counts, ["p_brand"], [F.desc("count")], 3)


QUERIES = {
    f.__name__: f
    for f in (
        ad_top3_by_province, category_actions, category_top10, category_explode, cogroup_counts, union_counts,
        star_left_join, area_product_top3, city_remark, area_product_remark, rank_top3,
    )
}
