"""Single operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import udfs
from clickloom.operators import aggs, changes, joins, rows, topn
from clickloom.plans.views import USER_ORDER, events, with_number
from clickloom.sinks import payloads
from clickloom.sources import tables, text


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggs.word_count(rows.explode_words(tables.load(spark, sf, "documents").select("text"), "text"))


def lateral_split(spark: SparkSession, sf: str) -> DataFrame:
    udfs.register_split_words(spark, " ")
    return spark.sql(
        "SELECT p_partkey, word, length FROM {part} AS p, LATERAL split_words(p.p_name) AS s(word, length)",
        part=tables.load(spark, sf, "part"),
    )


def split_column(spark: SparkSession, sf: str) -> DataFrame:
    """The same split through the API, by another separator."""
    orders = tables.load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return udfs.split_words(orders, "o_orderpriority", "-").drop("o_orderpriority")


def scalar_hash(spark: SparkSession, sf: str) -> DataFrame:
    udfs.register_hash_code(spark, 1.23)
    customer = tables.load(spark, sf, "customer")
    return spark.sql("SELECT c_custkey, c_name, hash_code(c_name) AS hash FROM {c}", c=customer)


def split_routes(spark: SparkSession, sf: str) -> DataFrame:
    readings = events(spark, sf).select("event_id", "value")
    return rows.route(readings, {"High": F.col("value") > 30}, default="Low")


def side_output(spark: SparkSession, sf: str) -> DataFrame:
    """Readings, and alerts from the side for those below 32."""
    readings = events(spark, sf).select("event_id", "value")
    main, side = rows.side_output(readings, F.col("value") < 32)
    alerts = side.select("event_id", F.concat(F.lit("freezing alert "), "event_id").alias("alert"))
    return main.unionByName(alerts, allowMissingColumns=True)


def co_map(spark: SparkSession, sf: str) -> DataFrame:
    routed = rows.route(events(spark, sf).select("event_id", "value"), {"High": F.col("value") > 30}, default="Low")
    return rows.co_map(
        rows.select_routes(routed, "High"),
        rows.select_routes(routed, "Low"),
        lambda high: high.withColumn("state", F.lit("warning")),
        lambda low: low.select("event_id", F.lit("healthy").alias("state")),
    )


def starts_with(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).filter(F.col("event_type").startswith("p")).select("event_id", "event_type", "value")


def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("user_id", "event_type").distinct()


def adjacent_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rows.adjacent_pairs(events(spark, sf), ["user_id"], USER_ORDER, "event_type")


def broadcast_lookup(spark: SparkSession, sf: str) -> DataFrame:
    customer = tables.load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    # Numbers moved by three, so that some customers show the default.
    nation = tables.load(spark, sf, "nation").select((F.col("n_nationkey") + 3).alias("c_nationkey"), "n_name")
    return joins.lookup(customer, nation, "c_nationkey", "n_name", "none")


def keyed_max(spark: SparkSession, sf: str) -> DataFrame:
    numbered = with_number(events(spark, sf), "k")
    return numbered.groupBy("user_id").agg(F.max("k").alias("max_k"), F.min("k").alias("min_k"))


def keyed_int_avg(spark: SparkSession, sf: str) -> DataFrame:
    return aggs.int_avg(with_number(events(spark, sf), "k"), ["user_id"], "k", "avg_k")


def two_stage_agg(spark: SparkSession, sf: str) -> DataFrame:
    """The highest number of each user's day, summed over the days."""
    numbered = with_number(events(spark, sf), "k").withColumn("day", F.to_date("ts"))
    return aggs.two_stage_agg(
        numbered, ["user_id"], ["day"], F.max("k").alias("top"), F.sum("top").alias("sum_of_max")
    )


def global_agg(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return tables.load(spark, sf, "orders").agg(
        F.count("*").alias("n"),
        F.sum(price).cast("double").alias("total"),
        F.min("o_totalprice").alias("low"),
        F.max("o_totalprice").alias("high"),
    )


def count_by_value(spark: SparkSession, sf: str) -> DataFrame:
    return aggs.count_by_value(tables.load(spark, sf, "orders"), "o_orderpriority")


def group_count(spark: SparkSession, sf: str) -> DataFrame:
    orders = tables.load(spark, sf, "orders")
    return spark.sql("SELECT o_custkey, count(o_custkey) AS count FROM {o} GROUP BY o_custkey", o=orders)


def take_ordered(spark: SparkSession, sf: str) -> DataFrame:
    orders = tables.load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return topn.top_n(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


def udaf_avg(spark: SparkSession, sf: str) -> DataFrame:
    exact = F.col("value").cast("decimal(18,2)")
    return events(spark, sf).groupBy("user_id").agg(udfs.temperature_avg(exact).alias("avg_value"))


def top2_flat_agg(spark: SparkSession, sf: str) -> DataFrame:
    return udfs.top2(events(spark, sf), ["user_id"], "value", ["event_id"])


def retract_changelog(spark: SparkSession, sf: str, until: str = "2024-01-16") -> DataFrame:
    """What the events from ``until`` on change in the counts per user."""
    seen = events(spark, sf)
    early = seen.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    count = F.count("*").alias("count")
    return changes.changelog(early.groupBy("user_id").agg(count), seen.groupBy("user_id").agg(count), ["user_id"])


def _changes_of_counts(spark: SparkSession, sf: str, until: str = "2024-01-16") -> DataFrame:
    """The counts per user as a changelog: those before ``until`` added, then what ``retract_changelog`` says."""
    early = events(spark, sf).filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    first = early.groupBy("user_id").agg(F.count("*").alias("count")).withColumn("added", F.lit(True))
    every = first.unionByName(retract_changelog(spark, sf, until))
    return every.withColumn("part", F.col("user_id") % 10)


def retract_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Users and their events by the last digit of the user, from the changes of the counts per user alone."""
    net = changes.net_rows(_changes_of_counts(spark, sf), ["part", "count"])
    kinds = ("sum", "avg", "min", "max")
    return changes.aggregate_net(net, ["part"], {"users": ("count", "*")} | {f"{k}_count": (k, "count") for k in kinds})


def retract_top2(spark: SparkSession, sf: str) -> DataFrame:
    """The two greatest counts per last digit of the user, from the changes of the counts alone."""
    return changes.top_of_net(changes.net_rows(_changes_of_counts(spark, sf), ["part", "count"]), ["part"], "count", 2)


def route_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Which partition each event is sent to."""
    slim = events(spark, sf).select("event_id", "event_type")
    each = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 3)
    placed = rows.route_partitions(slim, "event_type", {"view": 0, "click": 1}, 2, 3, each, ["event_id"])
    return placed.withColumn("partition", F.floor(F.spark_partition_id() / each).cast("int"))


def delimited_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as delimited lines and read back; type ``error`` stands for a missing value."""
    lines = payloads.to_messages(events(spark, sf).select("event_id", "user_id", "event_type", "ts"), fmt="text", sep="_")
    schema = "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz"
    return text.parse_delimited(lines, schema, "_", ["error"])


def csv_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as messages of a queue and back."""
    customer = tables.load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    sent = payloads.to_messages(customer, "c_custkey", "csv")
    queue = sent.select(*[F.col(c).cast("binary").alias(c) for c in sent.columns])
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"
    return text.parse_messages(queue, schema, "csv", ",")


def access_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as access log lines and read back."""
    hits = with_number(events(spark, sf), "k")
    line = F.concat_ws(
        " ",
        F.concat(F.lit("10.0.0."), "k"),
        F.lit("-"),
        F.coalesce(F.col("user_id").cast("string"), F.lit("-")),
        F.date_format("ts", text.ACCESS_LOG_TIME),
        F.lit("+0000"),
        F.lit("GET"),
        F.concat(F.lit("/"), "k"),
    )
    log = text.parse_access_log(hits.select(line.alias("value")))
    return log.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def table_views(spark: SparkSession, sf: str) -> DataFrame:
    """Columns chosen and renamed, under a view's name, and asked by SQL."""
    tables.as_table(tables.load(spark, sf, "customer"), "c_custkey", view="customers_of_nations", nation="c_nationkey")
    return spark.sql("SELECT nation, count(*) AS customers FROM customers_of_nations GROUP BY nation")


def documents_json(spark: SparkSession, sf: str) -> DataFrame:
    customer = tables.load(spark, sf, "customer")
    return payloads.to_documents(customer, "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"])


QUERIES = {
    f.__name__: f
    for f in (
        word_count, lateral_split, split_column, scalar_hash, split_routes, side_output, co_map, starts_with,
        distinct_values, adjacent_pairs, broadcast_lookup, keyed_max, keyed_int_avg, two_stage_agg, global_agg,
        count_by_value, group_count, take_ordered, udaf_avg, top2_flat_agg, retract_changelog, retract_totals,
        retract_top2, route_partitions,
        delimited_lines, csv_messages, access_log, table_views, documents_json,
    )
}
