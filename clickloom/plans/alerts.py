"""Sensor alerts, logins, payments and capped clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators import joins, rows, sequences
from clickloom.operators.windows import slide
from clickloom.plans.views import USER_ORDER, events, user_places, with_number

USER = ["user_id"]


def _is(event_type: str):
    return F.col("event_type") == event_type


def rolling_reduce(spark: SparkSession, sf: str) -> DataFrame:
    """Each reading with its key's running state: first time plus a second per reading, value plus 10."""
    readings = events(spark, sf).select("event_id", "user_id", "ts", "value")
    folds = {"n": ("sum", F.lit(1)), "first_ts": ("min", F.col("ts"))}
    state = sequences.rolling_reduce(readings, USER, USER_ORDER, folds)
    later = F.col("n") - 1
    return state.select(
        "event_id",
        "user_id",
        (F.col("first_ts") + F.expr("INTERVAL '1' SECOND") * later).alias("ts"),
        (F.col("value") + F.when(later > 0, 10.0).otherwise(0.0)).alias("value"),
    )


def jump_alert(spark: SparkSession, sf: str, threshold: float = 50) -> DataFrame:
    readings = events(spark, sf).select("event_id", "user_id", "ts", "value")
    return sequences.jump_alert(readings, USER, USER_ORDER, "value", threshold)


def rise_alert(spark: SparkSession, sf: str, span: str = "12 hours") -> DataFrame:
    return sequences.rise_alert(events(spark, sf), USER, USER_ORDER, "value", span)


def marker_watermark(spark: SparkSession, sf: str, delay: str = "1 minute") -> DataFrame:
    """Arrival order is by number ``k``, then id, so that rows come out of time order."""
    arrived = with_number(events(spark, sf), "k").select("event_id", "k", "ts", "event_type")
    return sequences.marker_watermark(arrived, ["k", "event_id"], "ts", _is("error"), delay)


def login_fail_burst(spark: SparkSession, sf: str, n: int = 2, span: str = "6 hours") -> DataFrame:
    return sequences.burst_alert(events(spark, sf), USER, USER_ORDER, _is("error"), n, span)


def login_fail_cep(spark: SparkSession, sf: str, within: str = "6 hours") -> DataFrame:
    logins = events(spark, sf).select("user_id", "ts", "event_id", "event_type")
    found = sequences.strict_sequence(logins, USER, USER_ORDER, [_is("error"), _is("error")], within)
    return found.select(
        "user_id",
        F.col("step_1.ts").alias("start_ts"),
        F.col("step_2.ts").alias("end_ts"),
        F.col("step_2.event_type").alias("event_type"),
    )


def order_pay(spark: SparkSession, sf: str, within: str = "12 hours") -> DataFrame:
    """Orders with the payment that followed in time, or a timeout."""
    orders = events(spark, sf, "signup", "purchase").select("user_id", "ts", "event_id", "event_type")
    pairs = sequences.followed_by(orders, USER, USER_ORDER, _is("signup"), _is("purchase"), within)
    paid = F.col("then_row").isNotNull()
    return pairs.select(
        "user_id",
        F.col("first_row.event_id").alias("order_event"),
        F.col("then_row.event_id").alias("pay_event"),
        F.when(paid, "order pay successfully").otherwise("order time out").alias("result"),
    )


def _pays(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf, "purchase").select(
        "user_id", F.col("event_id").alias("pay_event"), F.col("ts").alias("pay_ts")
    )


def _receipts(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf, "click").select(
        "user_id", F.col("event_id").alias("receipt_event"), F.col("ts").alias("receipt_ts")
    )


def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    """Payments with the receipts of the same user within an hour."""
    return joins.interval_join(
        _pays(spark, sf), _receipts(spark, sf), USER, "pay_ts", "receipt_ts", "-1 hour", "1 hour"
    )


def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Payments matched with receipts, and both sides' rows without a partner."""
    return joins.reconcile(_pays(spark, sf), _receipts(spark, sf), USER, "pay_ts", "receipt_ts", "1 hour")


def _ads(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("event_id", "ts", "user_id", "event_type")


def ad_click_cap(spark: SparkSession, sf: str, cap: int = 2) -> DataFrame:
    """One alert per user, ad and day above the cap."""
    _, alerts = sequences.daily_cap(_ads(spark, sf), ["user_id", "event_type"], USER_ORDER, cap)
    return alerts.select("user_id", "event_type", F.to_date("day").alias("day"), "event_id")


def ad_by_province(spark: SparkSession, sf: str, cap: int = 2) -> DataFrame:
    """Clicks below the cap per province and sliding window."""
    passed, _ = sequences.daily_cap(_ads(spark, sf), ["user_id", "event_type"], USER_ORDER, cap)
    placed = joins.star_left_join(passed, [user_places(spark, sf)])
    return slide(
        placed.withColumnRenamed("city", "province"), "ts", "1 hour", "5 minutes", ["province"], {"count": ("count", "*")}
    )


def ad_blacklist(spark: SparkSession, sf: str, limit: int = 2) -> DataFrame:
    """Users who clicked an ad at least ``limit`` times on one day, with their highest count."""
    clicks = with_number(events(spark, sf, "click"), "k")
    daily = clicks.groupBy(F.to_date("ts").alias("day"), "user_id", (F.col("k") % 4).alias("ad")).agg(
        F.count("*").alias("count")
    )
    over = daily.filter(F.col("count") >= limit)
    return over.groupBy("user_id").agg(F.max("count").alias("max_count"), F.count("*").alias("times"))


def blacklist_filter(spark: SparkSession, sf: str, limit: int = 20) -> DataFrame:
    """Clicks of users who are not blocked; blocked is who has ``limit`` clicks or more."""
    clicks = events(spark, sf, "click").select("event_id", "ts", "user_id")
    blocked = clicks.groupBy("user_id").agg(F.count("*").alias("n")).filter(F.col("n") >= limit)
    return rows.exclude_keys(clicks, blocked, "user_id")


def ad_area_city(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks per day, area, city and ad."""
    clicks = with_number(events(spark, sf, "click"), "ad").withColumn("day", F.to_date("ts"))
    placed = joins.star_counts(clicks, [user_places(spark, sf)], keep=["day", "ad"])
    return placed.groupBy("day", "area", "city", "ad").agg(F.sum("n").alias("count"))


QUERIES = {
    f.__name__: f
    for f in (
        rolling_reduce, jump_alert, rise_alert, marker_watermark, login_fail_burst, login_fail_cep, order_pay,
        interval_join, reconcile, ad_click_cap, ad_by_province, ad_blacklist, blacklist_filter, ad_area_city,
    )
}
