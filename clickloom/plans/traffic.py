"""Items, pages, visitors and marketing over time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.aggs import approx_distinct, bitmap_distinct, distinct_of_panes, sketch_panes, windowed_distinct
from clickloom.operators.ordered import over_preceding
from clickloom.operators.topn import window_top_n
from clickloom.operators.windows import rolling, slide, tumble
from clickloom.plans.views import USER_ORDER, events, with_number


def hot_items(spark: SparkSession, sf: str, size="6 hours", every="30 minutes", n=3) -> DataFrame:
    """The most viewed items of each sliding window."""
    views = with_number(events(spark, sf, "view"), "item_id")
    return window_top_n(views, "ts", size, every, "item_id", n)


def hot_urls(spark: SparkSession, sf: str, size="1 hour", every="5 minutes", n=3) -> DataFrame:
    """The most requested URLs of each sliding window; every event is a line of the log."""
    hits = with_number(events(spark, sf), "k").withColumn("url", F.concat(F.lit("/"), F.col("k")))
    return window_top_n(hits, "ts", size, every, "url", n)


def pv_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return tumble(events(spark, sf, "view"), "ts", "1 hour", [], {"pv": ("count", "*")})


def uv_exact(spark: SparkSession, sf: str) -> DataFrame:
    return windowed_distinct(events(spark, sf, "view"), "ts", "1 hour", "user_id", name="uv")


def uv_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return bitmap_distinct(events(spark, sf, "view"), "ts", "1 hour", "user_id", name="uv")


def uv_approx(spark: SparkSession, sf: str, rsd: float = 0.02) -> DataFrame:
    """Whether each day's approximate number of visitors is within five deviations of the exact one."""
    views = events(spark, sf, "view")
    days = approx_distinct(views.select(F.window("ts", "1 day").alias("w"), "user_id"), ["w"], "user_id", rsd, "uv")
    days = days.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv")
    exact = windowed_distinct(views, "ts", "1 day", "user_id", name="exact")
    off = F.abs(F.col("uv") - F.col("exact"))
    return days.join(exact, ["window_start", "window_end"]).select(
        "window_start", "window_end", (off <= F.greatest(5 * rsd * F.col("exact"), F.lit(1.0))).alias("within_bound")
    )


def uv_sliding(spark: SparkSession, sf: str, size="1 day", every="1 hour", lg: int = 12) -> DataFrame:
    """Whether each sliding window's visitors by sketches of its panes are within five deviations of the exact ones."""
    views = events(spark, sf, "view").select("ts", "user_id")
    sketched = distinct_of_panes(sketch_panes(views, "ts", size, every, "user_id", lg=lg), size, every, name="uv")
    in_panes = views.select(F.window("ts", every).alias("p"), "user_id").distinct()
    in_windows = in_panes.select(F.window("p.start", size, every).alias("w"), "user_id").distinct()
    exact = in_windows.groupBy("w").agg(F.count("user_id").alias("exact"))
    exact = exact.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "exact")
    off, one = F.abs(F.col("uv") - F.col("exact")), 1.04 / 2 ** (lg / 2)
    return sketched.join(exact, ["window_start", "window_end"]).select(
        "window_start", "window_end", (off <= F.greatest(5 * one * F.col("exact"), F.lit(1.0))).alias("within_bound")
    )


def marketing_total(spark: SparkSession, sf: str, size="1 hour", every="5 minutes") -> DataFrame:
    """All marketing events of each sliding window."""
    used = events(spark, sf).filter(F.col("event_type") != "error")
    total = slide(used, "ts", size, every, [], {"count": ("count", "*")})
    return total.withColumns({"behavior": F.lit("app"), "channel": F.lit("total")})


def marketing_by_channel(spark: SparkSession, sf: str, size="1 hour", every="5 minutes") -> DataFrame:
    used = with_number(events(spark, sf).filter(F.col("event_type") != "error"), "k")
    tagged = used.select("ts", F.col("event_type").alias("behavior"), (F.col("k") % 4).alias("channel"))
    return slide(tagged, "ts", size, every, ["behavior", "channel"], {"count": ("count", "*")})


def tumble_min(spark: SparkSession, sf: str) -> DataFrame:
    return tumble(events(spark, sf), "ts", "1 hour", ["event_type"], {"min_value": ("min", "value")})


def processing_tumble(spark: SparkSession, sf: str) -> DataFrame:
    """Events per window of the time at which they are processed: all of a table at once, so one window each."""
    counted = tumble(events(spark, sf), F.current_timestamp(), "1 hour", ["event_type"], {"count": ("count", "*")})
    length = F.unix_micros("window_end") - F.unix_micros("window_start")
    return counted.select("event_type", "count", (length == 3_600_000_000).alias("is_an_hour"))


def slide_count(spark: SparkSession, sf: str) -> DataFrame:
    aggs = {"count": ("count", "*"), "max_value": ("max", "value"), "min_value": ("min", "value")}
    return slide(events(spark, sf), "ts", "1 hour", "30 minutes", ["event_type"], aggs)


def sql_tumble(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """SELECT event_type, count(event_id) AS count, w.start AS window_start, w.end AS window_end
           FROM (SELECT event_type, event_id, window(ts, '1 hour') AS w FROM {events})
           GROUP BY event_type, w""",
        events=events(spark, sf),
    )


def sql_hop(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """SELECT event_type, count(event_id) AS count, w.start AS window_start, w.end AS window_end
           FROM (SELECT event_type, event_id, window(ts, '1 hour', '30 minutes') AS w FROM {events})
           GROUP BY event_type, w""",
        events=events(spark, sf),
    )


def recent_clicks(spark: SparkSession, sf: str, size="1 hour", every="5 minutes") -> DataFrame:
    """Clicks of the last while by minute and second."""
    clicks = events(spark, sf, "click").select("ts", F.date_format("ts", "mm:ss").alias("time_text"))
    return slide(clicks, "ts", size, every, ["time_text"], {"count": ("count", "*")})


def over_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Count and average over a user's event and the two before it."""
    rows = events(spark, sf).select("event_id", "user_id", "ts", "value")
    out = rolling(rows, ["user_id"], USER_ORDER, 2, {"count": ("count", "*"), "avg_value": ("avg", "value")})
    return out.select("event_id", "user_id", "ts", "count", F.round("avg_value", 4).alias("avg_value"))


def conversion(df: DataFrame, session: list[str], order: list[str], page: str, flow: list) -> DataFrame:
    """How often each step of a page flow was taken, against the visits of the step's first page.

    A step counts when its pages follow each other directly in a session.
    """
    seen = over_preceding(
        df.select(*session, *order, page), session, order, 1, lambda w: {"_next": F.lag(page).over(w)}, reverse=True
    )
    target = F.lit(None)
    for a, b in zip(flow, flow[1:]):
        target = F.when(F.col(page) == a, F.lit(b)).otherwise(target)
    steps = seen.withColumn("to_page", target).filter(F.col("to_page").isNotNull())
    counted = steps.groupBy(F.col(page).alias("from_page"), "to_page").agg(
        F.count_if(F.col("_next") == F.col("to_page")).alias("jumps"), F.count("*").alias("visits")
    )
    return counted.filter(F.col("jumps") > 0).withColumn("rate", F.col("jumps") / F.col("visits"))


def page_conversion(spark: SparkSession, sf: str) -> DataFrame:
    flow = ["signup", "view", "click", "purchase"]
    return conversion(events(spark, sf), ["user_id"], USER_ORDER, "event_type", flow)


QUERIES = {
    f.__name__: f
    for f in (
        hot_items, hot_urls, pv_hourly, uv_exact, uv_bitmap, uv_approx, uv_sliding, marketing_total, marketing_by_channel,
        tumble_min, processing_tumble, slide_count, sql_tumble, sql_hop, recent_clicks, over_rows, page_conversion,
    )
}
