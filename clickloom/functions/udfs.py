"""User functions: scalar, aggregate and table forms, for the API and by SQL name."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.topn import top_n_per_group


def register_hash_code(spark: SparkSession, factor: float, name: str = "hash_code") -> None:
    """The scaled string hash under a SQL name, as a SQL function that the optimizer inlines."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS DOUBLE RETURN
          (((aggregate(
            flatten(transform(filter(split(s, ''), c -> c != ''), c ->
              CASE WHEN ascii(c) < 65536 THEN array(CAST(ascii(c) AS BIGINT))
                   ELSE array(CAST(shiftright(ascii(c) - 65536, 10) + 55296 AS BIGINT),
                              CAST(((ascii(c) - 65536) & 1023) + 56320 AS BIGINT)) END)),
            0L, (h, u) -> (h * 31L + u) & 4294967295L
          ) + 2147483648L) & 4294967295L) - 2147483648L) * {float(factor)!r}D"""
    )


def temperature_avg(col: str | Column) -> Column:
    """Average as sum over count of the values present; a decimal column is summed exactly."""
    return F.sum(col).cast("double") / F.count(col)


def split_words(df: DataFrame, col: str, sep: str, names: tuple[str, str] = ("word", "length")) -> DataFrame:
    """Lateral join with the words of a column and their lengths."""
    word, length = names
    return df.withColumn(word, F.explode(F.split(F.col(col), re.escape(sep)))).withColumn(length, F.length(word))


def register_split_words(spark: SparkSession, sep: str, name: str = "split_words") -> None:
    """The same as a SQL table function: ``FROM t, LATERAL split_words(t.col) AS s(word, length)``."""
    pattern = re.escape(sep).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS TABLE(word STRING, length INT)
        RETURN SELECT w, length(w) FROM (SELECT explode(split(s, '{pattern}')) AS w)"""
    )


def top2(df: DataFrame, part: Sequence[str], val: str, ties: Sequence[str] = ()) -> DataFrame:
    """The two highest values of each group with their rank; a group of one row gives one."""
    order = [F.desc(val), *[F.asc(c) for c in ties]]
    return top_n_per_group(df, part, order, 2).select(*part, val, "rank")


def city_remark(
    df: DataFrame, keys: Sequence[str], city: str, top: int = 2, weight: str | None = None
) -> DataFrame:
    """Rows per group and a remark: the shares of the two most frequent cities, the rest as other.

    Shares are whole percents; other is 100 less the named shares, only if there are more cities.
    Rows, or their ``weight`` if they are counts, are added up per city first. Of a group only its best
    cities, found by rank, and two totals come together. A missing city shows as ``null``.
    """
    named_city = F.coalesce(F.col(city), F.lit("null")).alias(city)
    per_city = df.groupBy(*keys, named_city).agg((F.sum(weight) if weight else F.count("*")).alias("_n"))
    totals = per_city.groupBy(*keys).agg(F.sum("_n").alias("count"), F.count("*").alias("_cities"))
    best = top_n_per_group(per_city, keys, [F.desc("_n"), F.asc(city)], top, rank="_rank")
    ranked = F.sort_array(F.collect_list(F.struct(F.col("_rank"), F.col("_n").alias("n"), F.col(city).alias("city"))))
    named_best = best.groupBy(*[F.col(k).alias(f"_b_{k}") for k in keys]).agg(ranked.alias("_top"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys])
    grouped = totals.join(named_best, same)
    share = lambda x: F.floor(x["n"] * 100 / F.col("count"))
    named = F.array_join(F.transform("_top", lambda x: F.concat_ws(" ", x["city"], share(x).cast("string"), F.lit("%"))), ",")
    given = F.aggregate("_top", F.lit(0).cast("long"), lambda a, x: a + share(x))
    # Fixed value: the report's word for other cities.
    other = F.when(F.col("_cities") > top, F.concat(F.lit(",其它 "), (100 - given).cast("string"), F.lit(" %")))
    remark = F.concat(named, F.coalesce(other, F.lit("")))
    return grouped.select(*keys, "count", remark.alias("city_remark"))
