"""Findings over small result tables: changes over time, deltas, concentration and mixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def year_on_year(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """Adds the previous year's value (of the row before) and the change. One row for each year and group, so windows stay small."""
    order = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("year")
    return df.withColumn("previous", F.lag(value).over(order)).withColumn("change", F.col(value) - F.col("previous"))


def category_delta(counts: DataFrame, key: str, now: int, before: int) -> DataFrame:
    """Shares of each category in two years and their difference in percentage points."""
    of = lambda y: F.sum(F.when(F.col("year") == y, F.col("reports")).otherwise(0))
    rows = counts.where(F.col("year").isin(now, before)).groupBy(key).agg(of(now).alias("now"), of(before).alias("before"))
    total = rows.agg(F.sum("now").alias("_n"), F.sum("before").alias("_b"))
    share = lambda v, t: F.when(F.col(t) > 0, 100.0 * F.col(v) / F.col(t)).otherwise(0.0)
    return rows.crossJoin(F.broadcast(total)).select(key, "now", "before", F.round(share("now", "_n") - share("before", "_b"), 4).alias("points"))  # total: one row


def concentration(counts: DataFrame, by: list[str], n: str) -> DataFrame:
    """The share of the three largest, in percent, and the sum of squared percentages, by group; 0 if nothing is counted."""
    group, place = Window.partitionBy(*by), Window.partitionBy(*by).orderBy(F.desc(n), "label")
    rows = counts.withColumn("_total", F.sum(n).over(group)).withColumn("_place", F.row_number().over(place))
    share = F.when(F.col("_total") > 0, 100.0 * F.col(n) / F.col("_total")).otherwise(0.0)
    return rows.groupBy(*by).agg(
        F.sum(n).alias("total"),
        F.round(F.sum(F.when(F.col("_place") <= 3, share).otherwise(0.0)), 4).alias("top3_share"),
        F.round(F.sum(share * share), 4).alias("hhi"),
    )


def with_least(df: DataFrame, n: str, least: int = 20) -> DataFrame:
    """Groups with a sample of at least `least`."""
    return df.where(F.col(n) >= least)


def quality_trend(df: DataFrame, good: str, total: str, other: str) -> DataFrame:
    """Adds the good share in percent and the ratio to another count (null if that is 0)."""
    share = F.when(F.col(total) > 0, F.round(100.0 * F.col(good) / F.col(total), 1)).otherwise(0.0)
    return df.withColumn("good_share", share).withColumn("ratio", F.when(F.col(other) > 0, F.round(F.col(good) / F.col(other), 3)))
