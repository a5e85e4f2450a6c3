"""Choosing rows: the best of a group, ranks, shards, pairings by rank, and diverse examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank", candidates: str | None = None) -> DataFrame:
    """Adds each row's rank in its group, and on request the group's size. The order should be total."""
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return out.withColumn(candidates, F.count("*").over(Window.partitionBy(*keys))) if candidates else out


def pick_best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group. The rank filter is pushed below the shuffle, so a hot group sends one row for each task."""
    return ranked(df, keys, order, "_rank").where("_rank = 1").drop("_rank")


def losers(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return ranked(df, keys, order, "_rank").where("_rank > 1").drop("_rank")


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return ranked(df, keys, order).where(F.col("rank") <= n)


def numbered(df: DataFrame, order: list[Column], name: str = "number") -> DataFrame:
    """Rows of a small table numbered from 1 in order (the order is global)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def shard_of(df: DataFrame, order: list[Column], shards: int) -> DataFrame:
    """Adds `shard`: contiguous parts [n (i - 1) / k, n i / k) of the ordered rows, for i from 1. For small control tables: the order is global."""
    place = F.row_number().over(Window.orderBy(*order)) - 1
    n = F.count("*").over(Window.partitionBy())
    # row p is in shard i if floor(n (i - 1) / k) <= p < floor(n i / k)
    return df.withColumn("_p", place).withColumn("_n", n).withColumn("shard", F.floor(((F.col("_p") + 1) * shards - 1) / F.col("_n")).cast("int") + 1).drop("_p", "_n")


def zip_by_rank(dropped: DataFrame, spare: DataFrame, keys: list[str], order_a: list[Column], order_b: list[Column]) -> DataFrame:
    """Pairs the i-th dropped row of a group with its i-th spare row."""
    return ranked(dropped, keys, order_a).join(ranked(spare, keys, order_b), [*keys, "rank"])


def diverse(df: DataFrame, owner: str, order: list[Column], n: int) -> DataFrame:
    """n rows in order, first one for each owner, then filled with the best of the rest."""
    first = ranked(df, [owner], order, "_own").withColumn("_fill", F.col("_own") > 1)
    return first.orderBy("_fill", *order).limit(n).drop("_own", "_fill")


def locale_order(name: str, section: str | None = None, fixed: tuple[str, ...] = ()) -> list[Column]:
    """An order for names as readers expect it (root locale: accents and case only break ties); with a section, the fixed sections come first in their order, then the others by the same rule."""
    by_name = F.collate(F.col(name), "UNICODE")
    if section is None:
        return [by_name]
    place = F.nullif(F.array_position(F.array(*map(F.lit, fixed)), F.col(section)), F.lit(0)) if fixed else F.lit(None).cast("long")
    return [F.asc_nulls_last(place), F.collate(F.col(section), "UNICODE"), by_name]
