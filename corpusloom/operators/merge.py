"""Combining tables by key: precedence, overlays, patches, upserts and differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .select import pick_best


def precedence_union(parts: list[DataFrame], keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of all parts; of rows with one key that of the earliest part stays. Adds `source` (number of the part)."""
    tagged = [p.withColumn("source", F.lit(i)) for i, p in enumerate(parts)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return pick_best(both, keys, [F.col("source"), *(order or [])])


def fill_merge(parts: list[DataFrame], keys: list[str], values: list[str]) -> DataFrame:
    """One row for each key; a value comes from the earliest part where it isn't blank. Adds `sources`, the numbers of the parts with the key."""
    tagged = [p.select(*keys, *values).withColumn("_source", F.lit(i)) for i, p in enumerate(parts)]
    both = reduce(DataFrame.unionByName, tagged)
    first = [F.min_by(v, F.when(F.nullif(F.trim(F.col(v).cast("string")), F.lit("")).isNotNull(), F.col("_source"))).alias(v) for v in values]
    return both.groupBy(*keys).agg(*first, F.array_sort(F.collect_set("_source")).alias("sources"))


def overlay(base: DataFrame, patch: DataFrame, key: str, columns: list[str], when: Column | None = None, append: bool = False) -> DataFrame:
    """Base rows with the patch's columns where the key matches and `when` (over base and new_<column>) holds; with append, also the patch's extra rows."""
    new = patch.select(key, F.lit(True).alias("_hit"), *(F.col(c).alias(f"new_{c}") for c in columns))
    use = F.col("_hit") if when is None else F.col("_hit") & when
    joined = base.join(new, key, "left").withColumn("_use", F.coalesce(use, F.lit(False)))
    out = joined.select(*(F.when(F.col("_use"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns), F.col("_use").alias("replaced"))
    if append:
        extra = patch.join(base.select(key), key, "left_anti").withColumn("replaced", F.lit(False))
        out = out.unionByName(extra.select(*[c for c in out.columns if c in extra.columns]), allowMissingColumns=True)
    return out


def patch_fields(base: DataFrame, patch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Writes the patch's non-null fields; adds `changed`, the number of fields that were different."""
    new = patch.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns))
    joined = base.join(new, key, "left")
    differs = [(F.col(f"_new_{c}").isNotNull() & ~F.col(f"_new_{c}").eqNullSafe(F.col(c))).cast("int") for c in columns]
    fields = [F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns]
    return joined.select(*fields, reduce(lambda a, b: a + b, differs).alias("changed"))


def upsert(base: DataFrame, new: DataFrame, keys: list[str], keep: list[str] = ()) -> DataFrame:
    """New rows win over old ones with their key, but the fields in `keep` stay as they were unless they were null."""
    fields = [c for c in base.columns if c not in keys]
    both = base.withColumn("_old", F.lit(True)).join(new.select(*keys, F.lit(True).alias("_new"), *(F.col(c).alias(f"_n_{c}") for c in fields)), keys, "full")
    pick = lambda c: F.coalesce(c, F.col(f"_n_{c}")) if c in keep else F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c))
    return both.select(*keys, *(pick(c).alias(c) for c in fields)).select(*base.columns)


def replace_by_key(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return base.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def insert_absent(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return base.unionByName(new.join(base.select(*keys), keys, "left_anti"))


def missing_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of one side only, with the side that lacks them (`a` or `b`)."""
    in_b = a.select(key).distinct().join(b.select(key), key, "left_anti").withColumn("missing_in", F.lit("b"))
    return in_b.union(b.select(key).distinct().join(a.select(key), key, "left_anti").withColumn("missing_in", F.lit("a")))


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: keys in a only, in b only and in both; counted by tagged union, so each side is shuffled once."""
    tagged = a.select(F.col(key).alias("k"), F.lit(1).alias("t")).union(b.select(F.col(key), F.lit(2)))
    sides = tagged.groupBy("k").agg(F.bit_or("t").alias("t"))
    return sides.agg(F.count_if(F.col("t") == 1).alias("only_a"), F.count_if(F.col("t") == 2).alias("only_b"), F.count_if(F.col("t") == 3).alias("both"))


def repeated_keys(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Keys that stand in more than one row of the parts, with how often; empty if the union is disjoint."""
    return reduce(DataFrame.union, [p.select(*keys) for p in parts]).groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")
