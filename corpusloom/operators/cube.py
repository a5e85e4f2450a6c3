"""The reporting cube: label trends, heatmaps, blind spots, slices, flows and filter masks from one table of reports.

A report row has: report, owner, sector, year, month (yyyy-MM) and labels (array of strings).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import has_bit, label_mask, signal_level


def label_trend(reports: DataFrame, axis: str, vocabulary: Sequence[str]) -> DataFrame:
    """Reports with each label by axis value; values without any label get 0."""
    counts = [F.count_if(F.array_contains("labels", v)).alias(f"label_{v}") for v in vocabulary]
    return reports.where(F.col(axis).isNotNull()).groupBy(axis).agg(*counts)


def label_by(reports: DataFrame, *groups: str) -> DataFrame:
    """Reports by label and groups, only combinations that occur."""
    return reports.select(*groups, F.explode("labels").alias("label")).groupBy("label", *groups).agg(F.count("*").alias("reports"))


def scaffold(years: DataFrame, values: Sequence[str], name: str) -> DataFrame:
    """All years with all values of a fixed list."""
    return years.select("year").distinct().select("year", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


def dense(frame: DataFrame, counts: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return frame.join(counts, keys, "left").select(*keys, *(F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in measures))


def signal_heatmap(signals: DataFrame, years: DataFrame) -> DataFrame:
    """Signals (year, signal) by year and level name, zeros included; level 0 doesn't count."""
    level = signal_level(F.col("signal"))
    named = signals.select("year", F.when(level >= 3, "strong").when(level >= 2, "medium").when(level >= 1, "weak").alias("level"))
    counts = named.where(F.col("level").isNotNull()).groupBy("year", "level").agg(F.count("*").alias("signals"))
    return dense(scaffold(years, ("strong", "medium", "weak"), "level"), counts, ["year", "level"], ["signals"])


def majority_band(bands: DataFrame) -> DataFrame:
    """(report, year, band) rows to each report's most frequent band; ties go to the stronger one."""
    n = {b: F.count_if(F.col("band") == b) for b in ("strong", "medium", "weak")}
    counts = bands.groupBy("report", "year").agg(*(c.alias(b) for b, c in n.items()))
    s, m, w = F.col("strong"), F.col("medium"), F.col("weak")
    return counts.select("report", "year", F.when((s >= m) & (s >= w), "strong").when(m >= w, "medium").otherwise("weak").alias("band"))


def blind_spots(reports: DataFrame, axis: list[str], risk: str, none: str = "none") -> DataFrame:
    """Reports, those without any signal, those without a risk label, and the complements."""
    signal = F.exists("labels", lambda x: x != none)
    risky = F.array_contains("labels", risk)
    return reports.groupBy(*axis).agg(
        F.count("*").alias("reports"),
        F.count_if(~signal).alias("no_signal"),
        F.count_if(~risky).alias("no_risk"),
        F.count_if(signal).alias("with_signal"),
        F.count_if(risky).alias("with_risk"),
    )


def slices(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Each row once for each overlapping slice whose rule holds; the rows are read once."""
    names = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn("slice", F.explode(names))


def breakdown(reports: DataFrame, risk: str, none: str = "none") -> DataFrame:
    """A small tree of classes with counts and percentages of the parent: all -> signal or not; signal -> risk or other."""
    signal, risky = F.exists("labels", lambda x: x != none), F.array_contains("labels", risk)
    totals = reports.agg(
        F.count("*").alias("all"),
        F.count_if(signal).alias("signal"),
        F.count_if(~signal).alias("silent"),
        F.count_if(signal & risky).alias("risk"),
        F.count_if(signal & ~risky).alias("other"),
    )
    nodes = [("all", "all"), ("signal", "all"), ("silent", "all"), ("risk", "signal"), ("other", "signal")]
    rows = F.array(*[F.struct(F.lit(n).alias("node"), F.lit(p).alias("parent"), F.col(n).alias("reports"), F.when(F.col(p) > 0, F.round(100.0 * F.col(n) / F.col(p), 4)).otherwise(0.0).alias("percent")) for n, p in nodes])
    return totals.select(F.inline(rows))


def flow_edges(reports: DataFrame, stages: Sequence[tuple[str, Column]]) -> DataFrame:
    """Counts of the steps from each stage's node to the next one's."""
    named = reports.select(*(c.alias(f"s{i}") for i, (_, c) in enumerate(stages)))
    steps = F.array(*[F.struct(F.concat(F.lit(f"{stages[i][0]}:"), F.col(f"s{i}")).alias("source"), F.concat(F.lit(f"{stages[i + 1][0]}:"), F.col(f"s{i + 1}")).alias("target")) for i in range(len(stages) - 1)])
    return named.select(F.inline(steps)).groupBy("source", "target").agg(F.count("*").alias("reports"))


def flow_nodes(edges: DataFrame) -> DataFrame:
    """Nodes with the larger of what flows in and out."""
    sides = edges.select(F.col("source").alias("node"), F.col("reports").alias("out"), F.lit(0).cast("long").alias("in_")).union(edges.select("target", F.lit(0).cast("long"), "reports"))
    return sides.groupBy("node").agg(F.greatest(F.sum("out"), F.sum("in_")).alias("reports"))


def filter_index(reports: DataFrame, vocabulary: Sequence[str], sectors: Sequence[str]) -> DataFrame:
    """One small row for each report: year, sector number (-1: unknown) and label mask."""
    at = F.array_position(F.array(*[F.lit(s) for s in sectors]), F.col("sector")) - 1
    return reports.select("report", "year", F.coalesce(at, F.lit(-1)).cast("int").alias("sector_index"), label_mask(F.col("labels"), vocabulary).alias("mask"))


def masked_trend(index: DataFrame, vocabulary: Sequence[str], need: Column | None = None) -> DataFrame:
    """Label counts by year again, from masks alone, over the rows that meet `need`."""
    rows = index if need is None else index.where(need)
    return rows.groupBy("year").agg(*(F.count_if(has_bit(F.col("mask"), i)).alias(f"label_{v}") for i, v in enumerate(vocabulary)))


def percent_of(df: DataFrame, axis: list[str], value: str) -> DataFrame:
    """Adds `percent`, the value's share of its axis group's sum."""
    total = df.groupBy(*axis).agg(F.sum(value).alias("_total"))
    return df.join(total, axis).withColumn("percent", F.when(F.col("_total") > 0, F.round(100.0 * F.col(value) / F.col("_total"), 4)).otherwise(0.0)).drop("_total")
