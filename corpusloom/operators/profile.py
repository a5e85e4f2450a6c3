"""Statistics, coverage and quality checks over tables of chunks, documents and companies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_rank(df: DataFrame, value: str, quantiles: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """The values at index round((n - 1) * q), half to even, of the sorted values of each group.

    Equal values are counted first, so a group's window runs over its distinct values only.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    order = Window.partitionBy(*by).orderBy(value)
    rows = counts.withColumn("_end", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
    place = lambda q: F.bround((F.col("_n") - 1) * F.lit(float(q)), 0)
    hit = lambda q: (F.col("_end") > place(q)) & (F.col("_end") - F.col("_c") <= place(q))
    return rows.groupBy(*by).agg(F.max("_n").alias("n"), *(F.max(F.when(hit(q), F.col(value))).alias(f"p{round(q * 100)}") for q in quantiles))


def chunk_stats(chunks: DataFrame, text: str, short: int, long: int, by: Sequence[str] = ()) -> DataFrame:
    """Chunks, mean and largest length, shares of short and long ones, and the share that repeats an earlier text."""
    n = F.length(text)
    sized = chunks.select(*by, n.alias("_n"), F.sha2(text, 256).alias("_hash"))
    per_text = sized.groupBy(*by, "_hash").agg(F.count("*").alias("_c"), F.first("_n").alias("_n"))
    rate = lambda c: F.round(F.sum(F.when(c, F.col("_c")).otherwise(0)) / F.sum("_c"), 4)
    return per_text.groupBy(*by).agg(
        F.sum("_c").alias("chunks"),
        F.round(F.sum(F.col("_c") * F.col("_n")) / F.sum("_c"), 4).alias("mean_length"),
        F.max("_n").alias("max_length"),
        rate(F.col("_n") < short).alias("short_rate"),
        rate(F.col("_n") > long).alias("long_rate"),
        F.round(F.sum(F.col("_c") - 1) / F.sum("_c"), 4).alias("duplicate_rate"),
    )


def run_summary(results: DataFrame, confidence: Column, failed: Column, by: Sequence[str] = (), low: float = 0.7) -> DataFrame:
    """Results, successes, mean confidence of the successes, and how many of them are below `low` (a missing confidence counts as 1 there)."""
    good = ~failed
    return results.groupBy(*by).agg(
        F.count("*").alias("results"),
        F.count_if(good).alias("successes"),
        F.round(F.avg(F.when(good, confidence)), 4).alias("mean_confidence"),
        F.count_if(good & (F.coalesce(confidence, F.lit(1.0)) < low)).alias("low_confidence"),
    )


def positive_mean(value: Column) -> Column:
    """The mean without zeros and missing values, 0 if none is left."""
    return F.coalesce(F.avg(F.when(value > 0, value)), F.lit(0.0))


def ambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value, and how many."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("values")).where("values > 1")


def unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """A lookup of the keys that have one value only."""
    return df.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias("value"), F.max(value).alias("_high")).where("value = _high").drop("_high")


def inconsistent_groups(df: DataFrame, group: str, value: str, least: int) -> DataFrame:
    """Groups of at least `least` rows that hold several values: rows, values, the majority's value and share; ties go to the smaller value."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("_c"))
    rows = counts.groupBy(group).agg(
        F.sum("_c").alias("rows"), F.count("*").alias("values"), F.max("_c").alias("_most"), F.max_by(value, F.struct("_c", -F.ascii(value))).alias("majority")
    )
    return rows.where((F.col("values") > 1) & (F.col("rows") >= least)).select(group, "rows", "values", "majority", F.round(F.col("_most") / F.col("rows"), 4).alias("majority_share"))


def status_counts(df: DataFrame, key: str, year: str, status: str, years: Sequence[int], names: Sequence[str]) -> DataFrame:
    """How many of the fixed years of each key have each status, and how many are missing."""
    rows = df.where(F.col(year).isin(*years)).groupBy(key, year).agg(F.min(status).alias("_s"))
    counts = rows.groupBy(key).agg(*(F.count_if(F.col("_s") == s).alias(f"n_{s}") for s in names), F.count("*").alias("_n"))
    return df.select(key).distinct().join(counts, key, "left").select(key, *(F.coalesce(f"n_{s}", F.lit(0)).alias(f"n_{s}") for s in names), (F.lit(len(years)) - F.coalesce("_n", F.lit(0))).alias("missing"))


def waterfall(df: DataFrame, steps: Sequence[tuple[str, Column]], key: str) -> DataFrame:
    """Distinct keys that are left after each step, the steps' conditions adding up; one pass over the rows."""
    kept, columns = F.lit(True), []
    for name, rule in steps:
        kept = kept & rule
        columns.append((name, kept))
    keys = df.groupBy(key).agg(*(F.max(c.cast("int")).alias(f"_{i}") for i, (_, c) in enumerate(columns)))
    totals = keys.agg(*(F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(columns))))
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(name).alias("name"), F.col(f"_{i}").alias("keys")) for i, (name, _) in enumerate(columns)])
    return totals.select(F.inline(rows))


def open_labels(rows: DataFrame, label: str, signal: str, definition: str, most: int = 5) -> DataFrame:
    """Each label's count, mean signal and its `most` most frequent definitions (ties by text)."""
    totals = rows.groupBy(label).agg(F.count("*").alias("count"), F.round(F.avg(signal), 3).alias("mean_signal"))
    counts = rows.groupBy(label, definition).agg(F.count("*").alias("_c"))
    place = F.row_number().over(Window.partitionBy(label).orderBy(F.desc("_c"), definition))
    top = counts.withColumn("_place", place).where(F.col("_place") <= most).groupBy(label).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", definition))), lambda x: x[definition]), ",").alias("definitions"))
    return totals.join(top, label)


def grouped_cells(cells: DataFrame, groups: dict[str, str], row: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Heatmap cells summed by the group of their row; rows without a group stay as they are."""
    table = F.create_map(*[F.lit(x) for kv in groups.items() for x in kv])
    return cells.groupBy(F.coalesce(F.try_element_at(table, F.col(row)), F.col(row)).alias(row), *by).agg(F.sum(value).alias(value))


def token_estimate(sizes: DataFrame, chars: str, known: Column, tokens: Column, by: Sequence[str] = ()) -> DataFrame:
    """Tokens of known rows, and of all rows at the known ratio of tokens to characters."""
    got, part = F.sum(F.when(known, tokens)), F.sum(F.when(known, F.col(chars)))
    return sizes.groupBy(*by).agg(
        F.sum(chars).alias("chars"), F.coalesce(got, F.lit(0)).alias("known_tokens"), F.when(part > 0, F.round(F.sum(chars) * got / part, 4)).otherwise(0.0).alias("estimated_tokens")
    )


def expected_counts(df: DataFrame, group: str, key: str, expected: dict[str, int]) -> DataFrame:
    """Rows and repeated keys of each group, and whether it has as many rows as expected."""
    table = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    rows = df.groupBy(group, key).agg(F.count("*").alias("_c")).groupBy(group).agg(F.sum("_c").alias("rows"), F.count_if(F.col("_c") > 1).alias("repeated_keys"))
    want = F.try_element_at(table, F.col(group))
    return rows.withColumn("status", F.when(want.isNull(), "unknown").when(F.col("rows") == want, "ok").otherwise("count_differs"))


def issues(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds the names of the rules each row breaks (comma-joined, in order) and their number."""
    found = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))
    return df.withColumn("issues", F.array_join(found, ",")).withColumn("n_issues", F.size(found))
