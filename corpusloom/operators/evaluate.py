"""Agreement between two label sets. A pair row has: id, truth and guess (arrays of strings), and optionally confidences (map of the guess)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import at_least
from ..functions.text import jaccard


def thresholds(pairs: DataFrame, levels: Sequence[float]) -> DataFrame:
    """Each pair at each confidence level, its guess cut to labels with at least that confidence."""
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), at_least(F.col("guess"), F.col("confidences"), t).alias("guess_at")) for t in levels])
    return pairs.select("id", "truth", F.inline(rows)).withColumnRenamed("guess_at", "guess")


def label_metrics(pairs: DataFrame, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """True and false positives, false negatives, precision, recall and F1 (4 digits, 0 without a base) of each label."""
    names = F.explode(F.array(*[F.lit(x) for x in labels])).alias("label")
    rows = pairs.select(*by, "truth", "guess", names)
    t, g = F.array_contains("truth", F.col("label")), F.array_contains("guess", F.col("label"))
    n = rows.groupBy(*by, "label").agg(F.count_if(t & g).alias("tp"), F.count_if(~t & g).alias("fp"), F.count_if(t & ~g).alias("fn"))
    p = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    r = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    f = F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0)
    return n.select(*by, "label", "tp", "fp", "fn", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(f, 4).alias("f1"))


def mean_jaccard(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pairs.groupBy(*by).agg(F.count("*").alias("pairs"), F.round(F.avg(jaccard(F.col("truth"), F.col("guess"))), 4).alias("mean_jaccard"))


def confusion(rows: DataFrame, truth: str, guess: str, classes: Sequence[str]) -> DataFrame:
    """Counts of guesses by truth, with the row's total and its agreement in percent."""
    cells = [F.count_if(F.col(guess) == c).alias(f"guess_{c}") for c in classes]
    out = rows.where(F.col(truth).isin(*classes)).groupBy(F.col(truth).alias("truth")).agg(*cells, F.count("*").alias("total"), F.count_if(F.col(truth) == F.col(guess)).alias("agree"))
    return out.withColumn("agreement", F.round(100.0 * F.col("agree") / F.col("total"), 4)).drop("agree")


def divergence(pairs: DataFrame, most: int = 3) -> DataFrame:
    """Histogram of how many labels stand on one side only, the last bucket open."""
    apart = F.size(F.array_except("truth", "guess")) + F.size(F.array_except("guess", "truth"))
    bucket = F.when(apart >= most, F.lit(f"{most}+")).otherwise(apart.cast("string"))
    return pairs.groupBy(bucket.alias("differing")).agg(F.count("*").alias("pairs"))


def match_class(a: Column, b: Column) -> Column:
    same = F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))
    return F.when(same, "EXACT").when(F.arrays_overlap(a, b), "PARTIAL").otherwise("DIFF")


def match_tally(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(match_class(F.col("truth"), F.col("guess")).alias("match")).agg(F.count("*").alias("pairs"))


def transitions(pairs: DataFrame) -> DataFrame:
    """Labels added, labels removed, and plain changes from one single label to another."""
    added = F.transform(F.array_except("guess", "truth"), lambda x: F.struct(F.lit("added").alias("kind"), x.alias("label")))
    removed = F.transform(F.array_except("truth", "guess"), lambda x: F.struct(F.lit("removed").alias("kind"), x.alias("label")))
    single = (F.size("truth") == 1) & (F.size("guess") == 1) & (F.get("truth", F.lit(0)) != F.get("guess", F.lit(0)))
    change = F.struct(F.lit("changed").alias("kind"), F.concat_ws(" -> ", F.get("truth", F.lit(0)), F.get("guess", F.lit(0))).alias("label"))
    rows = F.concat(added, removed, F.when(single, F.array(change)).otherwise(F.array().cast("array<struct<kind:string,label:string>>")))
    return pairs.select(F.inline(rows)).groupBy("kind", "label").agg(F.count("*").alias("pairs"))


def confidence_difference(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Mean absolute difference of two confidence maps over the labels that both have."""
    shared = F.explode(F.array_intersect(F.map_keys(a), F.map_keys(b)))
    rows = pairs.select(a, b, shared.alias("label"))
    gap = F.abs(F.element_at(a, F.col("label")) - F.element_at(b, F.col("label")))
    return rows.groupBy("label").agg(F.count("*").alias("pairs"), F.round(F.avg(gap), 4).alias("mean_difference"))


def consistency(answers: DataFrame, key: str, answer: str) -> DataFrame:
    """Of repeated answers: how many, how many different ones, and the share of the most frequent."""
    counts = answers.groupBy(key, answer).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.sum("n").alias("runs"), F.count("*").alias("distinct_answers"), F.round(F.max("n") / F.sum("n"), 4).alias("modal_share"))
