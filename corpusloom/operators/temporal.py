"""Order and time: gaps, clusters, collisions, interval merging, carried headings and the fiscal-year cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fiscal_year, period_end


def gap_years(df: DataFrame, key: str, year: str = "year") -> DataFrame:
    """Years between a key's first and last that it has no row for."""
    have = df.groupBy(key).agg(F.array_distinct(F.collect_list(year)).alias("_have"))  # a key has few distinct years
    return have.select(key, F.explode(F.array_except(F.sequence(F.array_min("_have"), F.array_max("_have")), "_have")).alias("gap_year"))


def clusters(df: DataFrame, key: str, date: str, days: int = 90, tie: str = "id") -> DataFrame:
    """Adds `cluster` (from 1): a new one starts when the gap to the row before is `days` or more."""
    order = Window.partitionBy(key).orderBy(date, tie)
    starts = F.coalesce((F.datediff(F.col(date), F.lag(date).over(order)) >= days).cast("int"), F.lit(1))
    return df.withColumn("_new", starts).withColumn("cluster", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def cluster_summary(df: DataFrame, key: str, value: str, confidence: str) -> DataFrame:
    """Each cluster's most confident value, and whether its members disagree."""
    return df.groupBy(key, "cluster").agg(
        F.count("*").alias("members"),
        F.max_by(value, F.struct(F.col(confidence), -F.col(value))).alias("best_value"),
        (F.count_distinct(value) > 1).alias("conflict"),
    )


def collisions(df: DataFrame, key: str) -> DataFrame:
    """Severity of a key's missing years from the neighbouring year's row (key, year, title_year, candidates)."""
    gaps = gap_years(df, key)
    near = df.select(key, F.col("year").alias("_at"), (F.col("year") - F.col("title_year")).alias("lag"), "candidates")
    sides = gaps.select(key, "gap_year", F.explode(F.array(F.struct((F.col("gap_year") + 1).alias("_at"), F.lit("next").alias("side")), F.struct((F.col("gap_year") - 1).alias("_at"), F.lit("prev").alias("side")))).alias("_x")).select(key, "gap_year", "_x.*")
    rows = sides.join(near, [key, "_at"])
    far, many = F.col("lag") >= 2, F.col("candidates") > 1
    severity = F.when(far & many, "CONFIRMED").when(many, "LIKELY").when(far, "POSSIBLE").when((F.col("lag") == 0) & (F.col("side") == "prev"), "PATTERN")
    return rows.withColumn("severity", severity).where(F.col("severity").isNotNull()).select(key, "gap_year", "side", "severity")


def merged_intervals(df: DataFrame, key: str, start: str, end: str, adjacent: bool = False) -> DataFrame:
    """Overlapping intervals of a key joined; with adjacent, also those that only follow each other without a hole."""
    order = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.col(start) > reach + 1) if adjacent else (F.col(start) >= reach)
    rows = df.withColumn("_new", F.coalesce(apart.cast("int"), F.lit(1))).withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "_island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("parts")).drop("_island")


def carried(df: DataFrame, key: str, order: str, heading: str) -> DataFrame:
    """Adds `section`, the last heading before or at each row."""
    return df.withColumn("section", F.last(heading, ignorenulls=True).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def context(df: DataFrame, key: str, order: str, text: str, before: int = 2, after: int = 2) -> DataFrame:
    """Adds the texts of the rows before and after, clipped to the group."""
    own = Window.partitionBy(key).orderBy(order)
    return df.withColumn("context_before", F.collect_list(text).over(own.rowsBetween(-before, -1))).withColumn("context_after", F.collect_list(text).over(own.rowsBetween(1, after)))


def fiscal_cascade(df: DataFrame, title: str, released: str, document_year: str | None = None) -> DataFrame:
    """Adds fy, confidence, fy_source and anomaly: the document's own year, else the title's period end (a release before it means the year before, as an anomaly), else the title's year, else the release date."""
    end, year, release = period_end(F.col(title)), fiscal_year(F.col(title)), F.col(released)
    answer = lambda y, c, s, a=None: F.struct(y.cast("int").alias("fy"), F.lit(c).alias("confidence"), F.lit(s).alias("fy_source"), F.lit(a).cast("string").alias("anomaly"))
    steps = []
    if document_year:
        steps.append(F.when(F.col(document_year).between(2015, 2030), answer(F.col(document_year), "HIGH", "document")))
    steps += [
        F.when(end.isNotNull() & (release < end), answer(F.year(end) - 1, "HIGH", "title_date", "ANOMALY_PUB_BEFORE_END")),
        F.when(end.isNotNull(), answer(F.year(end), "HIGH", "title_date")),
        F.when(year.isNotNull(), answer(year, "MEDIUM", "title_year")),
        F.when(F.month(release) <= 4, answer(F.year(release) - 1, "MEDIUM", "release_early")),
        F.when(release.isNotNull(), answer(F.year(release), "LOW", "release")),
    ]
    return df.withColumn("_fy", F.coalesce(*steps, answer(F.lit(None), "LOW", "none"))).select("*", "_fy.*").drop("_fy")


CONFIDENCE = ("LOW", "MEDIUM", "HIGH")


def propagated(df: DataFrame, key: str, released: str, item: str, days: int = 90) -> DataFrame:
    """The cascade's answers (fy, confidence, fy_source, anomaly) after each cluster of a key's releases has been looked at as one.

    A cluster whose members name several years is an anomaly of all of them. Otherwise members less sure than its surest one (the
    first of them) take over that one's year, confidence and source.
    """
    rows = clusters(df, key, released, days, item)
    own = Window.partitionBy(key, "cluster")
    rank = F.array_position(F.array(*map(F.lit, CONFIDENCE)), F.coalesce("confidence", F.lit(CONFIDENCE[0])))
    rows = rows.withColumn("_rank", rank).withColumn("_at", F.row_number().over(own.orderBy(released, item)))
    best = F.max_by(F.struct("fy", "confidence", "fy_source", "_rank"), F.struct("_rank", -F.col("_at"))).over(own)
    rows = rows.withColumn("_best", best).withColumn("_years", F.size(F.collect_set("fy").over(own)))
    torn, taken = F.col("_years") > 1, (F.col("_years") <= 1) & (F.col("_rank") < F.col("_best._rank"))
    answer = {
        "fy": F.when(taken, F.col("_best.fy")).otherwise(F.col("fy")), "confidence": F.when(taken, F.col("_best.confidence")).otherwise(F.col("confidence")),
        "fy_source": F.when(taken, F.concat(F.lit("cluster_propagated("), F.col("_best.fy_source"), F.lit(")"))).otherwise(F.col("fy_source")), "anomaly": F.when(torn, "ANOMALY_CLUSTER").otherwise(F.col("anomaly")),
    }
    return rows.withColumns(answer).drop("_rank", "_at", "_best", "_years")


def outcomes(df: DataFrame, manifest: str) -> DataFrame:
    """Rows that need something: `qa` for every anomaly, `correction` for a sure enough year other than the manifest's."""
    sure = F.col("fy").isNotNull() & ~F.col("fy").eqNullSafe(F.col(manifest)) & F.col("confidence").isin(*CONFIDENCE[1:])
    return df.withColumn("outcome", F.when(F.col("anomaly").isNotNull(), "qa").when(sure, "correction")).where("outcome is not null")
