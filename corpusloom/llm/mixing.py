"""Mixing sources to target weights, with DataFrame functions only.

Each source gets a share of the wished total in proportion to its weight, but at most `most`
times its own size; what it can't take is shared again by weight until no source is above. The
end of that resharing is found directly: targets are min(level * weight, most * size), and the
level is where they add up to the total, read from running sums over the sources in order of
most * size / weight.

Inside a source, whole epochs come first: every document is taken floor(target / size of source)
times. The rest of the target is filled by Efraimidis-Spirakis sampling without replacement:
each document draws the exponential key -ln(u) / quality weight, u from a hash of its id and the
seed; documents are taken in rising key order while the running sum of their sizes stays
nearest to the rest. The running sum is two-level (key ranges first, then inside a range), so
a source that holds a third of all rows is spread over many tasks.

Quality weight: 0.1 plus the share of letters and spaces in the text, so that markup, tables and
symbol noise are drawn later. An own weight column can be named instead.

Cases: a null text has size 0 and is never needed for a target (taken 0). A null source is a
source of its own, ordered last. Repeated rows draw the same key, and are put in order by id and
size, so that reruns agree on how many of them are taken. Null ids draw as one id. Null,
non-positive or non-finite own weights count as 1e-6. A table whose sizes are all 0 gets targets
and takes of 0; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, running, table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BUCKETS = 1024
SEED = 17


def words(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: Column) -> Column:
    """0.1 to 1.1: 0.1 plus the share of letters and single spaces or line ends among the code points."""
    noise = F.length(F.regexp_replace(text, r"[\p{L} \n]+", ""))
    return F.lit(1.1) - F.coalesce(noise / F.greatest(F.length(text), F.lit(1)), F.lit(1.0))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds `target` to one row for each source (s_null, s_name, source_size)."""
    place = F.row_number().over(Window.orderBy("s_null", "s_name")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    df = sizes.withColumn("_w", weight).withColumn("_cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "s_null", "s_name")
    everything = Window.partitionBy()
    df = df.withColumns(
        {
            "_full": F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "_open": F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)),
            "_total": share * F.sum("source_size").over(everything),
        }
    )
    # while this source and the later ones share what the earlier ones leave, does this one stay under its cap?
    # the first that does has the level; later ones that do have a lower one
    level = (F.col("_total") - F.col("_full")) / F.col("_open")
    df = df.withColumn("_level", F.when(level * F.col("_w") <= F.col("_cap"), level))
    level = F.coalesce(F.max("_level").over(everything), F.lit(float("inf")))
    return df.withColumn("target", F.least(level * F.col("_w"), F.col("_cap"))).drop("_w", "_cap", "_full", "_open", "_total", "_level")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, weight_col: str | None = None) -> DataFrame:
    """doc_id, size, s_name, source_size, target, times and taken of every row of docs (doc_id, text, source)."""
    own = F.col(weight_col).cast("double") if weight_col else text_quality(F.col("text"))
    own = F.when((own > 0) & ~F.isnan(own) & (own < float("inf")), own).otherwise(F.lit(1e-6))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))), 1, 12), 16, 10)
    u = (draw.cast("double") + 0.5) / float(1 << 48)
    rows = cut(
        docs.select(
            "doc_id",
            F.col("source").isNull().alias("s_null"),
            F.coalesce("source", F.lit("")).alias("s_name"),
            words(F.col("text")).alias("size"),
            F.xxhash64("text").alias("text_hash"),
            (-F.log(u) / own).alias("key"),
        )
    )
    sizes = rows.groupBy("s_null", "s_name").agg(F.sum("size").alias("source_size"))
    sizes = source_targets(sizes, weights, share, most)
    whole = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    sizes = cut(sizes.withColumn("_epochs", whole).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size")))
    bucket = F.floor(BUCKETS * (1 - F.exp(-F.col("key")))).cast("int")
    ordered = running(rows, ["s_null", "s_name"], ["key", "doc_id", "size", "text_hash"], bucket, F.col("size"))
    taken_part = (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("_rest"))
    found = ordered.join(sizes, ["s_null", "s_name"]).withColumn("times", F.col("_epochs") + taken_part.cast("long"))
    return found.withColumn("taken", F.col("times") * F.col("size")).select("doc_id", "text_hash", "size", F.when(~F.col("s_null"), F.col("s_name")).alias("source"), "source_size", "target", "times", "taken", "key")


#: The same mix in DuckDB's SQL: one pass over the sources for the level, one running sum for the draws.
SQL = f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
  1.1 - CASE WHEN text IS NULL THEN 1.0 ELSE length(regexp_replace(text, '[\\p{{L}} \\n]+', '', 'g')) / greatest(length(text), 1) END AS own,
  (CAST(CAST('0x' || substr(md5(concat_ws(':', {SEED}, doc_id)), 1, 12) AS UBIGINT) AS DOUBLE) + 0.5) / {1 << 48}.0 AS u FROM documents),
 z AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
 w AS (SELECT *, [5.0, 2.0, 1.0][i % 3 + 1] AS weight, {MOST} * source_size AS cap FROM z),
 o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
  sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_, {SHARE} * sum(source_size) OVER () AS total FROM w),
 v AS (SELECT coalesce(max((total - full_) / open_) FILTER (WHERE (total - full_) / open_ * weight <= cap), 'inf'::DOUBLE) AS level FROM o),
 t AS (SELECT source, source_size, least(level * weight, cap) AS target FROM o CROSS JOIN v),
 r AS (SELECT d.*, source_size, target, coalesce(floor(target / nullif(source_size, 0)), 0) AS epochs,
  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / own, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source, CAST(source_size AS BIGINT) AS source_size, target,
 CAST(size * (epochs + CASE WHEN size > 0 AND before + size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r"""


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source", "source_size", "target", "taken")
