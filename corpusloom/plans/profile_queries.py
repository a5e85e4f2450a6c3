"""Statistics, coverage and consistency queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cube, findings, profile
from .base import FILINGS_SQL, REPORTS_SQL, filings, reports
from .registry import query, table


@query("""WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents WHERE n_chars IS NOT NULL)
SELECT lang, max(n) AS n, max(n_chars) FILTER (WHERE i = round_even((n - 1) * 0.1, 0)) AS p10, max(n_chars) FILTER (WHERE i = round_even((n - 1) * 0.5, 0)) AS p50, max(n_chars) FILTER (WHERE i = round_even((n - 1) * 0.9, 0)) AS p90 FROM r GROUP BY lang""")
def nearest_rank_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.nearest_rank(table(spark, sf_dir, "documents", "lang", "n_chars"), "n_chars", (0.1, 0.5, 0.9), ["lang"])


@query("""SELECT source, CAST(count(*) AS BIGINT) AS chunks, round(avg(length(text)), 4) AS mean_length, max(length(text)) AS max_length, round(count(*) FILTER (WHERE length(text) < 300) / count(*), 4) AS short_rate,
 round(count(*) FILTER (WHERE length(text) > 3000) / count(*), 4) AS long_rate, round((count(*) - count(DISTINCT text)) / count(*), 4) AS duplicate_rate FROM documents WHERE text IS NOT NULL GROUP BY source""")
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.chunk_stats(table(spark, sf_dir, "documents", "source", "text").where("text is not null"), "text", 300, 3000, ["source"])


@query("""SELECT l_returnflag AS classifier, count(*) AS results, count(*) FILTER (WHERE l_tax < 0.08) AS successes, round(avg(l_discount * 10) FILTER (WHERE l_tax < 0.08), 4) AS mean_confidence,
 count(*) FILTER (WHERE l_tax < 0.08 AND l_discount * 10 < 0.7) AS low_confidence FROM lineitem GROUP BY 1""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_returnflag", "l_discount", "l_tax").withColumnRenamed("l_returnflag", "classifier")
    return profile.run_summary(lines, F.col("l_discount") * 10, F.col("l_tax") >= 0.08, ["classifier"])


@query("SELECT l_suppkey AS supplier, round(coalesce(avg(l_discount) FILTER (WHERE l_discount > 0), 0.0), 6) AS mean_confidence, count(*) AS rows FROM lineitem GROUP BY 1")
def positive_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_suppkey", "l_discount")
    return lines.groupBy(F.col("l_suppkey").alias("supplier")).agg(F.round(profile.positive_mean(F.col("l_discount")), 6).alias("mean_confidence"), F.count("*").alias("rows"))


@query("SELECT p_brand AS brand, count(DISTINCT p_type) AS \"values\" FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part", "p_brand", "p_type").withColumnRenamed("p_brand", "brand")
    return profile.ambiguous(parts, "brand", "p_type")


@query("SELECT o_custkey AS owner, min(o_orderstatus) AS value FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1")
def unambiguous_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.unambiguous(table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus").withColumnRenamed("o_custkey", "owner"), "owner", "o_orderstatus")


@query("""WITH n AS (SELECT o_custkey AS owner, o_orderstatus AS s, count(*) AS c FROM orders GROUP BY ALL)
SELECT owner, CAST(sum(c) AS BIGINT) AS rows, count(*) AS "values", arg_max(s, (c, -ascii(s))) AS majority, round(max(c) / sum(c), 4) AS majority_share FROM n GROUP BY owner HAVING count(*) > 1 AND sum(c) >= 8""")
def inconsistent_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus").withColumnRenamed("o_custkey", "owner")
    return profile.inconsistent_groups(orders, "owner", "o_orderstatus", 8)


@query(f"""WITH {FILINGS_SQL}, y AS (SELECT owner, year, min(kind) AS s FROM filings WHERE year IN (1996, 1997, 1998) GROUP BY ALL), c AS (SELECT owner, count(*) FILTER (WHERE s = 'F') AS f, count(*) FILTER (WHERE s = 'O') AS o, count(*) AS n FROM y GROUP BY owner)
SELECT a.owner, coalesce(f, 0) AS "n_F", coalesce(o, 0) AS "n_O", 3 - coalesce(n, 0) AS missing FROM (SELECT DISTINCT owner FROM filings) a LEFT JOIN c ON c.owner = a.owner""")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.status_counts(filings(spark, sf_dir), "owner", "year", "kind", (1996, 1997, 1998), ("F", "O"))


_STEPS = ("true", "size > 1000", "kind = 'F'", "priority = '1-URGENT'")


@query(f"""WITH {FILINGS_SQL} SELECT 0 AS step, 'all' AS name, count(DISTINCT owner) AS keys FROM filings UNION ALL SELECT 1, 'large', count(DISTINCT owner) FROM filings WHERE size > 1000
 UNION ALL SELECT 2, 'final', count(DISTINCT owner) FROM filings WHERE size > 1000 AND kind = 'F' UNION ALL SELECT 3, 'urgent', count(DISTINCT owner) FROM filings WHERE size > 1000 AND kind = 'F' AND priority = '1-URGENT'""")
def coverage_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = list(zip(("all", "large", "final", "urgent"), map(F.expr, _STEPS), strict=True))
    return profile.waterfall(filings(spark, sf_dir), steps, "owner")


@query("""WITH r AS (SELECT l_returnflag || l_linestatus AS label, l_quantity AS signal, 'd' || (l_linenumber % 6) AS definition FROM lineitem), n AS (SELECT label, definition, count(*) AS c FROM r GROUP BY ALL),
 t AS (SELECT label, definition, row_number() OVER (PARTITION BY label ORDER BY c DESC, definition) AS p FROM n)
SELECT r.label, count(*) AS count, round(avg(signal), 3) AS mean_signal, (SELECT string_agg(definition, ',' ORDER BY p) FROM t WHERE t.label = r.label AND p <= 5) AS definitions FROM r GROUP BY r.label""")
def open_label_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_linenumber")
    rows = lines.select(F.concat("l_returnflag", "l_linestatus").alias("label"), F.col("l_quantity").alias("signal"), F.concat(F.lit("d"), (F.col("l_linenumber") % 6).cast("string")).alias("definition"))
    return profile.open_labels(rows, "label", "signal", "definition")


@query(f"""WITH {REPORTS_SQL} SELECT label, CASE WHEN sector IN ('AUTOMOBILE', 'MACHINERY') THEN 'engines' WHEN sector = 'BUILDING' THEN 'property' ELSE sector END AS sector, CAST(count(*) AS BIGINT) AS reports
FROM (SELECT sector, unnest(labels) AS label FROM reports) GROUP BY ALL""")
def grouped_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cube.label_by(reports(spark, sf_dir), "sector")
    return profile.grouped_cells(cells, {"AUTOMOBILE": "engines", "MACHINERY": "engines", "BUILDING": "property"}, "sector", "reports", ["label"])


@query("""SELECT lang, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(coalesce(sum(CASE WHEN doc_id % 2 = 0 THEN length(text) // 4 END), 0) AS BIGINT) AS known_tokens,
 round(sum(n_chars) * sum(CASE WHEN doc_id % 2 = 0 THEN length(text) // 4 END) / sum(CASE WHEN doc_id % 2 = 0 THEN n_chars END), 4) AS estimated_tokens FROM documents GROUP BY lang""")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "n_chars", "text")
    return profile.token_estimate(docs, "n_chars", F.col("doc_id") % 2 == 0, F.floor(F.length("text") / 4), ["lang"])


@query("""WITH n AS (SELECT c_mktsegment AS sector, c_nationkey, count(*) AS c FROM customer GROUP BY ALL)
SELECT sector, CAST(sum(c) AS BIGINT) AS rows, count(*) FILTER (WHERE c > 1) AS repeated_keys, CASE WHEN sector NOT IN ('BUILDING', 'MACHINERY') THEN 'unknown' WHEN sum(c) = 250 THEN 'ok' ELSE 'count_differs' END AS status FROM n GROUP BY sector""")
def segment_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = table(spark, sf_dir, "customer", "c_mktsegment", "c_nationkey").withColumnRenamed("c_mktsegment", "sector")
    return profile.expected_counts(owners, "sector", "c_nationkey", {"BUILDING": 250, "MACHINERY": 250})


@query(f"""WITH {REPORTS_SQL}, x AS (SELECT year, len(labels) AS n FROM reports) SELECT year, CAST(sum(n) AS BIGINT) AS assignments, count(*) FILTER (WHERE n > 0) AS reporting,
 CASE WHEN count(*) FILTER (WHERE n > 0) > 0 THEN round(sum(n) / count(*) FILTER (WHERE n > 0), 4) ELSE 0.0 END AS per_report FROM x GROUP BY year""")
def labels_per_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size("labels")
    rows = reports(spark, sf_dir).groupBy("year").agg(F.sum(n).alias("assignments"), F.count_if(n > 0).alias("reporting"))
    return rows.withColumn("per_report", F.when(F.col("reporting") > 0, F.round(F.col("assignments") / F.col("reporting"), 4)).otherwise(0.0))


@query(f"""WITH {REPORTS_SQL} SELECT sector, round(100.0 * count(*) FILTER (WHERE list_contains(labels, 'R')) / count(*), 4) AS lifetime,
 CASE WHEN count(*) FILTER (WHERE year = 1998) > 0 THEN round(100.0 * count(*) FILTER (WHERE year = 1998 AND list_contains(labels, 'R')) / count(*) FILTER (WHERE year = 1998), 4) ELSE 0.0 END AS current FROM reports GROUP BY sector""")
def lifetime_and_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    risky, now = F.array_contains("labels", "R"), F.col("year") == 1998
    rows = reports(spark, sf_dir).groupBy("sector").agg(F.count("*").alias("n"), F.count_if(risky).alias("r"), F.count_if(now).alias("n1"), F.count_if(now & risky).alias("r1"))
    share = lambda a, b: F.when(F.col(b) > 0, F.round(100.0 * F.col(a) / F.col(b), 4)).otherwise(0.0)
    return rows.select("sector", share("r", "n").alias("lifetime"), share("r1", "n1").alias("current"))


@query("""WITH n AS (SELECT p_brand AS sector, p_type AS label, count(*) AS n FROM part GROUP BY ALL), s AS (SELECT *, sum(n) OVER (PARTITION BY sector) AS t FROM n)
SELECT sector, CAST(sum(n) AS BIGINT) AS total, round(100.0 * sum(CASE WHEN label = 'PROMO' THEN n ELSE 0 END) / any_value(t), 4) AS opacity, CAST(sum(CASE WHEN label <> 'PROMO' THEN n ELSE 0 END) AS BIGINT) AS named FROM s GROUP BY sector""")
def opacity_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a group falls on a label that says nothing, and what is left when it is set aside."""
    hidden = F.col("p_type") == "PROMO"
    rows = table(spark, sf_dir, "part", "p_brand", "p_type").groupBy(F.col("p_brand").alias("sector")).agg(F.count("*").alias("total"), F.count_if(hidden).alias("h"))
    return rows.select("sector", "total", F.round(100.0 * F.col("h") / F.col("total"), 4).alias("opacity"), (F.col("total") - F.col("h")).alias("named"))


@query(f"""WITH {REPORTS_SQL}, n AS (SELECT year, label, count(*) AS reports FROM (SELECT year, unnest(labels) AS label FROM reports) GROUP BY ALL)
SELECT year, label, reports, reports - coalesce(lag(reports) OVER (PARTITION BY label ORDER BY year), 0) AS change FROM n""")
def label_change_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = findings.year_on_year(cube.label_by(reports(spark, sf_dir), "year"), "reports", ["label"])
    return rows.select("year", "label", "reports", (F.col("reports") - F.coalesce("previous", F.lit(0))).alias("change"))


@query("""WITH f AS (SELECT source, sha256(text) AS h, count(*) AS c FROM documents WHERE text IS NOT NULL GROUP BY ALL) SELECT source, count(*) AS distinct_texts, CAST(sum(c) AS BIGINT) AS documents, max(c) AS most_copies FROM f GROUP BY source""")
def copies_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "source", "text").where("text is not null")
    same = docs.groupBy("source", F.sha2("text", 256).alias("h")).agg(F.count("*").alias("c"))
    return same.groupBy("source").agg(F.count("*").alias("distinct_texts"), F.sum("c").alias("documents"), F.max("c").alias("most_copies"))
