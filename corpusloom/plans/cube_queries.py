"""Cube, evaluation and findings queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import BANDS, GOVERNANCE, MATERIALITY, has_bit, lookup, ratio, review_priority, signal_level, substantiveness, unit
from ..operators import cube, evaluate, findings
from .base import LABELS, NONE, PAIRS_SQL, REPORTS_SQL, RISK, SIGNALS_SQL, pairs, reports, signals
from .registry import query, table

SECTORS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_COUNTS = ", ".join(f"count(*) FILTER (WHERE list_contains(labels, '{v}')) AS label_{v}" for v in LABELS)


@query(f"WITH {REPORTS_SQL} SELECT year, {_COUNTS} FROM reports GROUP BY year")
def label_trend_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.label_trend(reports(spark, sf_dir), "year", LABELS)


@query(f"WITH {REPORTS_SQL} SELECT month, {_COUNTS} FROM reports GROUP BY month")
def label_trend_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.label_trend(reports(spark, sf_dir), "month", LABELS)


@query(f"WITH {REPORTS_SQL} SELECT label, sector, count(*) AS reports FROM (SELECT sector, unnest(labels) AS label FROM reports) GROUP BY ALL")
def label_by_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.label_by(reports(spark, sf_dir), "sector")


@query(f"WITH {REPORTS_SQL} SELECT label, sector, year, count(*) AS reports FROM (SELECT sector, year, unnest(labels) AS label FROM reports) GROUP BY ALL")
def label_by_sector_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.label_by(reports(spark, sf_dir), "sector", "year")


@query(f"""WITH {SIGNALS_SQL}, frame AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT f.year, l.level, count(n.report) AS signals FROM frame f CROSS JOIN (VALUES ('strong'), ('medium'), ('weak')) l(level)
LEFT JOIN named n ON n.year = f.year AND n.level = l.level GROUP BY ALL""")
def signal_level_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "orders", "o_orderdate").select(F.year("o_orderdate").alias("year"))
    return cube.signal_heatmap(signals(spark, sf_dir), years)


@query(f"""WITH {SIGNALS_SQL}, n AS (SELECT report, year, count(*) FILTER (WHERE level = 'strong') AS s, count(*) FILTER (WHERE level = 'medium') AS m,
 count(*) FILTER (WHERE level = 'weak') AS w FROM named WHERE level IS NOT NULL GROUP BY ALL)
SELECT year, CASE WHEN s >= m AND s >= w THEN 'strong' WHEN m >= w THEN 'medium' ELSE 'weak' END AS band, count(*) AS reports FROM n GROUP BY ALL""")
def majority_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = signal_level(F.col("signal"))
    rows = signals(spark, sf_dir).select("report", "year", F.when(level >= 3, "strong").when(level >= 2, "medium").when(level >= 1, "weak").alias("band")).where("band is not null")
    return cube.majority_band(rows).groupBy("year", "band").agg(F.count("*").alias("reports"))


_BLIND = """count(*) AS reports, count(*) FILTER (WHERE len(list_filter(labels, lambda x: x <> 'N')) = 0) AS no_signal,
 count(*) FILTER (WHERE NOT list_contains(labels, 'R')) AS no_risk, count(*) FILTER (WHERE len(list_filter(labels, lambda x: x <> 'N')) > 0) AS with_signal,
 count(*) FILTER (WHERE list_contains(labels, 'R')) AS with_risk"""


@query(f"WITH {REPORTS_SQL} SELECT year, {_BLIND} FROM reports GROUP BY year")
def blind_spot_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.blind_spots(reports(spark, sf_dir), ["year"], RISK, NONE)


@query(f"WITH {REPORTS_SQL} SELECT month, {_BLIND} FROM reports GROUP BY month")
def blind_spot_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.blind_spots(reports(spark, sf_dir), ["month"], RISK, NONE)


@query(f"""WITH {REPORTS_SQL}, frame AS (SELECT * FROM (SELECT DISTINCT year FROM reports) CROSS JOIN (SELECT unnest({list(SECTORS)}) AS sector)),
 n AS (SELECT year, sector, {_BLIND} FROM reports GROUP BY ALL)
SELECT f.year, f.sector, coalesce(reports, 0) AS reports, coalesce(no_signal, 0) AS no_signal, coalesce(no_risk, 0) AS no_risk, coalesce(with_risk, 0) AS with_risk
FROM frame f LEFT JOIN n ON n.year = f.year AND n.sector = f.sector""")
def sector_year_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports(spark, sf_dir)
    frame = cube.scaffold(rows.select("year"), SECTORS, "sector")
    return cube.dense(frame, cube.blind_spots(rows, ["year", "sector"], RISK, NONE), ["year", "sector"], ["reports", "no_signal", "no_risk", "with_risk"])


@query(f"WITH {REPORTS_SQL} SELECT count(*) AS reports, count(DISTINCT owner) AS owners, count(*) FILTER (WHERE list_contains(labels, 'R')) AS with_risk FROM reports")
def summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).agg(F.count("*").alias("reports"), F.count_distinct("owner").alias("owners"), F.count_if(F.array_contains("labels", RISK)).alias("with_risk"))


_SLICE_SQL = f"""WITH {REPORTS_SQL}, sliced AS (
 SELECT *, unnest(list_filter(['all', CASE WHEN sector = 'AUTOMOBILE' THEN 'auto' END, CASE WHEN sector IN ('AUTOMOBILE', 'MACHINERY') THEN 'engines' END,
  CASE WHEN sector <> 'BUILDING' THEN 'other' END], lambda x: x IS NOT NULL)) AS slice FROM reports)"""


def _sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    sector = F.col("sector")
    rules = {"all": F.lit(True), "auto": sector == "AUTOMOBILE", "engines": sector.isin("AUTOMOBILE", "MACHINERY"), "other": sector != "BUILDING"}
    return cube.slices(reports(spark, sf_dir), rules)


@query(f"{_SLICE_SQL} SELECT slice, year, {_COUNTS} FROM sliced GROUP BY ALL")
def segment_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [F.count_if(F.array_contains("labels", v)).alias(f"label_{v}") for v in LABELS]
    return _sliced(spark, sf_dir).groupBy("slice", "year").agg(*counts)


@query(f"{_SLICE_SQL} SELECT slice, count(DISTINCT owner) AS owners, count(*) AS reports FROM sliced GROUP BY slice")
def segment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sliced(spark, sf_dir).groupBy("slice").agg(F.count_distinct("owner").alias("owners"), F.count("*").alias("reports"))


@query(f"WITH {REPORTS_SQL} SELECT sector, count(DISTINCT owner) AS owners FROM reports GROUP BY sector")
def owners_by_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).groupBy("sector").agg(F.count_distinct("owner").alias("owners"))


@query(f"""WITH {REPORTS_SQL}, f AS (SELECT len(list_filter(labels, lambda x: x <> 'N')) > 0 AS s, list_contains(labels, 'R') AS r FROM reports),
 t AS (SELECT count(*) AS n, count(*) FILTER (WHERE s) AS sig, count(*) FILTER (WHERE s AND r) AS risk FROM f)
SELECT node, parent, reports, CASE WHEN base > 0 THEN round(100.0 * reports / base, 4) ELSE 0.0 END AS percent FROM (
 SELECT 'all' AS node, 'all' AS parent, n AS reports, n AS base FROM t UNION ALL SELECT 'signal', 'all', sig, n FROM t UNION ALL SELECT 'silent', 'all', n - sig, n FROM t
 UNION ALL SELECT 'risk', 'signal', risk, sig FROM t UNION ALL SELECT 'other', 'signal', sig - risk, sig FROM t)""")
def classification_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.breakdown(reports(spark, sf_dir), RISK, NONE)


_FLOW_SQL = f"""WITH {REPORTS_SQL}, s AS (SELECT 'sector:' || sector AS a, 'signal:' || CASE WHEN len(list_filter(labels, lambda x: x <> 'N')) > 0 THEN 'yes' ELSE 'no' END AS b,
 'risk:' || CASE WHEN list_contains(labels, 'R') THEN 'yes' ELSE 'no' END AS c FROM reports),
 edges AS (SELECT source, target, count(*) AS reports FROM (SELECT a AS source, b AS target FROM s UNION ALL SELECT b, c FROM s) GROUP BY ALL)"""


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes = lambda c: F.when(c, "yes").otherwise("no")
    stages = [("sector", F.col("sector")), ("signal", yes(F.exists("labels", lambda x: x != NONE))), ("risk", yes(F.array_contains("labels", RISK)))]
    return cube.flow_edges(reports(spark, sf_dir), stages)


@query(f"{_FLOW_SQL} SELECT * FROM edges")
def flow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


@query(f"""{_FLOW_SQL} SELECT node, CAST(greatest(sum(o), sum(i)) AS BIGINT) AS reports FROM (SELECT source AS node, reports AS o, 0 AS i FROM edges UNION ALL SELECT target, 0, reports FROM edges) GROUP BY node""")
def flow_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.flow_nodes(_edges(spark, sf_dir))


_INDEX_SQL = f"""WITH {REPORTS_SQL}, idx AS (SELECT report, year, CAST(coalesce(nullif(list_position({list(SECTORS)}, sector), 0) - 1, -1) AS INTEGER) AS sector_index,
 CAST(CASE WHEN list_contains(labels, 'A') THEN 1 ELSE 0 END + CASE WHEN list_contains(labels, 'N') THEN 2 ELSE 0 END + CASE WHEN list_contains(labels, 'R') THEN 4 ELSE 0 END AS BIGINT) AS mask FROM reports)"""


@query(f"{_INDEX_SQL} SELECT * FROM idx")
def filter_index_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.filter_index(reports(spark, sf_dir), LABELS, SECTORS)


@query(f"""{_INDEX_SQL} SELECT year, count(*) FILTER (WHERE mask & 1 <> 0) AS label_A, count(*) FILTER (WHERE mask & 2 <> 0) AS label_N, count(*) FILTER (WHERE mask & 4 <> 0) AS label_R
FROM idx WHERE mask & 4 <> 0 AND sector_index IN (0, 4) GROUP BY year""")
def masked_refilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = cube.filter_index(reports(spark, sf_dir), LABELS, SECTORS)
    return cube.masked_trend(index, LABELS, has_bit(F.col("mask"), 2) & F.col("sector_index").isin(0, 4))


@query(f"""WITH {REPORTS_SQL}, n AS (SELECT label, sector, count(*) AS reports FROM (SELECT sector, unnest(labels) AS label FROM reports) GROUP BY ALL)
SELECT label, sector, reports, round(100.0 * reports / sum(reports) OVER (PARTITION BY sector), 4) AS percent FROM n""")
def percent_by_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.percent_of(cube.label_by(reports(spark, sf_dir), "sector"), ["sector"], "reports").select("label", "sector", "reports", "percent")


# firm-year roll-ups: a line's status stands for governance, its quantity for materiality
_ROLL_SQL = f"""WITH rows AS (SELECT o_custkey AS owner, CAST(year(o_orderdate) AS INTEGER) AS year, l_returnflag AS label,
 CASE o_orderstatus WHEN 'F' THEN 'advanced' WHEN 'O' THEN 'basic' ELSE 'none' END AS governance,
 CASE WHEN l_quantity >= 40 THEN 3 WHEN l_quantity >= 20 THEN 2 WHEN l_quantity >= 10 THEN 1 ELSE 0 END AS mat,
 CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 0.33 ELSE 0.0 END AS gov FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_quantity")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    status, q = F.col("o_orderstatus"), F.col("l_quantity")
    governance = F.when(status == "F", "advanced").when(status == "O", "basic").otherwise("none")
    material = F.when(q >= 40, "high").when(q >= 20, "medium").when(q >= 10, "low").otherwise("unspecified")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.col("o_custkey").alias("owner"), F.year("o_orderdate").alias("year"), F.col("l_returnflag").alias("label"), governance.alias("governance"), material.alias("materiality"))


@query(f"""{_ROLL_SQL}, n AS (SELECT owner, year, label, count(*) AS n FROM rows GROUP BY ALL), d AS (SELECT owner, year, arg_max(label, (n, -ascii(label))) AS dominant FROM n GROUP BY ALL)
SELECT r.owner, r.year, count(*) AS mentions, count(*) FILTER (WHERE label = 'R') AS risk_mentions, d.dominant,
 CASE max(gov) WHEN 1.0 THEN 'advanced' WHEN 0.33 THEN 'basic' ELSE 'none' END AS best_governance, round(count(*) FILTER (WHERE mat = 3) / count(*), 4) AS high_share
FROM rows r JOIN d ON d.owner = r.owner AND d.year = r.year GROUP BY r.owner, r.year, d.dominant""")
def firm_year_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are taken by label first, so both roll-ups share one small aggregate."""
    by_label = _mentions(spark, sf_dir).groupBy("owner", "year", "label").agg(
        F.count("*").alias("n"), F.max_by("governance", lookup(F.col("governance"), GOVERNANCE, 0.0)).alias("governance"), F.count_if(F.col("materiality") == "high").alias("high")
    )
    return by_label.groupBy("owner", "year").agg(
        F.sum("n").alias("mentions"),
        F.sum(F.when(F.col("label") == RISK, F.col("n")).otherwise(0)).alias("risk_mentions"),
        F.max_by("label", F.struct("n", -F.ascii("label"))).alias("dominant"),
        F.max_by("governance", lookup(F.col("governance"), GOVERNANCE, 0.0)).alias("best_governance"),
        F.round(F.sum("high") / F.sum("n"), 4).alias("high_share"),
    )


@query(f"""{_ROLL_SQL}, g AS (SELECT owner, year, CAST(sum(mat) FILTER (WHERE label = 'R') AS BIGINT) * (100 - CAST(round(100 * max(gov) FILTER (WHERE label = 'R')) AS BIGINT)) AS num, 300 * count(*) FILTER (WHERE label = 'R') AS den FROM rows GROUP BY ALL)
SELECT owner, year, CASE WHEN den > 0 THEN (num * 20000 + den) // (2 * den) / 10000.0 ELSE 0.0 END AS gap FROM g""")
def mitigation_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean severity over 3 times what governance leaves open, rounded half up to four decimals on whole numbers, so that no rounding edge depends on the order of sums."""
    rows = _mentions(spark, sf_dir)
    risky = F.col("label") == RISK
    severity = F.sum(F.when(risky, lookup(F.col("materiality"), MATERIALITY, 0)).cast("long"))
    open_part = 100 - F.round(100 * F.max(F.when(risky, lookup(F.col("governance"), GOVERNANCE, 0.0)))).cast("long")
    sums = rows.groupBy("owner", "year").agg((severity * open_part).alias("num"), (300 * F.count_if(risky)).alias("den"))
    return sums.select("owner", "year", F.when(F.col("den") > 0, F.expr("(num * 20000 + den) div (2 * den)") / 10000.0).otherwise(0.0).alias("gap"))


@query("""SELECT l_orderkey AS report, l_linenumber AS line, least(greatest(l_quantity / 50, 0.0), 1.0) AS unit_signal,
 CASE WHEN l_discount * 10 < 0.7 THEN 'high' WHEN l_discount * 10 < 0.85 THEN 'medium' ELSE 'low' END AS priority FROM lineitem""")
def signal_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return lines.select(F.col("l_orderkey").alias("report"), F.col("l_linenumber").alias("line"), unit(F.col("l_quantity"), 50.0).alias("unit_signal"), review_priority(F.col("l_discount") * 10).alias("priority"))


@query("""SELECT band, count(*) AS lines FROM (SELECT CASE WHEN l_quantity / 20 <= 1 THEN (CASE WHEN l_quantity / 20 >= 0.67 THEN 'substantive' WHEN l_quantity / 20 >= 0.34 THEN 'moderate' ELSE 'boilerplate' END)
 WHEN round_even(l_quantity / 20, 0) >= 3 THEN 'substantive' WHEN round_even(l_quantity / 20, 0) >= 2 THEN 'moderate' ELSE 'boilerplate' END AS band FROM lineitem) GROUP BY band""")
def substantiveness_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_quantity")
    return lines.groupBy(substantiveness(F.col("l_quantity") / 20).alias("band")).agg(F.count("*").alias("lines"))


# agreement
_METRICS = """round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 4) AS "precision", round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 4) AS recall,
 round(CASE WHEN tp > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 4) AS f1"""


@query(f"""WITH {PAIRS_SQL}, n AS (SELECT label, count(*) FILTER (WHERE in_truth = 1 AND in_guess = 1) AS tp, count(*) FILTER (WHERE in_truth = 0 AND in_guess = 1) AS fp,
 count(*) FILTER (WHERE in_truth = 1 AND in_guess = 0) AS fn FROM conf GROUP BY label) SELECT label, tp, fp, fn, {_METRICS} FROM n""")
def pr_f1_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.label_metrics(pairs(spark, sf_dir), LABELS)


@query(f"""WITH {PAIRS_SQL}, x AS (SELECT t AS threshold, label, in_truth = 1 AS a, in_guess = 1 AND (t <= 0 OR c >= t) AS b FROM conf CROSS JOIN (VALUES (0.0::DOUBLE), (0.3::DOUBLE), (0.6::DOUBLE)) v(t)),
 n AS (SELECT threshold, label, count(*) FILTER (WHERE a AND b) AS tp, count(*) FILTER (WHERE NOT a AND b) AS fp, count(*) FILTER (WHERE a AND NOT b) AS fn FROM x GROUP BY ALL)
SELECT threshold, label, tp, fp, fn, {_METRICS} FROM n""")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.label_metrics(evaluate.thresholds(pairs(spark, sf_dir), (0.0, 0.3, 0.6)), LABELS, ["threshold"])


@query(f"""WITH {PAIRS_SQL} SELECT count(*) AS pairs, round(avg(CASE WHEN len(list_distinct(list_concat(truth, guess))) > 0
 THEN len(list_intersect(truth, guess)) / len(list_distinct(list_concat(truth, guess))) ELSE 1.0 END), 4) AS mean_jaccard FROM pairs""")
def jaccard_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.mean_jaccard(pairs(spark, sf_dir))


@query("""WITH x AS (SELECT CASE WHEN n_chars >= 2000 THEN 'long' WHEN n_chars >= 600 THEN 'middle' ELSE 'short' END AS truth,
 CASE WHEN len(regexp_extract_all(text, '\\S+')) >= 320 THEN 'long' WHEN len(regexp_extract_all(text, '\\S+')) >= 90 THEN 'middle' ELSE 'short' END AS guess FROM documents)
SELECT truth, count(*) FILTER (WHERE guess = 'long') AS guess_long, count(*) FILTER (WHERE guess = 'middle') AS guess_middle, count(*) FILTER (WHERE guess = 'short') AS guess_short,
 count(*) AS total, round(100.0 * count(*) FILTER (WHERE guess = truth) / count(*), 4) AS agreement FROM x GROUP BY truth""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, words = F.col("n_chars"), F.regexp_count("text", F.lit(r"\S+"))
    rows = table(spark, sf_dir, "documents", "n_chars", "text").select(
        F.when(n >= 2000, "long").when(n >= 600, "middle").otherwise("short").alias("truth"), F.when(words >= 320, "long").when(words >= 90, "middle").otherwise("short").alias("guess")
    )
    return evaluate.confusion(rows, "truth", "guess", ("long", "middle", "short"))


@query(f"""WITH {PAIRS_SQL}, d AS (SELECT len(list_filter(truth, lambda x: NOT list_contains(guess, x))) + len(list_filter(guess, lambda x: NOT list_contains(truth, x))) AS n FROM pairs)
SELECT CASE WHEN n >= 3 THEN '3+' ELSE CAST(n AS VARCHAR) END AS differing, count(*) AS pairs FROM d GROUP BY 1""")
def divergence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.divergence(pairs(spark, sf_dir))


@query(f"""WITH {PAIRS_SQL} SELECT CASE WHEN truth = guess THEN 'EXACT' WHEN list_has_any(truth, guess) THEN 'PARTIAL' ELSE 'DIFF' END AS "match", count(*) AS pairs FROM pairs GROUP BY 1""")
def match_class_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.match_tally(pairs(spark, sf_dir))


@query(f"""WITH {PAIRS_SQL}, t AS (SELECT 'added' AS kind, unnest(list_filter(guess, lambda x: NOT list_contains(truth, x))) AS label FROM pairs
 UNION ALL SELECT 'removed', unnest(list_filter(truth, lambda x: NOT list_contains(guess, x))) FROM pairs
 UNION ALL SELECT 'changed', truth[1] || ' -> ' || guess[1] FROM pairs WHERE len(truth) = 1 AND len(guess) = 1 AND truth[1] <> guess[1])
SELECT kind, label, count(*) AS pairs FROM t GROUP BY ALL""")
def label_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.transitions(pairs(spark, sf_dir))


@query("""WITH m AS (SELECT l_orderkey AS id, l_returnflag AS label, max(l_discount) AS a, max(l_tax) AS b FROM lineitem GROUP BY ALL)
SELECT label, count(*) AS pairs, round(avg(abs(a - b)), 4) AS mean_difference FROM m GROUP BY label""")
def confidence_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_discount", "l_tax")
    best = lines.groupBy("l_orderkey", "l_returnflag").agg(F.max("l_discount").alias("a"), F.max("l_tax").alias("b"))
    maps = best.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "a"))).alias("ma"), F.map_from_entries(F.collect_list(F.struct("l_returnflag", "b"))).alias("mb"))
    return evaluate.confidence_difference(maps, "ma", "mb")


@query("""WITH n AS (SELECT l_partkey AS id, l_returnflag AS answer, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT id, CAST(sum(n) AS BIGINT) AS runs, count(*) AS distinct_answers, round(max(n) / sum(n), 4) AS modal_share FROM n GROUP BY id""")
def answer_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_partkey", "l_returnflag").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("answer"))
    return evaluate.consistency(rows, "id", "answer")


# findings
@query(f"""WITH {REPORTS_SQL}, n AS (SELECT year, round(100.0 * count(*) FILTER (WHERE list_contains(labels, 'R')) / count(*), 4) AS rate FROM reports GROUP BY year)
SELECT year, rate, lag(rate) OVER (ORDER BY year) AS previous, round(rate - lag(rate) OVER (ORDER BY year), 4) AS change FROM n""")
def yoy_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = cube.blind_spots(reports(spark, sf_dir), ["year"], RISK, NONE).select("year", F.round(100.0 * ratio(F.col("with_risk"), F.col("reports")), 4).alias("rate"))
    return findings.year_on_year(rates, "rate").withColumn("change", F.round("change", 4))


@query(f"""WITH {REPORTS_SQL}, n AS (SELECT label, count(*) FILTER (WHERE year = 1998) AS now, count(*) FILTER (WHERE year = 1997) AS before FROM (SELECT year, unnest(labels) AS label FROM reports) WHERE year IN (1997, 1998) GROUP BY label)
SELECT label, now, before, round(100.0 * now / sum(now) OVER () - 100.0 * before / sum(before) OVER (), 4) AS points FROM n""")
def category_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.category_delta(cube.label_by(reports(spark, sf_dir), "year"), "label", 1998, 1997)


@query("""WITH n AS (SELECT c_mktsegment AS sector, o_orderpriority AS label, count(*) AS reports FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
 s AS (SELECT *, 100.0 * reports / sum(reports) OVER (PARTITION BY sector) AS share, row_number() OVER (PARTITION BY sector ORDER BY reports DESC, label) AS p FROM n)
SELECT sector, CAST(sum(reports) AS BIGINT) AS total, round(sum(CASE WHEN p <= 3 THEN share ELSE 0 END), 4) AS top3_share, round(sum(share * share), 4) AS hhi FROM s GROUP BY sector""")
def concentration_hhi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, owners = table(spark, sf_dir, "orders", "o_custkey", "o_orderpriority"), table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    rows = orders.join(owners, F.col("o_custkey") == F.col("c_custkey"))
    counts = rows.groupBy(F.col("c_mktsegment").alias("sector"), F.col("o_orderpriority").alias("label")).agg(F.count("*").alias("reports"))
    return findings.concentration(counts, ["sector"], "reports")


@query(f"""WITH {REPORTS_SQL}, n AS (SELECT sector, year, {_BLIND} FROM reports GROUP BY ALL)
SELECT sector, year, reports, with_risk, round(100.0 * with_risk / reports, 1) AS good_share, CASE WHEN no_risk > 0 THEN round(with_risk / no_risk, 3) END AS ratio FROM n WHERE reports >= 20""")
def sector_quality_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = findings.with_least(cube.blind_spots(reports(spark, sf_dir), ["sector", "year"], RISK, NONE), "reports")
    return findings.quality_trend(rows, "with_risk", "reports", "no_risk").select("sector", "year", "reports", "with_risk", "good_share", "ratio")


assert set(BANDS) == {"substantive", "moderate", "boilerplate"}
