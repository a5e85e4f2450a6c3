"""Queries for routing, payload, title, ordering and roll-up rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import payload, titles
from ..functions import text as rules
from .base import PAIRS_SQL, REPORTS_SQL, pairs, reports
from .registry import query, table

ALIAS = {"R": "risk", "A": "adoption", "N": "none"}
_ALIAS_SQL = "CASE l_returnflag WHEN 'R' THEN 'risk' WHEN 'A' THEN 'adoption' WHEN 'N' THEN 'none' ELSE l_returnflag END"
_BEST = "best AS (SELECT l_orderkey AS id, lower(l_returnflag) AS label, max(l_discount) AS c FROM lineitem GROUP BY 1, 2)"


def _lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", *columns)


def _best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_discount").groupBy(F.col("l_orderkey").alias("id"), F.lower("l_returnflag").alias("label")).agg(F.max("l_discount").alias("c"))


# payloads


@query(f"WITH {_BEST} SELECT id, label, c AS signal FROM best")
def canonical_or_legacy_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with a list of signals, or in the legacy form with a map of scores, as rows of label and signal."""
    rows = _best(spark, sf_dir).groupBy("id").agg(F.collect_list(F.struct(F.col("label").alias("type"), F.col("c").alias("signal"))).alias("signals"))
    scores = F.map_from_entries("signals")
    raw = F.when(F.col("id") % 2 == 0, F.to_json(F.struct("signals"))).otherwise(F.to_json(F.struct(scores.alias("scores"))))
    v = rows.select("id", F.try_parse_json(raw).alias("v"))
    new = F.try_variant_get("v", "$.signals", "array<struct<type string, signal double>>")
    old = F.transform(F.map_entries(F.try_variant_get("v", "$.scores", "map<string,double>")), lambda e: F.struct(e["key"].alias("type"), e["value"].alias("signal")))
    return v.select("id", F.inline(F.coalesce(new, old))).withColumnRenamed("type", "label")


@query(f"""WITH m AS (SELECT l_orderkey AS id, {_ALIAS_SQL} AS label, max(l_discount * 10) AS signal FROM lineitem GROUP BY 1, 2)
SELECT id, label, round(signal, 4) AS signal, CASE WHEN signal >= 0.67 THEN 'strong' WHEN signal >= 0.34 THEN 'medium' WHEN signal > 0 THEN 'weak' ELSE 'none' END AS band FROM m""")
def merged_signal_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources' signal maps (even and odd lines) under common label names, the larger signal of each label, and its band."""
    lines = _lines(spark, sf_dir, "l_discount")
    names = F.create_map(*[F.lit(x) for kv in ALIAS.items() for x in kv])
    source = lambda odd: lines.where(F.col("l_linenumber") % 2 == odd).select(F.col("l_orderkey").alias("id"), F.coalesce(F.try_element_at(names, "l_returnflag"), "l_returnflag").alias("label"), (F.col("l_discount") * 10).alias("signal"))
    best = source(0).union(source(1)).groupBy("id", "label").agg(F.max("signal").alias("signal"))
    s = F.col("signal")
    return best.select("id", "label", F.round(s, 4).alias("signal"), F.when(s >= 0.67, "strong").when(s >= 0.34, "medium").when(s > 0, "weak").otherwise("none").alias("band"))


@query("SELECT l_orderkey AS id, l_returnflag AS label, min((l_linenumber, l_discount))[2] AS signal FROM lineitem GROUP BY 1, 2")
def first_signal_per_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, "l_discount")
    return lines.groupBy(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("label")).agg(F.min(F.struct("l_linenumber", "l_discount"))["l_discount"].alias("signal"))


@query("SELECT l_orderkey AS id, lower(l_linestatus) AS vendor, max(l_tax) AS signal FROM lineitem GROUP BY 1, 2")
def vendor_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linestatus", "l_tax")
    return lines.groupBy(F.col("l_orderkey").alias("id"), F.lower("l_linestatus").alias("vendor")).agg(F.max("l_tax").alias("signal"))


@query("SELECT o_orderkey AS id, o_custkey + 0.5 AS x, o_orderkey + 0.25 AS y FROM orders")
def truncated_float_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers by name out of answers that are cut off behind the last one."""
    raw = F.format_string('{"scores": {"x": %d.5, "y": %d.25', "o_custkey", "o_orderkey")
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("id"), raw.alias("raw"))
    return rows.select("id", *(payload.salvage_number(F.col("raw"), n).alias(n) for n in ("x", "y")))


@query("""SELECT l_orderkey AS id, CASE WHEN l_orderkey % 2 = 0 THEN l_returnflag END AS label, 'line ' || l_linenumber AS excerpt FROM lineitem""")
def evidence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence given as lists by label or as one list, as a row for each excerpt (without label in the second form)."""
    rows = _lines(spark, sf_dir).withColumn("e", F.concat(F.lit("line "), F.col("l_linenumber").cast("string")))
    by = rows.groupBy(F.col("l_orderkey").alias("id"), "l_returnflag").agg(F.collect_list("e").alias("es")).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "es"))).alias("m"))
    raw = F.when(F.col("id") % 2 == 0, F.to_json("m")).otherwise(F.to_json(F.flatten(F.map_values("m"))))
    v = by.select("id", F.try_parse_json(raw).alias("v"))
    return payload.evidence(v, "v")


@query(f"""WITH {REPORTS_SQL}, r AS (SELECT report, list_filter(labels, lambda x: x <> 'N') AS own, len(labels) AS n FROM reports)
SELECT report, c AS classifier, CASE c WHEN 'mention' THEN CASE WHEN len(own) > 0 THEN array_to_string(own, ',') ELSE 'none' END WHEN 'risk' THEN CASE WHEN list_contains(own, 'R') THEN 'risk' ELSE 'none' END
 ELSE CASE WHEN len(own) > 1 THEN 'several' WHEN len(own) = 1 THEN own[1] ELSE 'none' END END AS label FROM r, (SELECT unnest(['mention', 'risk', 'adoption']) AS c)""")
def primary_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each classifier's primary label of a report, by the classifier's own rule."""
    rows = reports(spark, sf_dir).select("report", F.filter("labels", lambda x: x != "N").alias("own"))
    own, none = F.col("own"), F.lit("none")
    by_classifier = {
        "mention": F.when(F.size(own) > 0, F.array_join(own, ",")).otherwise(none),
        "risk": F.when(F.array_contains(own, "R"), "risk").otherwise(none),
        "adoption": F.when(F.size(own) > 1, "several").when(F.size(own) == 1, F.element_at(own, 1)).otherwise(none),
    }
    return rows.select("report", F.inline(F.array(*[F.struct(F.lit(k).alias("classifier"), v.alias("label")) for k, v in by_classifier.items()])))


@query(f"WITH {PAIRS_SQL} SELECT id, array_to_string(truth, ',') AS labels, id % 2 = 0 AND truth <> guess AS changed FROM pairs WHERE id % 2 = 0 UNION ALL SELECT id, array_to_string(guess, ','), FALSE FROM pairs WHERE id % 2 = 1")
def focus_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose focus field is taken from the chosen source; the rest of the record stays."""
    rows = pairs(spark, sf_dir).select("id", "truth", F.struct(F.col("guess").alias("labels"), F.lit(False).alias("changed")).alias("record"))
    chosen = F.col("record").withField("labels", F.col("truth")).withField("changed", F.col("truth") != F.col("record.labels"))
    record = F.when(F.col("id") % 2 == 0, chosen).otherwise(F.col("record"))
    return rows.select("id", F.array_join(record["labels"], ",").alias("labels"), record["changed"].alias("changed"))


@query(f"WITH {PAIRS_SQL} SELECT id, array_to_string(list_sort(list(label) FILTER (WHERE c >= 0.4)), ',') AS labels FROM conf WHERE in_guess = 1 GROUP BY id HAVING count(*) FILTER (WHERE c >= 0.4) > 0")
def confident_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.map_keys(F.map_filter("confidences", lambda _, c: c >= 0.4))
    return pairs(spark, sf_dir).select("id", F.array_join(F.array_sort(kept), ",").alias("labels")).where("labels <> ''")


@query("""WITH c AS (SELECT l_orderkey AS report, avg(l_discount) AS c FROM lineitem GROUP BY 1) SELECT report, round(c, 6) AS mean FROM c UNION ALL SELECT o_orderkey, 0.5 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def mean_signal_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean signal of a report, 0.5 without any."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_discount").groupBy("l_orderkey").agg(F.avg("l_discount").alias("c"))
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderkey").alias("report"), F.round(F.coalesce("c", F.lit(0.5)), 6).alias("mean"))


@query("""SELECT l_orderkey AS report, l_linenumber AS line, CASE WHEN greatest(l_discount, l_tax) < 0.03 THEN 'unclear' WHEN l_discount >= l_tax THEN 'discount' ELSE 'tax' END AS best FROM lineitem""")
def best_score_with_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name of the largest score (the first of equal ones), unless it is under the floor."""
    scores = F.array(F.struct(F.col("l_discount").alias("s"), F.lit(1).alias("first"), F.lit("discount").alias("name")), F.struct(F.col("l_tax").alias("s"), F.lit(0).alias("first"), F.lit("tax").alias("name")))
    best = F.array_max(scores)
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return lines.select(F.col("l_orderkey").alias("report"), F.col("l_linenumber").alias("line"), F.when(best["s"] < 0.03, "unclear").otherwise(best["name"]).alias("best"))


# routing


@query(f"WITH {REPORTS_SQL} SELECT report, CASE x WHEN 'R' THEN 'risk' ELSE 'adoption' END AS classifier FROM (SELECT report, unnest(labels) AS x FROM reports) WHERE x <> 'N'")
def classifier_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports by the classifiers that their labels call for."""
    to = F.array_compact(F.array(*[F.when(F.array_contains("labels", k), F.lit(n)) for k, n in ALIAS.items() if n != "none"]))
    return reports(spark, sf_dir).select("report", F.explode(to).alias("classifier"))


@query(f"WITH {PAIRS_SQL} SELECT id, label FROM conf WHERE in_guess = 1 AND c > CASE label WHEN 'R' THEN 0.3 WHEN 'A' THEN 0.5 ELSE 0.7 END")
def threshold_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels whose confidence is over (not at) their own threshold."""
    over = F.map_filter("confidences", lambda k, c: c > F.when(k == "R", 0.3).when(k == "A", 0.5).otherwise(0.7))
    return pairs(spark, sf_dir).select("id", F.explode(F.map_keys(over)).alias("label"))


@query(f"WITH {PAIRS_SQL} SELECT 'labels' AS field, truth = guess AS agree, count(*) AS n FROM pairs GROUP BY 2 UNION ALL SELECT 'risk', list_contains(truth, 'R') = list_contains(guess, 'R'), count(*) FROM pairs GROUP BY 2")
def agreement_by_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records agree in a focus field, label order and repeats aside."""
    same = lambda a, b: F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))
    fields = F.array(F.struct(F.lit("labels").alias("field"), same(F.col("truth"), F.col("guess")).alias("agree")), F.struct(F.lit("risk").alias("field"), (F.array_contains("truth", "R") == F.array_contains("guess", "R")).alias("agree")))
    return pairs(spark, sf_dir).select(F.inline(fields)).groupBy("field", "agree").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS pk, CASE o_orderstatus WHEN 'F' THEN 'ready' WHEN 'O' THEN 'pending' ELSE 'fr_' || lower(o_orderstatus) END AS status FROM orders")
def status_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.create_map(F.lit("F"), F.lit("ready"), F.lit("O"), F.lit("pending"))
    status = F.coalesce(F.try_element_at(known, "o_orderstatus"), F.concat(F.lit("fr_"), F.lower("o_orderstatus")))
    return table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").select(F.col("o_orderkey").alias("pk"), status.alias("status"))


_SEGMENTS = """seg AS (SELECT c_custkey AS owner, CASE WHEN c_custkey % 7 = 0 THEN ' Unknown ' WHEN c_custkey % 7 = 1 THEN '' ELSE c_mktsegment END AS sector,
 CASE WHEN c_custkey % 5 = 0 THEN 'FTSE 350' WHEN c_custkey % 5 < 3 THEN c_mktsegment END AS legacy, CASE WHEN c_custkey % 2 = 0 THEN 'AIM' END AS refined FROM customer)"""


@query(f"""WITH {_SEGMENTS} SELECT owner, trim(sector) NOT IN ('', 'Unknown', 'Other') AS mapped, CASE WHEN legacy = 'FTSE 350' THEN legacy ELSE coalesce(refined, legacy, 'Other') END AS segment FROM seg""")
def preferred_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sector is a mapped one, and the segment: the legacy index, else the refined one, else the legacy one."""
    k = F.col("c_custkey")
    sector = F.when(k % 7 == 0, " Unknown ").when(k % 7 == 1, "").otherwise(F.col("c_mktsegment"))
    legacy, refined = F.when(k % 5 == 0, "FTSE 350").when(k % 5 < 3, F.col("c_mktsegment")), F.when(k % 2 == 0, "AIM")
    segment = F.when(legacy == "FTSE 350", legacy).otherwise(F.coalesce(refined, legacy, F.lit("Other")))
    return table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").select(k.alias("owner"), (~F.trim(sector).isin("", "Unknown", "Other")).alias("mapped"), segment.alias("segment"))


@query("""SELECT p_partkey AS part FROM part WHERE NOT EXISTS (SELECT 1 FROM nation WHERE contains(lower(p_name), lower(left(n_name, 2))))""")
def without_known_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose name holds no key of a small list of names (at most one for each nation), by an anti join on containment."""
    keys = table(spark, sf_dir, "nation", "n_name").select(F.lower(F.left("n_name", F.lit(2))).alias("key")).distinct()  # 25 rows, whatever the scale
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name")
    return parts.join(F.broadcast(keys), F.contains(F.lower("p_name"), F.col("key")), "left_anti").select(F.col("p_partkey").alias("part"))


@query(f"WITH {REPORTS_SQL} SELECT year, x AS label, count(*) AS reports FROM (SELECT year, unnest(labels) AS x FROM reports WHERE year BETWEEN 1996 AND 1999) GROUP BY ALL")
def series_in_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports(spark, sf_dir).where(F.col("year").between(1996, 1999))
    return rows.select("year", F.explode("labels").alias("label")).groupBy("year", "label").agg(F.count("*").alias("reports"))


# titles and years

_TITLES = """t AS (SELECT o_orderkey AS pk, o_custkey AS owner, CAST(o_orderdate + INTERVAL 25 YEAR AS DATE) AS released, y + 25 AS y,
 CASE o_orderkey % 6 WHEN 0 THEN 'Annual Report ' || (y + 24) || '/' || lpad(CAST((y + 25) % 100 AS VARCHAR), 2, '0') WHEN 1 THEN 'Interim results for ' || (y + 25) WHEN 2 THEN 'Half-year report' WHEN 3 THEN 'Annual Financial Report ' || (y + 24) || '-' || (y + 25)
  WHEN 4 THEN 'Final results' ELSE 'Report of ' || (y + 24) || ' and ' || (y + 23) END AS title FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders))"""


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filings of 25 years later, with titles of six forms."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    y = F.year("o_orderdate") + 25
    last, kind = (y - 1).cast("string"), F.col("o_orderkey") % 6
    title = (
        F.when(kind == 0, F.concat(F.lit("Annual Report "), last, F.lit("/"), F.lpad((y % 100).cast("string"), 2, "0")))
        .when(kind == 1, F.concat(F.lit("Interim results for "), y.cast("string")))
        .when(kind == 2, F.lit("Half-year report"))
        .when(kind == 3, F.concat(F.lit("Annual Financial Report "), last, F.lit("-"), y.cast("string")))
        .when(kind == 4, F.lit("Final results"))
        .otherwise(F.concat(F.lit("Report of "), last, F.lit(" and "), (y - 2).cast("string")))
    )
    return orders.select(F.col("o_orderkey").alias("pk"), F.col("o_custkey").alias("owner"), F.to_date(F.col("o_orderdate") + F.expr("interval 25 years")).alias("released"), y.alias("y"), title.alias("title"))


@query(f"WITH {_TITLES} SELECT pk, title FROM t WHERE regexp_matches(title, '(?i)\\bannual (?:financial )?report\\b|\\bfinal results\\b|\\bannual results\\b') AND NOT regexp_matches(title, '(?i)\\binterim\\b|\\bhalf[- ]year\\b|\\bquarterly\\b')")
def annual_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).where(titles.annual(F.col("title"))).select("pk", "title")


@query("""WITH s AS (SELECT o_orderkey AS pk, CAST(o_orderdate AS DATE) AS d, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders), g AS (SELECT *, CAST(abs(date_diff('day', make_date(y, 12, 31), d)) AS INTEGER) AS gap FROM s)
SELECT pk, gap FROM g WHERE gap <= 60""")
def snapshot_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select(F.col("o_orderkey").alias("pk"), F.to_date("o_orderdate").alias("d"))
    return rows.select("pk", titles.gap_to_year_end(F.col("d"), F.year("d"), 60).alias("gap")).where("gap is not null")


@query(f"WITH {_TITLES} SELECT pk, CAST(CASE WHEN pk % 2 = 0 THEN year(released) ELSE TRY_CAST(nullif(regexp_extract(title, '\\b(20\\d{{2}})\\b', 1), '') AS INTEGER) END AS INTEGER) AS year FROM t")
def filing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year of a filing's date field, which every other filing lacks, else that of its description."""
    made_up = F.when(F.col("pk") % 2 == 0, F.year("released"))
    return _titles(spark, sf_dir).select("pk", F.coalesce(made_up, F.nullif(F.regexp_extract("title", titles.YEAR, 1), F.lit("")).try_cast("int")).alias("year"))


_FIRST = ("(?i)year ended [^\\n]{0,40}?((?:19|20)\\d{2})", "(?i)(?:annual|report)[^\\n]{0,40}?((?:19|20)\\d{2})", "((?:19|20)\\d{2})")


@query("""WITH h AS (SELECT doc_id, array_to_string(list_slice(string_split(text, chr(10)), 1, 100), chr(10)) AS h FROM documents)
SELECT doc_id, coalesce(""" + ", ".join(f"TRY_CAST(nullif(regexp_extract(h, '{p}', 1), '') AS INTEGER)" for p in _FIRST) + """) AS year FROM h""")
def first_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", titles.first_year(F.col("text"), _FIRST).alias("year"))


# roll-ups


@query("SELECT o_custkey AS owner, CAST(year(o_orderdate) AS INTEGER) AS year, bool_or(contains(lower(o_orderpriority), 'urgent')) AS principal, count(*) AS mentions FROM orders GROUP BY 1, 2")
def principal_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_orderpriority")
    return orders.groupBy(F.col("o_custkey").alias("owner"), F.year("o_orderdate").alias("year")).agg(F.bool_or(F.contains(F.lower("o_orderpriority"), F.lit("urgent"))).alias("principal"), F.count("*").alias("mentions"))


@query(f"WITH {REPORTS_SQL} SELECT report, l_linenumber AS chunk, sector, year, month, {_ALIAS_SQL} AS label FROM lineitem JOIN reports ON report = l_orderkey")
def chunk_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each chunk, with its report's sector, year and month."""
    names = F.create_map(*[F.lit(x) for kv in ALIAS.items() for x in kv])
    lines = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("report"), F.col("l_linenumber").alias("chunk"), F.coalesce(F.try_element_at(names, "l_returnflag"), "l_returnflag").alias("label"))
    return lines.join(reports(spark, sf_dir).select("report", "sector", "year", "month"), "report").select("report", "chunk", "sector", "year", "month", "label")


@query(f"""WITH {REPORTS_SQL}, y AS (SELECT year, count(*) AS total FROM reports GROUP BY year), l AS (SELECT year, unnest(labels) AS label FROM reports)
SELECT l.year, label, count(*) AS reports, CAST((count(*) * 2000 + any_value(total)) // (2 * any_value(total)) AS BIGINT) / 10.0 AS percent FROM l JOIN y ON y.year = l.year GROUP BY l.year, label""")
def figure_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent of a year's reports with each label, to one decimal (half up, on whole numbers)."""
    rows = reports(spark, sf_dir).select("year", "labels")
    total = rows.groupBy("year").agg(F.count("*").alias("total"))
    by = rows.select("year", F.explode("labels").alias("label")).groupBy("year", "label").agg(F.count("*").alias("reports"))
    return by.join(total, "year").select("year", "label", "reports", (F.expr("(reports * 2000 + total) div (2 * total)") / 10.0).alias("percent"))


@query(f"WITH {PAIRS_SQL} SELECT label, count(*) FILTER (WHERE in_truth = 1) AS truth, count(*) FILTER (WHERE in_guess = 1) AS guess FROM conf GROUP BY label")
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records have each label by either source, side by side."""
    rows = pairs(spark, sf_dir)
    both = rows.select(F.explode("truth").alias("label"), F.lit("truth").alias("source")).union(rows.select(F.explode("guess"), F.lit("guess")))
    return both.groupBy("label").agg(*(F.count_if(F.col("source") == s).alias(s) for s in ("truth", "guess")))


@query(f"""WITH {REPORTS_SQL} SELECT 'reports' AS measure, count(*) AS n FROM reports UNION ALL SELECT 'with labels', count(*) FROM reports WHERE len(labels) > 0
 UNION ALL SELECT 'owners', count(DISTINCT owner) FROM reports UNION ALL SELECT 'label ' || x, count(*) FROM (SELECT unnest(labels) AS x FROM reports) GROUP BY x""")
def classification_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports(spark, sf_dir)
    whole = rows.agg(F.count("*").alias("reports"), F.count_if(F.size("labels") > 0).alias("with labels"), F.count_distinct("owner").alias("owners"))
    entries = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").alias("n")) for c in ("reports", "with labels", "owners")])
    labels = rows.select(F.explode("labels").alias("x")).groupBy("x").agg(F.count("*").alias("n")).select(F.concat(F.lit("label "), F.col("x")).alias("measure"), "n")
    return whole.select(F.inline(entries)).union(labels)


@query("""SELECT l_orderkey AS document, l_suppkey % 3 AS rater, count(*) AS annotations, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS labels, max(l_discount) AS top, bool_or(l_linestatus = 'F') AS mentioned FROM lineitem GROUP BY 1, 2""")
def annotation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations as one row for each document and rater."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_returnflag", "l_discount", "l_linestatus")
    return lines.groupBy(F.col("l_orderkey").alias("document"), (F.col("l_suppkey") % 3).alias("rater")).agg(
        F.count("*").alias("annotations"), F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("labels"), F.max("l_discount").alias("top"), F.bool_or(F.col("l_linestatus") == "F").alias("mentioned")
    )


@query("""SELECT n.n_name AS label, CASE WHEN n_nationkey % 6 = 0 THEN 'Override' WHEN n_nationkey % 6 = 1 THEN 'pending' ELSE r_name END AS sector, CASE WHEN n_nationkey % 6 = 0 THEN 'override' WHEN n_nationkey % 6 = 1 THEN 'pending' ELSE 'static' END AS basis, count(c_custkey) AS companies
 FROM nation n JOIN region ON r_regionkey = n_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""")
def static_sector_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies by label through a static table of sectors, with overrides first and unmapped labels pending."""
    k = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    owners = table(spark, sf_dir, "customer", "c_nationkey").groupBy("c_nationkey").agg(F.count("*").alias("companies"))
    basis = F.when(k % 6 == 0, "override").when(k % 6 == 1, "pending").otherwise("static")
    sector = F.when(k % 6 == 0, "Override").when(k % 6 == 1, "pending").otherwise(F.col("r_name"))
    return nations.join(owners, k == F.col("c_nationkey"), "left").select(F.col("n_name").alias("label"), sector.alias("sector"), basis.alias("basis"), F.coalesce("companies", F.lit(0)).cast("long").alias("companies"))


@query("SELECT r_name AS parent, count(n_nationkey) AS children, array_to_string(list_sort(list(n_name) FILTER (WHERE n_name IS NOT NULL)), ',') AS names FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def hierarchy_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return rows.groupBy(F.col("r_name").alias("parent")).agg(F.count("n_nationkey").alias("children"), F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"))


# orders and ids


@query("""SELECT o_orderkey AS pk, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 99 END, lower(o_orderstatus), o_orderkey) AS INTEGER) AS place,
 CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END, o_totalprice DESC, o_orderkey) AS INTEGER) AS by_size FROM orders""")
def ranked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places by a fixed order of priorities (unknown ones as 99, then without regard to case), and by size with one status pinned to the bottom."""
    fixed = F.coalesce(F.try_element_at(F.create_map(F.lit("1-URGENT"), F.lit(0), F.lit("2-HIGH"), F.lit(1)), "o_orderpriority"), F.lit(99))
    own = Window.partitionBy("o_custkey")
    pinned = F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    return orders.select(
        F.col("o_orderkey").alias("pk"), F.row_number().over(own.orderBy(fixed, F.lower("o_orderstatus"), "o_orderkey")).alias("place"), F.row_number().over(own.orderBy(pinned, F.desc("o_totalprice"), "o_orderkey")).alias("by_size")
    )


@query(f"WITH {PAIRS_SQL}, w AS (SELECT id, label, coalesce(c, 0) AS c FROM conf WHERE in_guess = 1 AND in_truth = 0), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY c DESC, id) AS place FROM w) SELECT label, id, round(c, 6) AS confidence, CAST(place AS INTEGER) AS place FROM r WHERE place <= 20")
def top_false_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most confident labels of each kind that the truth lacks (a report's limit), those without confidence as 0."""
    rows = pairs(spark, sf_dir).select("id", "confidences", F.explode(F.array_except("guess", "truth")).alias("label"))
    rows = rows.withColumn("c", F.coalesce(F.try_element_at("confidences", "label"), F.lit(0.0)))
    best = Window.partitionBy("label").orderBy(F.desc("c"), "id")
    return rows.withColumn("place", F.row_number().over(best)).where("place <= 20").select("label", "id", F.round("c", 6).alias("confidence"), "place")


@query("""WITH c AS (SELECT l_orderkey AS grp, l_returnflag AS label, count(*) AS n, min(l_linenumber) AS first FROM lineitem GROUP BY 1, 2), s AS (SELECT grp, count(*) AS kinds, sum(n) AS lines FROM c GROUP BY grp)
SELECT c.grp AS report, c.label, CAST(row_number() OVER (PARTITION BY c.grp ORDER BY n, first, c.label) AS INTEGER) AS minority_rank, CAST(CASE WHEN kinds > 2 THEN 1 WHEN kinds > 1 THEN 2 ELSE 3 END AS INTEGER) AS priority FROM c JOIN s ON s.grp = c.grp""")
def review_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a report for review, the rarest first; reports with more kinds of labels come before others."""
    by = _lines(spark, sf_dir).groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n"), F.min("l_linenumber").alias("first"))
    own = Window.partitionBy("l_orderkey")
    kinds = F.count("*").over(own)
    return by.select(
        F.col("l_orderkey").alias("report"), F.col("l_returnflag").alias("label"), F.row_number().over(own.orderBy("n", "first", "l_returnflag")).alias("minority_rank"), F.when(kinds > 2, 1).when(kinds > 1, 2).otherwise(3).alias("priority")
    )


@query("""SELECT c_custkey AS k, concat_ws('-', lpad(CAST(c_custkey AS VARCHAR), 8, '0'), nullif(CASE WHEN c_custkey % 3 = 0 THEN 'LEI' || c_custkey ELSE '' END, ''), trim(regexp_replace(lower(trim(c_name)), '[^a-z0-9]+', '-', 'g'), '-'), lower(c_mktsegment)) AS document_id FROM customer""")
def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite ids of the parts that aren't blank."""
    k = F.col("c_custkey")
    lei = F.when(k % 3 == 0, F.concat(F.lit("LEI"), k.cast("string")))
    return table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment").select(k.alias("k"), F.concat_ws("-", F.lpad(k.cast("string"), 8, "0"), lei, rules.slug(F.col("c_name")), F.lower("c_mktsegment")).alias("document_id"))


@query("SELECT l_orderkey AS report, l_linenumber AS line, l_orderkey || '_' || printf('%04d', CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INTEGER)) AS span_id FROM lineitem")
def span_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a report's spans with a zero-padded counter."""
    own = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return _lines(spark, sf_dir, "l_partkey", "l_suppkey").select(F.col("l_orderkey").alias("report"), F.col("l_linenumber").alias("line"), F.format_string("%d_%04d", "l_orderkey", F.row_number().over(own)).alias("span_id"))


@query(f"WITH {PAIRS_SQL} SELECT id, label, CASE WHEN id % 3 = 0 THEN c WHEN id % 3 = 1 THEN 0.5 END AS confidence FROM conf WHERE in_guess = 1 AND id % 3 < 2")
def resolved_confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidences given by label, or one for all labels, or none at all."""
    k = F.col("id") % 3
    given, scalar = F.when(k == 0, F.col("confidences")), F.when(k == 1, F.lit(0.5))
    return pairs(spark, sf_dir).select("id", F.explode(payload.confidence_map(F.col("guess"), given, scalar)).alias("label", "confidence"))


# faulty answers: by id, one without signals, one whose labels are no list, one with a repeated signal, one with an unknown label
_CHECKED_SQL = """lab AS (SELECT l_orderkey AS id, CASE l_returnflag WHEN 'R' THEN 'cyber' WHEN 'A' THEN 'market' ELSE 'none' END AS label, CAST(round(max(l_discount) * 40) AS BIGINT) AS s FROM lineitem GROUP BY 1, l_returnflag),
 g AS (SELECT id, list_sort(list(label)) AS types, list(s ORDER BY label) AS scores FROM lab GROUP BY id),
 a AS (SELECT id, types, CASE id % 7 WHEN 2 THEN list_concat(types, types[1:1]) WHEN 3 THEN list_concat(types, ['other']) ELSE types END AS seen,
   CASE WHEN id % 7 IN (2, 3) THEN list_concat(scores, scores[1:1]) ELSE scores END AS scores, id % 7 <> 1 AS lt, id % 7 <> 0 AS ls FROM g)"""
_CHECKS_SQL = """list_filter([CASE WHEN NOT ls THEN 'missing field: risk_signals' END, CASE WHEN NOT lt THEN 'risk_types must be a list' END, CASE WHEN lt AND ls AND list_contains(types, 'none') AND len(types) > 1 THEN 'none with other labels' END,
 CASE WHEN lt AND id % 7 = 3 THEN 'signals without label: other' END, CASE WHEN ls AND id % 7 = 3 THEN 'unknown label in risk_signals: other' END, CASE WHEN id % 7 = 2 THEN 'repeated label: ' || types[1] END,
 CASE id % 5 WHEN 0 THEN 'confidence must be between 0 and 1' WHEN 1 THEN 'unknown level' WHEN 2 THEN 'missing field: substantiveness' WHEN 3 THEN 'confidence must be numeric' END], lambda x: x IS NOT NULL)"""


@query(f"""WITH {_CHECKED_SQL}, m AS (SELECT id, list_concat({_CHECKS_SQL}, CASE WHEN ls THEN list_transform(list_filter(scores, lambda x: x > 3 OR x = 0), lambda x: CASE WHEN x = 0 THEN 'selected labels need a signal of 1 to 3' ELSE 'signal must be between 0 and 3' END) ELSE CAST([] AS VARCHAR[]) END) AS ms FROM a)
SELECT id, array_to_string(list_sort(ms), '; ') AS messages FROM m""")
def risk_answer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules that each answer breaks; the answers are JSON and many are at fault."""
    label = F.when(F.col("l_returnflag") == "R", "cyber").when(F.col("l_returnflag") == "A", "market").otherwise("none")
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_discount")
    best = lines.groupBy(F.col("l_orderkey").alias("id"), label.alias("type")).agg(F.round(F.max("l_discount") * 40).cast("long").alias("signal"))
    rows = best.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("type", "signal"))).alias("e"))
    fault, odd = F.col("id") % 7, F.col("id") % 5
    first = F.slice("e", 1, 1)
    entries = F.when(fault == 2, F.concat("e", first)).when(fault == 3, F.concat("e", F.transform(first, lambda x: F.struct(F.lit("other").alias("type"), x["signal"].alias("signal"))))).otherwise(F.col("e"))
    types = F.to_json(F.transform("e", lambda x: x["type"]))
    parts = [
        F.concat(F.lit('"risk_types":'), F.when(fault == 1, F.lit('"cyber"')).otherwise(types)),
        F.when(fault != 0, F.concat(F.lit('"risk_signals":'), F.to_json(entries))),
        F.when(odd != 2, F.concat(F.lit('"substantiveness":'), F.when(odd == 1, F.lit('"unclear"')).otherwise(F.lit('" Moderate "')))),
        F.concat(F.lit('"confidence":'), F.when(odd == 0, F.lit("1.5")).when(odd == 3, F.lit('"high"')).otherwise(F.lit("0.5"))),
    ]
    raw = F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ","), F.lit("}"))
    answers = rows.select("id", F.try_parse_json(raw).alias("v"))  # parsed once: the rules name it many times
    found = payload.risk_messages(answers, "v", ("cyber", "market", "none"), ("boilerplate", "moderate", "substantive"))
    return found.select("id", F.array_join(F.array_sort("messages"), "; ").alias("messages"))
