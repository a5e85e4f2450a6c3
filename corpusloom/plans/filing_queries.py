"""Queries that choose filings: title points, report years, the clean choice for each year and the processing queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import titles
from ..operators import mentions, select
from .registry import query, table

WANTED = (2021, 2022, 2023)

#: Orders as filings of 25 years later; the expressions mean the same to both engines. y is the year that most titles report on.
_FORMS = [
    "'Annual Report and Accounts ' || (y - 1) || '/' || lpad(CAST(y % 100 AS STRING), 2, '0') || ' (ESEF)'", "'Annual report for the year ended 31 December ' || y", "'20-F/A'", "'Notice of AGM ' || y",
    "'Preliminary results ' || (y - 1) || ' - ' || y", "' ARS '", "'Proxy form'", "'Replacement Financial Statements ' || y", "'Report, annual, ' || (y - 1) || '-' || lpad(CAST(y % 100 AS STRING), 2, '0')",
    "'Interim results for ' || y", "'Results of Annual General Meeting ' || (y + 1)", "'Annual Report ' || y || ', compared with ' || (y - 1)", "'Transaction in own shares, year ended 30 June ' || y",
    "'Annual Financial Report ' || (y - 1)", "CAST(NULL AS STRING)", "'Annual report ' || (y - 2)", "'Final results, years ' || (y - 1) || '/' || y",
]
_TITLE = "CASE pk % 17 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_FORMS)) + " END"
_STATUS = "CASE pk % 9 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN ' done ' WHEN 2 THEN 'Pending' WHEN 3 THEN 'PROCESSING' WHEN 4 THEN 'failed' WHEN 5 THEN 'SKIPPED' WHEN 6 THEN '' WHEN 7 THEN 'Other' END"
_TYPE = "CASE kind WHEN '1-URGENT' THEN 'Annual Report (ESEF)' WHEN '2-HIGH' THEN 'Annual Report' WHEN '3-MEDIUM' THEN '10-K' WHEN '4-NOT SPECIFIED' THEN 'Annual Financial Statements' END"
_COLUMNS = ("pk", "owner", f"{_TITLE} AS title", f"{_STATUS} AS status", f"{_TYPE} AS filing_type", "pk % 3 <> 0 AS markdown", "CASE WHEN pk % 23 <> 0 THEN released END AS released")

_SQL_FILINGS = f"""b AS (SELECT o_orderkey AS pk, o_custkey AS owner, o_orderpriority AS kind, strftime(o_orderdate + INTERVAL 25 YEAR, '%Y-%m-%d') AS released, CAST(year(o_orderdate) AS INTEGER) + 24 AS y FROM orders),
f AS (SELECT {', '.join(_COLUMNS).replace('STRING', 'VARCHAR')} FROM b)"""
#: By the card: a range is four digits from 2000 on, a slash or dash with any space, and two digits (or four if two don't follow).
_SQL_YEARS = r"""r AS (SELECT f.*, lower(trim(coalesce(title, ''))) AS low, coalesce(title, '') AS t, TRY_CAST(left(released, 4) AS INTEGER) AS ry,
 list_transform(regexp_extract_all(coalesce(title, ''), '20[0-9]{2}\s*[/-]\s*[0-9]{2}'), lambda x: {'a': CAST(left(x, 4) AS INTEGER), 'b': CAST(left(x, 2) || right(x, 2) AS INTEGER)}) AS spans,
 list_transform(regexp_extract_all(coalesce(title, ''), '\b20[0-9]{2}\b'), lambda x: CAST(x AS INTEGER)) AS named,
 list_transform(regexp_extract_all(coalesce(title, ''), '(?i)year\s+ended[^0-9]{0,40}(20[0-9]{2})', 1), lambda x: CAST(x AS INTEGER)) AS ended FROM f)"""
_SQL_POINTS = """q AS (SELECT r.*, CASE WHEN contains(low, 'annual report and accounts') THEN 60 WHEN contains(low, 'annual report') THEN 45 WHEN contains(low, 'annual') AND contains(low, 'report') THEN 30 ELSE 0 END
  + CASE WHEN contains(low, 'esef') THEN 10 ELSE 0 END - CASE WHEN low IN ('ars', '20-f', '20-f/a') THEN 20 ELSE 0 END
  - 25 * len(list_filter(['20-f', '20-f/a', 'ars', 'notice of agm', 'replacement financial statements', 'preliminary', 'proxy'], lambda b: contains(low, b))) AS quality,
  coalesce(list_max(list_transform(spans, lambda s: s.b)), list_max(named), ry - 1) AS report_year FROM r)"""


def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    released = F.date_format(F.col("o_orderdate") + F.expr("interval 25 years"), "yyyy-MM-dd")
    rows = orders.select(F.col("o_orderkey").alias("pk"), F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("kind"), released.alias("released"), (F.year("o_orderdate") + 24).alias("y"))
    return rows.selectExpr(*_COLUMNS)


@query(f"""WITH {_SQL_FILINGS}, {_SQL_YEARS}, {_SQL_POINTS} SELECT pk, CAST(quality AS INTEGER) AS quality, report_year, CASE WHEN report_year <= ry + 1 THEN report_year END AS fiscal_year FROM q""")
def title_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title's points, the year it reports on, and that year if it isn't too far behind the release."""
    rows = _filings(spark, sf_dir)
    year = titles.report_year(F.col("title"), F.col("released"))
    rows = rows.select("pk", "released", titles.quality(F.col("title")).alias("quality"), year.alias("report_year"))
    return rows.select("pk", "quality", "report_year", titles.guarded_year(F.col("report_year"), F.col("released")).alias("fiscal_year"))


_TIER = "CASE WHEN markdown AND contains(lower(coalesce(filing_type, '')), 'esef') THEN 4 WHEN markdown THEN 3 WHEN contains(lower(coalesce(filing_type, '')), 'esef') THEN 2 ELSE 1 END"
_STATE = "upper(trim(coalesce(status, '')))"


def _clean_sql(bonus: str) -> str:
    return f"""WITH {_SQL_FILINGS}, {_SQL_YEARS}, {_SQL_POINTS}, s AS (SELECT *, {_TIER} AS tier, {bonus} AS bonus FROM q WHERE report_year IS NOT NULL),
 k AS (SELECT *, row_number() OVER (PARTITION BY owner, report_year ORDER BY tier DESC, quality DESC, bonus DESC, coalesce(released, '') DESC, pk DESC) AS n FROM s)
SELECT owner, report_year, pk, CAST(tier AS INTEGER) AS tier, CAST(quality AS INTEGER) AS title_points, CAST(bonus AS INTEGER) AS status_points FROM k WHERE n = 1"""


def _clean(spark: SparkSession, sf_dir: str, bulk: bool) -> DataFrame:
    rows = _filings(spark, sf_dir)
    esef = F.contains(F.lower(F.coalesce("filing_type", F.lit(""))), F.lit("esef"))
    order = titles.selection_order(F.col("markdown"), esef, F.col("title"), F.col("status"), F.col("released"), F.col("pk"), bulk)
    rows = rows.select("owner", titles.report_year(F.col("title"), F.col("released")).alias("report_year"), "pk", order.alias("order")).where("report_year is not null")
    return select.pick_best(rows, ["owner", "report_year"], [F.desc("order")]).select("owner", "report_year", "pk", "order.tier", "order.title_points", "order.status_points")


@query(_clean_sql(f"CASE WHEN {_STATE} IN ('COMPLETED', 'DONE', 'SUCCEEDED', 'SUCCESS') THEN 8 WHEN {_STATE} IN ('PENDING', 'PROCESSING') THEN -2 WHEN {_STATE} IN ('FAILED', 'SKIPPED') THEN -6 ELSE 0 END"))
def clean_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each owner's filing for a report year: tier, title points, status points, release, number."""
    return _clean(spark, sf_dir, bulk=False)


@query(_clean_sql(f"CASE WHEN {_STATE} IN ('COMPLETED', 'DONE', 'SUCCEEDED', 'SUCCESS') THEN 10 WHEN {_STATE} = 'PENDING' THEN 1 WHEN {_STATE} = 'PROCESSING' THEN 0 WHEN {_STATE} = 'SKIPPED' THEN -4 WHEN {_STATE} = 'FAILED' THEN -6 ELSE -1 END"))
def bulk_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same choice with the bulk table of status points."""
    return _clean(spark, sf_dir, bulk=True)


_SQL_SCORES = rf"""u AS (SELECT r.*, CAST(w AS INTEGER) AS year, list_distinct(list_filter(named, lambda x: x IN {WANTED})) AS mine FROM r, (SELECT unnest({list(WANTED)}) AS w)),
g AS (SELECT *, greatest(CASE WHEN list_contains(list_transform(spans, lambda s: s.b), year) THEN 500 END, CASE WHEN list_contains(ended, year) THEN 450 END, CASE WHEN len(mine) = 1 AND mine[1] = year THEN 400 END,
  CASE WHEN list_contains(list_transform(spans, lambda s: s.a), year) THEN 350 END, CASE WHEN ry - 1 = year THEN 320 END, CASE WHEN ry = year THEN 220 END) AS weight FROM u),
c AS (SELECT owner, year, pk, coalesce(released, '') AS release, CAST(weight AS INTEGER) AS weight, CAST(weight + CASE WHEN markdown THEN 1000 ELSE 0 END + CASE WHEN contains(lower(coalesce(filing_type, '')), 'esef') THEN 120 ELSE 0 END
  + CASE WHEN contains(lower(coalesce(filing_type, '')), 'annual report') THEN 80 ELSE 0 END + CASE WHEN contains(low, 'annual') AND contains(low, 'report') THEN 40 ELSE 0 END
  - CASE WHEN regexp_matches(t, '(?i)\b(preliminary|notice|proxy|transaction|holding\(s\)|director/pdmr|results of annual general meeting|agm)\b') THEN 240 ELSE 0 END
  - CASE WHEN weight = 320 AND NOT list_contains(named, year) AND len(mine) > 0 THEN 260 ELSE 0 END AS INTEGER) AS score FROM g WHERE weight IS NOT NULL)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _filings(spark, sf_dir)
    signal = titles.year_signals(F.col("title"), F.col("released"), WANTED)
    rows = rows.select("*", F.explode(signal).alias("s")).select("*", "s.year", "s.weight")
    score = titles.candidate_score(F.col("weight"), F.col("year"), F.col("title"), F.col("filing_type"), F.col("markdown"), WANTED)
    return rows.select("owner", "year", "pk", F.coalesce("released", F.lit("")).alias("release"), "weight", score.alias("score"))


@query(f"WITH {_SQL_FILINGS}, {_SQL_YEARS}, {_SQL_SCORES} SELECT pk, year, weight, score FROM c")
def year_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each filing's signal and score for each wanted year that it may report on."""
    return _scored(spark, sf_dir).select("pk", "year", "weight", "score")


@query(f"WITH {_SQL_FILINGS}, {_SQL_YEARS}, {_SQL_SCORES}, k AS (SELECT *, row_number() OVER (PARTITION BY owner, year ORDER BY score DESC, release DESC, CAST(pk AS VARCHAR) DESC) AS n FROM c) SELECT owner, year, pk, score FROM k WHERE n = 1")
def best_title_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each owner's best filing for each wanted year, whether another year takes it or not."""
    order = [F.desc("score"), F.desc("release"), F.col("pk").cast("string").desc()]
    return select.pick_best(_scored(spark, sf_dir), ["owner", "year"], order).select("owner", "year", "pk", "score")


@query(f"""WITH RECURSIVE {_SQL_FILINGS}, {_SQL_YEARS}, {_SQL_SCORES}, k AS (SELECT owner, year, list(pk ORDER BY score DESC, release DESC, CAST(pk AS VARCHAR) DESC) AS pool FROM c GROUP BY owner, year),
 o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY len(pool), year) AS i FROM k),
 w AS (SELECT owner, year, i, pool[1] AS pk, [pool[1]] AS used FROM o WHERE i = 1
  UNION ALL SELECT o.owner, o.year, o.i, coalesce(list_filter(o.pool, lambda p: NOT list_contains(w.used, p))[1], o.pool[1]), list_append(w.used, coalesce(list_filter(o.pool, lambda p: NOT list_contains(w.used, p))[1], o.pool[1])) FROM w JOIN o ON o.owner = w.owner AND o.i = w.i + 1)
SELECT owner, year, pk FROM w""")
def best_candidate_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue: of each owner the year with the fewest candidates chooses first, and no filing serves two years while another is left."""
    order = [F.desc("score"), F.desc("release"), F.col("pk").cast("string").desc()]
    return mentions.best_by_year(_scored(spark, sf_dir), "owner", "year", "pk", order, WANTED)
