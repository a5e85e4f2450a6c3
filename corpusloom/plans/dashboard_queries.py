"""The whole dashboard and the report's figures over the harness tables.

An order is a report and its lines are its annotations: a line's return flag tells the mention, part and supplier numbers its labels, the
discount its signal and the tax its substantiveness. Customers give sector, region and market segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import signal_level
from ..operators import dashboard as board
from .registry import query, table

VOCABULARY = {"mention": ("adoption", "risk", "vendor"), "adoption": ("a0", "a1", "a2"), "risk": ("r0", "r1", "r2", "r3"), "vendor": ("v0", "v1", "v2", "v3")}
SECTORS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
OTHER = "HOUSEHOLD"
_SEGMENT = "CASE c_custkey % 5 WHEN 0 THEN 'FTSE 100' WHEN 1 THEN 'FTSE 250' WHEN 2 THEN 'Main Market' WHEN 3 THEN 'AIM' ELSE 'Other' END"


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    flag, tag = F.col("l_returnflag"), (F.col("l_linestatus") == "F") & (F.col("l_linenumber") % 3 == 1)
    some = lambda test, v: F.array_compact(F.array(F.when(test, v)))
    level = signal_level(F.col("l_discount") * 10)
    band = F.when(F.col("l_tax") >= 0.06, "substantive").when(F.col("l_tax") >= 0.03, "moderate").otherwise("boilerplate")
    label = lambda c, k, n: F.concat(F.lit(c), (k % n).cast("string"))
    # a line is shuffled as a few numbers and spelt out when its order is whole
    line = F.struct(
        (flag == "A").alias("adopts"), (flag == "R").alias("risks"), tag.alias("tag"), (F.col("l_quantity") > 25).alias("much"), level.cast("int").alias("level"), band.alias("band"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"),
    )

    def chunk(x: Column) -> Column:
        kinds = (("adoption", x["adopts"]), ("risk", x["risks"]), ("vendor", x["tag"]))
        return F.struct(
            F.concat(F.array(F.when(x["adopts"], "adoption").when(x["risks"], "risk").otherwise("none")), some(x["tag"], F.lit("vendor"))).alias("mention"),
            some(x["adopts"], label("a", x["part"], 3)).alias("adoption"),
            some(x["risks"] & x["much"], label("r", x["supplier"], 4)).alias("risk"),
            some(x["tag"], label("v", x["supplier"], 4)).alias("vendor"),
            *(some(test & (x["level"] > 0), x["level"]).alias(f"{f}_signals") for f, test in kinds),
            *(some(test, x["band"]).alias(f"{f}_bands") for f, test in kinds),
        )

    chunks = lines.groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    chunks = chunks.select("l_orderkey", F.transform("lines", chunk).alias("chunks"))
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment").join(table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    customers = customers.join(table(spark, sf_dir, "region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").join(customers, F.col("o_custkey") == F.col("c_custkey")).join(chunks, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    month = F.when(F.col("o_orderkey") % 11 != 0, F.date_format("o_orderdate", "yyyy-MM"))
    return orders.select(
        F.col("o_custkey").alias("owner"), F.year("o_orderdate").alias("year"), month.alias("month"), F.col("c_mktsegment").alias("sector"), F.col("r_name").alias("isic"), F.expr(_SEGMENT).alias("segment"),
        F.coalesce("chunks", F.array().cast(f"array<{board.CHUNK}>")).alias("chunks"),
    )


def _list(*x: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in x) + "]"


def _rows(values: dict[str, tuple[str, ...]]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, vs in values.items() for v in vs)


_BASE = f"""l AS MATERIALIZED (SELECT l_orderkey AS report, row_number() OVER () AS chunk, l_returnflag = 'A' AS adopts, l_returnflag = 'R' AS risks, l_linestatus = 'F' AND l_linenumber % 3 = 1 AS tags, l_quantity > 25 AS much, l_partkey, l_suppkey,
  CASE WHEN l_discount * 10 >= 1 THEN least(greatest(CAST(floor(l_discount * 10 + 0.5) AS INTEGER), 1), 3) WHEN l_discount * 10 >= 0.67 THEN 3 WHEN l_discount * 10 >= 0.34 THEN 2 WHEN l_discount * 10 > 0 THEN 1 ELSE 0 END AS lvl,
  CASE WHEN l_tax >= 0.06 THEN 'substantive' WHEN l_tax >= 0.03 THEN 'moderate' ELSE 'boilerplate' END AS band FROM lineitem),
u AS (SELECT o_orderkey AS report, o_custkey AS owner, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m') END AS month, c_mktsegment AS sector, r_name AS isic, {_SEGMENT} AS market
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
units AS (SELECT 'report' AS basis, report, CAST(NULL AS BIGINT) AS chunk FROM u UNION ALL SELECT 'chunk', report, chunk FROM l),
pairs AS (SELECT 'report' AS basis, report, CAST(NULL AS BIGINT) AS chunk, l.* EXCLUDE (report, chunk) FROM l UNION ALL SELECT 'chunk', report, chunk, l.* EXCLUDE (report, chunk) FROM l),
lab AS (SELECT DISTINCT basis, report, chunk, unnest(CASE WHEN adopts THEN [{{'f': 'mention', 'v': 'adoption'}}, {{'f': 'adoption', 'v': 'a' || l_partkey % 3}}] WHEN risks AND much THEN [{{'f': 'mention', 'v': 'risk'}}, {{'f': 'risk', 'v': 'r' || l_suppkey % 4}}]
  WHEN risks THEN [{{'f': 'mention', 'v': 'risk'}}] ELSE [{{'f': 'mention', 'v': 'none'}}] END || CASE WHEN tags THEN [{{'f': 'mention', 'v': 'vendor'}}, {{'f': 'vendor', 'v': 'v' || l_suppkey % 4}}] ELSE [] END) AS x FROM pairs),
kinds AS (SELECT basis, report, chunk, unnest(CASE WHEN adopts THEN ['adoption'] WHEN risks THEN ['risk'] ELSE [] END || CASE WHEN tags THEN ['vendor'] ELSE [] END) AS f, lvl, band FROM pairs),
bands AS (SELECT basis, report, chunk, f, count_if(band = 'substantive') AS s, count_if(band = 'moderate') AS m, count_if(band = 'boilerplate') AS b FROM kinds GROUP BY ALL),
marks AS (SELECT n.basis, n.report, n.chunk, count_if(x.f = 'mention' AND x.v <> 'none') > 0 AS ai, count_if(x.f = 'risk' OR x.v = 'risk') > 0 AS risky, count_if(x.v = 'adoption') > 0 AS ad, count_if(x.v = 'risk') > 0 AS ri, count_if(x.v = 'vendor') > 0 AS ve
  FROM units n LEFT JOIN lab ON lab.basis = n.basis AND lab.report = n.report AND lab.chunk IS NOT DISTINCT FROM n.chunk GROUP BY ALL),
facts AS (SELECT basis, report, x.f AS family, x.v AS label FROM lab
  UNION ALL SELECT basis, report, f || '_level', CASE WHEN lvl >= 3 THEN '3-explicit' WHEN lvl >= 2 THEN '2-strong_implicit' ELSE '1-weak_implicit' END FROM kinds WHERE lvl > 0
  UNION ALL SELECT basis, report, f || '_band', CASE WHEN s >= m AND s >= b THEN 'substantive' WHEN m >= b THEN 'moderate' ELSE 'boilerplate' END FROM bands
  UNION ALL SELECT basis, report, 'measure', unnest(['total', CASE WHEN ai THEN 'ai' ELSE 'no_ai' END, CASE WHEN risky THEN 'ai_risk' ELSE 'no_ai_risk' END] || CASE WHEN ad THEN ['adoption_mention'] ELSE [] END || CASE WHEN ri THEN ['risk_mention'] ELSE [] END || CASE WHEN ve THEN ['vendor_mention'] ELSE [] END) FROM marks),
segs AS (SELECT * FROM (VALUES {', '.join(f"('{m}', '{s}')" for s, ms in {'All': ('FTSE 100', 'FTSE 250', 'Main Market', 'AIM', 'Other'), **board.SEGMENTS}.items() for m in ms)}) t(market, segment)),
scopes AS (SELECT * FROM (VALUES ('all'), ('cniOnly')) t(scope)),
sliced AS (SELECT f.basis, f.family, f.label, u.owner, u.year, u.month, u.sector, u.isic, segs.segment, scopes.scope FROM facts f JOIN u USING (report) JOIN segs USING (market) JOIN scopes ON scope = 'all' OR u.sector <> '{OTHER}'),
g AS (SELECT basis, segment, scope, family, label, year, month, sector, isic, count(*) AS n, count(DISTINCT owner) AS owners, GROUPING(year) * 8 + GROUPING(month) * 4 + GROUPING(sector) * 2 + GROUPING(isic) AS gid FROM sliced
  GROUP BY GROUPING SETS ((basis, segment, scope, family, label), (basis, segment, scope, family, label, year), (basis, segment, scope, family, label, month), (basis, segment, scope, family, label, sector),
   (basis, segment, scope, family, label, year, sector), (basis, segment, scope, family, label, isic), (basis, segment, scope, family, label, year, isic))),
h AS (SELECT *, CASE gid WHEN 15 THEN 'all' WHEN 7 THEN 'year' WHEN 11 THEN 'month' WHEN 13 THEN 'sector' WHEN 5 THEN 'sector_year' WHEN 14 THEN 'isic' WHEN 6 THEN 'isic_year' END AS grain FROM g WHERE gid <> 11 OR month IS NOT NULL),
names AS (SELECT * FROM (VALUES {', '.join(f"('{f}', '{a}', '', '{s}', CAST(NULL AS VARCHAR))" for (f, a), s in board.SERIES.items())}, {', '.join(f"('measure', '{a}', '{m}', '{s}', {'NULL' if v is None else repr(v)})" for (m, a), (s, v) in board.MEASURES.items() if a != 'owner')}) t(family, grain, measure, series, shown)),
own AS (SELECT h.basis, h.segment, h.scope, names.series, h.year, h.month, CASE WHEN h.family = 'measure' THEN names.shown ELSE h.label END AS label, coalesce(h.sector, h.isic) AS sector, n AS value FROM h JOIN names ON names.family = h.family AND names.grain = h.grain AND (h.family <> 'measure' OR names.measure = h.label)
  UNION ALL SELECT basis, segment, scope, 'summary', NULL, NULL, 'totalCompanies', NULL, owners FROM h WHERE family = 'measure' AND label = 'total' AND grain = 'all'),
every AS (SELECT DISTINCT 'report' AS basis, segment, scope FROM segs, scopes UNION ALL SELECT DISTINCT 'chunk', segment, scope FROM segs, scopes),
yearly AS (SELECT basis, year FROM (SELECT DISTINCT basis, year FROM sliced WHERE segment = 'All')),
vocab AS (SELECT * FROM (VALUES {_rows(VOCABULARY)}) t(family, label)),
dense AS (SELECT names.series, vocab.label, CAST(NULL AS VARCHAR) AS sector, names.grain FROM names JOIN vocab USING (family) WHERE names.grain IN ('year', 'month')
  UNION ALL SELECT series, unnest(CASE WHEN family LIKE '%level' THEN {_list(*board.LEVELS)} ELSE {_list(*board.BANDS)} END), NULL, 'year' FROM names WHERE family LIKE '%level' OR family LIKE '%band'
  UNION ALL SELECT series, shown, NULL, grain FROM names WHERE family = 'measure' AND grain IN ('year', 'month')
  UNION ALL SELECT series, NULL, unnest(CASE WHEN grain = 'sector_year' THEN {_list(*SECTORS)} ELSE {_list(*REGIONS)} END), 'year' FROM names WHERE family = 'measure' AND grain IN ('sector_year', 'isic_year')),
zero AS (SELECT every.basis, segment, scope, series, yearly.year, CAST(NULL AS VARCHAR) AS month, label, sector, 0 AS value FROM every JOIN yearly ON yearly.basis = every.basis JOIN dense ON dense.grain = 'year'
  UNION ALL SELECT m.basis, m.segment, m.scope, series, NULL, m.month, dense.label, dense.sector, 0 FROM (SELECT DISTINCT basis, segment, scope, month FROM sliced WHERE month IS NOT NULL) m JOIN dense ON dense.grain = 'month'),
cube AS (SELECT basis, segment, scope, series, year, month, label, sector, CAST(sum(value) AS BIGINT) AS value FROM (SELECT * FROM own UNION ALL SELECT * FROM zero) GROUP BY ALL)"""


@query(f"WITH {_BASE} SELECT * FROM cube")
def dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 34 series and the summary of all slices, for reports and for chunks."""
    return _board(spark, sf_dir)


def _board(spark: SparkSession, sf_dir: str, **some: tuple[str, ...]) -> DataFrame:
    return board.dashboard(_reports(spark, sf_dir), VOCABULARY, SECTORS, REGIONS, F.col("sector") != OTHER, **some)


_R1 = "floor(({}) * 10 + 0.5) / 10.0"


def _pct(a: str, b: str) -> str:
    return f"(CASE WHEN {b} > 0 THEN {a} / {b} * 100 ELSE 0 END)"


def _rate(a: str, b: str) -> str:
    return _R1.format(f"{_pct(a, b)} + pow(2, -52)")


def _gap(a: str, b: str, c: str, d: str) -> str:
    return _R1.format(f"{_pct(a, b)} - {_pct(c, d)} + pow(2, -52)")


def _figure(name: str, source: str, key: str, year: str, **measures: str) -> str:
    rows = ", ".join(f"{{'measure': '{m}', 'value': CAST({v} AS DOUBLE)}}" for m, v in measures.items())
    return f"SELECT '{name}' AS figure, {key} AS key, {year} AS year, unnest([{rows}]) AS m FROM {source}"


LAST, FIRST = 1999, 1996
_V = "coalesce(max(value) FILTER (WHERE series = '{}' AND {}), 0)"


def _by_year(*extra: str) -> str:
    return f"(SELECT year, {', '.join(extra)} FROM w GROUP BY year)"


_LABEL = lambda series, label, name: _V.format(series, f"label = '{label}'") + f" AS {name}"
_SECTOR = lambda series, name: _V.format(series, "TRUE") + f" AS {name}"
_F1 = _by_year(*(_LABEL("mentionTrend", m, m) for m in ("adoption", "risk", "vendor", "none")), _LABEL("blindSpotTrend", "total_reports", "total"))
_F5 = _by_year(_LABEL("blindSpotTrend", "total_reports", "total"), _LABEL("blindSpotTrend", "ai_risk_mention", "risk"), _LABEL("substantivenessHeatmap", "substantive", "sub"))
_S = "(SELECT sector, year, " + ", ".join(_SECTOR(s, n) for s, n in (("reportCountBySectorYear", "total"), ("riskMentionBySectorYear", "risk"), ("noAiRiskBySectorYear", "no_risk"))) + f" FROM cube WHERE basis = 'report' AND segment = 'All' AND scope = 'cniOnly' AND sector <> '{OTHER}' AND series IN ('reportCountBySectorYear', 'riskMentionBySectorYear', 'noAiRiskBySectorYear') GROUP BY sector, year)"
_F3 = f"(SELECT a.label, a.value AS old, b.value AS new, (SELECT value FROM w WHERE series = 'blindSpotTrend' AND label = 'total_reports' AND year = {LAST - 1}) AS old_all, (SELECT value FROM w WHERE series = 'blindSpotTrend' AND label = 'total_reports' AND year = {LAST}) AS new_all FROM w a JOIN w b ON a.series = 'riskTrend' AND b.series = 'riskTrend' AND a.label = b.label AND a.year = {LAST - 1} AND b.year = {LAST})"
_F4 = f"(SELECT label, value AS n, sum(value) OVER () AS total FROM w WHERE series = 'vendorTrend' AND year = {LAST})"
_F8 = "(SELECT segment, " + ", ".join((_LABEL("blindSpotTrend", "total_reports", "total"), _LABEL("blindSpotTrend", "ai_mention", "ai"), _LABEL("mentionTrend", "adoption", "adoption"), _LABEL("mentionTrend", "risk", "risk"))) + f" FROM cube WHERE basis = 'report' AND scope = 'all' AND segment <> 'All' AND year = {LAST} GROUP BY segment)"
_FIGURES = " UNION ALL ".join([
    _figure("figure1", f"{_F1} WHERE year <= {LAST}", "NULL", "year", total_reports="total", **{f"{m}_count": m for m in ("adoption", "risk", "vendor", "none")}, **{f"{m}_rate_pct": _rate(m, "total") for m in ("adoption", "risk", "vendor", "none")}, adoption_minus_risk_gap_pp=_gap("adoption", "total", "risk", "total")),
    _figure("figure2", f"w WHERE series = 'adoptionTrend' AND year <= {LAST}", "label", "year", count="value"),
    _figure("figure3", _F3, "label", str(LAST), count_from="old", count_to="new", rate_from_pct=_rate("old", "old_all"), rate_to_pct=_rate("new", "new_all"), delta_pp=_gap("new", "new_all", "old", "old_all")),
    _figure("figure4", _F4, "label", str(LAST), assignments="n", share_pct=_rate("n", "total")),
    _figure("figure4 groups", f"(SELECT CASE WHEN label IN ('v0', 'v1') THEN 'named_tracked' WHEN label = 'v2' THEN 'opaque_or_untracked' ELSE 'internal' END AS label, sum(n) AS n, any_value(total) AS total FROM {_F4} GROUP BY 1)", "label", str(LAST), assignments="n", share_pct=_rate("n", "total")),
    _figure("figure5", f"{_F5} WHERE year BETWEEN {FIRST} AND {LAST}", "NULL", "year", total_reports="total", risk_reports="risk", substantive_risk_reports="sub", risk_mention_rate_pct=_rate("risk", "total"), substantive_risk_rate_pct=_rate("sub", "total"), quality_gap_pp=_gap("risk", "total", "sub", "total")),
    _figure("figure6", f"{_S} WHERE year = {LAST}", "sector", "year", total_reports="total", risk_reports="risk", no_ai_risk_reports="no_risk", risk_rate_pct=_rate("risk", "total"), no_ai_risk_rate_pct=_rate("no_risk", "total")),
    _figure("figure7", f"(SELECT a.sector, a.year, a.total, a.risk, coalesce(b.total, 0) AS old_total, coalesce(b.risk, 0) AS old_risk FROM {_S} a LEFT JOIN {_S} b ON b.sector = a.sector AND b.year = a.year - 1 WHERE a.year BETWEEN {FIRST} AND {LAST})", "sector", "year",
            current_risk_rate_pct=_rate("risk", "total"), previous_risk_rate_pct=_rate("old_risk", "old_total"), delta_pp=_gap("risk", "total", "old_risk", "old_total")),
    _figure("figure8", _F8, "segment", str(LAST), total_reports="total", ai_mention_reports="ai", adoption_reports="adoption", risk_reports="risk", ai_mention_rate_pct=_rate("ai", "total"), adoption_rate_pct=_rate("adoption", "total"), risk_rate_pct=_rate("risk", "total")),
])


@query(f"WITH {_BASE}, w AS (SELECT * FROM cube WHERE basis = 'report' AND segment = 'All' AND scope = 'all' AND year IS NOT NULL AND month IS NULL), f AS ({_FIGURES}) SELECT figure, key, CAST(year AS INTEGER) AS year, m.measure AS measure, m.value AS value FROM f")
def figure_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data of the report's eight figures, from the series of the dashboard's reports that they show."""
    return board.figures(_board(spark, sf_dir, series=board.FIGURE_SERIES, bases=("report",)), LAST, FIRST, ("v0", "v1"), ("v2",), "v3", OTHER)
