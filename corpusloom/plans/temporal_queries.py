"""Queries over dates, order and streams of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as rules
from ..operators import temporal
from ..streaming import events as streaming
from .base import FILINGS_SQL, filings
from .registry import query, table


def _years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings(spark, sf_dir).select("owner", "year")


@query(f"""WITH {FILINGS_SQL}, b AS (SELECT owner, min(year) AS lo, max(year) AS hi FROM filings GROUP BY owner), s AS (SELECT owner, unnest(range(lo, hi + 1)) AS gap_year FROM b)
SELECT owner, CAST(gap_year AS INTEGER) AS gap_year FROM s WHERE (owner, gap_year) NOT IN (SELECT owner, year FROM filings)""")
def gap_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.gap_years(_years(spark, sf_dir), "owner")


_COLLISION = f"""WITH {FILINGS_SQL}, y AS (SELECT owner, year, count(*) AS candidates, CAST(year - arg_max(CAST(substr(priority, 1, 1) AS INTEGER), pk) % 3 AS INTEGER) AS title_year FROM filings GROUP BY owner, year),
 b AS (SELECT owner, min(year) AS lo, max(year) AS hi FROM y GROUP BY owner), s AS (SELECT owner, unnest(range(lo, hi + 1)) AS g FROM b), gaps AS (SELECT owner, CAST(g AS INTEGER) AS gap_year FROM s WHERE (owner, g) NOT IN (SELECT owner, year FROM y)),
 x AS (SELECT g.owner, g.gap_year, CASE WHEN y.year > g.gap_year THEN 'next' ELSE 'prev' END AS side, y.year - y.title_year AS lag, y.candidates FROM gaps g JOIN y ON y.owner = g.owner AND abs(y.year - g.gap_year) = 1),
 f AS (SELECT owner, gap_year, side, CASE WHEN lag >= 2 AND candidates > 1 THEN 'CONFIRMED' WHEN candidates > 1 THEN 'LIKELY' WHEN lag >= 2 THEN 'POSSIBLE' WHEN lag = 0 AND side = 'prev' THEN 'PATTERN' END AS severity FROM x)"""


def _collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = filings(spark, sf_dir).withColumn("digit", F.substring("priority", 1, 1).cast("int"))
    rows = named.groupBy("owner", "year").agg(F.count("*").alias("candidates"), F.max_by("digit", "pk").alias("digit"))
    return temporal.collisions(rows.withColumn("title_year", F.col("year") - F.col("digit") % 3), "owner")


@query(f"{_COLLISION} SELECT * FROM f WHERE severity IS NOT NULL")
def collision_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collisions(spark, sf_dir)


@query(f"{_COLLISION} SELECT severity, count(*) AS flags, count(DISTINCT owner) AS owners FROM f WHERE severity IS NOT NULL GROUP BY severity")
def collision_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collisions(spark, sf_dir).groupBy("severity").agg(F.count("*").alias("flags"), F.count_distinct("owner").alias("owners"))


@query(f"""WITH {FILINGS_SQL}, l AS (SELECT *, CASE WHEN date_diff('day', lag(filed) OVER w, filed) < 90 THEN 0 ELSE 1 END AS new FROM filings WINDOW w AS (PARTITION BY owner ORDER BY filed, pk)),
 c AS (SELECT *, CAST(sum(new) OVER (PARTITION BY owner ORDER BY filed, pk ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM l)
SELECT owner, cluster, count(*) AS members, arg_max(year, (size, -year)) AS best_value, count(DISTINCT year) > 1 AS conflict FROM c GROUP BY owner, cluster""")
def inactivity_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = temporal.clusters(filings(spark, sf_dir), "owner", "filed", 90, "pk")
    return temporal.cluster_summary(rows, "owner", "year", "size")


_SPANS = "spans AS (SELECT l_orderkey AS k, CAST(l_linenumber * 7 % 23 AS BIGINT) AS a, CAST(l_linenumber * 7 % 23 + l_quantity / 10 AS BIGINT) AS b FROM lineitem)"


def _islands(cut: str) -> str:
    return f"""WITH {_SPANS}, m AS (SELECT *, max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
 i AS (SELECT *, sum(CASE WHEN reach IS NULL OR {cut} THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS n FROM m)
SELECT k, min(a) AS "start", max(b) AS "end", count(*) AS parts FROM i GROUP BY k, n"""


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    a = (F.col("l_linenumber") * 7 % 23).cast("long")
    return lines.select(F.col("l_orderkey").alias("k"), a.alias("a"), F.round(a + F.col("l_quantity") / 10).cast("long").alias("b"))


@query(_islands("a >= reach").replace("CAST(l_linenumber * 7 % 23 + l_quantity / 10 AS BIGINT)", "CAST(round(l_linenumber * 7 % 23 + l_quantity / 10) AS BIGINT)"))
def merged_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.merged_intervals(_spans(spark, sf_dir), "k", "a", "b")


@query(_islands("a > reach + 1").replace("CAST(l_linenumber * 7 % 23 + l_quantity / 10 AS BIGINT)", "CAST(round(l_linenumber * 7 % 23 + l_quantity / 10) AS BIGINT)"))
def merged_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.merged_intervals(_spans(spark, sf_dir), "k", "a", "b", adjacent=True)


@query("""WITH t AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN left(text, 20) END AS heading FROM conversations)
SELECT conv_id, turn, last_value(heading IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM t""")
def carried_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("heading", F.when(F.col("role") == "user", F.substring("text", 1, 20)))
    return temporal.carried(turns, "conv_id", "turn", "heading").select("conv_id", "turn", "section")


@query("""SELECT conv_id, turn, coalesce(list(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), []) AS context_before,
 coalesce(list(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), []) AS context_after FROM conversations WHERE text IS NOT NULL""")
def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where("text is not null").withColumn("n", F.length("text").cast("long"))
    return temporal.context(turns, "conv_id", "turn", "n").select("conv_id", "turn", "context_before", "context_after")


_TITLE = """CASE o_orderkey % 5 WHEN 0 THEN 'Annual Report ' || y || '/' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') WHEN 1 THEN 'Results for the year ended 31 December ' || y
 WHEN 2 THEN 'Report and Accounts ' || y || '/' || (y + 1) WHEN 3 THEN 'AGM ' || (y - 3) || ' and ' || y ELSE 'Notice of meeting' END"""
_TITLES = f"""t0 AS (SELECT *, CAST(year(o_orderdate) + 22 AS BIGINT) AS y FROM orders), titles AS (SELECT o_orderkey AS pk, y, {_TITLE} AS title, o_orderkey % 5 AS form, CAST(o_orderdate + INTERVAL 22 YEAR AS DATE) AS released FROM t0)"""


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").withColumn("y", F.year("o_orderdate") + 22)
    y, form = F.col("y").cast("string"), F.col("o_orderkey") % 5
    title = (
        F.when(form == 0, F.concat(F.lit("Annual Report "), y, F.lit("/"), F.lpad(((F.col("y") + 1) % 100).cast("string"), 2, "0")))
        .when(form == 1, F.concat(F.lit("Results for the year ended 31 December "), y))
        .when(form == 2, F.concat(F.lit("Report and Accounts "), y, F.lit("/"), (F.col("y") + 1).cast("string")))
        .when(form == 3, F.concat(F.lit("AGM "), (F.col("y") - 3).cast("string"), F.lit(" and "), y))
        .otherwise("Notice of meeting")
    )
    released = F.add_months(F.to_date("o_orderdate"), 22 * 12)
    return rows.select(F.col("o_orderkey").alias("pk"), title.alias("title"), released.alias("released"))


@query(f"""WITH {_TITLES} SELECT pk, CAST(CASE form WHEN 0 THEN y + 1 WHEN 1 THEN y WHEN 2 THEN y + 1 WHEN 3 THEN y END AS INTEGER) AS fy FROM titles""")
def fiscal_year_from_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).select("pk", rules.fiscal_year(F.col("title")).alias("fy"))


@query(f"WITH {_TITLES} SELECT pk, CASE WHEN form = 1 THEN make_date(y, 12, 31) END AS period_end, CAST(y AS INTEGER) AS iso_year, strftime(released, '%Y-%m') AS iso_month FROM titles")
def period_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.date_format("released", "yyyy-MM-dd")
    return _titles(spark, sf_dir).select("pk", rules.period_end(F.col("title")).alias("period_end"), rules.iso_year(iso).alias("iso_year"), rules.iso_month(iso).alias("iso_month"))


@query(f"""WITH {_TITLES} SELECT pk, CAST(CASE form WHEN 0 THEN y + 1 WHEN 1 THEN CASE WHEN released < make_date(y, 12, 31) THEN y - 1 ELSE y END WHEN 2 THEN y + 1 WHEN 3 THEN y ELSE CASE WHEN month(released) <= 4 THEN y - 1 ELSE y END END AS INTEGER) AS fy,
 CASE WHEN form = 1 THEN 'HIGH' WHEN form IN (0, 2, 3) OR month(released) <= 4 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
 CASE WHEN form = 1 THEN 'title_date' WHEN form IN (0, 2, 3) THEN 'title_year' WHEN month(released) <= 4 THEN 'release_early' ELSE 'release' END AS fy_source,
 CASE WHEN form = 1 AND released < make_date(y, 12, 31) THEN 'ANOMALY_PUB_BEFORE_END' END AS anomaly FROM titles""")
def fiscal_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.fiscal_cascade(_titles(spark, sf_dir), "title", "released").select("pk", "fy", "confidence", "fy_source", "anomaly")


@query(f"""WITH {_TITLES}, a AS (SELECT t.pk, o_custkey AS owner, released, y, CASE WHEN t.pk % 7 = 0 AND y - 1 BETWEEN 2015 AND 2030 THEN y - 1 END AS d, form FROM titles t JOIN orders ON o_orderkey = t.pk),
 f AS (SELECT pk, owner, released, y, CAST(CASE WHEN d IS NOT NULL THEN d WHEN form = 0 THEN y + 1 WHEN form = 1 THEN CASE WHEN released < make_date(y, 12, 31) THEN y - 1 ELSE y END WHEN form = 2 THEN y + 1 WHEN form = 3 THEN y WHEN month(released) <= 4 THEN y - 1 ELSE y END AS INTEGER) AS fy,
  CASE WHEN d IS NOT NULL OR form = 1 THEN 2 WHEN form IN (0, 2, 3) OR month(released) <= 4 THEN 1 ELSE 0 END AS k, CASE WHEN d IS NOT NULL THEN 'document' WHEN form = 1 THEN 'title_date' WHEN form IN (0, 2, 3) THEN 'title_year' WHEN month(released) <= 4 THEN 'release_early' ELSE 'release' END AS src,
  CASE WHEN d IS NULL AND form = 1 AND released < make_date(y, 12, 31) THEN 'ANOMALY_PUB_BEFORE_END' END AS anomaly FROM a),
 g AS (SELECT *, CASE WHEN date_diff('day', lag(released) OVER (PARTITION BY owner ORDER BY released, pk), released) < 90 THEN 0 ELSE 1 END AS fresh FROM f), c AS (SELECT *, sum(fresh) OVER (PARTITION BY owner ORDER BY released, pk) AS cl FROM g),
 b AS (SELECT owner, cl, count(DISTINCT fy) AS years, max(k) AS top FROM c GROUP BY owner, cl), w AS (SELECT c.owner, c.cl, arg_min(fy, (released, pk)) AS fy, arg_min(src, (released, pk)) AS src FROM c JOIN b ON b.owner = c.owner AND b.cl = c.cl AND c.k = b.top GROUP BY c.owner, c.cl),
 r AS (SELECT c.pk, c.y, CASE WHEN years = 1 AND k < top THEN w.fy ELSE c.fy END AS fy, CASE WHEN years = 1 THEN top ELSE k END AS k, CASE WHEN years = 1 AND k < top THEN 'cluster_propagated(' || w.src || ')' ELSE c.src END AS src, CASE WHEN years > 1 THEN 'ANOMALY_CLUSTER' ELSE anomaly END AS anomaly
  FROM c JOIN b ON b.owner = c.owner AND b.cl = c.cl JOIN w ON w.owner = c.owner AND w.cl = c.cl)
SELECT pk, CAST(y AS INTEGER) AS manifest_fy, fy, ['LOW', 'MEDIUM', 'HIGH'][k + 1] AS confidence, src AS fy_source, anomaly, CASE WHEN anomaly IS NOT NULL THEN 'qa' ELSE 'correction' END AS outcome FROM r WHERE anomaly IS NOT NULL OR (fy <> y AND k > 0)""")
def fiscal_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cascade with documents' own years, its clusters of ninety days, and what is to be corrected or looked at."""
    owners = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("pk"), F.col("o_custkey").alias("owner"))
    rows = _titles(spark, sf_dir).join(owners, "pk").withColumn("manifest_fy", F.year("released")).withColumn("doc", F.when(F.col("pk") % 7 == 0, F.year("released") - 1))
    found = temporal.propagated(temporal.fiscal_cascade(rows, "title", "released", "doc"), "owner", "released", "pk")
    return temporal.outcomes(found, "manifest_fy").select("pk", "manifest_fy", "fy", "confidence", "fy_source", "anomaly", "outcome")


@query(f"""WITH {FILINGS_SQL}, n AS (SELECT owner, CAST(date_diff('day', make_date(year, 1, 1), filed) / 60 AS BIGINT) AS lag FROM filings), c AS (SELECT owner, lag, count(*) AS n FROM n GROUP BY ALL)
SELECT owner, arg_max(lag, (n, -lag)) AS typical_lag FROM c GROUP BY owner""".replace("CAST(date_diff('day', make_date(year, 1, 1), filed) / 60 AS BIGINT)", "date_diff('day', make_date(year, 1, 1), filed) // 60"))
def typical_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent distance (in 60 days) to the year's start; ties go to the shorter."""
    lag = F.floor(F.datediff("filed", F.make_date("year", F.lit(1), F.lit(1))) / 60)
    counts = filings(spark, sf_dir).groupBy("owner", lag.alias("lag")).agg(F.count("*").alias("n"))
    return counts.groupBy("owner").agg(F.max_by("lag", F.struct("n", -F.col("lag"))).alias("typical_lag"))


# streams: every query reads its whole table as a stream and returns what the stream wrote
def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.stream(spark, f"{sf_dir}/events.parquet")


def _late(spark: SparkSession, sf_dir: str) -> str:
    return streaming.lateness(spark, f"{sf_dir}/events.parquet")


@query('SELECT date_trunc(\'hour\', ts) AS "start", event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL')
def streaming_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by hour and type with a watermark of one day: windows behind it are closed and leave the state, and their late rows are added from the side output."""
    found = streaming.drain(streaming.counts_with_late(_events(spark, sf_dir)), "update")
    return streaming.settled(found).withColumn("total", F.round("total", 4))


@query("SELECT event_id, any_value(user_id) AS user_id FROM events GROUP BY event_id")
def streaming_unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir)
    return streaming.drain(streaming.unique_events(rows.select("event_id", "user_id", "ts"), late=_late(spark, sf_dir))).select("event_id", "user_id")


_SESSIONS = """WITH l AS (SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
 s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k"""


@query(_SESSIONS)
def batch_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions by inactivity, as a batch; the stream's form is the same function with a watermark."""
    return streaming.sessions(table(spark, sf_dir, "events"))


@query(_SESSIONS)
def streaming_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions of the stream, also the last ones, which no watermark passes: each batch gives all sessions, and the last one counts."""
    return streaming.drain(streaming.sessions(_events(spark, sf_dir), late=_late(spark, sf_dir)), "complete")


@query("SELECT event_id, user_id FROM events WHERE event_type <> 'view' AND event_id NOT IN (SELECT event_id FROM events WHERE event_id % 7 = 0)")
def resume_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stopped run has left: rows without an entry in the log of processed keys."""
    rows = table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    done = rows.where("event_id % 7 = 0").select("event_id")
    return rows.where("event_type <> 'view'").join(done, "event_id", "left_anti").select("event_id", "user_id")
