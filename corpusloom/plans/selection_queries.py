"""Queries that choose rows: best of a group, losers, ranks, shards, swaps and diverse examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import lookup
from ..operators import select
from .base import FILINGS_SQL, REPORTS_SQL, filings, reports
from .registry import query, table

KIND_RANK = {"F": 3, "O": 2, "P": 1}
_KIND = "CASE kind WHEN 'F' THEN 3 WHEN 'O' THEN 2 WHEN 'P' THEN 1 ELSE 0 END"
_BEST = f"row_number() OVER (PARTITION BY owner, year ORDER BY {_KIND} DESC, size DESC, pk)"


def _order() -> list:
    return [lookup(F.col("kind"), KIND_RANK, 0).desc(), F.desc("size"), F.col("pk")]


@query(f"WITH {FILINGS_SQL}, r AS (SELECT *, {_BEST} AS n FROM filings) SELECT pk, owner, year, kind, size FROM r WHERE n = 1")
def pick_best_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.pick_best(filings(spark, sf_dir), ["owner", "year"], _order()).select("pk", "owner", "year", "kind", "size")


@query(f"WITH {FILINGS_SQL}, r AS (SELECT *, {_BEST} AS n FROM filings) SELECT pk, owner, year FROM r WHERE n > 1")
def dropped_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.losers(filings(spark, sf_dir), ["owner", "year"], _order()).select("pk", "owner", "year")


@query(f"WITH {FILINGS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY owner, year ORDER BY CASE WHEN kind = 'F' THEN 0 ELSE 1 END, filed DESC, pk) AS n FROM filings) SELECT owner, year, pk, filed FROM r WHERE n = 1")
def prefer_type_then_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.when(F.col("kind") == "F", 0).otherwise(1), F.desc("filed"), F.col("pk")]
    return select.pick_best(filings(spark, sf_dir), ["owner", "year"], order).select("owner", "year", "pk", "filed")


@query(f"""WITH {FILINGS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY {_KIND} DESC, pk DESC) AS n, count(*) OVER (PARTITION BY owner) AS candidates FROM filings)
SELECT owner, pk, candidates FROM r WHERE n = 1""")
def winner_with_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner and the group's size come from one aggregate with partial sums, so no group is gathered."""
    best = F.struct(lookup(F.col("kind"), KIND_RANK, 0), F.col("pk"))
    return filings(spark, sf_dir).groupBy("owner").agg(F.max_by("pk", best).alias("pk"), F.count("*").alias("candidates"))


@query(f"WITH {FILINGS_SQL} SELECT pk, owner, size > 200000 OR size >= 50000 AND priority = '1-URGENT' AS chosen, CASE WHEN row_number() OVER (PARTITION BY owner, year ORDER BY size DESC, pk) = 1 THEN 'kept' ELSE 'duplicate' END AS status FROM filings")
def duplicate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select.ranked(filings(spark, sf_dir), ["owner", "year"], [F.desc("size"), F.col("pk")])
    chosen = (F.col("size") > 200000) | ((F.col("size") >= 50000) & (F.col("priority") == "1-URGENT"))
    return rows.select("pk", "owner", chosen.alias("chosen"), F.when(F.col("rank") == 1, "kept").otherwise("duplicate").alias("status"))


@query("""WITH n AS (SELECT c_mktsegment AS sector, c_custkey AS owner, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer)
SELECT * FROM n WHERE rank <= 5""")
def top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_acctbal")
    rows = select.top_n(owners, ["c_mktsegment"], [F.desc("c_acctbal"), F.col("c_custkey")], 5)
    return rows.select(F.col("c_mktsegment").alias("sector"), F.col("c_custkey").alias("owner"), "rank")


@query("""SELECT s_suppkey AS supplier, dense_rank() OVER (ORDER BY s_nationkey) AS nation_rank, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS place FROM supplier""")
def dense_rank_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group numbers come from the few distinct groups, so rows need no global order."""
    rows = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    groups = select.numbered(rows.select("s_nationkey").distinct(), [F.col("s_nationkey")], "nation_rank")
    placed = select.ranked(rows, ["s_nationkey"], [F.desc("s_acctbal"), F.col("s_suppkey")], "place")
    return placed.join(groups, "s_nationkey").select(F.col("s_suppkey").alias("supplier"), "nation_rank", "place")


@query("""WITH n AS (SELECT n_nationkey AS k, row_number() OVER (ORDER BY n_name) - 1 AS p, count(*) OVER () AS n FROM nation)
SELECT k AS nation, CAST(1 + floor(((p + 1) * 4 - 1) / n) AS INTEGER) AS shard FROM n""")
def contiguous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select.shard_of(table(spark, sf_dir, "nation"), [F.col("n_name")], 4)
    return rows.select(F.col("n_nationkey").alias("nation"), "shard")


@query("SELECT n_nationkey AS nation, n_name AS name FROM nation ORDER BY n_name LIMIT 10 OFFSET 5")
def offset_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").orderBy("n_name").offset(5).limit(10).select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))


@query("""WITH d AS (SELECT c_custkey AS out_id, c_mktsegment AS sector, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n FROM customer WHERE c_acctbal < 0),
 s AS (SELECT c_custkey AS in_id, c_mktsegment AS sector, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer WHERE c_acctbal >= 5000)
SELECT d.sector, out_id, in_id FROM d JOIN s ON d.sector = s.sector AND d.n = s.n""")
def zip_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_acctbal").withColumnRenamed("c_mktsegment", "sector")
    dropped = owners.where("c_acctbal < 0").select("sector", F.col("c_custkey").alias("out_id"))
    spare = owners.where("c_acctbal >= 5000").select("sector", F.col("c_custkey").alias("in_id"), "c_acctbal")
    return select.zip_by_rank(dropped, spare, ["sector"], [F.col("out_id")], [F.desc("c_acctbal"), F.col("in_id")]).select("sector", "out_id", "in_id")


@query(f"""WITH {REPORTS_SQL}, r AS (SELECT report, owner, year, len(labels) AS n, row_number() OVER (PARTITION BY owner ORDER BY len(labels) DESC, year DESC, report) AS p FROM reports)
SELECT report, owner FROM r ORDER BY p > 1, n DESC, year DESC, report LIMIT 12""")
def diverse_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports(spark, sf_dir).withColumn("n", F.size("labels"))
    return select.diverse(rows, "owner", [F.desc("n"), F.desc("year"), F.col("report")], 12).select("report", "owner")


@query(f"WITH {FILINGS_SQL} SELECT owner, arg_max(priority, (filed, pk)) AS latest_priority FROM filings GROUP BY owner")
def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings(spark, sf_dir).groupBy("owner").agg(F.max_by("priority", F.struct("filed", "pk")).alias("latest_priority"))


@query(f"""WITH {FILINGS_SQL}, n AS (SELECT owner, priority, count(*) AS c, min(pk) AS first_pk FROM filings GROUP BY ALL)
SELECT owner, arg_max(priority, (c, -first_pk)) AS modal FROM n GROUP BY owner""")
def modal_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent value; of equally frequent ones that which came first."""
    counts = filings(spark, sf_dir).groupBy("owner", "priority").agg(F.count("*").alias("n"), F.min("pk").alias("first_pk"))
    return counts.groupBy("owner").agg(F.max_by("priority", F.struct("n", -F.col("first_pk"))).alias("modal"))


@query(f"WITH {FILINGS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY owner, kind ORDER BY pk) AS n FROM filings) SELECT owner, kind, pk, n > 1 AS seen_before FROM r")
def seen_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags repeats of a key. The first of each key is found by a partial minimum and joined back."""
    rows = filings(spark, sf_dir).select("owner", "kind", "pk")
    first = rows.groupBy("owner", "kind").agg(F.min("pk").alias("first_pk"))
    return rows.join(first, ["owner", "kind"]).select("owner", "kind", "pk", (F.col("pk") > F.col("first_pk")).alias("seen_before"))


@query("""WITH o AS (SELECT o_custkey AS owner, list_sort(list(DISTINCT year(o_orderdate))) AS years, bool_or(o_orderstatus = 'P') AS gap FROM orders GROUP BY 1)
SELECT owner FROM o WHERE list_has_all(years, [1996, 1997, 1998]) AND NOT gap""")
def eligible_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners with a report in every wished year and none of a bad status."""
    rows = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_orderstatus")
    wanted = (1996, 1997, 1998)
    year = F.year("o_orderdate")
    found = rows.groupBy(F.col("o_custkey").alias("owner")).agg(
        F.count_distinct(F.when(year.isin(*wanted), year)).alias("years"), F.bool_or(F.col("o_orderstatus") == "P").alias("gap")
    )
    return found.where((F.col("years") == len(wanted)) & ~F.col("gap")).select("owner")


@query(f"""WITH {FILINGS_SQL}, s AS (SELECT owner, CAST(sum({_KIND}) AS BIGINT) AS ready, count(*) AS reports FROM filings WHERE year IN (1996, 1997) GROUP BY owner)
SELECT owner, ready, reports FROM s ORDER BY ready DESC, reports DESC, owner LIMIT 25""")
def ready_score_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report's limit: the 25 owners whose statuses add up to most."""
    rows = filings(spark, sf_dir).where(F.col("year").isin(1996, 1997))
    scores = rows.groupBy("owner").agg(F.sum(lookup(F.col("kind"), KIND_RANK, 0)).alias("ready"), F.count("*").alias("reports"))
    return scores.orderBy(F.desc("ready"), F.desc("reports"), "owner").limit(25)


@query("""SELECT n_name AS name, r_name AS section, CAST(row_number() OVER (PARTITION BY n_nationkey % 2 ORDER BY coalesce(list_position(['EUROPE', 'ASIA'], r_name), 9), r_name, n_name) AS INTEGER) AS rank FROM nation JOIN region ON r_regionkey = n_regionkey""")
def locale_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in readers' order inside sections, two of which come first."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    rows = rows.select(F.col("n_name").alias("name"), F.col("r_name").alias("section"), (F.col("n_nationkey") % 2).alias("half"))
    return select.ranked(rows, ["half"], select.locale_order("name", "section", ("EUROPE", "ASIA"))).select("name", "section", "rank")


@query("SELECT o_orderstatus AS status, least(count(*), 50) AS found, least(count(*), 50) AS fitting FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus")
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans that stop when fifty rows of a status are found (the limit is the feature), and how many of what they found fit."""
    orders = table(spark, sf_dir, "orders", "o_orderstatus", "o_totalprice")
    out = None
    for status in ("F", "O", "P"):
        fits = (F.col("o_orderstatus") == status) & (F.col("o_totalprice") > 100000)
        found = orders.where(fits).limit(50).agg(F.lit(status).alias("status"), F.count("*").alias("found"), F.count_if(fits).alias("fitting")).where("found > 0")
        out = found if out is None else out.union(found)
    return out
