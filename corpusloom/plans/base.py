"""The harness tables seen as reports, signals, label pairs and filings.

An order is a report of its customer; a line's return flag is a label, its discount the label's signal; the market segment
is the sector. `R` stands for the risk label and `N` for none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

LABELS = ("A", "N", "R")
RISK, NONE = "R", "N"

REPORTS_SQL = """
lab AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS labels FROM lineitem GROUP BY l_orderkey),
reports AS (
  SELECT o_orderkey AS report, o_custkey AS owner, c_mktsegment AS sector, CAST(year(o_orderdate) AS INTEGER) AS year,
         strftime(o_orderdate, '%Y-%m') AS month, coalesce(labels, CAST([] AS VARCHAR[])) AS labels
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN lab ON l_orderkey = o_orderkey)
"""
SIGNALS_SQL = """
sig AS (
  SELECT l_orderkey AS report, CAST(year(o_orderdate) AS INTEGER) AS year, l_discount * 10 AS signal,
    CASE WHEN l_discount * 10 >= 0.67 THEN (CASE WHEN l_discount * 10 < 1 THEN 3 ELSE least(greatest(CAST(floor(l_discount * 10 + 0.5) AS INTEGER), 1), 3) END)
         WHEN l_discount * 10 >= 0.34 THEN 2 WHEN l_discount * 10 > 0 THEN 1 ELSE 0 END AS lvl
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
named AS (SELECT *, CASE WHEN lvl >= 3 THEN 'strong' WHEN lvl >= 2 THEN 'medium' WHEN lvl >= 1 THEN 'weak' END AS level FROM sig)
"""
PAIRS_SQL = """
conf AS (
  SELECT l_orderkey AS id, l_returnflag AS label, max(CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END) AS in_truth,
         max(CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 0 END) AS in_guess, max(CASE WHEN l_linenumber % 2 = 1 THEN l_discount * 10 END) AS c
  FROM lineitem GROUP BY 1, 2),
pairs AS (
  SELECT id, coalesce(list_sort(list(label) FILTER (WHERE in_truth = 1)), CAST([] AS VARCHAR[])) AS truth,
         coalesce(list_sort(list(label) FILTER (WHERE in_guess = 1)), CAST([] AS VARCHAR[])) AS guess
  FROM conf GROUP BY id)
"""


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """report, owner, sector, year, month and labels. Lines are reduced to one row for each order before the join."""
    labels = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("labels"))
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").join(labels, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    owners = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return orders.join(owners, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("report"),
        F.col("o_custkey").alias("owner"),
        F.col("c_mktsegment").alias("sector"),
        F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.coalesce("labels", F.array().cast("array<string>")).alias("labels"),
    )


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """report, year and signal of every line."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_discount")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("report"), F.year("o_orderdate").alias("year"), (F.col("l_discount") * 10).alias("signal"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two label sets for each order: truth from its even lines, guess (with confidences) from its odd ones."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_discount")
    odd = F.col("l_linenumber") % 2 == 1
    by_label = lines.groupBy(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("label")).agg(
        F.bool_or(~odd).alias("t"), F.bool_or(odd).alias("g"), F.max(F.when(odd, F.col("l_discount") * 10)).alias("c")
    )
    return by_label.groupBy("id").agg(
        F.array_sort(F.collect_list(F.when(F.col("t"), F.col("label")))).alias("truth"),
        F.array_sort(F.collect_list(F.when(F.col("g"), F.col("label")))).alias("guess"),
        F.map_from_entries(F.collect_list(F.when(F.col("g"), F.struct("label", "c")))).alias("confidences"),
    )


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filings: pk, owner, year, kind (status), size (total price) and filed (date)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pk"), F.col("o_custkey").alias("owner"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("kind"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("size"), F.to_date("o_orderdate").alias("filed"),
    )


FILINGS_SQL = """
filings AS (
  SELECT o_orderkey AS pk, o_custkey AS owner, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS kind, o_orderpriority AS priority,
         o_totalprice AS size, CAST(o_orderdate AS DATE) AS filed FROM orders)
"""
