"""Streams over a table of many files whose rows aren't in time order."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.plans import all_queries
from corpusloom.streaming import events


@pytest.fixture(scope="module")
def unordered(spark: SparkSession, sf_dir: str, tmp_path_factory: pytest.TempPathFactory) -> str:
    folder: Path = tmp_path_factory.mktemp("unordered")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(20, F.xxhash64("event_id")).write.option("maxRecordsPerFile", 0).parquet(f"{folder}/events.parquet")
    assert len(list((folder / "events.parquet").glob("*.parquet"))) > 8
    return str(folder)


def _rows(df) -> list:  # noqa: ANN001
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_counts_of_unordered_files(spark: SparkSession, unordered: str) -> None:
    found = all_queries()["streaming_event_counts"](spark, unordered)
    events = spark.read.parquet(f"{unordered}/events.parquet").withColumn("start", F.date_trunc("hour", F.col("ts").cast("timestamp")))
    want = events.groupBy("start", "event_type").agg(F.count("*").alias("n"))
    assert _rows(found.select("start", "event_type", "n")) == _rows(want)


def test_unique_events_of_unordered_files(spark: SparkSession, unordered: str) -> None:
    found = all_queries()["streaming_unique_events"](spark, unordered)
    assert _rows(found.select("event_id")) == _rows(spark.read.parquet(f"{unordered}/events.parquet").select("event_id").distinct())


def test_sessions_of_unordered_files(spark: SparkSession, unordered: str) -> None:
    """All of the batch's sessions, the last ones too."""
    assert _rows(all_queries()["streaming_sessions"](spark, unordered)) == _rows(all_queries()["batch_sessions"](spark, unordered))


def test_late_rows_have_an_output_of_their_own(spark: SparkSession, tmp_path: Path) -> None:
    """Twenty days in time order, then rows of the first days: the state holds about a day, late rows come out one by one, and both together are the batch's counts."""
    hours = spark.range(0, 480 * 20).select(F.col("id").alias("event_id"), F.timestamp_seconds(1_704_067_200 + F.col("id") * 180).alias("ts"), F.concat(F.lit("t"), F.col("id") % 2).alias("event_type"), (F.col("id") % 7).cast("double").alias("value"))
    folder = tmp_path / "events.parquet"
    ordered = hours.withColumn("part", F.floor(F.col("event_id") / 480).cast("int"))
    for part in range(20):
        ordered.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(str(folder))
    old = hours.where("event_id < 100").select((F.col("event_id") + 1_000_000).alias("event_id"), "ts", "event_type", F.lit(None).cast("double").alias("value"))
    old.coalesce(1).write.mode("append").parquet(str(folder))
    found = events.drain(events.counts_with_late(events.stream(spark, str(folder), files=1), late="6 hours"), "update")
    late = found.where("kind = 'late'")
    assert {r["event_id"] for r in late.collect()} == {r["event_id"] for r in old.collect()}
    assert found.agg(F.max("held")).first()[0] <= 24 + 6 + 2  # a batch's day, the watermark's hours, and the ends of both
    closed = found.where("kind = 'closed'")
    assert closed.count() == closed.select("start", "event_type", "shard").distinct().count() > 1000
    want = hours.unionByName(old).groupBy(F.date_trunc("hour", "ts").alias("start"), "event_type").agg(F.count("*").alias("n"), F.sum(F.coalesce("value", F.lit(0.0))).alias("total"))
    assert _rows(events.settled(found)) == _rows(want.select("start", "event_type", "n", "total"))


def test_empty_stream(spark: SparkSession, tmp_path: Path) -> None:
    folder = tmp_path / "events.parquet"
    spark.createDataFrame([], "event_id long, ts timestamp, event_type string, value double").write.parquet(str(folder))
    assert events.settled(events.drain(events.counts_with_late(events.stream(spark, str(folder))), "update")).count() == 0
