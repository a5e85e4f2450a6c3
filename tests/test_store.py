"""Stored tables by optional filters."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import readers, store


@pytest.fixture(scope="module")
def stored(spark: SparkSession, tmp_path_factory: pytest.TempPathFactory) -> str:
    path: Path = tmp_path_factory.mktemp("store") / "t"
    rows = spark.range(400).select("id", (F.col("id") % 5 + 2020).cast("int").alias("year"), F.concat(F.lit("k"), F.col("id") % 3).alias("kind"))
    store.save(rows, f"file://{path}", ["year"])
    return f"file://{path}"


def _plan(df) -> str:  # noqa: ANN001
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_choose_folders_and_reach_the_scan(spark: SparkSession, stored: str) -> None:
    found = store.read(spark, stored, {"year": [2021, 2022], "kind": "k1"}, {"id": (10, 300)}, ["id"])
    assert [r["id"] for r in found.collect()] == [i for i in range(10, 301) if i % 5 in (1, 2) and i % 3 == 1]
    plan = _plan(found)
    assert "PartitionFilters: [year" in plan and "EqualTo(kind,k1)" in plan and "GreaterThanOrEqual(id,10)" in plan


def test_filters_that_are_not_given_leave_no_trace(spark: SparkSession, stored: str) -> None:
    found = store.read(spark, stored, {"year": None, "kind": None}, {"id": (None, None)})
    assert found.count() == 400 and "Filter" not in _plan(found).replace("PartitionFilters", "").replace("PushedFilters", "").replace("DataFilters", "")


def test_values_are_never_part_of_the_statement(spark: SparkSession, stored: str) -> None:
    assert store.read(spark, stored, {"kind": "k1' OR 'a'='a"}).count() == 0
    assert store.read(spark, stored, {"kind": []}).count() == 0
    with pytest.raises(ValueError, match="no column"):
        store.read(spark, stored, {"kind; DROP": 1})


def test_folders_are_pruned_by_a_joined_dimension(spark: SparkSession, stored: str) -> None:
    years = spark.createDataFrame([(2020, "a"), (2023, "b")], "year int, name string").where("name = 'b'")
    found = store.read(spark, stored).join(F.broadcast(years), "year")
    assert found.count() == 80 and "dynamicpruning" in _plan(found)


def test_records_in_two_encodings(spark: SparkSession, tmp_path: Path) -> None:
    (tmp_path / "a.txt").write_bytes("été\x1e".encode() + "été\n2".encode("latin-1") + b"\x1e" + "漢字".encode() + b"\x1e")
    found = readers.decoded(spark, f"file://{tmp_path}", "\x1e").collect()
    assert sorted((r["text"], r["size"]) for r in found) == sorted([("été", 5), ("été\n2", 5), ("漢字", 6)])
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "whole.txt").write_bytes("né\nb".encode("latin-1"))
    assert [r["text"] for r in readers.decoded(spark, f"file://{tmp_path}/b").collect()] == ["né\nb"]
