"""Versions, the pointer, writers that die and backups."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.publish import POINTER, Published


def _ids(df) -> list[int]:  # noqa: ANN001
    return sorted(r[0] for r in df.collect())


def test_readers_see_whole_versions_only(spark: SparkSession, tmp_path: Path) -> None:
    store = Published(spark, f"file://{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        store.read()
    store.publish(spark.range(3))
    held = store.read()
    # a writer that dies halfway through its rows
    failing = spark.range(10, 20, numPartitions=4).withColumn("id", F.when(F.col("id") == 17, F.raise_error(F.lit("dead"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="dead"):
        store.publish(failing)
    assert _ids(store.read()) == [0, 1, 2]
    # and one that dies after its rows, before the pointer
    lost = store.write(spark.range(30, 33))
    assert _ids(Published(spark, f"file://{tmp_path}/t").read()) == [0, 1, 2]
    store.publish(spark.range(5, 7))
    assert _ids(store.read()) == [5, 6]
    assert _ids(held) == [0, 1, 2]  # who began with the old version goes on with it
    assert lost in store.versions() and lost in store.sweep()
    assert _ids(store.read()) == [5, 6]
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith(f"_{POINTER}")]


def test_backups(spark: SparkSession, tmp_path: Path) -> None:
    store = Published(spark, f"file://{tmp_path}/t")
    names = [store.publish(spark.range(i, i + 1), keep=2) for i in range(4)]
    assert names == sorted(names) and store.current() == names[3]
    assert store.roll_back() == names[2] and _ids(store.read()) == [2]
    assert store.roll_back() == names[1] and _ids(store.read()) == [1]
    with pytest.raises(FileNotFoundError):
        store.roll_back()
    assert store.publish(spark.range(9, 10)) > names[3]  # a new version's number is over all that were begun
    assert set(store.sweep()) == {names[0], names[2], names[3]}
    assert _ids(store.read(names[1])) == [1]
