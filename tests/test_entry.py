"""The driver's contract."""

from __future__ import annotations

import importlib.util

from pyspark.sql import SparkSession

import __spark_entry__ as entry


def test_flagship(spark: SparkSession) -> None:
    assert entry.entry(spark).count() > 0


def test_names_agree() -> None:
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_optional_operators_are_there_with_their_package() -> None:
    there = importlib.util.find_spec("corpusloom.llm") is not None
    assert any(n.startswith("op1_") for n in entry.queries()) == there
