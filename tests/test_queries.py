"""Every query that has SQL gives the same rows as DuckDB does."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from corpusloom.plans import SQL, all_queries

from .oracle import differences


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark: SparkSession, sf_dir: str, name: str) -> None:
    assert differences(all_queries()[name](spark, sf_dir), SQL[name], sf_dir) == []


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(SQL)))
def test_others_give_rows(spark: SparkSession, sf_dir: str, name: str) -> None:
    assert all_queries()[name](spark, sf_dir).count() > 0
