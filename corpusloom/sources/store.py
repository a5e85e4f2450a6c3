"""Stored tables read by optional filters: partitioned by the columns that are asked for most, queried by SQL with parameters.

Values travel as parameters, never as text of the statement, so any string is safe. Filters that aren't given leave no trace in
the plan; those on partition columns choose folders, the others reach the Parquet scan. Joined to a filtered
dimension on a partition column, Spark prunes folders at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def save(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Writes df in folders by the columns, each task's rows of a folder in one file: rows are dealt by the columns and rebalanced, so a large folder has several files."""
    df.hint("rebalance", *by).write.partitionBy(*by).parquet(path)


def read(spark: SparkSession, path: str, filters: Mapping[str, object] | None = None, ranges: Mapping[str, tuple] | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Rows whose columns have the given values (a list: one of them; None: not filtered) and lie in the given ranges (ends included, None: open)."""
    rows = spark.read.parquet(path)
    tests, values = [], {}

    def bind(value: object) -> str:
        values[f"p{len(values)}"] = value
        return f":p{len(values) - 1}"

    for column, value in (filters or {}).items():
        if column not in rows.columns:
            raise ValueError(f"no column {column}")
        if isinstance(value, (list, tuple, set)):
            tests.append(f"`{column}` IN ({', '.join(map(bind, value))})" if value else "false")
        elif value is not None:
            tests.append(f"`{column}` = {bind(value)}")
    for column, (low, high) in (ranges or {}).items():
        if column not in rows.columns:
            raise ValueError(f"no column {column}")
        tests += [f"`{column}` {sign} {bind(end)}" for sign, end in ((">=", low), ("<=", high)) if end is not None]
    where = f" WHERE {' AND '.join(tests)}" if tests else ""
    by = f" ORDER BY {', '.join(f'`{c}`' for c in order)}" if order else ""
    return spark.sql(f"SELECT * FROM {{rows}}{where}{by}", args=values, rows=rows)
