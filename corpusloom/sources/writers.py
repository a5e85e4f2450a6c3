"""Writers: CSV, JSON lines, one folder for each group, single JSON summaries, and markdown tables of small results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    df.select(*(columns or df.columns)).write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="", lineSep="\n")


def csv_union(parts: list[DataFrame], path: str) -> None:
    """All columns of all parts, in order of first appearance."""
    csv(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), path)


def json_lines(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines; with `by`, a folder for each of its values."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def json_summary(df: DataFrame, path: str) -> None:
    """A result of one row as one JSON document."""
    df.limit(1).select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def front_matter(df: DataFrame, text: str, fields: list[str]) -> DataFrame:
    """Adds `document`: the fields as front matter, then the text."""
    head = [F.concat(F.lit(f"{f}: "), F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in fields]
    return df.withColumn("document", F.concat_ws("\n", F.lit("---"), *head, F.lit("---"), F.lit(""), F.col(text)))


def markdown_reports(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """(key, report): for each key a heading and a Markdown table of its rows in order. Pipes and line ends inside cells are escaped; a report is one text, so a key's rows must fit one."""
    cell = lambda c: F.regexp_replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"\\s*\\n\\s*", "<br>")
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |"))
    rows = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), line.alias("line")))).alias("_rows"))
    head = F.concat(F.lit("## "), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("\n\n| " + " | ".join(columns) + " |\n|" + " --- |" * len(columns) + "\n"))
    return rows.select(key, F.concat(head, F.array_join(F.transform("_rows", lambda r: r["line"]), "\n")).alias("report"))


def csv_cell(value: Column) -> Column:
    """A cell as an export writes it: quoted, with doubled quotes, where it holds a quote, a comma or a line end."""
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(F.regexp_like(value, F.lit('[",\n]')), quoted).otherwise(value)
