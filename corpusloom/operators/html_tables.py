"""HTML tables as cell grids, and the choice of the table, header row and columns that hold names and tickers."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the rules below.
NAME_HEADS = ("company", "constituent", "security", "issuer", "name")
TICKER_HEADS = ("ticker", "epic", "symbol", "mnemonic", "ric")
LONGEST_HEAD = 24
MOST_NAMES = 30
LEAST_SCORE = 35
SCORE = {"enough rows": 10, "near the expected number": 15, "names": 40, "tickers": 10}


class _Grid(HTMLParser):
    """Cells of all tables in order of their start; nested tables are tables of their own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.open: list[list[list[str]]] = []
        self.cell: list[list[str] | None] = []

    def _end_cell(self) -> None:
        if self.cell and self.cell[-1] is not None:
            self.open[-1][-1].append(" ".join("".join(self.cell[-1]).split()))
            self.cell[-1] = None

    def handle_starttag(self, tag: str, attrs: list) -> None:  # noqa: ARG002
        if tag == "table":
            grid: list[list[str]] = []
            self.tables.append(grid)
            self.open.append(grid)
            self.cell.append(None)
        elif self.open and tag == "tr":
            self._end_cell()
            self.open[-1].append([])
        elif self.open and tag in ("td", "th"):
            self._end_cell()
            if not self.open[-1]:
                self.open[-1].append([])
            self.cell[-1] = []
        elif self.cell and self.cell[-1] is not None and tag == "br":
            self.cell[-1].append(" ")

    def handle_endtag(self, tag: str) -> None:
        if self.open and tag in ("td", "th", "tr", "table"):
            self._end_cell()
            if tag == "table":
                self.open.pop()
                self.cell.pop()

    def handle_data(self, data: str) -> None:
        if self.cell and self.cell[-1] is not None:
            self.cell[-1].append(data)


def tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, place, cells): every table of every page as rows of cells; empty rows go. A null page has none."""
    kind = dict(pages.dtypes)[key]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for i, page in enumerate(b.column(1).to_pylist()):
                grid = _Grid()
                grid.feed(page or "")
                grid.close()
                found += [(i, n, [r for r in t if any(r)]) for n, t in enumerate(grid.tables)]
            of, place, cells = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(of, pa.int64())), pa.array(place, pa.int32()), pa.array(cells, pa.list_(pa.list_(pa.string())))], [key, "place", "cells"])

    return pages.select(key, html).mapInArrow(make, f"`{key}` {kind}, place int, cells array<array<string>>")


def _normal(cell: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(cell), "[^a-z0-9]+", " "))


def _holds(cell: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(cell, w))


def _first(heads: Column, words: tuple[str, ...]) -> Column:
    """The 0-based place of the first head that one of the words stands in."""
    place = F.array_position(F.transform(heads, lambda h: _holds(_normal(h), words)), True)
    return F.when(place > 0, (place - 1).cast("int"))


def is_header(row: Column) -> Column:
    """A row that names what a column holds anywhere, or has letters in all cells and no long one."""
    cells = F.transform(row, _normal)
    letters = F.filter(cells, lambda c: F.regexp_like(c, F.lit("[a-z]")))
    short = (F.size(letters) > 0) & (F.size(letters) == F.size(cells)) & F.forall(letters, lambda c: F.length(c) <= LONGEST_HEAD)
    return (F.size(cells) > 0) & (_holds(F.array_join(cells, " "), NAME_HEADS + TICKER_HEADS) | short)


def scored(found: DataFrame, expected: Column) -> DataFrame:
    """Adds to tables `heads`, `body` (rows padded to one width), `name_at`, `ticker_at` and `score`, for an expected number of rows.

    Columns of names are found by their heads, else the second one if many first cells are whole numbers, else the first.
    """
    width = F.array_max(F.transform("cells", lambda r: F.size(r)))
    rows = found.where(F.size("cells") > 0).withColumn("_width", width)
    rows = rows.withColumn("_rows", F.transform("cells", lambda r: F.concat(r, F.array_repeat(F.lit(""), F.col("_width") - F.size(r))))).withColumn("_headed", is_header(F.get("_rows", F.lit(0))))
    rows = rows.withColumn("heads", F.when(F.col("_headed"), F.get("_rows", F.lit(0))).otherwise(F.transform(F.sequence(F.lit(1), F.col("_width")), lambda i: F.concat(F.lit("column_"), i.cast("string")))))
    rows = rows.withColumn("body", F.when(F.col("_headed"), F.slice("_rows", F.lit(2), F.greatest(F.size("_rows") - 1, F.lit(0)))).otherwise(F.col("_rows")))
    n = F.size("body")
    digits = F.size(F.filter("body", lambda r: F.regexp_like(F.get(r, F.lit(0)), F.lit("^[0-9]+$"))))
    second = (F.col("_width") >= 2) & (n > 0) & (digits >= F.greatest(F.lit(3), F.floor(n / 3)))
    rows = rows.withColumn("name_at", F.coalesce(_first(F.col("heads"), NAME_HEADS), F.when(second, 1).otherwise(0))).withColumn("ticker_at", _first(F.col("heads"), TICKER_HEADS))
    names = F.size(F.filter("body", lambda r: F.trim(F.get(r, F.col("name_at"))) != ""))
    score = (
        F.when(n >= F.greatest(F.lit(10), F.floor(expected / 3)), SCORE["enough rows"]).otherwise(0) + F.when(F.abs(n - expected) <= expected, SCORE["near the expected number"]).otherwise(0)
        + SCORE["names"] + F.when(F.col("ticker_at").isNotNull(), SCORE["tickers"]).otherwise(0) + F.least(names, F.lit(MOST_NAMES))
    )
    return rows.withColumn("score", F.when(n > 0, score).otherwise(-1)).drop("_width", "_rows", "_headed")


def records(found: DataFrame, key: str, expected: Column) -> DataFrame:
    """(key, place, row, name, ticker): rows with a name of each page's best table (the first of equal ones) that scores enough; a page's tables travel once, as one row each."""
    best = Window.partitionBy(key).orderBy(F.desc("score"), "place")
    # tables are ranked before low scores go: a filter on the score right after it would be pushed down with all that the score is made of spelt out, for each row of each table again
    rows = scored(found, expected).withColumn("_k", F.row_number().over(best)).where((F.col("_k") == 1) & (F.col("score") >= LEAST_SCORE))
    body = rows.select(key, "place", "name_at", "ticker_at", F.posexplode("body").alias("row", "r"))
    body = body.select(key, "place", (F.col("row") + 1).alias("row"), F.get("r", "name_at").alias("name"), F.coalesce(F.get("r", "ticker_at"), F.lit("")).alias("ticker"))
    return body.where("name <> ''")
