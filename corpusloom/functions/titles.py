"""Rules on titles, dates and states of filings as Column functions: kinds, years, quality, choice and queue scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rules below.
ANNUAL = r"(?i)\bannual (?:financial )?report\b|\bfinal results\b|\bannual results\b"
INTERIM = r"(?i)\binterim\b|\bhalf[- ]year\b|\bquarterly\b"
YEAR = r"\b(20\d{2})\b"
#: Two digits are tried first, so 2021/2022 ends in 2020: the rule's own reading.
RANGE = r"(20\d{2})\s*[/\-]\s*(\d{2}|20\d{2})"
YEAR_ENDED = r"(?i)(?:year\s+ended|for\s+the\s+year\s+ended)\D{0,40}(20\d{2})"
NOISE = r"(?i)\b(preliminary|notice|proxy|transaction|holding\(s\)|director/pdmr|results of annual general meeting|agm)\b"
BAD_TOKENS = ("20-f", "20-f/a", "ars", "notice of agm", "replacement financial statements", "preliminary", "proxy")
SHORT_LABELS = ("ars", "20-f", "20-f/a")
TITLE_POINTS = {"annual report and accounts": 60, "annual report": 45, "annual and report": 30, "esef": 10, "bad token": -25, "short label": -20}
STATUS_POINTS = {"COMPLETED": 8, "DONE": 8, "SUCCEEDED": 8, "SUCCESS": 8, "PENDING": -2, "PROCESSING": -2, "FAILED": -6, "SKIPPED": -6}
BULK_STATUS_POINTS = {"COMPLETED": 10, "DONE": 10, "SUCCEEDED": 10, "SUCCESS": 10, "PENDING": 1, "PROCESSING": 0, "SKIPPED": -4, "FAILED": -6}
STATUS_ELSE, BULK_STATUS_ELSE = 0, -1
SIGNAL_POINTS = {"range_end": 500, "year_ended": 450, "year_only": 400, "range_start": 350, "release_minus_one": 320, "release_year": 220}
CANDIDATE_POINTS = {"markdown": 1000, "esef": 120, "annual type": 80, "annual title": 40, "noise": -240, "other year": -260}


def annual(title: Column) -> Column:
    """An annual-results title that isn't an interim one."""
    return F.regexp_like(title, F.lit(ANNUAL)) & ~F.regexp_like(title, F.lit(INTERIM))


def _points(test: Column, n: int) -> Column:
    return F.when(test, n).otherwise(0)


def _has(title: Column, token: str) -> Column:
    return F.contains(F.lower(title), F.lit(token))


def ranges(title: Column) -> Column:
    """(start, end) of each range of years in a title; an end of two digits is in the start's century."""
    pairs = F.arrays_zip(F.regexp_extract_all(title, F.lit(RANGE), F.lit(1)).alias("a"), F.regexp_extract_all(title, F.lit(RANGE), F.lit(2)).alias("b"))
    end = lambda p: F.when(F.length(p["b"]) == 2, F.concat(F.left(p["a"], F.lit(2)), p["b"])).otherwise(p["b"]).cast("int")
    return F.transform(pairs, lambda p: F.struct(p["a"].cast("int").alias("start"), end(p).alias("end")))


def range_end(title: Column) -> Column:
    """The last year that ends a range, null without ranges."""
    return F.array_max(F.transform(ranges(title), lambda p: p["end"]))


def years(title: Column) -> Column:
    return F.transform(F.regexp_extract_all(title, F.lit(YEAR), F.lit(1)), lambda y: y.cast("int"))


def release_year(released: Column) -> Column:
    """The year that a release's text begins with, null if it doesn't."""
    return F.when(F.regexp_like(released, F.lit("^[0-9]{4}")), F.left(released, F.lit(4)).cast("int"))


def report_year(title: Column, released: Column) -> Column:
    """The last range's end, else the largest year of the title, else the year before the release (text)."""
    return F.coalesce(range_end(title), F.array_max(years(title)), release_year(released) - 1)


def guarded_year(year: Column, released: Column) -> Column:
    """The year if it is at most one after the release's (text)."""
    return F.when(year <= release_year(released) + 1, year)


def quality(title: Column, whole_tokens: bool = False) -> Column:
    """Points of a title. Bad tokens count anywhere, so the `ars` of `years` does too, unless only whole ones are wanted."""
    title = F.trim(F.lower(F.coalesce(title, F.lit(""))))
    p = TITLE_POINTS
    kind = F.when(_has(title, "annual report and accounts"), p["annual report and accounts"]).when(_has(title, "annual report"), p["annual report"])
    kind = kind.when(_has(title, "annual") & _has(title, "report"), p["annual and report"]).otherwise(0)
    bad = lambda t: F.regexp_like(title, F.lit(rf"(?<!\w)\Q{t}\E(?!\w)")) if whole_tokens else _has(title, t)
    tokens = sum((_points(bad(t), p["bad token"]) for t in BAD_TOKENS), F.lit(0))
    return kind + _points(_has(title, "esef"), p["esef"]) + tokens + _points(title.isin(*SHORT_LABELS), p["short label"])


def status_bonus(status: Column, bulk: bool = False) -> Column:
    """Points of a processing status, by the plain or the bulk table."""
    points, rest = (BULK_STATUS_POINTS, BULK_STATUS_ELSE) if bulk else (STATUS_POINTS, STATUS_ELSE)
    status = F.upper(F.trim(F.coalesce(status, F.lit(""))))
    out = None
    for name, n in points.items():
        out = F.when(status == name, n) if out is None else out.when(status == name, n)
    return out.otherwise(rest)


def selection_order(markdown: Column, esef: Column, title: Column, status: Column, released: Column, pk: Column, bulk: bool = False) -> Column:
    """What the clean choice compares, larger first: tier (text and tagged 4, text 3, tagged 2, neither 1), title, status, release, number."""
    tier = F.when(markdown & esef, 4).when(markdown, 3).when(esef, 2).otherwise(1)
    return F.struct(tier.alias("tier"), quality(title).alias("title_points"), status_bonus(status, bulk).alias("status_points"), F.coalesce(released, F.lit("")).alias("release"), pk.alias("number"))


def year_signals(title: Column, released: Column, wanted: Sequence[int]) -> Column:
    """(year, weight) of the wanted years that a filing may report on: named as a range's end or start, as a year ended, as the only
    wanted year of the title, or near the release (text). The largest weight of a year counts."""
    title = F.coalesce(title, F.lit(""))
    spans, ended, named = ranges(title), F.regexp_extract_all(title, F.lit(YEAR_ENDED), F.lit(1)), F.array_distinct(F.filter(years(title), lambda y: y.isin(*wanted)))
    p, year = SIGNAL_POINTS, release_year(released)
    out = []
    for y in wanted:
        weights = {
            "range_end": F.array_contains(F.transform(spans, lambda s: s["end"]), y), "range_start": F.array_contains(F.transform(spans, lambda s: s["start"]), y), "year_ended": F.array_contains(ended, str(y)),
            "year_only": (F.size(named) == 1) & F.array_contains(named, y), "release_minus_one": year - 1 == y, "release_year": year == y,
        }
        out.append(F.struct(F.lit(y).alias("year"), F.greatest(*(F.when(test, p[k]) for k, test in weights.items())).alias("weight")))
    return F.filter(F.array(*out), lambda x: x["weight"].isNotNull())


def candidate_score(weight: Column, year: Column, title: Column, filing_type: Column, markdown: Column, wanted: Sequence[int]) -> Column:
    """How well a filing serves a year that it has a signal for."""
    title, kind, p = F.coalesce(title, F.lit("")), F.coalesce(filing_type, F.lit("")), CANDIDATE_POINTS
    named = years(title)
    elsewhere = (weight == SIGNAL_POINTS["release_minus_one"]) & ~F.array_contains(named, year) & F.exists(named, lambda y: y.isin(*wanted))
    return (
        weight + _points(markdown, p["markdown"]) + _points(_has(kind, "esef"), p["esef"]) + _points(_has(kind, "annual report"), p["annual type"])
        + _points(_has(title, "annual") & _has(title, "report"), p["annual title"]) + _points(F.regexp_like(title, F.lit(NOISE)), p["noise"]) + _points(elsewhere, p["other year"])
    )


def gap_to_year_end(day: Column, year: Column, most: int) -> Column:
    """Days between a day and the end of a year; null beyond `most`."""
    gap = F.abs(F.datediff(day, F.make_date(year, F.lit(12), F.lit(31))))
    return F.when(gap <= most, gap)


def first_year(text: Column, patterns: Sequence[str], lines: int = 100) -> Column:
    """The last group of the first pattern that the first lines match, as a year (the rule reads no further)."""
    head = F.array_join(F.slice(F.split(text, "\n"), 1, lines), "\n")
    return F.coalesce(*[F.nullif(F.regexp_extract(head, p, 1), F.lit("")).try_cast("int") for p in patterns])
