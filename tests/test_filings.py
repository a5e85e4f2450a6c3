"""Points, signals and choices of filings, branch by branch."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import titles
from corpusloom.operators import mentions, temporal


def _one(spark: SparkSession, c: Column) -> object:
    return spark.range(1).select(c).first()[0]


@pytest.mark.parametrize(
    ("title", "points"),
    [
        ("Annual Report and Accounts 2022", 60), ("annual report", 45), ("Report, annual", 30), ("ESEF annual report and accounts", 70), ("20-F", -45), ("20-F/A", -70), (" ARS ", -45),
        ("Results for the years 2021", -25), ("Notice of AGM", -25), ("Replacement Financial Statements", -25), ("Preliminary proxy", -50), ("Interim", 0), ("", 0), (None, 0),
    ],
)
def test_title_points(spark: SparkSession, title: str | None, points: int) -> None:
    assert _one(spark, titles.quality(F.lit(title).cast("string"))) == points


def test_whole_tokens(spark: SparkSession) -> None:
    assert _one(spark, titles.quality(F.lit("two years"), whole_tokens=True)) == 0
    assert _one(spark, titles.quality(F.lit("the ars of 2021"), whole_tokens=True)) == -25


@pytest.mark.parametrize(("status", "plain", "bulk"), [(" done", 8, 10), ("SUCCESS", 8, 10), ("pending", -2, 1), ("Processing", -2, 0), ("FAILED", -6, -6), ("skipped", -6, -4), ("", 0, -1), (None, 0, -1), ("new", 0, -1)])
def test_status_points(spark: SparkSession, status: str | None, plain: int, bulk: int) -> None:
    status = F.lit(status).cast("string")
    assert (_one(spark, titles.status_bonus(status)), _one(spark, titles.status_bonus(status, bulk=True))) == (plain, bulk)


@pytest.mark.parametrize(
    ("title", "released", "year"),
    [("Report 2021/22", "2023", 2022), ("Report 2019 - 20 and 2021-22", None, 2022), ("Report 2021/2022", "2023", 2020), ("2020 against 2019", "2025", 2020), ("Final results", "2024-03-01", 2023), ("Final results", "n/a", None), (None, "2024", 2023)],
)
def test_report_year(spark: SparkSession, title: str | None, released: str | None, year: int | None) -> None:
    assert _one(spark, titles.report_year(F.lit(title or ""), F.lit(released).cast("string"))) == year


@pytest.mark.parametrize(
    ("title", "released", "signals"),
    [
        ("Report 2022/23", "2030", {2023: 500, 2022: 400}),  # the start is the only year named as a word, too
        ("Report 2021-22, 2022-23", "2030", {2022: 500, 2023: 500, 2021: 350}),
        ("for the Year  ended December 2022 and 2021", "2030", {2022: 450}),
        ("for the year ended 31 December 2022 and 2021", "2030", {}),  # the day's digits stand between
        ("2022", "2023", {2022: 400, 2023: 220}),
        ("Final", "2023", {2022: 320, 2023: 220}),
        ("Final", "2030", {}),
        (None, None, {}),
    ],
)
def test_signals(spark: SparkSession, title: str | None, released: str | None, signals: dict) -> None:
    found = _one(spark, titles.year_signals(F.lit(title).cast("string"), F.lit(released).cast("string"), (2021, 2022, 2023)))
    assert {r["year"]: r["weight"] for r in found} == signals


@pytest.mark.parametrize(
    ("weight", "year", "title", "kind", "markdown", "score"),
    [
        (500, 2022, "Annual report", "Annual Report (ESEF)", True, 1740), (450, 2022, "Notice", None, False, 210), (320, 2022, "Accounts 2021", "", False, 60), (320, 2022, "Accounts 2019", "", False, 320),
        (320, 2022, "Accounts 2021, 2022", "", False, 320), (220, 2022, "Accounts 2021", "", False, 220), (400, 2021, "Holding(s) in company", "", False, 400), (400, 2021, "Director/PDMR deals", "", False, 160),
    ],
)
def test_scores(spark: SparkSession, weight: int, year: int, title: str, kind: str | None, markdown: bool, score: int) -> None:
    c = titles.candidate_score(F.lit(weight), F.lit(year), F.lit(title), F.lit(kind).cast("string"), F.lit(markdown), (2021, 2022, 2023))
    assert _one(spark, c) == score


def test_years_with_few_candidates_choose_first(spark: SparkSession) -> None:
    rng, rows = random.Random(2), []
    for owner in range(40):
        for pk in range(rng.randrange(1, 7)):
            rows += [(owner, y, 100 * owner + pk, rng.randrange(4)) for y in rng.sample((1, 2, 3, 4), rng.randrange(1, 5))]
    rows += [(99, y, 9900 + i, i % 3) for i in range(500) for y in (1, 2)]  # many candidates of one owner
    want = []
    for owner in {r[0] for r in rows}:
        pools = {y: [r[2] for r in sorted(rows, key=lambda r: (-r[3], r[2])) if r[0] == owner and r[1] == y] for y in (1, 2, 3, 4)}
        used: set = set()
        for y in sorted((y for y in pools if pools[y]), key=lambda y: (len(pools[y]), y)):
            chosen = next((i for i in pools[y] if i not in used), pools[y][0])
            used.add(chosen)
            want.append((owner, y, chosen))
    df = spark.createDataFrame(rows, "owner long, year int, pk long, score int")
    found = mentions.best_by_year(df, "owner", "year", "pk", [F.desc("score"), F.col("pk")], (1, 2, 3, 4))
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_clusters_hand_on_their_surest_year(spark: SparkSession) -> None:
    """Against a walk over each owner's releases."""
    rng = random.Random(21)
    rank = {"LOW": 0, "MEDIUM": 1, "HIGH": 2}
    rows = []
    for owner in range(60):
        day = dt.date(2020, 1, 1)
        for k in range(rng.randrange(1, 8)):
            day += dt.timedelta(rng.choice([1, 30, 89, 90, 200]))
            rows.append((owner * 100 + k, owner, None if rng.random() < 0.05 else day, rng.choice([2020, 2020, 2021, None]), rng.choice(list(rank)), f"s{k}", rng.choice([None, None, "OLD"])))
    df = spark.createDataFrame(rows, "id int, owner int, released date, fy int, confidence string, fy_source string, anomaly string")
    want = {}
    for owner in range(60):
        mine = sorted((r for r in rows if r[1] == owner), key=lambda r: (r[2] is not None, r[2] or dt.date.min, r[0]))
        groups: list[list] = []
        for r in mine:
            if groups and r[2] and groups[-1][-1][2] and (r[2] - groups[-1][-1][2]).days < 90:
                groups[-1].append(r)
            else:
                groups.append([r])
        for g in groups:
            best, years = max(g, key=lambda r: rank[r[4]]), {r[3] for r in g if r[3]}
            for r in g:
                if len(years) > 1:
                    want[r[0]] = (*r[3:6], "ANOMALY_CLUSTER")
                elif rank[r[4]] < rank[best[4]]:
                    want[r[0]] = (best[3], best[4], f"cluster_propagated({best[5]})", r[6])
                else:
                    want[r[0]] = r[3:]
    found = temporal.propagated(df, "owner", "released", "id").collect()
    assert {r["id"]: (r["fy"], r["confidence"], r["fy_source"], r["anomaly"]) for r in found} == want
