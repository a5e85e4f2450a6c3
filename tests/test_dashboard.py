"""The dashboard against a plain count, and its plan."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import dashboard as board
from corpusloom.plans import dashboard_queries as queries

VOCABULARY = {"mention": ("adoption", "risk", "vendor"), "adoption": ("llm", "agentic"), "risk": ("cyber", "law"), "vendor": ("internal",)}
SECTORS, ISIC = ("Energy", "Other"), ("A", "B")
FIELDS = [f.split(":")[0] for f in board.CHUNK[7:-1].split(",")]


def _chunk(rng: random.Random) -> dict:
    some = lambda values, most: [rng.choice(values) for _ in range(rng.randrange(most + 1))]
    out = {f: some(v, 2) for f, v in VOCABULARY.items()}
    out["mention"] = rng.choice([[], ["none"], ["none", "risk"], ["risk", "adoption"], ["vendor"], ["general", "general"]])
    for f in ("adoption", "risk", "vendor"):
        out[f"{f}_signals"], out[f"{f}_bands"] = some([1, 2, 3], 2), some(list(board.BANDS), 3)
    return out


def _reports(seed: int) -> list[dict]:
    rng = random.Random(seed)
    return [
        {
            "owner": rng.choice(["x", "y", "z"]), "year": rng.choice([2021, 2022, 2024]), "month": rng.choice(["2021-01", "2022-05", None]), "sector": rng.choice(["Energy", "Other", "Mines"]),
            "isic": rng.choice(ISIC), "segment": rng.choice(["FTSE 100", "FTSE 250", "Main Market", "AIM", "FTSE 350", None]), "chunks": [_chunk(rng) for _ in range(rng.randrange(4))],
        }
        for _ in range(60)
    ]


def _plain(reports: list[dict]) -> Counter:
    """(basis, segment, scope, series, year, month, label, sector) -> value, series by series."""
    out: Counter = Counter()
    units = [("report", r, {f: [x for c in r["chunks"] for x in c[f]] for f in FIELDS}) for r in reports] + [("chunk", r, c) for r in reports for c in r["chunks"]]
    for basis in ("report", "chunk"):
        for segment in ("All", *board.SEGMENTS):
            for scope in board.SCOPES:
                mine = [(r, c) for b, r, c in units if b == basis and (segment == "All" or r["segment"] in board.SEGMENTS[segment]) and (scope == "all" or r["sector"] != "Other")]

                def add(n: int, series: str, year=None, month=None, label=None, sector=None) -> None:  # noqa: ANN001, B023
                    out[basis, segment, scope, series, year, month, label, sector] += n  # noqa: B023

                years = sorted({r["year"] for b, r, _ in units if b == basis})
                months = sorted({r["month"] for r, _ in mine if r["month"]})
                for f, labels in VOCABULARY.items():
                    for v in labels:
                        for y in years:
                            add(0, f"{f}Trend", y, None, v)
                        for m in months:
                            add(0, f"{f}TrendMonthly", None, m, v)
                for y in years:
                    for f in ("adoption", "risk", "vendor"):
                        for level in board.LEVELS:
                            add(0, f"{f}SignalHeatmap", y, None, level)
                        for band in board.BANDS:
                            add(0, "substantivenessHeatmap" if f == "risk" else f"{f}SubstantivenessHeatmap", y, None, band)
                    for name in ("total_reports", "ai_mention", "ai_risk_mention", "no_ai_mention", "no_ai_risk_mention"):
                        add(0, "blindSpotTrend", y, None, name)
                    for s in SECTORS:
                        for series in ("reportCountBySectorYear", "noAiBySectorYear", "noAiRiskBySectorYear", "riskMentionBySectorYear"):
                            add(0, series, y, None, None, s)
                    for s in ISIC:
                        for series in ("reportCountByIsicSectorYear", "riskMentionByIsicSectorYear"):
                            add(0, series, y, None, None, s)
                for m in months:
                    for name in ("total_reports", "no_ai_mention", "no_ai_risk_mention"):
                        add(0, "blindSpotTrendMonthly", None, m, name)
                for r, c in mine:
                    y, m, mention = r["year"], r["month"], set(c["mention"])
                    ai, risky = bool(mention - {"none"}), "risk" in mention or bool(c["risk"])
                    for f in VOCABULARY:
                        for v in set(c[f]):
                            add(1, f"{f}Trend", y, None, v)
                            if m:
                                add(1, f"{f}TrendMonthly", None, m, v)
                            if f != "mention":
                                for axis, name in (("sector", "Sector"), ("isic", "IsicSector")):
                                    add(1, f"{f}By{name}", None, None, v, r[axis])
                                    add(1, f"{f}By{name}Year", y, None, v, r[axis])
                    for f in ("adoption", "risk", "vendor"):
                        for s in c[f"{f}_signals"]:
                            add(1, f"{f}SignalHeatmap", y, None, board.LEVELS[3 - s])
                        bands = Counter(c[f"{f}_bands"])
                        if bands:
                            best = max(board.BANDS, key=lambda b: (bands[b], -board.BANDS.index(b)))  # noqa: B023
                            add(1, "substantivenessHeatmap" if f == "risk" else f"{f}SubstantivenessHeatmap", y, None, best)
                        if f in mention:
                            add(1, "summary", label=f"{f}Reports")
                    tests = {"total_reports": True, "ai_mention": ai, "no_ai_mention": not ai, "ai_risk_mention": risky, "no_ai_risk_mention": not risky}
                    for name, test in tests.items():
                        if test:
                            add(1, "blindSpotTrend", y, None, name)
                            if m and name in ("total_reports", "no_ai_mention", "no_ai_risk_mention"):
                                add(1, "blindSpotTrendMonthly", None, m, name)
                    for series, test in (("reportCountBySectorYear", True), ("noAiBySectorYear", not ai), ("noAiRiskBySectorYear", not risky), ("riskMentionBySectorYear", "risk" in mention)):
                        if test:
                            add(1, series, y, None, None, r["sector"])
                    for series, test in (("reportCountByIsicSectorYear", True), ("riskMentionByIsicSectorYear", "risk" in mention)):
                        if test:
                            add(1, series, y, None, None, r["isic"])
                    add(1, "summary", label="totalReports")
                    if ai:
                        add(1, "summary", label="aiSignalReports")
                if mine:
                    add(len({r["owner"] for r, _ in mine}), "summary", label="totalCompanies")
    return out


def test_against_plain_count(spark: SparkSession) -> None:
    reports = _reports(4)
    df = spark.createDataFrame([(r["owner"], r["year"], r["month"], r["sector"], r["isic"], r["segment"], [tuple(c[f] for f in FIELDS) for c in r["chunks"]]) for r in reports], f"owner string, year int, month string, sector string, isic string, segment string, chunks array<{board.CHUNK}>")
    found = board.dashboard(df, VOCABULARY, SECTORS, ISIC, F.col("sector") != "Other").collect()
    got = {tuple(r[k] for k in board.KEYS): r["value"] for r in found}
    assert len(got) == len(found)
    assert got == dict(_plain(reports))
    assert len({r["series"] for r in found}) == 35  # 34 series and the summary


def test_no_reports(spark: SparkSession) -> None:
    df = spark.createDataFrame([], f"owner string, year int, month string, sector string, isic string, segment string, chunks array<{board.CHUNK}>")
    assert board.dashboard(df, VOCABULARY, SECTORS, ISIC, F.col("sector") != "Other").count() == 0


def test_tables_are_read_once(spark: SparkSession, sf_dir: str) -> None:
    """One scan of each table, also for the eight figures, and no join of the result with itself."""
    for df in (queries.dashboard(spark, sf_dir), queries.figure_data(spark, sf_dir)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 5 and plan.count("Expand ") == 1


@pytest.mark.parametrize(("series", "bases"), [(board.FIGURE_SERIES, ("report",)), (("blindSpotTrendMonthly", "riskBySector"), ("chunk",)), (("summary",), board.BASES), (("noAiBySectorYear",), ("report",))])
def test_named_series_are_those_of_the_whole(spark: SparkSession, sf_dir: str, series: tuple[str, ...], bases: tuple[str, ...]) -> None:
    """Some series of some bases have the rows that the whole dashboard has of them."""
    whole = {tuple(r) for r in queries.dashboard(spark, sf_dir).where(F.col("series").isin(*series) & F.col("basis").isin(*bases)).collect()}
    rows = [tuple(r) for r in queries._board(spark, sf_dir, series=series, bases=bases).collect()]
    assert len(rows) == len(whole) > 0 and set(rows) == whole


def test_figures_spell_out_their_own_facts_only(spark: SparkSession, sf_dir: str) -> None:
    """No facts of chunks, months, owners or levels are made for figures that don't show them."""
    plan = queries.figure_data(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "adoptionTrendMonthly" not in plan and "_level" not in plan and "date_format" not in plan


def test_figures_have_all_data_sets(spark: SparkSession, sf_dir: str) -> None:
    found = queries.figure_data(spark, sf_dir).select("figure").distinct().collect()
    assert {r[0][:7] for r in found} == {f"figure{i}" for i in range(1, 9)}


def test_grouping_sets_see_counts_not_facts(spark: SparkSession) -> None:
    """Four times the reports give the same rows before the grouping sets, with four times the counts."""
    reports = _reports(4)
    rows = [(r["owner"], r["year"], r["month"], r["sector"], r["isic"], r["segment"], [tuple(c[f] for f in FIELDS) for c in r["chunks"]]) for r in reports]
    schema = f"owner string, year int, month string, sector string, isic string, segment string, chunks array<{board.CHUNK}>"
    once, often = (
        {tuple(r)[:-1]: r["n"] for r in board._counted(spark.createDataFrame(x, schema), board.slice_bits(F.col("sector") != "Other")).collect()} for x in (rows, rows * 4)
    )
    assert often == {k: 4 * n for k, n in once.items()}
