"""The whole dashboard as one result: every series of every slice, for reports and for chunks, by one aggregation over grouping sets.

A report row has owner, year, month (yyyy-MM or null), sector, isic, segment and `chunks`, an array of structs with the labels
and signals of one annotation each (CHUNK). Its rows are read once: each report, and each of its chunks, spells out its facts (a
family and a label), and a number with one bit for each slice that the report belongs to goes along. Equal facts are first counted in
each task by month, by year, sector and isic, and by owner, with the number of slices as it is; the grouping sets then see these counts
only and sum them for each slice. Zeros come from the year and month totals themselves, so nothing is read again to learn which years
there are. A hot year or sector is summed in each task before the first shuffle; later shuffles move sums only. Who needs some series or
one basis only names them, and facts and dimensions of the others are never made.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABELS = ("mention", "adoption", "risk", "vendor")
#: One annotation: its labels, the levels of its signals and the bands of its substantiveness.
CHUNK = "struct<mention:array<string>,adoption:array<string>,risk:array<string>,vendor:array<string>,adoption_signals:array<int>,risk_signals:array<int>,vendor_signals:array<int>,adoption_bands:array<string>,risk_bands:array<string>,vendor_bands:array<string>>"
# Names of levels and bands, strongest first, of series, and of market slices with the segments in each.
LEVELS = ("3-explicit", "2-strong_implicit", "1-weak_implicit")
BANDS = ("substantive", "moderate", "boilerplate")
SEGMENTS = {
    "Main Market": ("FTSE 100", "FTSE 250", "Main Market"),
    "Main Market (FTSE 100 only)": ("FTSE 100",),
    "Main Market (FTSE 350 only)": ("FTSE 100", "FTSE 250"),
    "AIM": ("AIM",),
}
SCOPES = ("all", "cniOnly")
SETS = {
    "all": (), "year": ("year",), "month": ("month",), "sector": ("sector",), "sector_year": ("sector", "year"), "isic": ("isic",), "isic_year": ("isic", "year"), "owner": ("owner",),
}
#: (family, set) -> series; of measures (name, set) -> (series, label).
SERIES = {("mention", "year"): "mentionTrend", ("mention", "month"): "mentionTrendMonthly"}
for _f in ("adoption", "risk", "vendor"):
    SERIES |= {(_f, "year"): f"{_f}Trend", (_f, "month"): f"{_f}TrendMonthly"}
    SERIES |= {(_f, k): f"{_f}By{k.replace('isic', 'isic_sector').title().replace('_', '')}" for k in ("sector", "sector_year", "isic", "isic_year")}
    SERIES |= {(f"{_f}_level", "year"): f"{_f}SignalHeatmap", (f"{_f}_band", "year"): "substantivenessHeatmap" if _f == "risk" else f"{_f}SubstantivenessHeatmap"}
MEASURES = {
    ("total", "all"): ("summary", "totalReports"), ("total", "owner"): ("summary", "totalCompanies"), ("ai", "all"): ("summary", "aiSignalReports"),
    ("adoption_mention", "all"): ("summary", "adoptionReports"), ("risk_mention", "all"): ("summary", "riskReports"), ("vendor_mention", "all"): ("summary", "vendorReports"),
    ("total", "year"): ("blindSpotTrend", "total_reports"), ("ai", "year"): ("blindSpotTrend", "ai_mention"), ("ai_risk", "year"): ("blindSpotTrend", "ai_risk_mention"),
    ("no_ai", "year"): ("blindSpotTrend", "no_ai_mention"), ("no_ai_risk", "year"): ("blindSpotTrend", "no_ai_risk_mention"),
    ("total", "month"): ("blindSpotTrendMonthly", "total_reports"), ("no_ai", "month"): ("blindSpotTrendMonthly", "no_ai_mention"), ("no_ai_risk", "month"): ("blindSpotTrendMonthly", "no_ai_risk_mention"),
    ("total", "sector_year"): ("reportCountBySectorYear", None), ("no_ai", "sector_year"): ("noAiBySectorYear", None), ("no_ai_risk", "sector_year"): ("noAiRiskBySectorYear", None),
    ("risk_mention", "sector_year"): ("riskMentionBySectorYear", None), ("total", "isic_year"): ("reportCountByIsicSectorYear", None), ("risk_mention", "isic_year"): ("riskMentionByIsicSectorYear", None),
}
BASES = ("report", "chunk")
ZERO = "struct<series:string,label:string,sector:string>"
#: What the figures are made from.
FIGURE_SERIES = ("mentionTrend", "adoptionTrend", "riskTrend", "vendorTrend", "blindSpotTrend", "substantivenessHeatmap", "reportCountBySectorYear", "riskMentionBySectorYear", "noAiRiskBySectorYear")
KEYS = ("basis", "segment", "scope", "series", "year", "month", "label", "sector")


def slice_names(segments: Mapping[str, Sequence[str]] = SEGMENTS) -> list[tuple[str, str]]:
    """(segment slice or All, scope) by bit."""
    return [(s, c) for s in ("All", *segments) for c in SCOPES]


def slice_bits(cni: Column, segments: Mapping[str, Sequence[str]] = SEGMENTS) -> Column:
    """A number with a bit for each slice that a report belongs to."""
    bits = F.lit(0).cast("long")
    for i, (s, c) in enumerate(slice_names(segments)):
        inside = F.lit(True) if s == "All" else F.coalesce(F.col("segment").isin(*segments[s]), F.lit(False))
        bits = bits + F.when(inside & (cni if c == "cniOnly" else F.lit(True)), 1 << i).otherwise(0)
    return bits


def _made(series: Collection[str] | None) -> tuple[dict[tuple[str, str], str], dict[tuple[str, str], tuple[str, str | None]]]:
    """SERIES and MEASURES of the named series, or all."""
    some = lambda name: series is None or name in series
    return {k: v for k, v in SERIES.items() if some(v)}, {k: v for k, v in MEASURES.items() if some(v[0])}


def _units(bases: Collection[str], families: Collection[str]) -> Column:
    """(basis, labels, signals and bands) of the report and of each of its chunks; a report's chunks as one have labels once, signals and bands as often as they stand."""
    fields = [f.split(":")[0] for f in CHUNK[7:-1].split(",")]
    fields = [f for f in fields if f in LABELS or f.replace("_signals", "_level").replace("_bands", "_band") in families]
    all_of = lambda f: F.flatten(F.transform("chunks", lambda c: c[f]))
    whole = F.struct(F.lit("report").alias("basis"), *((F.array_distinct(all_of(f)) if f in LABELS else all_of(f)).alias(f) for f in fields))
    units = {"report": F.array(whole), "chunk": F.transform("chunks", lambda c: F.struct(F.lit("chunk").alias("basis"), *(c[f].alias(f) for f in fields)))}
    return F.concat(*(units[b] for b in BASES if b in bases))


def majority(bands: Column) -> Column:
    """The most frequent band of a list, ties to the stronger; null for an empty list."""
    strong, middle, weak = (F.size(F.filter(bands, _is(b))) for b in BANDS)
    return F.when(F.size(bands) > 0, F.when((strong >= middle) & (strong >= weak), BANDS[0]).when(middle >= weak, BANDS[1]).otherwise(BANDS[2]))


def _is(value: str):  # noqa: ANN202
    return lambda x: x == value


def _level(signal: Column) -> Column:
    return F.when(signal >= 3, LEVELS[0]).when(signal >= 2, LEVELS[1]).otherwise(LEVELS[2])


def _facts(families: Collection[str], measures: Collection[str]) -> Column:
    """(family, label) of one report or chunk, from its columns; bands are told by their majorities, tests by columns of their names."""
    fact = lambda family, label: F.struct(F.lit(family).alias("family"), label.alias("label"))
    parts = []

    def each(family: str, values: Column, name) -> None:  # noqa: ANN001
        parts.append(F.transform(values, lambda x: fact(family, name(x))))

    for f in LABELS:
        if f in families:
            each(f, F.array_distinct(f), lambda x: x)
    for f in LABELS[1:]:
        if f"{f}_level" in families:
            each(f"{f}_level", F.col(f"{f}_signals"), _level)
    bands = [F.when(F.col(f"_{f}_band").isNotNull(), fact(f"{f}_band", F.col(f"_{f}_band"))) for f in LABELS[1:] if f"{f}_band" in families]
    ai, risky = F.col("_ai"), F.col("_risky")
    tests = {"total": F.lit(True), "ai": ai, "no_ai": ~ai, "ai_risk": risky, "no_ai_risk": ~risky, **{f"{m}_mention": F.array_contains("mention", m) for m in ("adoption", "risk", "vendor")}}
    parts.append(F.array_compact(F.array(*bands, *(F.when(test, fact("measure", F.lit(m))) for m, test in tests.items() if m in measures))))
    return F.concat(*parts)


def _counted(reports: DataFrame, bits: Column, bases: Collection[str] = BASES, families: Collection[str] = tuple({f for f, _ in SERIES}), measures: Collection[str] = tuple({m for m, _ in MEASURES}), sets: Collection[str] = tuple(SETS)) -> DataFrame:
    """(part, basis, family, label, owner, year, month, sector, isic, bits, n): how often each fact stands in each month; year, sector and isic; and, of totals, owner."""
    dims = ("owner", "year", "month", "sector", "isic")
    units = reports.select(*dims, bits.alias("bits"), F.inline(_units(bases, families)))
    tests = {"_ai": F.size(F.array_except("mention", F.array(F.lit("none")))) > 0, "_risky": F.array_contains("mention", "risk") | (F.size("risk") > 0)}
    units = units.withColumns({**tests, **{f"_{f}_band": majority(F.col(f"{f}_bands")) for f in LABELS[1:] if f"{f}_band" in families}})
    facts = units.select(*dims, "bits", "basis", F.inline(_facts(families, measures)))
    types = dict(reports.dtypes)

    def part(name: str, *columns: str) -> Column:
        return F.struct(F.lit(name).alias("part"), *((F.col(c) if c in columns else F.lit(None).cast(types[c])).alias(c) for c in dims))

    total = (F.col("family") == "measure") & (F.col("label") == "total")
    used = {c for at in sets for c in SETS[at]}
    two = [*([part("month", "month")] if "month" in used else []), part("rest", *(used & {"year", "sector", "isic"}))]
    parts = F.array(*two)
    if "owner" in used:
        parts = F.when(total, F.array(*two, part("owner", "owner"))).otherwise(parts)
    facts = facts.select("basis", "family", "label", "bits", F.inline(parts))
    return facts.groupBy("part", "basis", "family", "label", "bits", *dims).agg(F.count("*").alias("n"))


def _series_of(made: Mapping[tuple[str, str], str], counts: Mapping[tuple[str, str], tuple[str, str | None]]) -> Column:
    """(series, label) of a family, label and set; null for what no series holds."""
    names: list[Column] = []
    for (family, at), series in made.items():
        names += [F.lit(f"{family}/{at}"), F.struct(F.lit(series).alias("series"), F.lit("*").alias("label"))]
    for (measure, at), (series, label) in counts.items():
        names += [F.lit(f"measure/{at}/{measure}"), F.struct(F.lit(series).alias("series"), F.lit(label).cast("string").alias("label"))]
    key = F.concat_ws("/", "family", "at", F.when(F.col("family") == "measure", F.col("label")))
    return F.try_element_at(F.create_map(*names), key)


def _zeros(made: Mapping[tuple[str, str], str], counts: Mapping[tuple[str, str], tuple[str, str | None]], vocabulary: Mapping[str, Sequence[str]], sectors: Sequence[str], isic: Sequence[str]) -> tuple[Column, Column]:
    """(series, label, sector) that stand in every year, and in every month."""
    row = lambda series, label=None, sector=None: F.struct(F.lit(series).alias("series"), F.lit(label).cast("string").alias("label"), F.lit(sector).cast("string").alias("sector"))
    yearly = [row(made[f, "year"], v) for f in LABELS if (f, "year") in made for v in vocabulary[f]]
    yearly += [row(made[f"{f}_{kind}", "year"], v) for f in LABELS[1:] for kind, values in (("level", LEVELS), ("band", BANDS)) if (f"{f}_{kind}", "year") in made for v in values]
    monthly = [row(made[f, "month"], v) for f in LABELS if (f, "month") in made for v in vocabulary[f]]
    for (_, at), (series, label) in counts.items():
        if at == "year":
            yearly.append(row(series, label))
        elif at == "month":
            monthly.append(row(series, label))
        elif at in ("sector_year", "isic_year"):
            yearly += [row(series, None, s) for s in (sectors if at == "sector_year" else isic)]
    return tuple(F.array(*rows).cast(f"array<{ZERO}>") for rows in (yearly, monthly))


def dashboard(reports: DataFrame, vocabulary: Mapping[str, Sequence[str]], sectors: Sequence[str], isic: Sequence[str], cni: Column, segments: Mapping[str, Sequence[str]] = SEGMENTS, series: Collection[str] | None = None, bases: Collection[str] = BASES) -> DataFrame:
    """(basis, segment, scope, series, year, month, label, sector, value): all series of all slices, or the named series and bases only.

    Trends, heatmaps and blind spots have all years (and the months of their slice) with zeros for the vocabulary's labels; counts by sector and year have all
    given sectors; label-by-sector series have only what occurs. cni tells from a report whether it belongs to the narrow scope.
    """
    made, counts = _made(series)
    measures = {"total", *(m for m, _ in counts)}  # zeros come with totals
    sets = [at for at in SETS if at in {at for _, at in (*made, *counts)}]
    if {"sector_year", "isic_year"} & set(sets) and "year" not in sets:
        sets.append("year")
    facts = _counted(reports, slice_bits(cni, segments), bases, {f for f, _ in made}, measures, sets)
    total = (F.col("family") == "measure") & (F.col("label") == "total")
    names = slice_names(segments)
    fixed, free = ("part", "basis", "family", "label"), ("owner", "year", "month", "sector", "isic")
    sums = [F.sum(F.getbit("bits", F.lit(i)) * F.col("n")).alias(f"n{i}") for i in range(len(names))]
    at = None
    for name in sets:
        columns = SETS[name]
        test = F.lit(True)
        for c in free:
            test = test & (F.grouping(c) == (0 if c in columns else 1))
        at = F.when(test, name) if at is None else at.when(test, name)
    counted = facts.groupingSets([[*fixed, *SETS[name]] for name in sets], *fixed, *free).agg(*sums, F.bit_or("bits").alias("seen"), at.alias("at"))
    counted = counted.where("part = if(at in ('month', 'owner'), at, 'rest') and (at <> 'month' or month is not null) and (at <> 'owner' or owner is not null)").withColumn("_s", _series_of(made, counts))
    year_zeros, month_zeros = _zeros(made, counts, vocabulary, sectors, isic)
    head = F.when(total & (F.col("at") == "year"), year_zeros).when(total & (F.col("at") == "month"), month_zeros)
    value = lambda i: F.when(F.col("at") == "owner", F.getbit("seen", F.lit(i)).cast("long")).otherwise(F.col(f"n{i}"))
    each = F.array(*(F.struct(F.lit(s).alias("segment"), F.lit(c).alias("scope"), value(i).alias("value")) for i, (s, c) in enumerate(names)))
    own = F.struct(F.col("_s.series").alias("series"), F.when(F.col("_s.label") == "*", F.col("label")).otherwise(F.col("_s.label")).alias("label"), F.coalesce("sector", "isic").alias("sector"))
    zero = F.transform(F.coalesce(head, F.array().cast(f"array<{ZERO}>")), lambda z: F.named_struct(F.lit("key"), z, F.lit("times"), F.lit(0)))
    mine = F.array_compact(F.array(F.when(F.col("_s").isNotNull(), F.struct(own.alias("key"), F.lit(1).alias("times")))))
    rows = counted.select("basis", "at", "year", "month", F.inline(each), mine.alias("_mine"), zero.alias("_zero"))
    rows = rows.where("value > 0 or at = 'year'").select("basis", "segment", "scope", "year", "month", "value", F.explode(F.concat("_mine", "_zero")).alias("_r"))
    rows = rows.where("value > 0 or _r.times = 0")
    return rows.groupBy("basis", "segment", "scope", F.col("_r.key.series").alias("series"), "year", "month", F.col("_r.key.label").alias("label"), F.col("_r.key.sector").alias("sector")).agg(F.sum(F.col("value") * F.col("_r.times")).alias("value"))


def _one_decimal(x: Column) -> Column:
    return F.floor((x + 2.0**-52) * 10 + 0.5) / 10.0


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(0.0)


def figures(cube: DataFrame, last: int, first: int, named: Sequence[str], opaque: Sequence[str], internal: str, other: str = "Other") -> DataFrame:
    """(figure, key, year, measure, value): the eight figures' data, for the years up to `last`, from the dashboard's report rows (of FIGURE_SERIES) in one pass.

    A cube row becomes parts of the figures that use it; a change needs a value both as its own year's and as the next year's
    earlier one. One shuffle puts a figure's parts side by side. named, opaque and internal are groups of vendor labels.
    """
    s, scope, segment, label = F.col("series"), F.col("scope"), F.col("segment"), F.col("label")
    whole = (segment == "All") & (scope == "all")
    narrow = (segment == "All") & (scope == "cniOnly") & (F.col("sector") != other)
    by_segment = (segment != "All") & (scope == "all") & (F.col("year") == last)
    part = lambda figure, key, measure, year=F.col("year"): F.struct(F.lit(figure).alias("figure"), key.cast("string").alias("key"), measure.alias("part"), year.alias("at"))
    none, upto = F.lit(None), F.col("year") <= last
    trend, blind = s == "mentionTrend", s == "blindSpotTrend"
    sector = F.when(s == "reportCountBySectorYear", "total").when(s == "riskMentionBySectorYear", "risk").when(s == "noAiRiskBySectorYear", "no_risk")
    group = F.when(label.isin(*named), "named_tracked").when(label.isin(*opaque), "opaque_or_untracked").when(label == internal, "internal")
    ago = F.when(F.col("year") == last, "to").when(F.col("year") == last - 1, "from")
    rows = F.array(
        F.when(whole & upto & trend, part("figure1", none, label)),
        F.when(whole & upto & blind & (label == "total_reports"), part("figure1", none, F.lit("total"))),
        F.when(whole & upto & (s == "adoptionTrend"), part("figure2", label, F.lit("count"))),
        F.when(whole & ago.isNotNull() & (s == "riskTrend"), part("figure3", label, ago, F.lit(last))),
        F.when(whole & (F.col("year") == last) & (s == "vendorTrend"), part("figure4", label, F.lit("count"))),
        F.when(whole & (F.col("year") == last) & (s == "vendorTrend") & group.isNotNull(), part("figure4 groups", group, F.lit("count"))),
        F.when(whole & upto & (F.col("year") >= first) & blind, part("figure5", none, label)),
        F.when(whole & upto & (F.col("year") >= first) & (s == "substantivenessHeatmap") & (label == BANDS[0]), part("figure5", none, label)),
        F.when(narrow & (F.col("year") == last) & sector.isNotNull(), part("figure6", F.col("sector"), sector)),
        F.when(narrow & upto & (F.col("year") >= first) & sector.isNotNull(), part("figure7", F.col("sector"), sector)),
        F.when(narrow & (F.col("year") < last) & (F.col("year") >= first - 1) & sector.isNotNull(), part("figure7", F.col("sector"), F.concat(F.lit("old_"), sector), F.col("year") + 1)),
        F.when(by_segment & trend, part("figure8", segment, label)),
        F.when(by_segment & blind, part("figure8", segment, label)),
        # what the changes of figure 3 are shares of
        F.when(whole & ago.isNotNull() & blind & (label == "total_reports"), part("figure3", none, F.concat(F.lit("total_"), ago), F.lit(last))),
    )
    parts = cube.where("basis = 'report' and year is not null and month is null").select("value", F.inline(F.array_compact(rows)))
    sides = parts.groupBy("figure", "key", "at", "part").agg(F.sum("value").alias("n"))
    sides = sides.groupBy("figure", "key", "at").agg(F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("n"))
    n = lambda name: F.coalesce(F.try_element_at("n", F.lit(name)), F.lit(0))
    own = Window.partitionBy(F.left("figure", F.lit(7)))  # a few rows each
    sides = sides.withColumn("_all", F.sum(F.when(F.col("figure") == "figure4", n("count"))).over(own)).withColumn("_from", F.max(n("total_from")).over(own)).withColumn("_to", F.max(n("total_to")).over(own))
    measure = lambda name, v: F.struct(F.lit(name).alias("measure"), v.cast("double").alias("value"))
    rate = lambda name, a, b: measure(name, _one_decimal(_percent(a, b)))
    change = lambda name, a, b, c, d: measure(name, _one_decimal(_percent(a, b) - _percent(c, d)))
    total, reports = n("total"), n("total_reports")
    figure = F.col("figure")
    made = (
        F.when(figure == "figure1", F.array(
            measure("total_reports", total), *(measure(f"{m}_count", n(m)) for m in ("adoption", "risk", "vendor", "none")), *(rate(f"{m}_rate_pct", n(m), total) for m in ("adoption", "risk", "vendor", "none")),
            change("adoption_minus_risk_gap_pp", n("adoption"), total, n("risk"), total)))
        .when(figure == "figure2", F.array(measure("count", n("count"))))
        .when((figure == "figure3") & F.col("key").isNotNull(), F.array(
            measure("count_from", n("from")), measure("count_to", n("to")), rate("rate_from_pct", n("from"), F.col("_from")), rate("rate_to_pct", n("to"), F.col("_to")), change("delta_pp", n("to"), F.col("_to"), n("from"), F.col("_from"))))
        .when(figure == "figure4", F.array(measure("assignments", n("count")), rate("share_pct", n("count"), F.col("_all"))))
        .when(figure == "figure4 groups", F.array(measure("assignments", n("count")), rate("share_pct", n("count"), F.col("_all"))))
        .when(figure == "figure5", F.array(
            measure("total_reports", reports), measure("risk_reports", n("ai_risk_mention")), measure("substantive_risk_reports", n(BANDS[0])), rate("risk_mention_rate_pct", n("ai_risk_mention"), reports),
            rate("substantive_risk_rate_pct", n(BANDS[0]), reports), change("quality_gap_pp", n("ai_risk_mention"), reports, n(BANDS[0]), reports)))
        .when(figure == "figure6", F.array(
            measure("total_reports", total), measure("risk_reports", n("risk")), measure("no_ai_risk_reports", n("no_risk")), rate("risk_rate_pct", n("risk"), total), rate("no_ai_risk_rate_pct", n("no_risk"), total)))
        .when(figure == "figure7", F.array(
            rate("current_risk_rate_pct", n("risk"), total), rate("previous_risk_rate_pct", n("old_risk"), n("old_total")), change("delta_pp", n("risk"), total, n("old_risk"), n("old_total"))))
        .when(figure == "figure8", F.array(
            measure("total_reports", reports), measure("ai_mention_reports", n("ai_mention")), measure("adoption_reports", n("adoption")), measure("risk_reports", n("risk")), rate("ai_mention_rate_pct", n("ai_mention"), reports),
            rate("adoption_rate_pct", n("adoption"), reports), rate("risk_rate_pct", n("risk"), reports)))
    )
    return sides.select("figure", "key", F.col("at").alias("year"), F.inline(made))
