"""Filters over ordered spans, mention units, segment rules, manifests and notices."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sentences
from .select import pick_best


def strategy_filter(spans: DataFrame, key: str, order: str, hit: Column, heading: Column, strategy: str = "full", context: bool = False, section: Column | None = None, sections: Sequence[str] = ()) -> DataFrame:
    """`full` keeps all spans; `section` those whose section holds one of the names; `keyword` hits and headings, with context also the plain span just before a hit."""
    if strategy == "full":
        return spans
    if strategy == "section":
        return spans.where(F.exists(F.array(*[F.lit(s.lower()) for s in sections]), lambda s: F.contains(F.lower(section), s)))
    keep = hit | heading
    if context:
        own = Window.partitionBy(key).orderBy(order)
        rows = spans.withColumn("_hit", hit).withColumn("_before", F.coalesce(F.lead("_hit").over(own), F.lit(False)) & ~heading)
        return rows.where(keep | F.col("_before")).drop("_hit", "_before")
    return spans.where(keep)


def mention_units(chunks: DataFrame, document: str, chunk: str, text: str, hit: str, around: int = 1) -> DataFrame:
    """(document, chunk, sentence, unit): sentences with a hit, each with its neighbours; of equal units of one document the first stays."""
    rows = chunks.select(document, chunk, F.posexplode(sentences(F.col(text))).alias("sentence", "_s"))
    own = Window.partitionBy(document, chunk).orderBy("sentence").rowsBetween(-around, around)
    rows = rows.withColumn("unit", F.array_join(F.collect_list("_s").over(own), " ")).where(F.regexp_like("_s", F.lit(hit)))
    first = rows.groupBy(document, "unit").agg(F.min(F.struct(chunk, "sentence")).alias("_at"))
    return first.select(document, F.col("_at")[chunk].alias(chunk), F.col("_at")["sentence"].alias("sentence"), "unit")


def two_way_coverage(forward: DataFrame, backward: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """From best matches (a, b) of each side: the matched share of either side, and how many rows of a share one row of b on average."""
    f = forward.agg(F.count("*").alias("fa"), F.count_distinct("b").alias("fb"))
    g = backward.agg(F.count("*").alias("gb"))
    one = f.crossJoin(F.broadcast(g))  # one row each
    share = lambda x, n: F.round(F.col(x) / n, 4) if n else F.lit(0.0)
    return one.select(share("fa", n_a).alias("recall"), share("gb", n_b).alias("precision"), F.when(F.col("fb") > 0, F.round(F.col("fa") / F.col("fb"), 4)).otherwise(0.0).alias("fan_in"))


def ladder(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """The name of the first rule that holds."""
    out = F.when(*[rules[0][0], rules[0][1]])
    for rule, name in rules[1:]:
        out = out.when(rule, name)
    return out.otherwise(default)


def target_manifest(filings: DataFrame, registry: DataFrame, companies: DataFrame, key: str, years: Sequence[int]) -> DataFrame:
    """(key, year, status): a company's filings and the target years missing between them; without filings its registry years; else one row to look into.

    Every branch is an equality join or anti join on (key, year), and a company's years are exploded from its bounds.
    """
    span = filings.groupBy(key).agg(F.min("year").alias("_lo"), F.max("year").alias("_hi"))
    own = filings.select(key, "year").distinct().withColumn("status", F.lit("filed"))
    inside = span.select(key, F.explode(F.filter(F.array(*[F.lit(y) for y in years]), lambda y: (y > F.col("_lo")) & (y < F.col("_hi")))).alias("year"))
    holes = inside.join(own, [key, "year"], "left_anti").withColumn("status", F.lit("interpolated"))
    listed = registry.select(key, "year").distinct().join(span.select(key), key, "left_anti").withColumn("status", F.lit("registry"))
    rest = companies.select(key).distinct().join(span.select(key), key, "left_anti").join(registry.select(key), key, "left_anti")
    return own.union(holes).union(listed).union(rest.select(key, F.lit(None).cast("int"), F.lit("investigate")))


def best_by_year(candidates: DataFrame, key: str, year: str, item: str, order: list[Column], years: Sequence[int]) -> DataFrame:
    """(key, year, item): years with the fewest candidates choose first (then the earlier), each its first unused item by order; where all are used, its first.

    A year can lose at most one item to each other year, so its first len(years) candidates decide. Those are found by a
    ranking whose limit is pushed below the shuffle, and a fold over at most len(years) squared of them chooses.
    """
    most = len(years)
    own = Window.partitionBy(key, year)
    candidates = pick_best(candidates, [key, year, item], order)  # an item counts once for a year
    counts = candidates.groupBy(key, year).agg(F.count("*").alias("_n"))
    first = candidates.withColumn("_k", F.row_number().over(own.orderBy(*order))).where(F.col("_k") <= most)
    pools = first.groupBy(key, year).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", item))), lambda x: x[item]).alias("_items"))
    pools = pools.join(counts, [key, year]).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_n", year, "_items"))).alias("_pools"))
    kinds = dict(candidates.dtypes)
    none = F.array().cast(f"array<struct<{year}:{kinds[year]},{item}:{kinds[item]}>>")

    def choose(done: Column, pool: Column) -> Column:
        left = F.filter(pool["_items"], lambda i: ~F.exists(done, lambda d: d[item] == i))
        return F.concat(done, F.array(F.struct(pool[year].alias(year), F.coalesce(F.try_element_at(left, F.lit(1)), pool["_items"][0]).alias(item))))

    return pools.select(key, F.explode(F.aggregate("_pools", none, choose)).alias("_x")).select(key, f"_x.{year}", f"_x.{item}")


def limited_batches(items: DataFrame, key: str, order: str, size: str, most_size: int, most_items: int) -> DataFrame:
    """Adds `batch` (from 0): items in order, a new batch where the size or number would be passed. A too large item has a batch of its own."""
    schema = ", ".join([*(f"`{c}` {t}" for c, t in items.dtypes), "batch int"])

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        batch, total, n, out = 0, 0, 0, []
        for x in rows[size]:
            if n and (total + x > most_size or n == most_items):
                batch, total, n = batch + 1, 0, 0
            total, n = total + x, n + 1
            out.append(batch)
        return rows.assign(batch=out)

    return items.groupBy(key).applyInPandas(walk, schema)


def joined_lines(lines: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """(key, paragraph, text): a line goes on with the paragraph so far unless that ends a sentence or is a heading, or the line begins like a new one (a heading mark, a bullet).

    Whether a line begins a paragraph shows in it and the line before, so places are running sums and no text is walked.
    """
    rows = lines.select(key, order, F.regexp_replace(text, r"^\s+|\s+$", "").alias("_t")).where("_t <> ''")
    own = Window.partitionBy(key).orderBy(order, "_t")
    before = F.lag("_t").over(own)
    fresh = before.isNull() | F.regexp_like(before, F.lit(r"[.!?:]$|^#")) | F.regexp_like("_t", F.lit("^[#*•-]"))
    rows = rows.withColumn("_new", fresh.cast("int")).withColumn("paragraph", (F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct(order, "_t")))
    return rows.groupBy(key, "paragraph").agg(F.array_join(F.transform(parts, lambda x: x["_t"]), " ").alias("text"))



def notice_changes(notices: DataFrame, text: str) -> DataFrame:
    """(effective, added, deleted) of index-change notices: the effective date and the names before `is added` and `is deleted`."""
    names = lambda verb: F.transform(F.regexp_extract_all(text, F.lit(rf"([A-Z][A-Za-z0-9&' ]+?) (?:is|are|will be) {verb}"), F.lit(1)), lambda x: F.trim(x))
    date = F.regexp_extract(text, r"(?i)effective(?: from)? (\d{1,2} [A-Z][a-z]+ \d{4})", 1)
    return notices.select("*", F.try_to_date(date, "d MMMM yyyy").alias("effective"), names("added").alias("added"), names("deleted").alias("deleted"))
