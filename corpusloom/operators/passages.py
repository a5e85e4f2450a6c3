"""Passages of texts: hits with places, sentences around hits, headings and conservative rewrites. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _placed(rows: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """Adds `start`, the sizes' sum over the earlier pieces (column _k) of the same text."""
    before = Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long"))


def hits(texts: DataFrame, key: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """(key, name, hit, start, end) of every match of every pattern: a text is cut at the matches, and the pieces' lengths add up to their places."""
    out = None
    for name, pattern in sorted(patterns.items()):
        found = texts.where(F.regexp_like(text, F.lit(pattern)))
        pairs = F.arrays_zip(F.split(text, pattern).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
        rows = found.select(key, F.xxhash64(text).alias("_text"), F.posexplode(pairs).alias("_k", "_x")).select(key, "_text", "_k", "_x.gap", "_x.hit").where("hit is not null")
        rows = _placed(rows, [key, "_text"], F.length("gap") + F.length("hit"))
        start = F.col("start") + F.length("gap")
        rows = rows.select(key, F.lit(name).alias("name"), "hit", start.alias("start"), (start + F.length("hit")).alias("end"))
        out = rows if out is None else out.union(rows)
    return out


def sentences_with(texts: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """(key, start, end) of the sentences (which end at a full stop, question or exclamation mark before white space) that the pattern hits."""
    rows = texts.select(key, F.xxhash64(text).alias("_text"), F.posexplode(F.split(text, r"[.!?][ \n]")).alias("_k", "_s"))
    rows = _placed(rows, [key, "_text"], F.length("_s") + 2).where(F.regexp_like("_s", F.lit(pattern)))
    return rows.select(key, "start", (F.col("start") + F.length("_s")).alias("end"))


# Limits of the heading rules.
HEADING = {"longest": 60, "upper share": 0.6, "upper words": 8, "title words": 6, "larger": 1.2}


def looks_like_heading(text: Column) -> Column:
    """A short text that is mostly upper case in few words, or whose few words all begin with a capital (those that begin with a letter)."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    upper, letters = F.regexp_count(text, F.lit(r"\p{Lu}")), F.regexp_count(text, F.lit(r"\p{L}"))
    capital = F.forall(words, lambda w: ~F.regexp_like(w, F.lit(r"^\p{L}")) | F.regexp_like(w, F.lit(r"^\p{Lu}")))
    shouted = (upper > F.greatest(letters, F.lit(1)) * HEADING["upper share"]) & (F.size(words) <= HEADING["upper words"])
    return (F.length(text) <= HEADING["longest"]) & (F.size(words) > 0) & (shouted | ((F.size(words) <= HEADING["title words"]) & capital))


def is_heading(text: Column, size: Column, average: Column) -> Column:
    """A line in letters clearly larger than the average, in capitals only and few words, or numbered."""
    capitals = F.regexp_like(text, F.lit(r"\p{Lu}")) & ~F.regexp_like(text, F.lit(r"\p{Ll}")) & (F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")) <= HEADING["upper words"])
    return F.coalesce(size > average * HEADING["larger"], F.lit(False)) | capitals | F.regexp_like(text, F.lit(r"^\d+\.(\d+\.?)?\s+[A-Z]"))


def normalise(text: Column) -> Column:
    """The conservative rewrites of extracted markup, in their fixed order: entity numbers with dates, dates, units, spelled words, tags, page leaders, gaps in numbers, broken and joined words."""
    space = lambda t: F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
    text = space(text)
    for pattern, to in (
        (r"(?U)\b[A-Z0-9]{18,20}\b(?:\s+\d{4}-\d{2}-\d{2}(?:\s+\d{4}-\d{2}-\d{2})?)*", ""), (r"(?U)\b\d{4}-\d{2}-\d{2}\b", ""), (r"(?U)\b(?:iso4217|xbrli):[A-Za-z]+\b", ""),
    ):
        text = F.regexp_replace(text, pattern, to)
    text = merged_spelling(text)
    for pattern, to in (
        (r"(?U)\b[a-z0-9]{2,}(?:-[a-z0-9]{2,})?:[A-Za-z][A-Za-z0-9_-]*\b", ""), (r"(?U)\s*\.{3,}\s*\d+\b", ""), (r"(?U)(\d)\s+(\d)", "$1$2"), (r"(?U)(\d)\s+,\s+(\d)", "$1,$2"), (r"(?U)(\d)\s+\.\s+(\d)", "$1.$2"),
        (r"(?U)(\d)\s+%", "$1%"), (r"(?U)([£$€])\s+(\d)", "$1$2"), (r"(?U)([A-Za-z])-\s+([A-Za-z])", "$1$2"), ("(?<=[a-z])(?=[A-Z])", " "),
    ):
        text = F.regexp_replace(text, pattern, to)
    return space(F.replace(text, F.lit("�"), F.lit("")))


def merged_spelling(text: Column) -> Column:
    """Three or more single letters in a row put together (`A n n u a l`). The rewrite depends on the match, so the text is cut at matches and put together from the pieces."""
    pattern = r"(?U)(?:\b[A-Za-z]\b(?:\s+|&nbsp;)+){2,}\b[A-Za-z]\b"
    letters = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.regexp_replace(m, "[^A-Za-z]", ""))
    pieces = F.zip_with(F.split(text, pattern, -1), letters, lambda gap, word: F.concat(gap, F.coalesce(word, F.lit(""))))
    return F.array_join(pieces, "")


def merged_letters(text: Column) -> Column:
    """A stray consonant or vowel other than a and i joins the word behind it (unless that is a small connecting one), then the word before it: `c ustomer`, `risk s`."""
    text = F.regexp_replace(text, r"(?U)(?<=\s)([b-hj-z])\s+(?!(?:and|the|for|with|to|of|in|on|at)\b)([a-z]{3,})", "$1$2")
    return F.regexp_replace(text, r"(?U)([a-z]{3,})\s+([b-hj-z])(?=\s|[,.;:\)]|\z)", "$1$2")


def markdown(spans: DataFrame, key: str, order: str) -> DataFrame:
    """(key, markdown) of spans (key, order, text, heading, size): headings over 16 points are of the first level, all others of the second; paragraphs have single spaces, blank ones go."""
    head = F.concat(F.when(F.col("size") > 16, "\n# ").otherwise("\n## "), F.col("text"), F.lit("\n"))
    plain = F.trim(F.regexp_replace("text", r"\s+", " "))
    part = F.when(F.col("heading"), head).when(plain != "", F.concat(plain, F.lit("\n")))
    rows = spans.groupBy(key).agg(F.array_sort(F.collect_list(F.when(part.isNotNull(), F.struct(F.col(order).alias("k"), part.alias("part"))))).alias("_parts"))
    return rows.select(key, F.array_join(F.transform("_parts", lambda x: x["part"]), "\n").alias("markdown"))
