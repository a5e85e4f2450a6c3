"""Text rules as Column functions: counting, normalising, keys, years and scores. All run inside code generation, without Python workers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rules below.
LEGAL_SUFFIXES = ("plc", "limited", "ltd", "llp", "inc", "corp", "corporation", "company", "co", "group", "holdings", "holding", "sa", "ag", "nv", "se", "the")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
YEAR_LOW, YEAR_HIGH = 2015, 2030
LISTING_PIPES = ((14, 2), (10, 1))
LISTING_LENGTHS = ((900, 3), (500, 2), (300, 1))
LISTING_ENTITIES = ((4, 3), (2, 2), (1, 1))
LISTING_ADDRESSES = ((2, 2), (1, 1))
LISTING_COMMAS = ((12, 2), (8, 1))
LISTING_DROP = 6
TABLE_ROW = r"\|.*\|"
TABLE_RULE = r"^\|?\s*:?-{2,}.*\|.*$"
LISTING_KEEP = (
    r"(?i)\b(ai|artificial intelligence|machine learning|\bml\b|gen(?:erative)?\s*ai|llm|algorithm|risk|principal risk|mitigation|control|governance|opportunit(?:y|ies)|threat|compliance|regulat(?:ion|ory))\b"
)
LISTING_PERCENT = r"\d+(?:\.\d+)?%"
LISTING_YEAR = r"\b20\d{2}\b"
POSTCODE = r"(?i)\b[A-Z]{1,2}\d[A-Z\d]?\s?\d[A-Z]{2}\b"
ENTITY_TERMS = ("limited", "ltd", "llp", "plc", "holdco", "holdings", "nominee", "ordinary", "spv", "fund", "oeic", "sicav", "company", "group", "partners", "partnership", "trust")
ADDRESS_TERMS = (
    "road", "street", "st ", "avenue", "drive", "house", "court", "park", "building", "floor", "unit", "united kingdom", "london", "glasgow", "edinburgh", "reading", "cardiff", "plymouth", "warrington", "york",
)
SECTION_PATTERNS = (
    r"principal\s+risks?(?:\s+and\s+uncertainties)?",
    r"risk\s+(?:management|factors|review)",
    r"strategic\s+report",
    r"directors'?\s+report",
    r"governance\s+report",
    r"sustainability\s+report",
    r"esg\s+report",
    r"environmental,?\s+social\s+and\s+governance",
    r"operational\s+review",
    r"business\s+review",
    r"financial\s+review",
    r"notes\s+to\s+(?:the\s+)?financial\s+statements",
)


_LETTER = r"([0-9A-Za-z_])(?![?*{])"
#: A bound before a word character, or before a plain group whose alternatives all begin with one.
_BEFORE_WORD = re.compile(rf"\\b(?={_LETTER}|\((?:\?:)?({_LETTER}[\w ]*(?:\|{_LETTER}[\w ]*)*)\)(?![?*{{]))")


def ascii_bounds(pattern: str) -> str:
    r"""A pattern whose \b are the bounds of ASCII words, in every version of Java as in RE2: to some versions a letter with an accent is no bound.

    Before a word the next letter is tried first, since to look behind at each character takes most of a search's time.
    """
    word = "[0-9A-Za-z_]"
    ahead = lambda m: f"(?=[{''.join(sorted({x[0] for x in (m[1] or m[2]).split('|')}))}])(?<!{word})"
    return _BEFORE_WORD.sub(ahead, pattern).replace(r"\b", f"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+")


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, r"\n\s*\n"), lambda p: F.trim(p) != "")


def term_hits(text: Column, terms: Sequence[str]) -> Column:
    """How many of the terms occur in the text, each counted once."""
    low = F.lower(text)
    return sum((F.contains(low, F.lit(t.lower())).cast("int") for t in terms), F.lit(0))


def keywords_hit(text: Column, patterns: dict[str, str]) -> Column:
    """The names of the patterns that occur in the text, in name order."""
    tests = [F.when(F.regexp_like(text, F.lit(p)), F.lit(name)) for name, p in sorted(patterns.items())]
    return F.array_compact(F.array(*tests))


def content_signature(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", ""))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def name_key(name: Column) -> Column:
    """A company name for matching: lower case, `&` as and, letters and digits only, legal words dropped, single spaces."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "&", " and "), "[^a-z0-9 ]+", " ")
    legal = F.array(*[F.lit(x) for x in LEGAL_SUFFIXES])
    return F.array_join(F.filter(F.split(plain, " +"), lambda w: (w != "") & ~F.array_contains(legal, w)), " ")


def ticker_key(ticker: Column) -> Column:
    return F.nullif(F.regexp_replace(F.upper(F.coalesce(ticker, F.lit(""))), "[^A-Z0-9]+", ""), F.lit(""))


def slug(text: Column, collapse: bool = True) -> Column:
    """Lower-case slug. With collapse, runs of other characters become one hyphen and outer ones go; without, each becomes one."""
    low = F.lower(F.trim(text))
    return F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", "-"), "^-+|-+$", "") if collapse else F.regexp_replace(low, "[^a-z0-9]", "-")


def pretty_label(label: Column, overrides: dict[str, str] | None = None) -> Column:
    plain = F.initcap(F.translate(label, "_", " "))
    if not overrides:
        return plain
    table = F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv])
    return F.coalesce(F.try_element_at(table, label), plain)


def fiscal_year(title: Column) -> Column:
    """The fiscal year that a title names: a span 2021/22 ends in its second year, 2021/2022 likewise; else the latest plain year in bounds."""
    short = F.regexp_extract(title, r"\b(20\d{2})\s*[/-]\s*(\d{2})\b(?!\d)", 1).try_cast("int")
    long = F.transform(F.regexp_extract_all(title, F.lit(r"\b(20\d{2})\s*[/-]\s*(20\d{2})\b"), F.lit(2)), lambda y: y.cast("int"))
    plain = F.transform(F.regexp_extract_all(title, F.lit(r"\b(20\d{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    bounded = F.array_max(F.filter(plain, lambda y: (y >= YEAR_LOW) & (y <= YEAR_HIGH)))
    return F.coalesce(F.array_max(long), short + 1, bounded)


def period_end(title: Column) -> Column:
    """The date `31 December 2021` (or a month's first three letters) in a title."""
    pattern = r"(?i)\b(\d{1,2})(?:st|nd|rd|th)?\s+(" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + r")\s+(20\d{2})\b"
    month = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.lower(F.substring(F.regexp_extract(title, pattern, 2), 1, 3)))
    iso = F.concat_ws("-", F.regexp_extract(title, pattern, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(title, pattern, 1), 2, "0"))
    return F.when(month > 0, F.try_to_date(iso, "yyyy-MM-dd"))


def iso_year(date: Column) -> Column:
    return F.when(F.regexp_like(date, F.lit(r"^\d{4}")), F.substring(date, 1, 4).try_cast("int"))


def iso_month(date: Column) -> Column:
    return F.when(F.regexp_like(date, F.lit(r"^\d{4}-\d{2}")), F.substring(date, 1, 7))


def quality_metrics(text: Column) -> Column:
    """Share of letters, of single-letter tokens and of long tokens (over 18), share of spaces, and tokens."""
    size = F.greatest(F.length(text), F.lit(1))
    tokens = F.regexp_count(text, F.lit(r"\S+"))
    some = F.greatest(tokens, F.lit(1))
    return F.struct(
        (F.regexp_count(text, F.lit("[A-Za-z]")) / size).alias("alpha_ratio"),
        (F.regexp_count(text, F.lit(r"(?<!\S)[A-Za-z](?!\S)")) / some).alias("single_letter_rate"),
        (F.regexp_count(text, F.lit(r"(?<!\S)\S{19,}(?!\S)")) / some).alias("long_token_rate"),
        (F.regexp_count(text, F.lit(" ")) / size).alias("space_ratio"),
        tokens.alias("tokens"),
    )


def repair_route(metrics: Column, perplexity: Column | None = None) -> Column:
    """0 to 3; the first rule that holds decides."""
    start = F.when(perplexity > 100, 3) if perplexity is not None else F.when(F.lit(False), 3)
    return (
        start.when(metrics["single_letter_rate"] > 0.25, 3)
        .when(metrics["single_letter_rate"] > 0.12, 1)
        .when(metrics["long_token_rate"] > 0.08, 2)
        .when(metrics["space_ratio"] < 0.12, 2)
        .otherwise(0)
    )


def repair_accepted(before: Column, after: Column, least: float = 0.6) -> Column:
    """A repair may not change the order of numbers, and must keep most of the capitalised words."""
    number, capital = F.lit(r"\d+(?:[.,]\d+)*"), F.lit(r"\b[A-Z][a-z]+\b")
    names = F.array_distinct(F.regexp_extract_all(before, capital, F.lit(0)))
    kept = F.array_intersect(names, F.regexp_extract_all(after, capital, F.lit(0)))
    same = F.regexp_extract_all(before, number, F.lit(0)) == F.regexp_extract_all(after, number, F.lit(0))
    return same & ((F.size(names) == 0) | (F.size(kept) / F.greatest(F.size(names), F.lit(1)) >= least))


def _points(value: Column, steps: Sequence[tuple[int, int]]) -> Column:
    out = F.when(value >= steps[0][0], steps[0][1])
    for least, score in steps[1:]:
        out = out.when(value >= least, score)
    return out.otherwise(0)


def _listed(line: Column) -> Column:
    """What the listing rules count in a line, once: its entities, addresses and post code."""
    low = F.lower(line)
    hits = lambda terms: F.transform(F.array(low), lambda t: sum((F.contains(t, F.lit(x.lower())).cast("int") for x in terms), F.lit(0)))[0]
    return F.struct(line.alias("line"), hits(ENTITY_TERMS).alias("entity"), hits(ADDRESS_TERMS).alias("address"), F.regexp_like(line, F.lit(POSTCODE)).alias("postcode"))


def _is_listing_row(c: Column) -> Column:
    line = c["line"]
    figures = (c["entity"] < 2) & (c["address"] == 0) & ~c["postcode"] & ((F.regexp_count(line, F.lit(LISTING_YEAR)) >= 2) | F.regexp_like(line, F.lit(LISTING_PERCENT)))
    return ~F.regexp_like(line, F.lit(LISTING_KEEP)) & ~figures


def _listing_points(c: Column) -> Column:
    line = c["line"]
    return (
        _points(F.regexp_count(line, F.lit(r"\|")), LISTING_PIPES)
        + _points(F.length(line), LISTING_LENGTHS)
        + _points(c["entity"], LISTING_ENTITIES)
        + _points(c["address"], LISTING_ADDRESSES)
        + F.when(c["postcode"], 2).otherwise(0)
        + _points(F.regexp_count(line, F.lit(",")), LISTING_COMMAS)
    )


def listing_row(line: Column) -> Column:
    """A table line that may be a listing: no rule, no word that keeps it, and not a row of figures without entities or places."""
    row = F.regexp_like(line, F.lit(TABLE_ROW)) & ~F.regexp_like(line, F.lit(TABLE_RULE))
    return F.when(row, F.transform(F.array(_listed(line)), _is_listing_row)[0]).otherwise(row)


def listing_score(line: Column) -> Column:
    """How much a table line looks like a listing of entities and addresses; LISTING_DROP or more is noise. Only a table row's terms are looked for, each once."""
    row = F.regexp_like(line, F.lit(TABLE_ROW)) & ~F.regexp_like(line, F.lit(TABLE_RULE))
    return F.when(row, F.transform(F.array(_listed(line)), lambda c: F.when(_is_listing_row(c), _listing_points(c)).otherwise(0))[0]).otherwise(0)


def cleaned_lines(text: Column, keep: Sequence[str]) -> Column:
    """(text, rules, listings): a text without blank lines, table rules and listings, and how many of the two went; a line that a pattern hits always stays."""
    rows = F.transform(F.split(text, "\\r?\\n"), lambda t: F.struct(t.alias("t"), F.regexp_replace(t, r"(?U)^\s+|\s+$", "").alias("s")))
    hit = lambda r: F.lit(False) if not keep else _any([F.regexp_like(r["s"], F.lit(p)) for p in keep])
    kind = lambda r: F.when(r["s"] == "", "blank").when(hit(r), "kept").when(F.regexp_like(r["s"], F.lit(TABLE_RULE)), "rule").when(listing_score(r["s"]) >= LISTING_DROP, "listing").otherwise("kept")
    marked = F.transform(rows, lambda r: F.struct(r["t"].alias("t"), kind(r).alias("k")))

    def parts(lines: Column) -> Column:
        of = lambda name: F.filter(lines, lambda r: r["k"] == name)
        kept = F.regexp_replace(F.array_join(F.transform(of("kept"), lambda r: r["t"]), "\n"), r"(?U)^\s+|\s+$", "")
        return F.struct(kept.alias("text"), F.size(of("rule")).alias("rules"), F.size(of("listing")).alias("listings"))

    return F.transform(F.array(marked), parts)[0]  # lines are told apart once for all three


def _any(tests: Sequence[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def truncate_middle(text: Column, most: int = 30_000, side: int = 15_000, mark: str = "\n...\n") -> Column:
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(side)), F.lit(mark), F.right(text, F.lit(side)))).otherwise(text)


def chunk_id(document: Column, start: Column, end: Column, sub: Column | None = None) -> Column:
    """A stable id from a chunk's document and bounds."""
    return F.concat(F.lit("doc-chunk-"), F.substring(F.sha1(F.concat_ws(":", document, start, end, *([sub] if sub is not None else []))), 1, 12))


def excerpt_hash(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def company_id(number: Column, lei: Column, name: Column) -> Column:
    """The first that isn't blank: number, LEI, slug of the name."""
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(filled(number), filled(lei), slug(name))


def tokens(text: Column) -> Column:
    """Distinct words of letters and digits, lower case."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " +"), lambda w: w != ""))


def dice(a: Column, b: Column) -> Column:
    total = F.size(a) + F.size(b)
    return F.when(total > 0, 2.0 * F.size(F.array_intersect(a, b)) / total).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(1.0)


def section_of(text: Column) -> Column:
    """The section that a text names by the first pattern it holds, in lower case with underscores for spaces; else null."""
    low = F.lower(text)
    return F.replace(F.coalesce(*[F.nullif(F.regexp_extract(low, p, 0), F.lit("")) for p in SECTION_PATTERNS]), F.lit(" "), F.lit("_"))


def section_title(heading: Column) -> Column:
    """A heading that names a section, without its number, with single spaces and capital initials; else null."""
    bare = F.regexp_replace(heading, r"^\d+\.(\d+\.?)?\s+", "")
    return F.when(section_of(heading).isNotNull(), F.initcap(collapse_space(bare)))


def stitched(segments: Column) -> Column:
    """Segments of a text joined by spaces, or by nothing where two look like one cut word or number: two digits meet, or two letters of which one side has at most
    three characters, or both are lower case and the right has at most four. Each decision sees what the left side has grown to."""
    parts = F.filter(F.transform(segments, lambda x: F.trim(x)), lambda x: x != "")

    def add(done: Column, part: Column) -> Column:
        left = F.substring_index(done, "\x01", -1)
        digits = F.regexp_like(left, F.lit(r"\p{Nd}$")) & F.regexp_like(part, F.lit(r"^\p{Nd}"))
        letters = F.regexp_like(left, F.lit(r"\p{L}$")) & F.regexp_like(part, F.lit(r"^\p{L}"))
        small = (F.lower(left) == left) & (F.lower(part) == part) & (F.length(part) <= 4)
        one = digits | (letters & ((F.length(left) <= 3) | (F.length(part) <= 3) | small))
        return F.concat(done, F.when(one | (done == ""), "").otherwise("\x01"), part)

    return F.translate(F.aggregate(parts, F.lit(""), add), "\x01", " ")
