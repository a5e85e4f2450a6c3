"""Markdown to keyword-gated chunks.

A document stays one row: its lines are an array, blocks are found from the lines' kinds and lengths alone (in Arrow batches), and
headings, keywords and windows are column functions on those arrays, so that texts are neither shuffled nor sorted. Each step's work
is linear in a document's text. Windows of malformed documents, and packing a text into parts of limited size, where each cut
depends on the one before, walk in Python, in Arrow batches.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chunk_id, sentences

_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_BLANK = re.compile(r"\n\s*\n")
#: The first of two characters that end a sentence or a paragraph.
_MARK = re.compile(r"[.!?](?=[ \n])|\n(?=\n)")
_BOUNDS = "array<struct<first int, last int, heading boolean, above int, start long, end long>>"
#: Characters of parts that leave a task together.
AT_ONCE = 1_000_000


def line_bounds(kinds: pa.Array, sizes: pa.Array) -> pa.Array:
    """The blocks of each document from its lines' kinds (0 blank, 1 plain, 2 heading) and lengths: first and last line, heading or not, the line of the heading before (or null), start and end."""
    many = pc.fill_null(kinds.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    kind, size = kinds.flatten().to_numpy(zero_copy_only=False), sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row, line = np.repeat(np.arange(len(many)), many), np.arange(len(kind))
    top = np.repeat(np.cumsum(many) - many, many)  # the first line of the same document
    at = np.cumsum(size + 1) - size - 1
    at = at - at[top]
    joined, goes_on = np.zeros((2, len(kind)), bool)  # with the line before, with the line behind
    joined[1:] = (kind[1:] == 1) & (kind[:-1] == 1) & (line[1:] > top[1:])
    goes_on[:-1] = joined[1:]
    first, last = np.flatnonzero((kind > 0) & ~joined), np.flatnonzero((kind > 0) & ~goes_on)
    heads = np.append(-1, np.maximum.accumulate(np.where(kind == 2, line, -1)))[first]
    columns = [
        pa.array(first - top[first], pa.int32()), pa.array(last - top[first], pa.int32()), pa.array(kind[first] == 2), pa.array(heads - top[first], pa.int32(), mask=heads < top[first]),
        pa.array(at[first], pa.int64()), pa.array(at[last] + size[last], pa.int64()),
    ]
    ends = np.append(0, np.cumsum(np.bincount(row[first], minlength=len(many))))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, ["first", "last", "heading", "above", "start", "end"]))


def _with_bounds(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, _lines, _bounds) of the documents with a text."""
    lines = docs.where(F.col(text).isNotNull()).select(key, text, F.split(F.col(text), "\n").alias("_lines"))
    kind = F.transform("_lines", lambda t: F.when(F.trim(t).startswith("#"), 2).when(F.trim(t) == "", 0).otherwise(1))
    bounds = F.arrow_udf(line_bounds, _BOUNDS).asNondeterministic()  # or filters on what comes of it would be pushed down with a run of it of their own
    return lines.withColumn("_bounds", bounds(kind, F.transform("_lines", F.length)))


def _section(b: Column) -> Column:
    """The text, without marks, of the heading before a block."""
    return F.trim(F.regexp_replace(F.trim(F.get("_lines", b["above"])), "^#+", ""))


def _joined(of: Callable[[Column], Column], first: Column, last: Column, joint: str) -> Column:
    # not slice(), which copies the whole array each time
    return F.array_join(F.transform(F.sequence(first, last), of), joint)


def _blocks() -> Column:
    line = lambda j: F.get("_lines", j)
    return F.transform("_bounds", lambda b: F.struct(_joined(line, b["first"], b["last"], "\n").alias("text"), b["heading"].alias("heading"), _section(b).alias("section"), b["start"].alias("start"), b["end"].alias("end")))


def blocks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, block, text, heading, section, start, end): blocks between blank lines, headings on their own. Offsets are code points of the document.

    A heading's section is the one before it; the following blocks have its text without the marks.
    """
    rows = _with_bounds(docs, key, text).select(key, F.posexplode_outer(_blocks()).alias("block", "_b")).where("_b is not null")
    return rows.select(key, "block", "_b.*")


def _window_chunks(found: DataFrame, patterns: dict[str, str], before: int, after: int, key: str) -> DataFrame:
    """Chunks of documents that have _lines and _bounds."""
    block, place, n = (lambda i: F.get("_blocks", i)), (lambda p: F.get("_body", p)), F.size("_body")
    named = lambda t: F.array_compact(F.array(*[F.when(F.regexp_like(t, F.lit(p)), F.lit(name)) for name, p in sorted(patterns.items())]))
    found = found.select(key, _blocks().alias("_blocks"))
    found = found.withColumn("_body", F.array_compact(F.transform("_blocks", lambda b, i: F.when(~b["heading"], i))))
    around = lambda i, p: F.struct(F.greatest(p - before, F.lit(0)).alias("first"), F.least(p + after, n - 1).alias("last"), named(block(i)["text"]).alias("keywords"), block(i)["section"].alias("section"))
    found = found.withColumn("_hits", F.filter(F.transform("_body", around), lambda h: F.size(h["keywords"]) > 0))
    # windows of different paragraphs are equal only where both span all paragraphs
    whole = lambda h: (h["first"] == 0) & (h["last"] == n - 1)
    window = lambda first, last, keywords, sections: F.struct(first.alias("first"), last.alias("last"), keywords.alias("keywords"), F.array_compact(sections).alias("sections"))
    found = found.withColumn("_all", F.filter("_hits", whole))
    every = lambda field: F.transform("_all", lambda h: h[field])
    once = window(F.lit(0), n - 1, F.array_sort(F.array_distinct(F.flatten(every("keywords")))), F.array_sort(F.array_distinct(every("section"))))
    own = F.transform(F.filter("_hits", lambda h: ~whole(h)), lambda h: window(h["first"], h["last"], h["keywords"], F.array(h["section"])))
    found = found.withColumn("_windows", F.concat(F.filter(F.array(once), lambda _: F.size("_all") > 0), own))
    chunks = F.transform(
        "_windows",
        lambda w: F.struct(
            w["first"].alias("first"),
            w["last"].cast("long").alias("last"),
            block(place(w["first"]))["start"].alias("start"),
            block(place(w["last"]))["end"].alias("end"),
            _joined(lambda j: block(j)["text"], place(w["first"]), place(w["last"]), "\n\n").alias("chunk_text"),
            w["keywords"].alias("keywords"),
            w["sections"].alias("sections"),
        ),
    )
    # an outer generator, since Spark gives others a filter with the whole array spelt out in it once more
    rows = found.select(key, F.inline_outer(chunks)).where("start is not null")
    return rows.select(chunk_id(F.col(key).cast("string"), F.col("first"), F.col("last")).alias("chunk_id"), key, "first", "last", "start", "end", "chunk_text", "keywords", "sections")


def keyword_chunks(docs: DataFrame, patterns: dict[str, str], before: int = 2, after: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One chunk for each different window of paragraphs around a paragraph with a keyword.

    Equal windows of several paragraphs are one chunk with all their keywords; others may overlap. A chunk's text holds all
    blocks between its first and last paragraph, headings included, joined by blank lines.
    """
    return _window_chunks(_with_bounds(docs, key, text), patterns, before, after, key)


def _pack(units: Iterable[str | None], most: int, size: Callable[[str], int], joint: str, overlap: int = 0, gap: int = 0) -> Iterator[str]:
    """Runs of units of at most `most` in all, each unit costing its size and a gap; None ends a run. A run begins with the last `overlap` units of the one before where the next unit still fits."""
    run: list[str] = []
    sizes: list[int] = []
    total = 0
    for unit in units:
        own = 0 if unit is None else size(unit)
        if run and (unit is None or total + own > most):
            yield joint.join(run)
            kept = len(run) - (min(overlap, len(run)) if unit is not None else 0)
            run, sizes = run[kept:], sizes[kept:]
            total = sum(sizes)
            if unit is not None and total + own > most:
                run, sizes, total = [], [], 0
        if unit is not None:
            run.append(unit)
            sizes.append(own + gap)
            total += own + gap
    if run:
        yield joint.join(run)


def _words(text: str) -> int:
    return len(text.split())


def _word_runs(sentence: str, most: int) -> Iterator[str]:
    """The sentence, or runs of `most` of its words, each with the last 40 words (at most a tenth) of the one before."""
    words, step = sentence.split(), max(most - min(40, most // 10), 1)
    if len(words) <= most:
        yield sentence
        return
    yield from (" ".join(words[i : i + most]) for i in range(0, len(words) - most + step, step))


def _word_parts(text: str, most: int, overlap: int) -> Iterator[str]:
    paragraphs = list(filter(None, map(str.strip, _BLANK.split(text))))
    counts = {p: _words(p) for p in paragraphs}
    if sum(counts[p] for p in paragraphs) <= most:
        yield text
        return

    def units() -> Iterator[str]:
        for paragraph in paragraphs:
            pieces = [paragraph]
            if counts[paragraph] > most:
                pieces = _pack((r for s in _SENTENCE.split(paragraph) for r in _word_runs(s, most)), most, _words, " ", overlap)
            yield from pieces

    yield from _pack(units(), most, lambda u: counts[u] if u in counts else _words(u), "\n\n")


def _rows(df: DataFrame, text: str, parts: Callable[[object], Iterable[str]]) -> DataFrame:
    """Each row once for each part of its `text`, numbered in `part` from 0; a row without parts keeps an empty one."""
    kinds = {c: "string" if c == text else t for c, t in df.dtypes}
    schema = ", ".join([*(f"`{c}` {t}" for c, t in kinds.items()), "part int"])
    return df.mapInArrow(lambda batches: cut_rows(batches, text, parts), schema)


def cut_rows(batches: Iterable[pa.RecordBatch], text: str, parts: Callable[[object], Iterable[str]]) -> Iterator[pa.RecordBatch]:
    """Each row once for each part of its `text`, with its number, in batches of AT_ONCE characters and at most one text more."""
    for b in batches:
        at = b.schema.names.index(text)
        of, texts, places, size = [], [], [], 0
        for i in range(b.num_rows):
            found = list(parts(b.column(at)[i].as_py())) or [""]
            of += [i] * len(found)
            texts += found
            places += range(len(found))
            size += sum(map(len, found))
            if size >= AT_ONCE or i == b.num_rows - 1:
                rows = pa.array(of, pa.int64())
                columns = [pa.array(texts, pa.string()) if k == at else c.take(rows) for k, c in enumerate(b.columns)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(places, pa.int32())], [*b.schema.names, "part"])
                of, texts, places, size = [], [], [], 0


def split_words(chunks: DataFrame, most: int, text: str = "chunk_text", overlap: int = 1) -> DataFrame:
    """Each chunk as rows (`part` from 0) of at most `most` words; a text that fits stays as it is. most <= 0: no split.

    Paragraphs are packed together. One that is too long is first cut at sentences, each piece repeating the last `overlap`
    sentences of the one before; a sentence that is too long is cut by words. A null text becomes an empty part.
    """
    return chunks.withColumn("part", F.lit(0)) if most <= 0 else _rows(chunks, text, lambda t: _word_parts(t or "", most, overlap))


def split_chars(texts: DataFrame, most: int, text: str = "text", by: str = "paragraph") -> DataFrame:
    """Each text as rows (`part` from 0): its paragraphs, or sentences, packed greedily to at most `most` characters, a space after each counted, and joined by a space.

    A paragraph (which also ends at three spaces) over the limit starts a new part and is packed by its sentences; a sentence over the limit stays whole. Null and blank texts become one empty part.
    """
    filled = lambda c: F.filter(F.transform(c, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    whole, cut = F.lit(None).cast("string"), lambda c: filled(sentences(c))
    units = cut(F.col(text))
    if by == "paragraph":
        pieces = filled(F.split(text, r"\n\s*\n|\s{3,}"))
        units = F.flatten(F.transform(pieces, lambda p: F.when(F.length(p) > most, F.concat(F.array(whole), cut(p))).otherwise(F.array(p))))
    return _rows(texts.withColumn(text, units), text, lambda u: _pack(u if u is not None else (), most, len, " ", gap=1))


LONG = 20_000  # characters of a paragraph from which a text counts as malformed


def _shaped(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Adds paragraphs, sections and _bad to what _with_bounds gives."""
    body = F.filter("_bounds", lambda b: ~b["heading"])
    longest = F.array_max(F.transform(body, lambda b: b["end"] - b["start"]))
    sections = F.array_sort(F.array_distinct(F.array_compact(F.transform(body, _section))))
    found = _with_bounds(docs, key, text).withColumns({"paragraphs": F.size(body).cast("long"), "sections": sections})
    return found.withColumn("_bad", (F.size("_lines") <= 2) | (F.col("paragraphs") <= 1) | (longest >= LONG))


def malformed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, paragraphs, sections) of the documents that paragraphs can't cut: one line end or fewer, one paragraph or fewer, or one of LONG characters."""
    return _shaped(docs, key, text).where("_bad").select(key, "paragraphs", "sections")


def text_windows(text: str, hits: list[dict], radius: int) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, keywords) of the windows around hits, which are a pattern's gaps before its hits and their sizes."""
    places = []
    for h in hits:
        at = 0
        for gap, size in zip(h["gaps"] or (), h["sizes"] or (), strict=False):
            places.append((at + gap, at + gap + size, h["name"]))
            at += gap + size
    marks = [m.start() for m in _MARK.finditer(text)]
    begin, top, names = 0, -1, set()
    for start, stop, name in sorted(places):
        low, high = max(start - radius, 0), min(stop + radius, len(text))
        if low > 0:
            k = bisect_right(marks, low - 2)
            low = marks[k - 1] + 2 if k else 0
        if high < len(text):
            k = bisect_left(marks, high)
            high = len(text) if k == len(marks) else marks[k] + (1 if text[marks[k]] == "\n" else 2)
        if high <= low:
            continue
        if names and low >= top:
            yield begin, top, sorted(names)
            names = set()
        begin, top = (begin, max(top, high)) if names else (low, high)
        names.add(name)
    if names:
        yield begin, top, sorted(names)


def window_rows(batches: Iterable[pa.RecordBatch], text: str, radius: int) -> Iterator[pa.RecordBatch]:
    """Each row once for each window of its text, which is cut out and trimmed, in batches of AT_ONCE characters and at most one text more."""
    for b in batches:
        kept = b.select([c for c in b.schema.names if c not in (text, "_hits")])
        of, found, cuts, size = [], [], [], 0
        for i in range(b.num_rows):
            whole = b.column(text)[i].as_py()
            for w in text_windows(whole, b.column("_hits")[i].as_py(), radius):
                of.append(i)
                found.append(w)
                cuts.append(whole[w[0] : w[1]].strip(" \t\n\x0b\f\r"))
                size += len(cuts[-1])
            if size >= AT_ONCE or i == b.num_rows - 1:
                starts, ends, names = ([w[k] for w in found] for k in range(3))
                columns = [pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(cuts, pa.string())]
                yield pa.RecordBatch.from_arrays([*kept.take(pa.array(of, pa.int64())).columns, *columns], [*kept.schema.names, "start", "end", "keywords", "chunk_text"])
                of, found, cuts, size = [], [], [], 0


def _cut_windows(docs: DataFrame, patterns: dict[str, str], radius: int, text: str) -> DataFrame:
    """Each row, without its text, once for each window around hits, with start, end, keywords and chunk_text (trimmed)."""
    sizes = lambda pieces: F.transform(pieces, F.length)
    like = {p: F.regexp_like(text, F.lit(p)) for p in patterns.values()}
    of = lambda p, pieces: F.when(like[p], sizes(pieces))
    hits = [F.struct(F.lit(name).alias("name"), of(p, F.split(text, p)).alias("gaps"), of(p, F.regexp_extract_all(text, F.lit(p), F.lit(0))).alias("sizes")) for name, p in sorted(patterns.items())]
    found = docs.where(functools.reduce(Column.__or__, like.values(), F.lit(False))).withColumn("_hits", F.array(*hits))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes if c != text), "start long, `end` long, keywords array<string>, chunk_text string"])
    return found.mapInArrow(lambda batches: window_rows(batches, text, radius), schema)


def hit_windows(docs: DataFrame, patterns: dict[str, str], radius: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, end, keywords): `radius` characters around each hit, widened to sentence ends or blank lines; windows that overlap are one.

    A text's hits go to its task's walk as lengths, and its sentence ends are found once, so the work is linear in the text.
    """
    return _cut_windows(docs.select(key, text), patterns, radius, text).drop("chunk_text")


def document_chunks(docs: DataFrame, patterns: dict[str, str], before: int = 2, after: int = 2, most: int = 600, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of all documents: paragraph windows, and character windows for malformed documents (their `first` and `last` span all paragraphs). Keys are distinct."""
    found = _shaped(docs, key, text)
    radius = max(1200, min(4000, (most or 600) * 3))
    good = _window_chunks(found.where("not _bad"), patterns, before, after, key)
    rows = _cut_windows(found.where("_bad").select(key, text, "paragraphs", "sections"), patterns, radius, text)
    rows = rows.where("chunk_text <> ''").withColumns({"first": F.lit(0), "last": F.greatest(F.col("paragraphs") - 1, F.lit(0)).cast("int")})
    named = rows.select(chunk_id(F.col(key).cast("string"), F.col("start"), F.col("end")).alias("chunk_id"), key, "first", "last", "start", "end", "chunk_text", "keywords", "sections")
    return good.unionByName(named)


def repeated_lines(docs: DataFrame, least: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line, t) without short lines (10 to 120 characters) whose normal form stands `least` times or more in their document."""
    lines = docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line", "t"))
    form = F.trim(F.regexp_replace(F.regexp_replace(F.lower("t"), "[0-9]+", ""), r"[^\p{L}]+", " "))
    lines = lines.withColumn("_form", F.when(F.length("t").between(10, 120), form))
    often = lines.where(F.col("_form").isNotNull()).groupBy(key, "_form").agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return lines.join(often.drop("_n"), [key, "_form"], "left_anti").select(key, "line", "t")
