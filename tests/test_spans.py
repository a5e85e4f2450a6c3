"""Packing, windows of malformed documents and combined similarity against plain versions."""

from __future__ import annotations

import random
import re
from difflib import SequenceMatcher

import pyarrow as pa
import pytest
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as rules
from corpusloom.operators import chunking, html_spans, lookup, passages, select


def _texts(seed: int, n: int, ends: tuple[str, ...]) -> list[str]:
    rng = random.Random(seed)
    return ["".join(f"{rng.choice(('alpha', 'be', 'gamma 123', 'delta', 'é'))}{rng.choice(ends)}" for _ in range(rng.randrange(0, 120))) for _ in range(n)]


def test_word_parts_hold_all_sentences_in_order(spark: SparkSession) -> None:
    texts = [*_texts(1, 40, (" ", " ", ". ", "! ", "\n\n")), "w " * 95, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, chunk_text string").repartition(3)
    got: dict[int, list[str]] = {}
    for r in sorted(chunking.split_words(df, 20).collect(), key=lambda r: (r["k"], r["part"])):
        got.setdefault(r["k"], []).append(r["chunk_text"])
    assert set(got) == set(range(len(texts)))
    for k, text in enumerate(texts):
        parts = got[k]
        if len((text or "").split()) <= 20:
            assert parts == [text or ""]
            continue
        assert all(0 < len(p.split()) <= 20 for p in parts)
        words, at = text.split(), 0  # nothing is lost: each part starts where the one before ends, or before that
        for p in parts:
            mine = p.split()
            back = next(i for i in range(at, -1, -1) if words[i : i + len(mine)] == mine)
            at = back + len(mine)
        assert at == len(words)


def test_a_long_sentence_is_cut_by_words_with_overlap(spark: SparkSession) -> None:
    words = [f"w{i}" for i in range(50)]
    df = spark.createDataFrame([(" ".join(words),)], "chunk_text string")
    parts = [r["chunk_text"].split() for r in sorted(chunking.split_words(df, 20, overlap=0).collect(), key=lambda r: r["part"])]
    assert parts == [words[i : i + 20] for i in (0, 18, 36)]


def test_sentences_overlap_inside_a_paragraph(spark: SparkSession) -> None:
    text = "One two three. Four five. Six seven eight. Nine ten."
    df = spark.createDataFrame([(text,)], "chunk_text string")
    parts = [r["chunk_text"] for r in sorted(chunking.split_words(df, 6).collect(), key=lambda r: r["part"])]
    assert parts == ["One two three. Four five.", "Four five. Six seven eight.", "Six seven eight. Nine ten."]
    plain = [r["chunk_text"] for r in sorted(chunking.split_words(df, 6, overlap=0).collect(), key=lambda r: r["part"])]
    assert plain == ["One two three. Four five.", "Six seven eight. Nine ten."]


@pytest.mark.parametrize("by", ["paragraph", "sentence"])
def test_character_parts(spark: SparkSession, by: str) -> None:
    most = 60
    texts = [*_texts(2, 40, (" ", " ", ". ", "? ", "\n \n", "    ")), "x" * 200, "   ", "", None]

    def plain(text: str) -> list[str]:
        """Parts by looking, from each start, for the last unit that still fits."""
        cut = lambda t: [s for s in map(str.strip, re.split(r"(?<=[.!?])\s+", t)) if s]
        groups = [cut(text)]
        if by == "paragraph":  # a long paragraph opens a group of its own
            groups = [[]]
            for p in filter(None, map(str.strip, re.split(r"\n\s*\n|\s{3,}", text))):
                if len(p) > most:
                    groups.append([])
                groups[-1] += cut(p) if len(p) > most else [p]
        out = []
        for units in groups:
            i = 0
            while i < len(units):
                j = i + 1
                while j < len(units) and len(" ".join(units[i:j])) + 1 + len(units[j]) <= most:
                    j += 1
                out.append(" ".join(units[i:j]))
                i = j
        return out or [""]

    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(3)
    got = [(r["k"], r["part"], r["text"]) for r in chunking.split_chars(df, most, by=by).collect()]
    assert sorted(got) == [(k, i, p) for k, t in enumerate(texts) for i, p in enumerate(plain(t or ""))]


def test_windows_around_hits(spark: SparkSession) -> None:
    texts = [*_texts(3, 60, (" ", " ", " ", ". ", "!\n", ".\n\n")), "no hit", "123", "", None]
    patterns, radius = {"number": "[0-9]{3}", "be": r"\bbe\b"}, 25
    want = []
    for k, t in enumerate(texts):
        if t is None:
            continue
        marks = [i for i in range(len(t)) if re.match(r"[.!?][ \n]|\n\n", t[i : i + 2])]
        found = sorted((m.start(), m.end(), n) for n, p in patterns.items() for m in re.finditer(p, t))
        windows: list[list] = []
        for s, e, n in found:
            low, high = max(s - radius, 0), min(e + radius, len(t))
            low = max((i + 2 for i in marks if i + 2 <= low), default=0) if low else 0
            high = min((i + 1 if t[i] == "\n" else i + 2 for i in marks if i >= high), default=len(t)) if high < len(t) else high
            if windows and low < windows[-1][1]:
                windows[-1] = [windows[-1][0], max(windows[-1][1], high), windows[-1][2] | {n}]
            else:
                windows.append([low, high, {n}])
        want += [(k, a, b, sorted(ns)) for a, b, ns in windows]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(3)
    got = chunking.hit_windows(df, patterns, radius, "k", "t").select("k", "start", "end", "keywords").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 60


def test_malformed_and_other_documents_get_chunks(spark: SparkSession) -> None:
    rows = [(1, "# A\nfirst\n\nno 123\n\nlast"), (2, "one line with 123 in it. And more"), (3, "x" * 25_000 + " 123\n\nb\n\nc"), (4, ""), (5, None), (6, "nothing\n\nhere\n\nat all")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert {r["doc_id"] for r in chunking.malformed(df).collect()} == {2, 3, 4}
    found = {r["doc_id"]: r for r in chunking.document_chunks(df, {"n": "123"}).collect()}
    assert set(found) == {1, 2, 3}
    assert found[1]["chunk_text"] == "first\n\nno 123\n\nlast" and found[1]["sections"] == ["A"]
    assert found[2]["chunk_text"] == rows[1][1] and found[2]["keywords"] == ["n"]
    assert (found[3]["start"], found[3]["first"], found[3]["last"]) == (0, 0, 2)


def _score(a: str, b: str) -> float:
    a, b = (re.sub("[^a-z0-9]+", " ", x.lower()).strip() for x in (a, b))
    x, y = (set(re.findall("[a-z0-9]{3,}", t)) for t in (a, b))
    dice = 2 * len(x & y) / (len(x) + len(y)) if x and y else 0.0
    return 0.65 * dice + 0.35 * SequenceMatcher(None, a[:6000], b[:6000]).ratio() if a and b else 0.0


def _sides(seed: int) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(seed)
    base = [" ".join(rng.choice(("apple", "pear", "plum", "fig", "of", "Kiwi", "lime", "date")) for _ in range(rng.randrange(1, 14))) for _ in range(25)]
    edit = lambda t: " ".join(w if rng.random() < 0.8 else rng.choice(("nut", "pea", "x")) for w in t.split())
    side = lambda: [(g, i, rng.choice((base[i % 25], edit(base[i % 25]), base[i % 25] + "!", "", None))) for g in ("p", "q", None) for i in range(40)]
    return side(), side()


@pytest.mark.parametrize("least", [0.4, 0.6, 0.9, 1.0])
def test_combined_similarity(spark: SparkSession, least: float) -> None:
    a, b = _sides(4)
    want = {}
    for g, i, t in a:
        scores = [(-_score(t, u), j) for h, j, u in b if h == g and g is not None and t is not None and u is not None]
        if scores and -min(scores)[0] >= least:
            want[g, i] = (min(scores)[1], round(-min(scores)[0], 9))
    left, right = spark.createDataFrame(a, "g string, a int, text string"), spark.createDataFrame(b, "g string, b int, text string")
    got = {(r["g"], r["a"]): (r["b"], round(r["score"], 9)) for r in lookup.best_similar(left, right, least, ["g"]).collect()}
    assert got == want and len(want) > 10
    if least != 0.6:
        return
    back = {}
    for g, j, u in b:
        scores = [(-_score(u, t), i) for h, i, t in a if h == g and g is not None and t is not None and u is not None]
        if scores and -min(scores)[0] >= least:
            back[g, j] = (min(scores)[1], -min(scores)[0])
    rows = {r["g"]: r for r in lookup.two_way_overlap(left, right, least, ["g"]).collect()}
    for g in ("p", "q"):
        for name, found in (("a_to_b", want), ("b_to_a", back)):
            mine = [v for (h, _), v in found.items() if h == g]
            assert rows[g][f"{name}_overlap"] == pytest.approx(len(mine) / 40)
            assert rows[g][f"{name}_score"] == pytest.approx(sum(s for _, s in mine) / len(mine))
            assert rows[g][f"{name}_fan_in"] == pytest.approx(len(mine) / len({j for j, _ in mine}))


def test_low_thresholds_are_refused(spark: SparkSession) -> None:
    with pytest.raises(ValueError, match="over 0.35"):
        lookup.best_similar(spark.range(1), spark.range(1), 0.35)


def test_sections_and_stitching(spark: SparkSession) -> None:
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(rules.section_of(F.lit("Our DIRECTORS' report"))) == "directors'_report"
    assert one(rules.section_of(F.lit("Chair's letter"))) is None and one(rules.section_of(F.lit(None).cast("string"))) is None
    assert one(rules.section_title(F.lit("2.1 notes to the  financial statements"))) == "Notes To The Financial Statements"
    cases = {("gov", "ernance"): "governance", ("20", "21"): "2021", ("Report", "2021"): "Report 2021", ("Annual", "Report"): "Annual Report", ("manage", "ment"): "management", ("a", " ", "b", "cdefg"): "abcdefg", (): ""}
    for parts, want in cases.items():
        assert one(rules.stitched(F.array(*map(F.lit, parts)).cast("array<string>"))) == want


def test_markdown_of_spans(spark: SparkSession) -> None:
    spans = [Row(k=1, i=2, text=" a \n b ", heading=False, size=None), Row(k=1, i=1, text="Top", heading=True, size=18), Row(k=1, i=3, text=" ", heading=False, size=9), Row(k=1, i=4, text="Sub", heading=True, size=None), Row(k=2, i=1, text=None, heading=False, size=None)]
    got = dict(map(tuple, passages.markdown(spark.createDataFrame(spans, "k int, i int, text string, heading boolean, size int"), "k", "i").collect()))
    assert got == {1: "\n# Top\n\na b\n\n\n## Sub\n", 2: ""}


def test_paragraph_windows(spark: SparkSession) -> None:
    """Windows of one paragraph each way: equal ones are one chunk, others may overlap, and headings between count as text only."""
    text = "# One\na 11\n\nb\n\n# Two\n\nc 22\n\nd 22 xx\n\ne"
    df = spark.createDataFrame([(7, text), (8, "a\n\nb 11"), (9, None)], "doc_id int, text string")
    got = sorted(chunking.keyword_chunks(df, {"n": "[0-9]{2}", "x": "xx"}, 1, 1).collect(), key=lambda r: (r["doc_id"], r["first"], r["last"]))
    want = [(7, 0, 1, "a 11\n\nb", ["n"], ["One"]), (7, 1, 3, "b\n\n# Two\n\nc 22\n\nd 22 xx", ["n"], ["Two"]), (7, 2, 4, "c 22\n\nd 22 xx\n\ne", ["n", "x"], ["Two"]), (8, 0, 1, "a\n\nb 11", ["n"], [])]
    assert [(r["doc_id"], r["first"], r["last"], r["chunk_text"], r["keywords"], r["sections"]) for r in got] == want
    assert all(text[r["start"] : r["end"]] == r["chunk_text"] for r in got if r["doc_id"] == 7)


def test_html_spans(spark: SparkSession) -> None:
    cases = {
        "<h1>Top &amp; more</h1><p>One <b>two</b>\n three<br>four</p>": [("heading", "Top & more"), ("text", "One two three"), ("text", "four")],
        "<head><title>x</title></head><div>a<script>b</script><div style='display: none'>c</div>d</div>": None,
        "<p>open<p>next": [("text", "open"), ("text", "next")],
        "": [],
        None: [],
    }
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id int, html string")
    got: dict[int, list] = {}
    for r in sorted(html_spans.spans(pages).collect(), key=lambda r: (r["page_id"], r["span"])):
        got.setdefault(r["page_id"], []).append((r["kind"], r["text"]))
    for i, want in enumerate(cases.values()):
        if want is not None:
            assert got.get(i, []) == want
    assert "".join(t for _, t in got[1]) == "ad"  # neither hidden parts nor scripts


def test_names_in_readers_order(spark: SparkSession) -> None:
    rows = [("s", n) for n in ("Zed", "apple", "Éclair", "eclair", "Banana")] + [("first", "z"), ("A", "q"), ("b", "p"), ("late", "x")]
    df = spark.createDataFrame(rows, "section string, name string")
    by_name = [r["name"] for r in df.where("section = 's'").orderBy(*select.locale_order("name")).collect()]
    assert by_name == ["apple", "Banana", "eclair", "Éclair", "Zed"]
    both = [r["section"] for r in df.orderBy(*select.locale_order("name", "section", ("late", "first"))).select("section").collect()]
    assert both == ["late", "first", "A", "b", *["s"] * 5]


def test_parts_leave_in_small_batches() -> None:
    """A batch of many texts doesn't become one batch of all their parts."""
    texts = ["a" * 300_000, None, "b" * 900_000, "c", ""] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(15)), pa.array(texts)], ["k", "text"])
    out = list(chunking.cut_rows([batch], "text", lambda t: [t, t] if t else []))
    assert len(out) > 2
    assert [(k, p) for b in out for k, p in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)] == [(k, p) for k, t in enumerate(texts) for p in range(2 if t else 1)]
    assert max(sum(map(len, b.column(1).to_pylist())) for b in out) < chunking.AT_ONCE + 2_000_000


@pytest.mark.parametrize("least", [0.4, 0.6, 0.9])
def test_a_small_side_is_held_by_the_tasks(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, least: float) -> None:
    """Held sources, held targets and sides that meet by shuffles give the same rows; where a side is held, no words are shuffled."""
    a, b = _sides(7)
    left, right = spark.createDataFrame(a, "g string, a int, text string").repartition(3), spark.createDataFrame(b + b[:50], "g string, b int, text string").repartition(5)
    got = []
    for held in (10_000, 80, 0):  # both sides are small, and the first is held; only the left one is; none
        monkeypatch.setattr(lookup, "HELD", held)
        found = [lookup.best_similar(left, right, least, ["g"]), lookup.best_similar(right, left, least, ["g"], "b", "a")]
        got.append([sorted((r[0], r[1], r[2], round(r[3], 12)) for r in df.collect()) for df in found])
        assert [d for _, d in found[0].dtypes] == ["string", "int", "int", "double"]
        for df in found:
            assert ("hashpartitioning(token" in df._jdf.queryExecution().executedPlan().toString()) == (held == 0)
    assert got[0] == got[1] == got[2] and len(got[0][0]) > 10


def _plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_not_shuffled_for_chunks(spark: SparkSession) -> None:
    df = spark.createDataFrame([(1, "a 11\n\nb")], "doc_id int, text string").repartition(2, "text")
    for found in (chunking.document_chunks(df, {"n": "[0-9]{2}"}), chunking.keyword_chunks(df, {"n": "[0-9]{2}"}), chunking.hit_windows(df, {"n": "[0-9]{2}"}, 9), chunking.malformed(df), chunking.blocks(df)):
        plan = _plan(found)
        assert plan.count("Exchange hashpartitioning(text") >= 1 and plan.count("Exchange") == plan.count("Exchange hashpartitioning(text") and "Window" not in plan
    # a keyword is sought once in each paragraph, not again in a filter that was pushed down
    assert _plan(chunking.keyword_chunks(df, {"n": "[0-9]{2}"})).count("[0-9]{2}") == 1
    assert _plan(chunking.malformed(df)).count("ArrowEvalPython") == 1  # and a document's blocks once


def test_windows_of_all_paragraphs_beside_others(spark: SparkSession) -> None:
    """Two of four paragraphs see all of them: these are one window, the outer ones have windows of their own."""
    text = "\n# H\n \na 1\nA\n\n\n## S #\nb 2\n\tc\n\n3\n \n \nd 4 x\n"
    df = spark.createDataFrame([(1, text), (2, "\n"), (3, "# only\n#"), (4, "")], "doc_id int, text string")
    got = sorted(chunking.keyword_chunks(df, {"n": "[0-9]", "x": "x"}).collect(), key=lambda r: (r["first"], r["last"]))
    assert [(r["first"], r["last"], r["keywords"], r["sections"]) for r in got] == [(0, 2, ["n"], ["H"]), (0, 3, ["n"], ["S #"]), (1, 3, ["n", "x"], ["S #"])]
    assert got[1]["chunk_text"] == "a 1\nA\n\n## S #\n\nb 2\n\tc\n\n3\n\nd 4 x" and text[got[1]["start"] : got[1]["end"]].startswith("a 1") and got[1]["end"] == len(text) - 1
    rows = chunking.blocks(df).collect()
    assert [r["block"] for r in rows if r["doc_id"] == 1] == list(range(6)) and [r["section"] for r in rows if r["doc_id"] == 3] == [None, "only"]
    assert all({1: text, 3: "# only\n#"}[r["doc_id"]][r["start"] : r["end"]] == r["text"] for r in rows)


def test_word_bounds_try_the_next_letter_first() -> None:
    texts = ["time", "xtime times", "étime", "a day-year_ days", "The the_ the", "ab b ba", "", "3time time3"]
    for p in (r"(?i)\b(?:time|year|day)s?\b", r"\bthe\b", r"\b(ab|b)", r"\b(?:a?|b)b", r"\ba?b", r"\b(?:b|a)?b\b", r"\b[ab]"):
        bounded = rules.ascii_bounds(p)
        assert all([m.span() for m in re.finditer(bounded, t)] == [m.span() for m in re.finditer(p, t, re.ASCII)] for t in texts), p
        assert bounded.startswith(("(?=[", "(?i)(?=[")) == (p in (r"(?i)\b(?:time|year|day)s?\b", r"\bthe\b", r"\b(ab|b)"))


def test_units_are_measured_once() -> None:
    asked: list[str] = []
    units = ["aa", "bbb", "c", "d", "eeeee", "f", None, "g"]
    parts = list(chunking._pack(iter(units), 5, lambda u: asked.append(u) or len(u), " ", overlap=1))
    assert parts == ["aa bbb", "bbb c d", "eeeee", "f", "g"] and asked == [u for u in units if u]
