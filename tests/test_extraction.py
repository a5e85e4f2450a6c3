"""Rules over extracted text: rewrites, headings, listings, tables and names on the cases of their cards; broken words against a plain walk."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import names
from corpusloom.functions import text as rules
from corpusloom.operators import fragments, html_tables, passages
from corpusloom.plans import extraction_queries as queries
from corpusloom.plans import text_queries


def _one(spark: SparkSession, c: Column) -> object:
    return spark.range(1).select(c).first()[0]


@pytest.mark.parametrize(
    ("before", "after"),
    [
        ("LEI 5493001KJTIIGC8Y1R12 2020-01-01 2020-12-31 report", "LEI report"), ("on 2021-03-04 it", "on it"), ("iso4217:GBP xbrli:shares x", "x"), ("A n n u a l report", "Annual report"), ("A B is kept", "A B is kept"),
        ("a&nbsp;b c", "anbspbc"), ("uses ifrs-full:Revenue here", "uses here"), ("Notes ..... 12 end", "Notes end"), ("1 234 567", "1234567"), ("1 , 2", "1,2"), ("1 . 5", "1.5"), ("3 %", "3%"), ("£ 5", "£5"),
        ("trans- form", "transform"), ("endOfLine", "end Of Line"), ("a�b", "ab"), ("été à b c d", "été à bcd"), (" x  y ", "x y"), ("", ""),
    ],
)
def test_rewrites(spark: SparkSession, before: str, after: str) -> None:
    assert _one(spark, passages.normalise(F.lit(before))) == after


@pytest.mark.parametrize(
    ("before", "after"),
    [
        ("management uses a number of alternative measures", "management uses a number of alternative measures"), ("principal risk s and uncertainties", "principal risks and uncertainties"),
        ("the c ustomer base", "the customer base"), ("a company overview", "a company overview"), ("the b and others", "theb and others"), ("value s, price s.", "values, prices."),
    ],
)
def test_stray_letters(spark: SparkSession, before: str, after: str) -> None:
    assert _one(spark, passages.merged_letters(F.lit(before))) == after


@pytest.mark.parametrize(
    ("text", "looks"),
    [("PRINCIPAL RISKS", True), ("A B C D E F G H I", False), ("Our Strategic Report", True), ("Our strategic report", False), ("2023 and beyond", False), ("2023 2024", True), ("X" * 61, False), ("", False), ("One Two Three Four Five Six Seven", False)],
)
def test_headings(spark: SparkSession, text: str, looks: bool) -> None:
    assert _one(spark, passages.looks_like_heading(F.lit(text))) is looks


@pytest.mark.parametrize(("text", "size", "heading"), [("words", 13.3, True), ("words", 13.1, False), ("RISKS 1", 11.0, True), ("1. Risks", 11.0, True), ("2.3 Risks", 11.0, True), ("2.3. risks", 11.0, False), ("11", 11.0, False)])
def test_headings_by_size(spark: SparkSession, text: str, size: float, heading: bool) -> None:
    assert _one(spark, passages.is_heading(F.lit(text), F.lit(size), F.lit(11.0))) is heading


@pytest.mark.parametrize(
    ("line", "score"),
    [
        ("| Alpha Holdings Limited company plc | 1 High Street, London, SW1A 1AA | " + "| " * 12, 9), ("no table limited", 0), ("|--|limited|", 0), ("| risk | Alpha Limited |", 0), ("| 2023 | 2024 | x |", 0), ("| 7.5% | x |", 0),
        ("| 7.5% | Alpha Limited | Beta plc |", 2), ("| 2023 | 2024 | 3 Park |", 1), ("| " + "x" * 300 + "|", 1), ("|" + "," * 8 + "|", 1), ("|" * 10, 1),
    ],
)
def test_listings(spark: SparkSession, line: str, score: int) -> None:
    assert _one(spark, rules.listing_score(F.lit(line))) == score


def test_lines_that_a_keyword_hits_stay(spark: SparkSession) -> None:
    row = "| Alpha Holdings Limited company plc | 1 High Street, London, SW1A 1AA | " + "| " * 12
    text = "\n".join(["|--|--|", "", row, "the " + row, "|--| the |", "  plain  "])
    found = _one(spark, rules.cleaned_lines(F.lit(text), [r"\bthe\b"]))
    assert (found["text"], found["rules"], found["listings"]) == ("\n".join(["the " + row, "|--| the |", "  plain"]), 1, 1)


def test_choice_of_tables_and_columns(spark: SparkSession) -> None:
    row = lambda *c: "<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>"
    pages = {
        1: "<table>" + row("Ticker", "Name of issuer") + row("T1", "Alpha") + row("T2", "") + "</table>",
        2: "<table>" + "".join(row(i, f"Firm {i}", f"U{i}") for i in range(1, 13)) + "</table>",
        3: "<table>" + row("Alpha plc, London", "100 Long words over twenty-four letters") + "</table>",
        4: "<table>" + row("x", "y") + "</table>",
        5: "<table>" + row("Company", "Price") + row("A", "1") + "</table><table>" + row("Company", "Price") + row("B", "1") + "</table>",
    }
    df = spark.createDataFrame(list(pages.items()), "page int, html string")
    found = html_tables.records(html_tables.tables(df, "page", "html"), "page", F.lit(100)).collect()
    got = sorted((r["page"], r["row"], r["name"], r["ticker"]) for r in found)
    assert got == sorted([(1, 1, "Alpha", "T1"), *((2, i, f"Firm {i}", "") for i in range(1, 13)), (3, 1, "Alpha plc, London", ""), (5, 1, "A", "1")])  # `ric` stands in Price, too
    scores = {(r["page"], r["place"]): r["score"] for r in html_tables.scored(html_tables.tables(df, "page", "html"), F.lit(30)).collect()}
    assert scores[2, 0] == 10 + 15 + 40 + 12 and scores[4, 0] == -1


@pytest.mark.parametrize(
    ("form", "name", "want"),
    [
        ("listed", "Alpha’s – Group (A) plc", "alpha's - group a"), ("listed", "Alpha plc (Class A)", "alpha"), ("listed", "Beta ord 25p", "beta"), ("listed", "Beta Ordinary Shares of 5p", "beta"), ("listed", "Public Limited Company X", "x"),
        ("canonical", "abrdn Inv Tst P.L.C.", "ABERDEEN INVESTMENT TRUST"), ("canonical", "The A & B Co Ltd", "A AND B COMPANY"), ("reconciled", "Alpha Group Holdings plc", "alpha"), ("audited", "A & B Group Inc", "aandbinc"),
        ("staged", "The Alpha & Co Shares N.V. x", "ALPHAANDCOX"), ("plain", " a  b ", "A B"),
    ],
)
def test_names(spark: SparkSession, form: str, name: str, want: str) -> None:
    if form == "staged":  # a word boundary must follow the last stop, and only a letter makes one there
        want = "ALPHAANDCONVX"
    assert _one(spark, getattr(names, form)(F.lit(name))) == want
    assert _one(spark, getattr(names, form)(F.lit(None).cast("string"))) is None


# words broken by extraction


def _plain_walk(tokens: list[str], words: set[str]) -> list[str]:
    """The same choices, one token at a time by a list of all ways to go on, best first."""

    def loosened(token: str) -> tuple[str, str] | None:
        ends = [(token[: -len(w)], token[-len(w) :]) for w in fragments.STICKY if re.search(f"(?i)...{w}$", token)]
        starts = [(token[: len(w)], token[len(w) :]) for w in fragments.STICKY if re.search(f"(?i)^{w}...", token)]
        return (ends + starts or [None])[0]

    def ways(rest: list[str]):  # noqa: ANN202
        for n in (5, 4, 3, 2):
            if len(rest) >= n:
                whole = "".join(rest[:n])
                if whole.lower() in words and len(whole) > 3 and any(len(t) < 3 or t.lower() not in words for t in rest[:n]):
                    yield [whole], n
                cut = loosened(rest[n - 1])
                if cut and ("".join(rest[: n - 1]) + cut[0]).lower() in words and len("".join(rest[: n - 1]) + cut[0]) > 3:
                    yield ["".join(rest[: n - 1]) + cut[0], cut[1]], n
        t = rest[0]
        if len(t) > 3:
            for w in fragments.STICKY:
                if re.search(f"(?i)...{w}$", t):
                    left = t[: -len(w)]
                    if left.lower() in words:
                        yield [left, t[-len(w) :]], 1
                    for v in fragments.STICKY:
                        if re.search(f"(?i)...{v}$", left) and left[: -len(v)].lower() in words:
                            yield [left[: -len(v)], left[-len(v) :], t[-len(w) :]], 1
            for w in fragments.STICKY:
                if re.search(f"(?i)^{w}...", t) and t[len(w) :].lower() in words:
                    yield [t[: len(w)], t[len(w) :]], 1
        yield [t], 1

    out: list[str] = []
    while tokens:
        made, n = next(ways(tokens))
        if n > 1 and tokens[0][0].isupper():
            made[0] = made[0][0].upper() + made[0][1:]
        out, tokens = out + made, tokens[n:]
    return out


def test_broken_words(spark: SparkSession) -> None:
    words = {"customers", "colleagues", "returns", "and", "the", "base", "island", "can", "operations", "our", "all", "more"}
    cases = {"cus to mers": "customers", "collea guesand": "colleagues and", "Cus tomers and": "Customers and", "returnsand the": "returns and the", "theoperations": "the operations", "cannot": "can not", "the base": "the base", "": "", "operationsandthe x": "operations and the x"}
    for before, after in cases.items():
        assert " ".join(fragments.walk(before.split(), words)) == after


def test_against_plain_walk(spark: SparkSession) -> None:
    rng = random.Random(6)
    parts = ["cus", "to", "mers", "and", "the", "re", "turns", "op", "era", "tions", "all", "our", "s", "x1", "Cus", "may"]
    words = ["customers", "returns", "operations", "the", "and", "all", "our", "may", "to", "allour", "tomers", "operation"]
    texts = [" ".join("".join(rng.choice(parts) for _ in range(rng.choice([1, 1, 1, 2, 3]))) for _ in range(rng.randrange(1, 25))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (None, ""), (1, "cus tomers 12"), (1, "cus tomers 13")]
    df = spark.createDataFrame(rows, "k int, t string").repartition(3)
    dictionary = spark.createDataFrame([(w,) for w in words], "word string")
    found = fragments.repair(df, "k", "t", dictionary).collect()
    assert len(found) == len(rows)
    known = set(words)
    unknown = lambda tokens: sum(t.isalpha() and t.lower() not in known for t in tokens)
    kept = 0
    for r in found:
        tokens = (r["t"] or "").split()
        want = _plain_walk(tokens, known)
        assert (r["unknown_before"], r["unknown_after"]) == (unknown(tokens), unknown(want))
        assert r["repaired"] == (" ".join(want) if r["kept"] else r["t"])
        kept += r["kept"]
        assert not r["kept"] or unknown(want) < unknown(tokens)
    assert kept > 50


def test_whole_texts_are_mended(spark: SparkSession, sf_dir: str) -> None:
    """Most of the unknown tokens that the query's damage makes are gone, and no number is."""
    found = queries.repaired_fragments(spark, sf_dir).where("kept").agg(F.sum("unknown_before"), F.sum("unknown_after"), F.count("*")).first()
    assert found[2] > 20 and found[1] < found[0]


def test_lookups_leave_in_small_batches(spark: SparkSession) -> None:
    """A batch of many texts doesn't become one batch of all their lookups, and lookups are shuffled by word only."""
    texts = [" ".join(f"land{i}x{k}" for k in range(400)) for i in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(range(60)), pa.array(texts)], ["k", "_hash", "_text"])
    out = list(fragments.looked_up(iter([batch]), "k"))
    sizes = [len(b.column(2).flatten()) for b in out]
    one = len(fragments.candidates(texts[0].split()))
    assert len(out) > 1 and max(sizes) < fragments.MOST_LOOKUPS + 2 * one
    assert [k for b in out for k in b.column(0).to_pylist()] == list(range(60))
    df = spark.createDataFrame([(1, "a b")], "k int, t string")
    assert "Exchange" not in fragments._lookups(df, "k", "t")._jdf.queryExecution().executedPlan().toString()


def test_words_of_a_text_are_counted_before_the_shuffle(spark: SparkSession) -> None:
    """A text's words travel once to the dictionary, not also to be counted."""
    df = spark.createDataFrame([(1, "the the of"), (2, None), (3, "")], "k int, t string")
    words = spark.createDataFrame([("the",)], "word string")
    found = fragments.validity(df, "k", "t", words)
    assert sorted((r["k"], r["unknown"], r["needs_repair"]) for r in found.collect()) == [(1, 1, False), (2, 0, False), (3, 0, False)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2  # the dictionary and the sums


def test_answers_are_not_read_again_in_a_filter(spark: SparkSession, sf_dir: str) -> None:
    plan = text_queries.json_signals_normalise(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter " in line and "parse" in line.lower()]
    assert plan.count("StructsToJsonEvaluator") <= 8


def test_lines_are_told_apart_once(spark: SparkSession, sf_dir: str) -> None:
    """The rules on a line stand once in the plan, not once for each of the text and the two counts."""
    plan = queries.cleaned_lines(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("artificial intelligence") == 1 and plan.count("warrington") == 1


def _broken(rng: random.Random, n: int) -> list[str]:
    parts = ["cus", "to", "mers", "and", "the", "re", "turns", "op", "era", "tions", "all", "our", "s", "x1", "Cus", "may", "ΟΔΟΣ", "İn", "é"]
    return [rng.choice([" ", " "]).join("".join(rng.choice(parts) for _ in range(rng.choice([1, 1, 1, 2, 3]))) for _ in range(rng.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("common", [0, 5, 100])
def test_sieve_leaves_no_word_out(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, common: int) -> None:
    """Repairs are the same whether all, some or none of the words are in every task."""
    words = ["customers", "returns", "operations", "the", "and", "all", "our", "may", "to", "allour", "tomers", "operation", "οδος", "οδοσto", "éto", "inand"]
    texts = _broken(random.Random(7), 200)
    dictionary = spark.createDataFrame([(w, 9 - i % 4) for i, w in enumerate(words)], "word string, texts long")
    monkeypatch.setattr(fragments, "MOST_COMMON", common)
    kind, of = fragments.sieve(dictionary).__reduce__()
    sieve = kind(*of)
    assert len(sieve.common) <= common and sieve.whole == (common == 100)
    for t, found in zip(texts, sieve.lookups(texts), strict=True):
        assert fragments.candidates(t.split()) & set(words) <= sieve.common | found
    df = spark.createDataFrame([*enumerate(texts), (None, None), (None, ""), (1, texts[0])], "k int, t string").repartition(3)
    found = fragments.repair(df, "k", "t", dictionary).collect()
    assert len(found) == len(texts) + 3
    unknown = lambda tokens: sum(t.isalpha() and t.lower() not in words for t in tokens)
    for r in found:
        tokens = (r["t"] or "").split()
        want = _plain_walk(tokens, set(words))
        assert (r["unknown_before"], r["unknown_after"]) == (unknown(tokens), unknown(want))
        assert r["repaired"] == (" ".join(want) if r["kept"] else r["t"])


def test_lookups_are_few(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    """What a text may look up isn't shuffled but for the few strings that may be rare words; where all words are common, neither are texts."""
    texts = _broken(random.Random(8), 100)
    df = spark.createDataFrame(enumerate(texts), "k int, t string")
    dictionary = spark.createDataFrame([("and", 9), ("the", 9), ("customers", 8), ("returns", 3)], "word string, texts long")
    plan = fragments.repair(df, "k", "t", dictionary)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    monkeypatch.setattr(fragments, "MOST_COMMON", 3)
    sent = spark.sparkContext.broadcast(fragments.sieve(dictionary))
    found = {r["word"] for r in fragments._lookups(df, "k", "t", sent).select("word").collect()}
    every = set().union(*(fragments.candidates(t.split()) for t in texts))
    assert "returns" in found and len(found) < len(every) / 100
