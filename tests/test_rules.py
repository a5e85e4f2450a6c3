"""Rules and operators against plain versions on small fixtures."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import payload, titles
from corpusloom.operators import html_tables, lookup, mentions, passages
from corpusloom.plans import SQL, all_queries
from corpusloom.sources import readers

from .oracle import TABLES, differences


@pytest.mark.parametrize(("heads", "rows"), [(("Company", "EPIC"), 100), (("Issuer name", "Ticker"), 250)])
def test_tables_of_constituents(spark: SparkSession, heads: tuple[str, str], rows: int) -> None:
    body = "".join(f"<tr><td>Company &amp; Sons {i}</td><td>\n T{i}<br>X </td></tr>" for i in range(rows))
    html = f"<p>x<table><tr><th>a</th></tr></table><table><thead><tr><th>{heads[0]}</th><th>{heads[1]}</th></tr></thead><tbody>{body}</tbody></table>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<table></table>"), (4, "<td>stray</td></table>")], "page int, html string")
    found = sorted(html_tables.records(html_tables.tables(pages, "page", "html"), "page", F.lit(rows)).collect(), key=lambda r: r["row"])
    assert [(r["page"], r["name"], r["ticker"]) for r in found] == [(1, f"Company & Sons {i}", f"T{i} X") for i in range(rows)]


def test_prefixes_anywhere_in_other_texts(spark: SparkSession) -> None:
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9)))
    texts = [" ".join(word() for _ in range(rng.randrange(10, 60))) for _ in range(60)]
    for _ in range(40):
        a, b = rng.choice(texts), rng.choice(texts)
        texts.append(b[: rng.randrange(50)] + a[:100] + b[50:])
    texts += [texts[0]] * 3 + ["x" * 99, "x" * 100, "x" * 300, "", None]
    rows = list(enumerate(texts))
    want = {}
    for i, a in rows:
        for j, b in rows:
            if i != j and a is not None and b is not None and ((len(a) >= 100 and a[:100] in b) or (len(b) >= 100 and b[:100] in a)):
                want[i] = min(want.get(i, j), j)
    got = {r["k"]: r["first_id"] for r in lookup.prefix_contained(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()}
    assert got == want and len(want) > 40


def test_hits_have_their_places(spark: SparkSession) -> None:
    rows = [(1, "the end of the day, and the rest"), (1, "the"), (2, ""), (3, None), (4, "a 123 b 4567\n890")]
    patterns = {"mean": r"\bthe\b", "number": "[0-9]{3}"}
    found = passages.hits(spark.createDataFrame(rows, "k int, t string"), "k", "t", patterns).collect()
    want = [(k, n, m.group(), m.start(), m.end()) for k, t in rows for n, p in patterns.items() for m in re.finditer(p, t or "")]
    assert sorted(map(tuple, found)) == sorted(want)


def test_small_rules(spark: SparkSession) -> None:
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(passages.merged_spelling(F.lit("A n n u a l report of a company"))) == "Annual report of a company"
    assert one(titles.range_end(F.lit("Annual Report 2021/22"))) == 2022
    assert one(titles.range_end(F.lit("Annual Report"))) is None
    assert one(titles.annual(F.lit("Annual results"))) and not one(titles.annual(F.lit("Half-year report after annual results")))
    assert one(titles.first_year(F.lit("x\nReport for the year 2019"), [r"year (\d{4})"])) == 2019
    assert one(titles.first_year(F.lit("\n" * 100 + "year 2019"), [r"year (\d{4})"])) is None


def test_strict_json_lines_fail_at_a_bad_line(spark: SparkSession, tmp_path) -> None:  # noqa: ANN001
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n{broken\n')
    with pytest.raises(Exception, match="(?i)malformed|parse|json"):
        readers.json_lines(spark, str(tmp_path), "a int").collect()
    assert readers.json_lines(spark, str(tmp_path), "a int", "lenient").where("a is not null").count() == 1


def test_each_year_takes_its_best_item_once(spark: SparkSession) -> None:
    """Against repeated passes that look, one year at a time, for the year with the fewest candidates of those still open."""
    rng = random.Random(8)
    rows = [(k, 2000 + rng.randrange(5), rng.randrange(6), float(rng.randrange(4))) for k in range(40) for _ in range(rng.randrange(1, 12))]
    want = set()
    for k in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == k]
        open_, used = {r[1] for r in mine}, set()
        while open_:
            items = {y: {r[2] for r in mine if r[1] == y} for y in open_}
            y = min(open_, key=lambda y: (len(items[y]), y))
            left = [r for r in mine if r[1] == y and r[2] not in used] or [r for r in mine if r[1] == y]
            top = max(r[3] for r in left)
            best = min(r[2] for r in left if r[3] == top)
            used.add(best)
            open_.remove(y)
            want.add((k, y, best))
    df = spark.createDataFrame(rows, "k int, year int, item int, score double").repartition(5)
    assert {tuple(r) for r in mentions.best_by_year(df, "k", "year", "item", [F.desc("score"), F.col("item")], range(2000, 2005)).collect()} == want


def test_greedy_matches_use_each_side_once(spark: SparkSession) -> None:
    """Against picking, again and again, the first pair in order whose sides are both free."""
    rng = random.Random(9)
    rows = list({(k, rng.randrange(5), rng.randrange(5)): rng.randrange(9) for k in range(40) for _ in range(rng.randrange(1, 10))}.items())
    rows = [(k, a, b, 10 - a, gap) for (k, a, b), gap in rows]
    want = set()
    for k in {r[0] for r in rows}:
        free = [r for r in rows if r[0] == k]
        while free:
            r = min(free, key=lambda r: (r[3], r[1], r[4], r[2]))
            want.add((k, r[1], r[2]))
            free = [x for x in free if x[1] != r[1] and x[2] != r[2]]
    df = spark.createDataFrame(rows, "k int, a int, b int, turn int, gap int").repartition(5)
    assert {tuple(r) for r in lookup.greedy_assign(df, "k", ["turn"], ["gap"], "a", "b").collect()} == want


def test_risk_answers_name_every_broken_rule(spark: SparkSession) -> None:
    good = '"risk_types": ["cyber"], "risk_signals": [{"type": "cyber", "signal": 2}], "substantiveness": "low", "confidence": 0.5'
    cases = {
        "{" + good + "}": [],
        "{}": ["missing field: risk_signals", "missing field: risk_types", "missing field: substantiveness"],
        '{"risk_types": "cyber", "risk_signals": 3, "substantiveness": 4}': ["risk_signals must be a list", "risk_types must be a list", "unknown level"],
        "{" + good.replace('"signal": 2', '"signal": 1.5').replace("0.5", "true") + "}": ["confidence must be numeric", "signal must be an integer"],
        "{" + good.replace('"signal": 2', '"signal": "2"').replace("0.5", "-1") + "}": ["confidence must be between 0 and 1", "signal must be numeric"],
        "{" + good.replace('["cyber"]', '["cyber", "none"]').replace('"signal": 2', '"signal": 0') + "}": ["labels without signal: none", "none with other labels", "selected labels need a signal of 1 to 3"],
        "{" + good.replace('["cyber"]', '["war"]') + "}": ["labels without signal: war", "signals without label: cyber", "unknown label in risk_types: war"],
        "{" + good.replace('"signal": 2}', '"signal": 2}, {"type": "cyber", "signal": 9}') + "}": ["repeated label: cyber", "signal must be between 0 and 3"],
        "{" + good.replace('"type": "cyber"', '"kind": "cyber"') + "}": ["labels without signal: cyber", "unknown label in risk_signals: null"],
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "id int, raw string").select("id", F.try_parse_json("raw").alias("v"))
    got = dict(map(tuple, payload.risk_messages(rows, "v", ("cyber", "market", "none"), ("low", "high")).select("id", F.array_sort("messages")).collect()))
    assert got == dict(enumerate(cases.values()))


def test_words_end_at_letters_with_accents(spark: SparkSession, sf_dir: str, tmp_path: Path) -> None:
    """A letter with an accent bounds a word, as it does in the queries' SQL."""
    for t in TABLES:
        (tmp_path / f"{t}.parquet").symlink_to(f"{sf_dir}/{t}.parquet")
    (tmp_path / "conversations.parquet").unlink()
    turns = [(1, 0, "user", "éla"), (1, 1, "user", "ela"), (1, 2, "user", "a"), (1, 3, "user", "dieñ x"), (2, 0, "user", "ofé. x"), (2, 1, "user", "_the")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    for name in ("keyword_strategy", "mention_units"):
        assert differences(all_queries()[name](spark, str(tmp_path)), SQL[name], str(tmp_path)) == []


def test_scores_of_tables_are_not_spelt_out_in_a_filter(spark: SparkSession) -> None:
    """What a score is made of isn't worked out again in a filter under the projections."""
    pages = spark.createDataFrame([(1, "<table><tr><td>a<td>b</table>")], "page int, html string")
    plan = html_tables.records(html_tables.tables(pages, "page", "html"), "page", F.lit(100))._jdf.queryExecution().optimizedPlan().toString()
    assert all(line.count("transform(") < 3 for line in plan.splitlines() if "Filter " in line)


def test_greedy_matches_pass_by_in_batches(spark: SparkSession) -> None:
    """No call for each key: many keys and a key over several batches are walked by one map over sorted rows."""
    rows = [(k, a, b, a, abs(a - b)) for k in range(30) for a in range(3) for b in range(3)] + [(99, a, b, a, b) for a in range(60) for b in range(60)] + [(None, 1, 2, 1, 0)]
    df = spark.createDataFrame(rows, "k int, a int, b int, turn int, gap int").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        found = lookup.greedy_assign(df, "k", ["turn"], ["gap"], "a", "b")
        assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()
        got = [tuple(r) for r in found.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 151 and set(got) == {(k, a, a) for k in range(30) for a in range(3)} | {(99, a, a) for a in range(60)} | {(None, 1, 2)}


def test_a_frequent_passage_costs_each_text_a_few_rows(spark: SparkSession) -> None:
    """Many different prefixes that share a passage don't meet as pairs: rows of joins grow with the texts, not with their square."""
    passage = "this passage is the license line of every text and long enough to give anchors whatever it is that each has next "
    rng = random.Random(3)
    rows = [(i, f"{i:04d} " + passage + "".join(rng.choice("abcdefgh ") for _ in range(200))) for i in range(300)]
    rows += [(1000 + i, "x " + t[:150]) for i, t in rows[:5]]
    df = spark.createDataFrame(rows, "k long, t string")
    found = lookup.prefix_contained(df, "k", "t")
    assert {r["k"]: r["first_id"] for r in found.collect()} == {i: 1000 + i for i in range(5)} | {1000 + i: i for i in range(5)}
    text = df.select("k", "t", F.array(F.lit(2), F.lit(2), F.lit(400), F.lit(-1)).alias("at"))
    assert lookup._windows_at(text, "k", "t", "at").count() == len(rows)
    heads = lookup.anchors(df.select("k", F.left("t", F.lit(100)).alias("t")), "k", "t")
    assert heads.count() >= len(rows) > heads.select("gram", "place").distinct().count()


def test_risk_answers_are_read_in_steps(spark: SparkSession) -> None:
    """Kinds are asked of scores only, and lists with entries of all kinds are still lists."""
    raw = '{"risk_types": [1, {"a": 2}, null, "cyber"], "risk_signals": [{"type": "cyber", "signal": 1}, 3, null, [1], {"type": null, "signal": {}}], "substantiveness": "low"}'
    rows = spark.createDataFrame([(raw,)], "raw string").select(F.try_parse_json("raw").alias("v"))
    found = payload.risk_messages(rows, "v", ("cyber",), ("low",))
    messages = found.first()["messages"]
    assert not any("must be a list" in m for m in messages)
    assert messages.count("signal must be numeric") == 4 and messages.count("unknown label in risk_signals: null") == 4 and "unknown label in risk_types: 1" in messages
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "")
    assert 1 <= plan.count("schemaofvariant(") <= 4
