from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import SparkSession

from corpusloom.llm import mixing

from .brute import words

DOCS = "doc_id long, text string, source string, size string, target string, key string"


def _targets(sizes: dict) -> dict:
    """Resharing by weight until no source is above twice its size."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, left, open_ = {}, 1.5 * sum(sizes.values()), set(sizes)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(2.0 * sizes[s] for s in over)
        open_ -= over
    return out


def _holds(found: list, rows: list[tuple]) -> None:
    texts = {r[0]: r for r in rows}
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in found:
        _, text, source = texts[r["doc_id"]][:3]
        n = len(words(text))
        assert r["size"] == n and r["taken"] <= 2 * n and (n == 0 or r["taken"] % n == 0)
        sizes[source] += n
        taken[source] += r["taken"]
        target[source] = r["target"]
        largest[source] = max(largest[source], n)
    for r in found:
        assert r["source_size"] == sizes[texts[r["doc_id"]][2]]
    want = _targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= max(largest[s], 1e-6)


def test_whole_table(spark: SparkSession, sf_dir: str) -> None:
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = mixing.op5_mix_sources(spark, sf_dir).collect()
    assert len(found) == len(rows)
    _holds(found, rows)
    again = mixing.op5_mix_sources(spark, sf_dir).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_edge_cases(spark: SparkSession) -> None:
    rows = [(i, None if i % 7 == 0 else "w " * (i % 50), (None, "", "z", "é", "a")[i % 5], "", "", "") for i in range(400)]
    found = mixing.mix(spark.createDataFrame(rows, DOCS).repartition(7)).collect()
    assert len(found) == len(rows)
    _holds(found, rows)
    nothing = mixing.mix(spark.createDataFrame([(1, None, "a", "", "", ""), (2, " ", None, "", "", "")], DOCS)).collect()
    assert [r["taken"] for r in nothing] == [0, 0]
    repeated = mixing.mix(spark.createDataFrame([(1, "a b", "a", "", "", "")] * 4 + [(None, "c", "b", "", "", "")] * 3, DOCS)).collect()
    assert len(repeated) == 7
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_better_documents_are_drawn_first(spark: SparkSession) -> None:
    rows = [(i, "clean words all the way down" if i % 2 else "#### $$$$ %%%% &&&& ++++ ====", "a" if i < 1000 else "b", "", "", "") for i in range(2000)]
    found = mixing.mix(spark.createDataFrame(rows, DOCS), weights=(1.0, 10.0), share=0.5).collect()
    taken = [sum(r["taken"] for r in found if r["doc_id"] < 1000 and r["doc_id"] % 2 == k) for k in (0, 1)]
    assert taken[1] > 1.2 * taken[0]
