from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

from corpusloom.llm import jaccard_join
from corpusloom.llm.textkernel import shingle_sets, utf8

from .brute import components, shingles, words

SCHEMA = "doc_id long, text string, tile string, cls string, n string, part string"


def _rows(seed: int = 5) -> list[tuple]:
    """Copies, chains of near copies on either side of the threshold, short, empty and missing texts."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)
    texts: list[str | None] = [None, "", " \t\n", "one", "one", "One two", "a b c d e", "A b c d E", "x " * 9]
    for n in (5, 8, 30, 60, 200):
        for _ in range(3):
            base = [word() for _ in range(n)]
            for edits in (0, 0, 1, 2, 3, 5, 9):
                new = list(base)
                for _ in range(edits):
                    new[rng.randrange(n)] = word()
                texts.append(" ".join(new))
            texts.append(" ".join(base[: n * 9 // 10]))
    shared = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(100)] + shared) for _ in range(8)]
    rng.shuffle(texts)
    return [(i, t, "t", "c", "n", "p") for i, t in enumerate(texts)]


def test_components_are_those_of_brute_force(spark: SparkSession) -> None:
    rows = _rows()
    want = components([r[:2] for r in rows])
    found = jaccard_join.join_components(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_whole_table(spark: SparkSession, sf_dir: str) -> None:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = components([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    found = jaccard_join.op1_jaccard_join(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert len({c for _, c in want.values()}) < len(want)


def test_group_over_many_batches(spark: SparkSession) -> None:
    """Near copies dealt over many partitions, where no task sees the whole group."""
    rng = random.Random(1)
    base = ["b%d" % i for i in range(80)]
    rows = []
    for i in range(300):
        new = list(base)
        new[rng.randrange(80)] = "v%d" % i
        rows.append((i, " ".join(new)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    assert {r["component_id"] for r in jaccard_join.join_components(docs).collect()} == {0}


def test_null_ids_repeats_and_empty_table(spark: SparkSession) -> None:
    schema = "doc_id long, text string"
    text = "the same text stands here again and again"
    rows = [(None, text), (7, text), (7, text), (9, text + " now"), (None, None), (3, "other words that are not linked")]
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join_components(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, [(None, 4, 7), (7, 4, 7), (7, 4, 7), (9, 5, 7), (None, 0, None), (3, 2, 3)]))
    assert jaccard_join.join_components(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("text", ["", "a", "a b c d", "a b c d e", "É x y z\x0bq A a A a A a A", "w " * 3000])
def test_shingle_counts(text: str) -> None:
    h, at = shingle_sets(*utf8(pa.array(["x y", text, None])))
    assert np.diff(at)[1] == len(shingles(text))
    assert len(words("x y")) == 2


def test_linked_sets_share_a_tile() -> None:
    rng = np.random.default_rng(3)
    for n in (1, 2, 4, 5, 9, 40, 150, 900):
        for _ in range(40):
            same = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            most = n // 8
            a = np.sort(np.concatenate([same, rng.integers(0, 1 << 63, rng.integers(0, most + 1), dtype=np.uint64)]))
            b = np.sort(np.concatenate([same, rng.integers(0, 1 << 63, rng.integers(0, most + 1), dtype=np.uint64)]))
            if 100 * n < 80 * (len(a) + len(b) - n) or np.array_equal(a, b):  # equal sets are one class
                continue
            h, at = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            key, who, side = jaccard_join.tiles(h, at)
            need = jaccard_join.needs(h, at)
            both = set(key[who == 0]) & set(key[who == 1])
            assert both
            for x in (0, 1):
                for s in (0, 1):
                    mine = set(key[(who == x) & (side == s)])
                    assert not (mine & both) or len(mine & both) >= need[s][x]
