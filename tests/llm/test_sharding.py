from __future__ import annotations

import random
import zlib
from collections import defaultdict

from pyspark.sql import SparkSession

from corpusloom.llm import sharding

DOCS = "doc_id long, text string, shard string, size string, group string"


def _holds(rows: list, texts: dict, shards: int) -> None:
    places, sums, groups = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 16 and r["text_crc32"] == zlib.crc32(data)
        assert 0 <= r["shard"] < shards
        places[r["shard"]].append(r["slot"])
        sums[r["shard"]] += r["size"]
        groups[data].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    assert all(len(x) == 1 for x in groups.values())
    return sums


def test_whole_table(spark: SparkSession, sf_dir: str) -> None:
    rows = sharding.op10_shard_minimax(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts) and {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    _holds(rows, texts, 40)


def test_sizes_are_near_equal(spark: SparkSession) -> None:
    rng = random.Random(4)
    texts = {i: "é" * rng.randrange(400) for i in range(3000)}
    texts |= {i: None if i % 2 else "" for i in range(3000, 3050)} | {i: "a copy of one text " * 9 for i in range(4000, 4040)}
    docs = spark.createDataFrame([(i, t, "s", "z", "g") for i, t in texts.items()], DOCS).repartition(6)
    sums = _holds(sharding.shard(docs, 10).collect(), texts, 10)
    even = sum(sums.values()) / 10
    assert len(sums) == 10 and max(sums.values()) <= 1.05 * even and min(sums.values()) >= 0.95 * even


def test_few_groups_null_ids_and_empty_table(spark: SparkSession) -> None:
    rows = [(None, "a", "", "", ""), (None, "a", "", "", ""), (4, "b", "", "", ""), (4, "b", "", "", ""), (5, None, "", "", "")]
    found = sharding.shard(spark.createDataFrame(rows, DOCS), 40).collect()
    assert len(found) == 5
    assert sharding.shard(spark.createDataFrame([], DOCS), 40).count() == 0


def test_cuts_are_minimax() -> None:
    """The largest shard is as small as any contiguous cut of the ordered groups allows."""
    rng = random.Random(6)
    for _ in range(200):
        runs = sorted({rng.randrange(1, 40): rng.randrange(1, 5) for _ in range(rng.randrange(1, 8))}.items(), reverse=True)
        items = [s for s, c in runs for _ in range(c)]
        shards = rng.randrange(1, 6)
        best = {0: 0}  # items placed -> smallest largest shard
        for _ in range(shards):
            new = {}
            for at, cost in best.items():
                total = 0
                for to in range(at, len(items) + 1):
                    new[to] = min(new.get(to, 1 << 60), max(cost, total))
                    total += items[to] if to < len(items) else 0
            best = new
        cuts = sharding.minimax_cuts(runs, shards)
        starts = [sum(c for _, c in runs[:r]) + o for r, o in cuts]
        edges = [0, *starts, len(items)]
        assert edges == sorted(edges)
        assert max(sum(items[a:b]) for a, b in zip(edges, edges[1:], strict=False)) == best[len(items)]
