from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import SparkSession

from corpusloom.llm import yinyang

from ..oracle import differences

VECTORS = "vec_id long, embedding array<double>, cluster string, lower string"


def _plain(rows: list[tuple], k: int, rounds: int, size: int) -> list[tuple]:
    """All distances in Python's whole numbers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in kept]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]

    def nearest(v: tuple) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if mine:
                centroids[j] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    return sorted((-1 if i is None else i, j, d) for i, v in kept for d, j in [nearest(v)])


def _found(spark: SparkSession, rows: list[tuple], k: int, rounds: int, size: int) -> list[tuple]:
    df = spark.createDataFrame([(*r, "", "") for r in rows], VECTORS).repartition(3)
    found, _ = yinyang.cluster(df, k, rounds, size=size)
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in found.collect())


def test_whole_table(spark: SparkSession, sf_dir: str) -> None:
    assert differences(yinyang.op11_yinyang_clusters(spark, sf_dir), yinyang.SQL, sf_dir) == []


@pytest.mark.parametrize("seed", range(3))
def test_against_all_distances(spark: SparkSession, seed: int) -> None:
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(9)]
    rows = [(i, [m + rng.gauss(0, 0.2) for m in rng.choice(middles)]) for i in range(300)]
    assert _found(spark, rows, 25, 6, 4) == _plain(rows, 25, 6, 4)


def test_ties_repeats_and_equal_centroids(spark: SparkSession) -> None:
    grid = [(x / 256, y / 256) for x in range(6) for y in range(6)]
    rows = [(i, list(grid[i % 36])) for i in range(150)]  # centroids repeat, and many vectors lie halfway between two
    assert _found(spark, rows, 40, 5, 2) == _plain(rows, 40, 5, 2)


def test_odd_rows(spark: SparkSession) -> None:
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("inf"), 0.0]), (None, [0.5, -0.25]), (None, [0.5, -0.25]), (7, [0.0, 0.0]), (7, [-3.3, 2.0])]
    assert _found(spark, rows, 3, 2, 2) == _plain(rows, 3, 2, 2)
    assert _found(spark, [], 3, 2, 2) == []
    assert _found(spark, [(8, [1e300, 0.0]), (9, [1.0, 1.0])], 3, 2, 2) == [(9, 0, 0)]


def test_large_numbers_stay_exact(spark: SparkSession) -> None:
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) * 2.0**e for _ in range(3)]) for i, e in enumerate([1, 15, 22, 30, 21] * 12)]
    want = [(i, j, d if d < 1 << 63 else None) for i, j, d in _plain(rows, 10, 4, 3)]
    assert _found(spark, rows, 10, 4, 3) == want


def test_bounds_spare_distances() -> None:
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(20, 8)) * 4000)[rng.integers(0, 20, 2000)].astype(np.int64) + rng.integers(-200, 200, (2000, 8))
    now = yinyang.Round(x[:40].copy(), [])
    now.groups = yinyang.groups_of(now.centroids)
    assert sorted(j for g in now.groups for j in g) == list(range(40)) and len(now.groups) > 1
    state = yinyang.first_assignment(x, now)
    for r in range(6):
        new = np.array([x[state.cluster == j].sum(0) // max(1, (state.cluster == j).sum()) if (state.cluster == j).any() else now.centroids[j] for j in range(40)])
        step = np.sqrt(((new - now.centroids) ** 2).sum(1).astype(float)) * (1 + yinyang.MARGIN)
        now = yinyang.Round(new, now.groups, step)
        state = yinyang.next_assignment(x, state, now)
        exact = ((x[:, None] - new[None]) ** 2).sum(2)
        assert (state.cluster == exact.argmin(1)).all()
        roots = np.sqrt(exact.astype(float))
        assert (state.upper >= roots[np.arange(len(x)), state.cluster]).all()
        roots[np.arange(len(x)), state.cluster] = np.inf
        for g, members in enumerate(now.groups):
            assert (state.lower[:, g] <= roots[:, members].min(1)).all()
    assert r and state.scanned < 0.5 * exact.size
