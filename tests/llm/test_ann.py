from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import SparkSession

from corpusloom.llm import ann

ROWS = "vec_id long, embedding array<float>, label int, t string, slot string, q string"


def _exact(rows: list[tuple], every: int = 50, k: int = 5) -> dict:
    use = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, x = [i for i, _ in use], np.array([v for _, v in use])
    if not use:
        return {}
    norm = np.sqrt((x * x).sum(1))
    out = {}
    for j, i in enumerate(ids):
        if i % every == 0:
            score = x @ x[j] / (norm * norm[j])
            order = sorted((-s, o) for s, o in zip(score, ids, strict=True) if o != i)
            out[i] = [(o, -s) for s, o in order[:k]]
    return out


def _found(df) -> dict:  # noqa: ANN001
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def _recall(found: dict, want: dict) -> float:
    hits = total = 0
    for q, best in want.items():
        got = dict(found.get(q, []))
        hits += sum(o in got for o, _ in best)
        total += len(best)
    return hits / total


def test_whole_table(spark: SparkSession, sf_dir: str) -> None:
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, found = _exact(rows), _found(ann.op4_ann_multiprobe(spark, sf_dir))
    assert set(found) == set(want) and all(len(found[q]) == len(want[q]) for q in want)
    assert _recall(found, want) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, best in found.items():
        for o, s in best:
            a, b = vectors[q], vectors[o]
            assert s == pytest.approx(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), abs=1e-12)
        assert best == sorted(best, key=lambda x: (-x[1], x[0]))


def test_clusters_copies_and_bad_rows(spark: SparkSession) -> None:
    rng = np.random.default_rng(1)
    centre = rng.standard_normal((30, 16))
    rows = [(i, (centre[i % 30] + 0.2 * rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(i, rows[0][1]) for i in range(3000, 3040)] + [(3051, [2 * x for x in rows[0][1]])]
    bad = [(4000, None), (4050, []), (4100, [0.0] * 16), (4150, [float("nan")] + [1.0] * 15), (4200, [None] + [1.0] * 15), (4250, [float("inf")] * 16), (None, rows[3][1]), (4300, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "t", "s", "q") for i, v in rows + bad], ROWS).repartition(5)
    want, found = _exact(rows), _found(ann.nearest(df))
    assert set(found) == set(want)
    assert _recall(found, want) >= 0.9
    assert [o for o, _ in found[3000]][:3] == [o for o, _ in want[3000]][:3]


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_rows(spark: SparkSession, n: int) -> None:
    rows = [(i * 50, [1.0, float(i)]) for i in range(n)]
    found = _found(ann.nearest(spark.createDataFrame([(i, v, 1, "", "", "") for i, v in rows], ROWS)))
    want = {q: b for q, b in _exact(rows).items() if b}
    assert {q: [o for o, _ in b] for q, b in found.items()} == {q: [o for o, _ in b] for q, b in want.items()}


def test_both_sides_of_a_slot_are_cut_into_blocks(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    """More queries and rows in one slot than a block holds: the answers are those of one block."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(600)]
    df = spark.createDataFrame([(i, v, 1, "t", "s", "q") for i, v in rows], ROWS)
    setting = (3, 2.0, 27)
    one = _found(ann.nearest(df, every=2, setting=setting))
    monkeypatch.setattr(ann, "QUERIES_AT_ONCE", 32)
    monkeypatch.setattr(ann, "SLOT", 40)
    many = _found(ann.nearest(df, every=2, setting=setting))
    assert len(one) == 300 and set(many) == set(one) and _recall(many, _exact(rows, 2)) >= 0.9
    same = sum([o for o, _ in many[q]] == [o for o, _ in one[q]] for q in one)
    assert same == len(one)


def test_fitted_setting_visits_few_rows_of_clustered_vectors(spark: SparkSession) -> None:
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((300, 32))
    rows = [(i, (centre[i % 300] + 0.1 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(6000)]
    classes = spark.createDataFrame(rows, "cls long, embedding array<double>")
    wanted = classes.where("cls % 50 = 0").withColumnRenamed("cls", "q")
    dims, width, probes = ann.tune(classes, wanted, 32, 5)
    hasher, x = ann.Hasher(32, ann.TABLES, dims, width), ann._unit(np.array([v for _, v in rows], float))
    ask = x[::50]
    visited = np.zeros((len(ask), len(x)), bool)
    for t in range(ann.TABLES):
        visited |= (hasher.probes(ask, t, probes)[:, :, None] == hasher.buckets(x, t)[None, None, :]).any(axis=1)
    assert visited.mean() < 0.05
    near = np.argsort(-(ask @ x.T), axis=1)[:, 1:6]
    assert np.take_along_axis(visited, near, 1).mean() >= 0.9
