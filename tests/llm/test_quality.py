from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

from corpusloom.llm import quality
from corpusloom.llm.textkernel import utf8

from .brute import fold

DOCS = "doc_id long, text string, quality string, score string, features string"


def test_held_out_accuracy(spark: SparkSession, sf_dir: str) -> None:
    found = {r["doc_id"]: r for r in quality.op9_quality_gam(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for i, r in found.items():
        assert r["held_out"] == (fold(i, 3) == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in labels if found[r["doc_id"]]["held_out"]]
    right = np.mean([found[r["doc_id"]]["predicted"] == r["quality"] for r in held])
    most = np.mean([r["quality"] for r in held])
    assert right >= max(0.9, most)


def test_labels_of_held_out_rows_are_never_used(spark: SparkSession) -> None:
    rows = [(i, "good words stand here. " * 5 if i % 2 else "#$% ### |||| 123 " * 5, "", "", "") for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    label = lambda flip: spark.createDataFrame([(i, (i % 2) ^ (flip and fold(i, 3) == 1)) for i in range(300)], "doc_id long, quality int")
    scores = [sorted((r["doc_id"], r["score"]) for r in quality.classify(docs, label(flip)).collect()) for flip in (False, True)]
    assert scores[0] == scores[1]
    assert all((s >= 0.5) == bool(i % 2) for i, s in scores[0])


def test_edge_cases(spark: SparkSession) -> None:
    rows = [(1, None, "", "", ""), (2, "", "", "", ""), (None, "x", "", "", ""), (4, "long " * 50_000, "", "", ""), (4, "long " * 50_000, "", "", "")]
    docs = spark.createDataFrame(rows, DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = quality.classify(docs, none).collect()
    assert len(found) == 5 and {r["score"] for r in found} == {0.5}
    one = spark.createDataFrame([(2, 1), (4, 1), (4, None), (99, 0)], "doc_id long, quality int")
    assert len({r["score"] for r in quality.classify(docs, one).collect()}) == 1
    assert quality.classify(spark.createDataFrame([], DOCS), one).count() == 0


def test_features_do_not_depend_on_neighbours() -> None:
    texts = ["", "One two.\nTwo one!", None, "ééé éé", "A" * 100, "x\n\n\nx\nx ", "|a|b|", " "]
    all_ = quality.features(*utf8(pa.array(texts)))
    alone = np.vstack([quality.features(*utf8(pa.array([t], pa.string()))) for t in texts])
    assert np.isfinite(all_).all() and np.allclose(all_, alone, atol=1e-5)


@pytest.mark.parametrize("kind", ["main", "pair"])
def test_fit_learns_effects_and_interactions(kind: str) -> None:
    rng = np.random.default_rng(0)
    x = rng.random((3000, 22)).astype(np.float32)
    y = (x[:, 3] > 0.6) if kind == "main" else (x[:, 3] > 0.5) ^ (x[:, 7] > 0.5)
    model = quality.fit(x[:2000], y[:2000].astype(float))
    assert ((model.score(x[2000:]) >= 0.5) == y[2000:]).mean() > (0.97 if kind == "main" else 0.8)
