from __future__ import annotations

import random
import hashlib

import pytest
from pyspark.sql import SparkSession

from corpusloom.llm import fingerprint

from .brute import components, jaccard, shingles

DOCS = "doc_id long, text string, part string, ghost string, key string"


def _edited(rows: list[tuple]) -> dict[int, tuple[int, str, str, str]]:
    """doc_id -> (n_chars, edited sha256, edited text, next text)."""
    out, texts = {}, [t or "" for _, t in rows]
    for i, (doc_id, _) in enumerate(rows):
        t, after = texts[i], texts[(i + 1) % len(rows)]
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        out[doc_id] = (len(t), hashlib.sha256(new.encode()).hexdigest(), new, after)
    return out


@pytest.mark.parametrize("parts", [1, 7, None])
def test_whole_table(spark: SparkSession, sf_dir: str, parts: int | None) -> None:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    want, found = _edited(rows), fingerprint.edited(docs, parts=parts).collect()
    assert len(found) == len(rows)
    texts, error = dict(rows), []
    prints = {}
    for r in found:
        n, sha, new, after = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        assert prints.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        own = shingles(texts[r["doc_id"]])
        for near, other in ((r["near_edited"], new), (r["near_next"], after)):
            assert 0 <= near <= 1
            error.append(abs(near - jaccard(own, shingles(other))))
    assert max(error) < 0.25 and sum(error) / len(error) < 0.03


def test_edge_cases(spark: SparkSession) -> None:
    rows = [(1, None, "", "", ""), (2, "", "", "", ""), (3, "é😀x", "", "", ""), (4, "one two three four five six", "", "", ""), (5, "one two three four five six", "", "", "")]
    found = {r["doc_id"]: r for r in fingerprint.edited(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    want = _edited([r[:2] for r in rows])
    assert {i: (r["n_chars"], r["edited_sha256"]) for i, r in found.items()} == {i: w[:2] for i, w in want.items()}
    assert found[1]["fingerprint"] == found[2]["fingerprint"] and found[1]["near_next"] == 1 and found[4]["near_next"] == 1
    repeated = spark.createDataFrame([(7, "a", "", "", ""), (7, "a", "", "", ""), (None, "b", "", "", "")], DOCS)
    assert fingerprint.edited(repeated).count() == 3
    assert fingerprint.edited(spark.createDataFrame([(7, "a b", "", "", "")], DOCS)).first()["near_next"] == 1
    assert fingerprint.edited(spark.createDataFrame([], DOCS)).count() == 0


def test_near_duplicates_by_bands(spark: SparkSession) -> None:
    base = [f"w{i}" for i in range(120)]
    near = [*base[:60], "new", *base[60:]]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base)), (4, " ".join(base[:60])), (5, "other words stand here and there"), (6, None), (7, ""), (None, " ".join(near))]
    found = {r["doc_id"]: r["component_id"] for r in fingerprint.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, None: 1}
    assert fingerprint.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chains_in_large_groups_keep_their_links(spark: SparkSession) -> None:
    """Variants of three texts, each a few words from the one before: most links are between texts that lead no bucket."""
    rng = random.Random(6)
    rows = []
    for g in range(3):
        text = [f"g{g}w{i}" for i in range(200)]
        for _ in range(110):
            text = list(text)
            for _ in range(2):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    want = components(rows)
    found = {r["doc_id"]: r["component_id"] for r in fingerprint.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len({c for _, c in want.values()}) < 30
    same = sum(found[i] == c for i, (_, c) in want.items())
    assert same >= 0.9 * len(rows)
    root = {i: c for i, (_, c) in want.items()}
    assert all(root[i] == root[c] for i, c in found.items())  # nothing is linked that isn't
