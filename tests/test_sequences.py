"""The matching-blocks kernel against the standard library, and how much its bound spares."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import sequences


def _edited(rng: random.Random, text: str) -> str:
    out = list(text)
    for _ in range(rng.randrange(1, 12)):
        i = rng.randrange(len(out) + 1)
        j = min(len(out), i + rng.randrange(1, 30))
        out[i:j] = rng.choice([[], out[:20], list("zq9 é"), out[i:j] * 2, [rng.choice("abc ")]])
    return "".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_same_as_the_standard_library(seed: int) -> None:
    rng = random.Random(seed)
    alphabets = ["ab", "abcdefghijklmnopqrstuvwxyz0123456789   ", "aaaaaaab", "éßæ😀 abc"]
    lengths = [0, 1, 5, 60, 198, 199, 200, 201, 450, 1500]
    for _ in range(60):
        letters = rng.choice(alphabets)
        a = "".join(rng.choice(letters) for _ in range(rng.choice(lengths)))
        b = _edited(rng, a) if rng.random() < 0.6 else "".join(rng.choice(letters) for _ in range(rng.choice(lengths)))
        want = SequenceMatcher(None, a, b).ratio()
        x, y = sequences.codes(a), sequences.codes(b)
        assert sequences.ratio(x, y) == want, (a[:50], b[:50])
        assert sequences.most_ratio(x, y) >= want - 1e-12


def test_prose(spark: SparkSession, sf_dir: str) -> None:
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(40).collect() if r[0]]
    for a, b in zip(texts, texts[1:], strict=False):
        a, b = a[:3000], b[:3000]
        for x, y in ((a, b), (a, a[:500] + b[:500] + a[700:])):
            assert sequences.ratio(sequences.codes(x), sequences.codes(y)) == SequenceMatcher(None, x, y).ratio()


def test_long_runs_of_one_character() -> None:
    assert sequences.ratio(sequences.codes("a" * 6000), sequences.codes("a" * 5000)) == SequenceMatcher(None, "a" * 6000, "a" * 5000).ratio()
    assert sequences.ratio(sequences.codes("a" * 6000), sequences.codes("a" * 150)) == SequenceMatcher(None, "a" * 6000, "a" * 150).ratio()


def test_column_with_need(spark: SparkSession) -> None:
    rng = random.Random(3)
    words = ["alpha", "beta", "risk", "report", "zeta", "quantum", "policy"]
    rows = [(i, " ".join(rng.choices(words, k=30)), " ".join(rng.choices(words if i % 3 else ["xxxx", "yyyy", "kkkk"], k=30))) for i in range(300)] + [(300, None, ""), (301, None, "x")]
    df = spark.createDataFrame(rows, "k int, a string, b string").repartition(3)
    found = {r["k"]: r["ratio"] for r in sequences.with_ratio(df, "a", "b", F.lit(0.5)).collect()}
    spared = 0
    for k, a, b in rows:
        want = SequenceMatcher(None, a or "", b or "").ratio()
        assert found[k] == want or (found[k] is None and want < 0.5)
        spared += found[k] is None
    assert spared >= 100  # a third of the pairs have few characters in common
