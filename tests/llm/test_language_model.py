from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

from corpusloom.llm import language_model as lm

from .brute import fold, words

DOCS = "doc_id long, text string, w string, tail string, c string, rid string"


def _base(rows: list[tuple]) -> tuple[dict, int]:
    """doc_id -> (tokens, known tokens, base score) and N."""
    counts: Counter = Counter()
    for i, t in rows:
        if fold(i, 5) != 1:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, t in rows:
        tokens = [*words(t), None]
        out[i] = (len(tokens), sum(counts[x] > 0 for x in tokens), sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens))
    return out, n


@pytest.fixture(scope="module")
def whole(spark: SparkSession, sf_dir: str) -> tuple[list, list]:
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    return rows, lm.op3_maxent_score(spark, sf_dir).collect()


def test_counts_and_base_scores(whole: tuple[list, list]) -> None:
    rows, found = whole
    want, n = _base(rows)
    assert len(found) == len(rows)
    for r in found:
        tokens, known, base = want[r["doc_id"]]
        assert r["held_out"] == (fold(r["doc_id"], 5) == 1) and r["train_tokens"] == n
        assert (r["n_tokens"], r["n_known"]) == (tokens, known)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_model_is_better_than_the_base_on_held_out_texts(whole: tuple[list, list]) -> None:
    held = [r for r in whole[1] if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert gain > 0.5
    assert all(r["score"] < 0 for r in whole[1])


def test_rare_words_score_like_frequent_ones(spark: SparkSession, sf_dir: str, whole: tuple[list, list]) -> None:
    """A small in-task table sends most words through the join, and nothing changes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    chunks = lm.chunked(docs)
    counts = lm.count_words(chunks.where("train"))
    model = lm.prepare(counts, frequent=200)
    assert len(model.words) <= 200
    found = {r["doc_id"]: r for r in lm.score(chunks, counts, model).collect()}
    for r in whole[1]:
        f = found[r["doc_id"]]
        assert (f["n_tokens"], f["n_known"]) == (r["n_tokens"], r["n_known"])
        assert f["base_score"] == pytest.approx(r["base_score"], rel=1e-9)


def test_probabilities_add_up(spark: SparkSession) -> None:
    """Over all known words, the end and one unseen word for each class that has room for one, the next token's probabilities add up to 1."""
    text = "a b c a d e f a b g h i j k l m n o p q r s t u v w x y z aa bb cc dd ee ff gg hh ii jj kk ll mm nn oo pp"
    docs = spark.createDataFrame([(i, text) for i in range(20)], "doc_id long, text string")
    chunks = lm.chunked(docs, lm.F.lit(True))
    counts = lm.count_words(chunks)
    model = lm.train(chunks, lm.prepare(counts))
    rows = lm.features(np.array([5, 7, 0]), np.array([0, 3]))
    p = lm._probabilities(model.weights, model.bias, rows)
    assert np.allclose(p.sum(1), 1, atol=1e-5)
    own = {*model.own.view(np.int64).tolist(), int(lm.END.view(np.int64))}
    inside = Counter()
    for r in counts.collect():
        if r["w"] not in own:
            inside[int(lm.tail_class(np.array([r["tail"]]))[0])] += r["c"] + 0.5
    for k, total in inside.items():
        assert total + 0.5 == pytest.approx(10 ** model.norm[k])


def test_edge_cases(spark: SparkSession) -> None:
    rows = [(0, None, *"abcd"), (1, "", *"abcd"), (2, " \t", *"abcd"), (3, "A a É é", *"abcd"), (3, "A a É é", *"abcd"), (None, "a", *"abcd"), (4, "w" * 100_000 + " b" * 9999, *"abcd")]
    found = lm.score_documents(spark.createDataFrame(rows, DOCS)).collect()
    by = {r["doc_id"]: r for r in found}
    assert len(found) == 7 and by[0]["n_tokens"] == by[1]["n_tokens"] == by[2]["n_tokens"] == 1 and by[3]["n_tokens"] == 5 and by[None]["held_out"]
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in found)
    only_held_out = [(i, "x y", *"abcd") for i in range(200) if fold(i, 5) == 1]
    assert {r["train_tokens"] for r in lm.score_documents(spark.createDataFrame(only_held_out, DOCS)).collect()} == {0}
    assert lm.score_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_word_pairs_and_passages_seen_in_training_are_learned(spark: SparkSession) -> None:
    """Two held-out texts of the same classes, words and word counts: the one whose passages stand in training texts scores much higher."""
    train, held = [i for i in range(400) if fold(i, 5) != 1], [i for i in range(400) if fold(i, 5) == 1]
    names = [f"{x}{y}{z}wo" for x in "bdfgklmnprst" for y in "aeiou" for z in "bdfgklmnprst"]  # one tail: all outside the commonest are of one class
    texts = [" ".join(names[(7 * i + k) % len(names)] for k in range(40)) for i in train]
    seen = " ".join(names[100 + k] for k in range(30))
    mixed = " ".join(sorted(seen.split(), key=lambda x: x[::-1]))
    rows = [*zip(train, texts, strict=True), (held[0], seen), (held[1], mixed)]
    by = {r["doc_id"]: r for r in lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    a, b = by[held[0]], by[held[1]]
    assert a["base_score"] == pytest.approx(b["base_score"]) and a["score"] > b["score"] + 15


def test_word_features_match_plain_counts(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    """Small chunks and many blocks: the counts that meet are those of plain Python."""
    monkeypatch.setattr(lm, "CHUNK", 50)
    monkeypatch.setattr(lm, "BLOCK_KEYS", 16)
    rows = [(i, " ".join("abcde"[(i * i + k * k) % 5] for k in range(i % 9))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chunks = lm.chunked(docs)
    assert chunks.count() > 5
    counts = lm.count_words(chunks.where("train"))
    model = lm.prepare(counts, frequent=3)  # the other words meet in blocks too
    uni, pairs, three = Counter(), Counter(), Counter()
    token = lambda t: [*words(t), None]
    for i, t in rows:
        if fold(i, 5) != 1:
            x = token(t)
            uni.update(x)
            pairs.update(zip(["^", *x], x, strict=False))
            three.update(zip(["^", *x], x, x[1:], strict=False))
    got = {r["doc_id"]: r["score"] for r in lm.score(chunks, counts, model).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        x, total = token(t), 0.0
        raw, at = lm.utf8(pa.array([t]))
        h, tail, at = lm._tokens(raw, at)
        cls = model.classes(h, tail)
        p0 = 10 ** (lm.class_scores(model, cls, at) - model.norm[cls])
        for k, w in enumerate(x):
            p = p0[k] * (uni[w] + 0.5 if cls[k] > len(model.own) else 1)
            first = x[k - 1] if k else "^"
            steps = [(pairs[first, w], uni[first] if k else uni[None])]
            if k:
                before = x[k - 2] if k > 1 else "^"
                steps.append((three[before, x[k - 1], w], pairs[before, x[k - 1]]))
            for (count, past), (strength, power) in zip(steps, lm.STRENGTH, strict=False):
                s = strength * (past + 1) ** power
                p = (count + s * p) / (past + s)
            total += math.log10(p)
        assert got[i] == pytest.approx(total, abs=1e-6)


def test_class_probabilities_and_features_by_hand() -> None:
    """The softmax over summed weight rows, and the rows of n-grams and skips, token by token."""
    rng = np.random.default_rng(8)
    weights, bias = rng.normal(size=(lm.ROWS, lm.CLASSES)).astype(np.float32), rng.normal(size=lm.CLASSES).astype(np.float32)
    none = np.zeros(0, np.uint64)
    model = lm.Model(none, none.astype(np.int64), none, none.astype(np.int64), bias, np.zeros(lm.CLASSES), 1, 1, weights)
    cls, at = rng.integers(0, lm.CLASSES, 300), np.array([0, 1, 3, 3, 120, 300])
    rows, found = lm.features(cls, at), lm.class_scores(model, cls, at)
    one = lambda x: int(lm.mix(np.array([x], np.uint64))[0]) % lm.ROWS
    for a, b in zip(at, at[1:], strict=False):
        for i in range(a, b):
            c1, c2, c3 = (int(cls[i - d]) if i - d >= a else lm.CLASSES for d in (1, 2, 3))
            keys = [c1, c2 + 256, c3 + 512, (c1 << 16) + (c2 << 24) + 768, (c1 << 16) + (c3 << 24) + 1024]
            want = [one(k) for k in keys]
            assert rows[:, i].tolist() == want
            z = bias.astype(float) + sum(weights[r].astype(float) for r in want)
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            assert abs(found[i] - np.log10(p[cls[i]])) < 1e-4


def test_updates_follow_the_gradient() -> None:
    """One batch against sums of single tokens' gradients, feature by feature."""
    rng = np.random.default_rng(9)
    cls, at = rng.integers(0, lm.CLASSES, 500), np.array([0, 200, 500])
    rows, bias = lm.features(cls, at), rng.normal(size=lm.CLASSES).astype(np.float32)
    weights, squares, used = np.zeros((lm.ROWS, lm.CLASSES), np.float32), np.zeros(lm.ROWS, np.float32), np.zeros(lm.ROWS, np.int64)
    lm.update(weights, squares, used, bias, cls, rows)
    p = np.exp(bias.astype(float)) / np.exp(bias.astype(float)).sum()
    want, sums, seen = np.zeros((lm.ROWS, lm.CLASSES)), np.zeros(lm.ROWS), np.zeros(lm.ROWS, int)
    for feature in rows:
        step = np.zeros((lm.ROWS, lm.CLASSES))
        for r, c in zip(feature, cls, strict=True):
            step[r] += p
            step[r, c] -= 1
            seen[r] += 1
        sums += (step**2).sum(1)
        touched = np.unique(feature)
        want[touched] -= lm.RATE * step[touched] / np.sqrt(sums[touched] + 1)[:, None]
    assert np.allclose(weights, want, atol=1e-4) and np.allclose(squares, sums, rtol=1e-3) and (used == seen).all()
