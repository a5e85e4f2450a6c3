from __future__ import annotations

from collections import Counter

from pyspark.sql import SparkSession

import corpus_pipeline
from corpusloom.llm import mixing, quality
from corpusloom.llm.common import cut

from .brute import components

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def test_stages_take_effect(spark: SparkSession, sf_dir: str) -> None:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    (n1, quality_stage), (n2, near), (n3, mix), (n4, pack) = corpus_pipeline.STAGES
    assert (n1, n2, n3, n4) == ("quality", "near_duplicates", "mix", "pack")
    rows = lambda df: Counter((r["doc_id"], r["text"], r["source"]) for r in df.collect())

    kept = cut(quality_stage(spark, docs, sf_dir))
    passed = {r["doc_id"] for r in quality.op9_quality_gam(spark, sf_dir).collect() if r["predicted"]}
    assert rows(kept) == rows(docs.where(docs.doc_id.isin(list(passed))))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in passed for i in good) >= 0.97 * len(good)

    single = cut(near(spark, kept, sf_dir))
    want = components([(r["doc_id"], r["text"]) for r in kept.collect()])
    assert {r["doc_id"] for r in single.collect()} == {i for i, (_, c) in want.items() if i == c} and single.count() == len({c for _, c in want.values()})

    mixed = cut(mix(spark, single, sf_dir))
    taken = {r["doc_id"]: r["times"] for r in mixing.mix(single).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in taken.items() if n})
    for df in (kept, single, mixed):
        assert tuple(df.columns) == COLUMNS

    packed = pack(spark, mixed, sf_dir).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed.collect())


def test_odd_tables(spark: SparkSession, sf_dir: str) -> None:
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, _hash long, _copy int"
    text = "These are words of a plain sentence, and they go on for a while until it ends. " * 4
    rows = [(None, text, None, None, None, 0.0, 1, 1, 1), (1, None, "en", "a", 0, 0.0, 1, 1, 1), (2, "", "en", "a", 0, 0.0, 1, 1, 1), (3, text, "en", "b", 9, 0.0, 1, 1, 1), (3, text, "en", "b", 9, 0.0, 1, 1, 1), (None, text + "end", "en", None, 9, 0.0, 1, 1, 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = cut(stage(spark, docs, sf_dir))
            if i == 1:
                assert docs.where("text is not null and text <> ''").count() <= 2
        docs.count()


def test_columns_of_any_name_come_out_unchanged(spark: SparkSession, sf_dir: str) -> None:
    names = ("_hash", "_id", "_source", "_times", "_copy", "row", "id", "hash", "origin", "times", "at", "n", "col")
    text = "These are words of a plain sentence, and they go on for a while until it ends. " * 4
    rows = [(i, f"{text} Number {i} has its own end here, {i} times over.", "en", "a", 9, *(1000 * i + k for k in range(len(names)))) for i in range(1, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} long" for n in names))
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = cut(stage(spark, docs, sf_dir))
        assert docs.columns[5:] == list(names)
        for r in docs.collect():
            assert [r[n] for n in names] == [1000 * r["doc_id"] + k for k in range(len(names))]
    assert docs.count()
