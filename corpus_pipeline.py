"""A training corpus from raw documents in four stages; each works on all rows that the one before it kept.

1. quality: documents that the additive quality model scores under 0.5 go.
2. near_duplicates: of each group of documents linked by 5-word shingle Jaccard >= 0.8, one document stays, that with the smallest doc_id.
3. mix: documents are repeated or left out so that sources come near their target weights.
4. pack: what is left is packed into sequences of 2048 tokens.

Rows with equal doc_id and equal text are one document to stages 1 and 2: the first keeps or drops
all of them, the second keeps one. Rows without a doc_id pass stage 2 only as the sole member of their group or if no
member has an id (then one stays).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import jaccard_join, mixing, packing, quality
from corpusloom.llm.common import cut, table

LOWEST = -(1 << 63)


def _fresh(docs: DataFrame, *names: str) -> list[str]:
    """These names, with as many underscores before them as keep them apart from the columns of docs."""
    taken = {c.lower() for c in docs.columns}
    longest = max((len(c) - len(c.lstrip("_")) for c in taken), default=0)
    return ["_" * (longest + 1) + n for n in names]


def _key() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(LOWEST))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more. Only labelled documents' features are made to learn from; then the model is applied while the documents stream by."""
    chosen = cut(quality.lessons(docs, table(spark, sf_dir, "labels")))
    labelled = docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")  # at most quality.MAX_ROWS ids
    return quality.passing(docs, quality.learn(quality.feature_rows(labelled), chosen))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, text = _fresh(docs, "key", "text")
    found = jaccard_join.join_components(docs)
    # the rows of one document are few, unless ids are missing: those are ranked by text
    own = Window.partitionBy("component_id", "text_hash").orderBy("n_shingles")
    kept = found.where("doc_id = component_id or component_id is null").withColumn("n", F.row_number().over(own))
    kept = kept.where("n = 1").select(_key().alias(key), F.col("text_hash").alias(text)).distinct()
    rows = docs.withColumns({key: _key(), text: F.xxhash64("text")}).join(kept, [key, text], "left_semi")
    return rows.dropDuplicates([key, text]).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, text, origin, at, of_text, of, times, copy = _fresh(docs, "key", "text", "origin", "at", "of_text", "of", "times", "copy")
    found = mixing.mix(docs).where("times > 0").groupBy("doc_id", "text_hash", "source").agg(F.sum("times").alias(times))
    found = found.select(_key().alias(at), F.col("text_hash").alias(of_text), F.col("source").alias(of), times)
    rows = docs.withColumns({key: _key(), text: F.xxhash64("text"), origin: F.col("source")})
    one = rows.dropDuplicates([key, text, origin])  # rows alike in these are interchangeable; the takes of all of them are summed
    same = (F.col(key) == F.col(at)) & (F.col(text) == F.col(of_text)) & F.col(origin).eqNullSafe(F.col(of))
    return one.join(found, same).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = packing.pack_documents(docs, remember=False)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Neither the model of the first stage nor the tokenizer of the last can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's result written once to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
