"""MinHash fingerprints of documents.

A text's set is that of its distinct k-word shingles, as 64-bit hashes. `PERMS` universal hash functions
a * h + b (mod 2^64, a odd) are applied to the whole set in vectorised numpy, and 16
mixed bits of each function's smallest value make the fingerprint (four hex digits each). The likeness of two
fingerprints is the share of equal places, an estimate of the sets' Jaccard similarity.

`near_duplicates` joins the bands of the signatures in Spark: sets that agree in all places of a band share that band's bucket. Equal sets are one
class first. Each class of a bucket meets the bucket's leader, then classes of a bucket that are still in different components meet in
blocks, and each such pair is verified by the exact Jaccard of the sets, so no link of two sets that share a bucket is lost.

`edited` finds each document's successor in doc_id order without a global sort in one task: rows are
dealt to ranges of ids, whose bounds are approximate quantiles; the first row of a range is also sent
to the range before it, so every row meets its successor inside its range. The bounds only decide
where rows go, never the result.

Cases: a null text is empty. An empty text, or one of white space, has an empty set: its fingerprint is
all f, and two such fingerprints have likeness 1. Fewer than k words: the whole sequence is the one
shingle. Rows with equal doc_id follow each other in order of their texts; null doc_ids come first. The
successor of the last row is the first; a table of one row succeeds itself. An empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .jaccard_join import DEN, NUM, answers, class_keys, classes_of, linked_components, memberships
from .textkernel import mix, runs, shingle_sets, utf8

PERMS = 128
BANDS = 32
K = 5
LOWEST = -(1 << 63)
_rng = np.random.default_rng(8)
_A = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64)


def minhashes(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """PERMS 16-bit places for each set of hashes."""
    out = np.full((len(at) - 1, PERMS), 0xFFFF, np.uint16)
    some = np.flatnonzero(np.diff(at) > 0)
    if len(some):
        starts = at[some]
        for p in range(PERMS):
            out[some, p] = mix(np.minimum.reduceat(h * _A[p] + _B[p], starts)) >> np.uint64(48)
    return out


def fingerprints(texts: pa.Array, k: int = K) -> np.ndarray:
    raw, offsets = utf8(texts)
    parts = [minhashes(*shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)) for i, j in runs(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, PERMS), np.uint16)


def as_hex(prints: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes().hex() for x in prints.astype(">u2")], pa.string())


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def with_successors(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(part, doc_id, text, ghost) sorted inside partitions so that each row that isn't a ghost is followed by its successor."""
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(LOWEST))
    cuts = docs.select(F.percentile_approx(key, [i / parts for i in range(1, parts)], 100 * parts).alias("q")).first()["q"] or []  # `parts` numbers
    bounds = sorted(set(cuts))
    # how many bounds lie below the key: first among the last bounds of blocks of about sqrt(n), then inside one block
    step = max(1, math.isqrt(len(bounds)))
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs]) if xs else F.array().cast("array<long>")
    block = F.size(F.filter(array(bounds[step - 1 :: step]), lambda x: x < key))
    part = block * step + F.size(F.filter(F.slice(array(bounds), block * step + 1, step), lambda x: x < key))
    rows = docs.select(key.alias("key"), "doc_id", "text", part.alias("part"))
    heads = sorted((r["part"], r["key"]) for r in rows.groupBy("part").agg(F.min("key").alias("key")).collect())  # one row for each range
    ghosts = spark.createDataFrame([(k, heads[i - 1][0]) for i, (_, k) in enumerate(heads)], "key long, to int")
    extra = rows.join(F.broadcast(ghosts), "key").select("key", "doc_id", "text", F.col("to").alias("part"), F.lit(1).alias("ghost"))
    both = rows.select("key", "doc_id", "text", "part", F.lit(0).alias("ghost")).union(extra)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(n, "part").sortWithinPartitions("part", "ghost", "key", "text").select("part", "doc_id", "text", "ghost")


def edited(docs: DataFrame, k: int = K, parts: int | None = None) -> DataFrame:
    """n_chars, edited_sha256, both fingerprints and the likenesses of every row of docs (doc_id, text)."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                now = b.slice(at, 1000)
                if held is not None:
                    now = pa.concat_batches([held, now])
                yield from answer(now)
                held = now.slice(now.num_rows - 1)

    def answer(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        part, ghost = (np.asarray(b.column(c)) for c in ("part", "ghost"))
        use = np.flatnonzero((part[1:] == part[:-1]) & (ghost[:-1] == 0))
        if not len(use):
            return
        texts = [x or "" for x in b.column("text").to_pylist()]
        changed = []
        for i in use:
            t, half = texts[i], len(texts[i]) // 2
            changed.append(t[: len(t) - half] + texts[i + 1][:half])
        own, new = fingerprints(b.column("text"), k), fingerprints(pa.array(changed, pa.large_string()), k)
        yield pa.RecordBatch.from_arrays(
            [
                b.column("doc_id").take(pa.array(use)),
                pa.array([len(texts[i]) for i in use], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed]),
                as_hex(own[use]),
                as_hex(new),
                pa.array(likeness(own[use], new)),
                pa.array(likeness(own[use], own[use + 1])),
            ],
            names,
        )

    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_successors(docs, parts).mapInArrow(make, schema)


def band_rows(docs: DataFrame, bands: int = BANDS, k: int = K) -> DataFrame:
    """(tile, cls): the buckets of each set's bands, a bucket being a band and its places."""
    width = PERMS // bands

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = utf8(b.column("text"))
            for i, j in runs(offsets):
                h, at = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                cls, prints = class_keys(h, at)[0].view(np.int64), minhashes(h, at).astype(np.uint64)
                full = np.flatnonzero(np.diff(at) > 0)
                for band in range(bands):
                    key = np.full(len(full), band + 1, np.uint64)
                    for p in range(band * width, (band + 1) * width):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + prints[full, p])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(cls[full])], ["tile", "cls"])

    return docs.select("text").mapInArrow(make, "tile long, cls long").distinct()


def near_duplicates(docs: DataFrame, bands: int = BANDS, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, text_hash, n_shingles, class_id and component_id of every row of docs: texts whose bands met and whose sets link, num / den being the least Jaccard."""
    members = cut(memberships(docs, k, num, den))
    classes = cut(classes_of(members))
    rows = cut(band_rows(docs, bands, k))
    shared = rows.groupBy("tile").agg(F.count("*").alias("held")).where("held > 1")
    rows = rows.join(shared, "tile")
    rows = cut(rows.join(rows.groupBy("cls").agg(F.sum("held").alias("weight")), "cls").select("tile", "cls", "weight"))
    return answers(members, classes, linked_components(rows, classes, docs, k, num, den))


def op8_minhash_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited(table(spark, sf_dir, "documents"))
