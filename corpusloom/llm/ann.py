"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact reranking.

Vectors are scaled to length 1, so that the smallest Euclidean distance means the largest cosine. A table
hashes a vector by `dims` Gaussian (2-stable) projections cut into cells of width `width`; the cells
together are the bucket. A query visits its own bucket and the `probes` - 1 perturbed buckets
that most likely hold near vectors: perturbations move some projections to the next cell, and are
visited in order of the sum of squared distances to the cell borders crossed. Candidates of all tables are
merged and reranked by the exact cosine of the original vectors in double precision.

Equal vectors form one class, of which the `k` + 1 smallest ids are kept (ties go to smaller ids, so no others can be
among the k nearest), so that a very common vector costs no more than any other. Buckets are grouped
into slots of about `SLOT` vectors. A slot with more is cut into blocks, and so are the queries that visit a slot (`QUERIES_AT_ONCE`
in a block); every block of queries meets every block of the slot in a cell of its own, so no task holds an unbounded bucket or set of
queries. A query that finds fewer than k rows in its buckets is searched exactly, against all classes, in blocks of queries.

Every valid row is indexed. The number of projections, their cells' width and the number of buckets that a query visits are fitted (`tune`):
the true neighbours of `SAMPLE_QUERIES` queries are searched among all rows, and of the settings that find at least `RECALL` of
them that which visits the smallest share of `SAMPLE_ROWS` rows is taken. Noise, whose neighbours are hardly nearer than other rows,
has no cheap setting; clustered vectors need to visit a small share. Where no setting finds enough, all queries are searched exactly.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, as query or
candidate, nor do vectors whose dimension isn't the most frequent one (ties: the smaller). Rows without vec_id
take no part. Repeated ids are distinct candidates with one id; a row never finds another of its own id. With k rows or
fewer all are returned; a table with one valid row gives an empty result. Only vec_id and embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

EVERY = 50
NEAREST = 5
TABLES = 6
SETTINGS = tuple(product((3, 4, 6, 8, 12, 16), (1.5, 2.0, 3.0)))
RECALL = 0.95
SAMPLE_QUERIES, SAMPLE_ROWS = 128, 2000
MOVES = 3000
SLOT = 4000
QUERIES_AT_ONCE = 2048
SEED = 404


def _moves(dims: int) -> np.ndarray:
    """Perturbations: steps of -1, 0 and 1 in each projection, with as many steps at once as keep their number within MOVES."""
    out: list[np.ndarray] = [np.zeros((1, dims), int)]
    for steps in range(1, dims + 1):
        more = [(at, way) for at in combinations(range(dims), steps) for way in product((-1, 1), repeat=steps)] if math.comb(dims, steps) << steps <= MOVES else []
        if not more or sum(map(len, out)) + len(more) > MOVES:
            break
        rows = np.zeros((len(more), dims), int)
        for row, (at, way) in zip(rows, more, strict=True):
            row[list(at)] = way
        out.append(rows)
    return np.concatenate(out)


class Hasher:
    """`tables` independent p-stable hash tables for vectors of one dimension."""

    def __init__(self, dim: int, tables: int, dims: int, width: float, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.a = rng.standard_normal((tables, dim, dims))
        self.b = rng.uniform(0, width, (tables, dims))
        self.width, self.dims, self.tables = width, dims, tables
        self.moves = _moves(dims)
        self.mixer = rng.integers(1, 1 << 62, dims) * 2 + 1

    def cells(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        at = (x @ self.a[t] + self.b[t]) / self.width
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def code(self, cell: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = ((cell + (1 << 20)) * self.mixer).sum(-1)
            h ^= (h >> 29) & ((1 << 35) - 1)
            return h * np.int64(-4658895280553007687)

    def buckets(self, x: np.ndarray, t: int) -> np.ndarray:
        return self.code(self.cells(x, t)[0])

    def probes(self, x: np.ndarray, t: int, n: int) -> np.ndarray:
        """The n buckets of each vector that most likely hold near ones, likeliest first."""
        cell, inside = self.cells(x, t)
        best = np.argsort(self.costs(inside), axis=1, kind="stable")[:, :n]
        return self.code(cell[:, None, :] + self.moves[best])

    def costs(self, inside: np.ndarray) -> np.ndarray:
        """The sum of squared distances to the crossed borders of each move."""
        cost = np.stack([np.zeros_like(inside), (1 - inside) ** 2, inside**2], -1)  # moves 0, +1, -1
        return sum(cost[:, d, :][:, self.moves[:, d]] for d in range(self.dims))

    def turns(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many buckets each vector of x visits before it meets the vectors of y (those beside it: one matrix of y for each x), in the best table."""
        out = np.full(y.shape[:2], len(self.moves))
        for t in range(self.tables):
            cell, inside = self.cells(x, t)
            order = np.sort(self.costs(inside), axis=1)
            step = self.cells(y, t)[0] - cell[:, None, :]
            cost = np.where(step == 0, 0, np.where(step == 1, (1 - inside[:, None, :]) ** 2, np.where(step == -1, inside[:, None, :] ** 2, np.inf))).sum(-1)
            cost[(step != 0).sum(-1) > np.abs(self.moves).sum(1).max()] = np.inf  # more steps at once than any move has
            for i, row in enumerate(order):
                out[i] = np.minimum(out[i], np.searchsorted(row, cost[i] - 1e-12))
        return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _single(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists of floats: near enough to choose candidates, which are then scored in double precision."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.astype(np.float32).reshape(-1)))


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (double) of the rows that take part."""
    v = F.col("embedding")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(ok, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))


def tune(classes: DataFrame, wanted: DataFrame, dim: int, k: int, tables: int = TABLES) -> tuple[int, float, int] | None:
    """Projections, width and buckets to visit, fitted on a bounded sample of queries and rows; None if nothing finds enough."""
    asked = wanted.orderBy(F.xxhash64("q"), "q").limit(SAMPLE_QUERIES).toArrow()
    if not asked.num_rows:
        return None
    x, names = _unit(_matrix(asked["embedding"].combine_chunks(), dim)), asked["q"].to_numpy()
    near = _scan(classes, classes.sparkSession, asked, dim, k).join(classes.select("cls", "embedding"), "cls").where("q <> cls").toArrow()
    q, y = near["q"].to_numpy(), _unit(_matrix(near["embedding"].combine_chunks(), dim))
    some = _unit(_matrix(classes.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE_ROWS).toArrow()["embedding"].combine_chunks(), dim))
    true, who = [], []
    for i, name in enumerate(names):
        mine = y[q == name]
        if len(mine) >= k:
            true.append(mine[np.argsort(-(mine @ x[i]), kind="stable")[:k]])
            who.append(i)
    if not who:
        return None
    x, true = x[who], np.stack(true)
    best: tuple[float, int, int, float] | None = None
    for dims, width in SETTINGS:
        hasher = Hasher(dim, tables, dims, width)
        turn = np.sort(hasher.turns(x, true).ravel())
        n = int(turn[math.ceil(RECALL * len(turn)) - 1]) + 1
        if n > len(hasher.moves):
            continue
        share = np.mean([hasher.turns(x[i : i + 8], np.broadcast_to(some, (len(x[i : i + 8]), *some.shape))) < n for i in range(0, len(x) // 8 * 8 or len(x), 8)])
        if best is None or (share, n) < best[:2]:
            best = (float(share), n, dims, width)
    return best and (best[2], best[3], best[1])


def nearest(vectors: DataFrame, every: int = EVERY, k: int = NEAREST, tables: int = TABLES, setting: tuple[int, float, int] | None = None) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest of each row whose id is divisible by `every`. setting: projections, width and buckets, instead of fitted ones."""
    spark = vectors.sparkSession
    rows = cut(valid(vectors))
    size = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = size["dim"] if size else 1
    rows = rows.where(F.size("embedding") == dim)
    # classes of equal vectors; only the first k + 1 ids of a class are of use
    own = Window.partitionBy("embedding").orderBy("vec_id")
    members = rows.select("vec_id", "embedding", F.row_number().over(own).alias("_n")).where(F.col("_n") <= k + 1)
    classes = cut(members.groupBy("embedding").agg(F.min("vec_id").alias("cls"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asks = rows.where(F.col("vec_id") % every == 0).select("vec_id", "embedding")
    asking = asks.join(classes.select("cls", "embedding"), "embedding").select(F.col("vec_id").alias("query_id"), F.col("cls").alias("q"))
    asking = cut(asking)
    wanted = cut(asking.select("q").distinct().join(classes.select(F.col("cls").alias("q"), "embedding"), "q"))
    slots = max(1, classes.count() // SLOT)
    dims, width, probes = setting or tune(classes, wanted, dim, k, tables) or (1, 1.0, 0)  # visiting no bucket leaves all to the exact search
    hasher = Hasher(dim, tables, dims, width)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unit(_matrix(b.column("embedding"), dim))
            for t in range(tables):
                code = hasher.buckets(x, t)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), t, np.int32)), pa.array(code % slots), pa.array(code), b.column("cls"), _single(x)], ["t", "slot", "code", "cls", "v"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part = b.slice(i, 200)
                x = _unit(_matrix(part.column("embedding"), dim))
                v = _single(x)
                for t in range(tables):
                    code = np.sort(hasher.probes(x, t, probes), axis=1)
                    slot = code % slots
                    for s in np.unique(slot):
                        who = np.flatnonzero((slot == s).any(axis=1))
                        codes = [code[w][slot[w] == s] for w in who]
                        lists = pa.array(codes, pa.list_(pa.int64()))
                        take = pa.array(who)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), t, np.int32)), pa.array(np.full(len(who), s, np.int64)), lists, part.column("q").take(take), v.take(take)], ["t", "slot", "codes", "q", "v"])

    data = classes.select("cls", "embedding").mapInArrow(index, "t int, slot long, code long, cls long, v array<float>")
    asked = cut(wanted.mapInArrow(ask, "t int, slot long, codes array<long>, q long, v array<float>"))
    # a slot's rows and the queries that visit it are both cut into blocks
    rows_in = data.groupBy("t", "slot").agg(F.ceil(F.count("*") / (2.0 * SLOT)).alias("blocks"))
    asked_in = asked.groupBy("t", "slot").agg(F.ceil(F.count("*") / QUERIES_AT_ONCE).alias("lots"))
    counts = cut(rows_in.join(asked_in, ["t", "slot"]))  # slots that no query visits are gone
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    data = data.join(counts, ["t", "slot"]).select("t", "slot", F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("block"), upto("lots").alias("lot"), "code", "cls", "v")
    asked = asked.join(counts, ["t", "slot"]).select("t", "slot", upto("blocks").alias("block"), F.pmod(F.xxhash64("q"), F.col("lots")).alias("lot"), "codes", "q", "v")

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The k + 1 nearest classes in this block for each query, among the rows of the buckets it visits."""
        empty = pd.DataFrame({"q": np.zeros(0, np.int64), "cls": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(left) or not len(right):
            return empty
        x = np.vstack(left["v"].to_numpy())
        code, cls = left["code"].to_numpy(), left["cls"].to_numpy()
        order = np.argsort(code, kind="stable")
        code, cls, x = code[order], cls[order], x[order]
        asked, names, scores = [], [], []
        for q, codes, v in zip(right["q"], right["codes"], right["v"], strict=True):
            lo, hi = np.searchsorted(code, codes, "left"), np.searchsorted(code, codes, "right")
            n = hi - lo
            total = int(n.sum())
            if not total:
                continue
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
            score = x[at] @ v
            if total > k + 1:  # the k + 1 best, and all that tie with the last of them
                some = score >= np.partition(score, total - k - 1)[total - k - 1]
                at, score = at[some], score[some]
            best = np.lexsort((cls[at], -score))[: k + 1]
            asked.append(np.full(len(best), q))
            names.append(cls[at[best]])
            scores.append(score[best].astype(float))
        return pd.DataFrame({"q": np.concatenate(asked), "cls": np.concatenate(names), "score": np.concatenate(scores)}) if asked else empty

    cell = ["t", "slot", "block", "lot"]
    grouped = data.groupBy(*cell).cogroup(asked.groupBy(*cell))
    found = grouped.applyInPandas(rerank, "q long, cls long, score double").groupBy("q", "cls").agg(F.max("score").alias("score"))
    found = _best(found, k)
    ranked = cut(_answers(found, wanted, classes, asking, dim, k))
    # exact search for those that found fewer than k
    total = rows.count()
    short = ranked.groupBy("query_id").count().where(F.col("count") < min(k, total - 1)).select("query_id")
    none = asking.select("query_id").distinct().join(ranked.select("query_id").distinct(), "query_id", "left_anti")
    left = cut(asking.join(short.union(none), "query_id", "left_semi"))
    rest = cut(left.select("q").distinct())
    n_rest = rest.count() if total > 1 else 0
    if not n_rest:
        return ranked
    groups = -(-n_rest // QUERIES_AT_ONCE)
    exact = None
    for g in range(groups):
        block = wanted.join(rest.where(F.pmod(F.xxhash64("q"), F.lit(groups)) == g), "q", "left_semi").toArrow()
        if block.num_rows:
            part = _scan(classes, spark, block, dim, k)
            exact = part if exact is None else exact.union(part)
    again = _answers(exact, wanted, classes, left, dim, k)
    return ranked.join(left.select("query_id").distinct(), "query_id", "left_anti").union(again)


def _scan(classes: DataFrame, spark: SparkSession, block: pa.Table, dim: int, k: int) -> DataFrame:
    """(q, cls): the k + 1 nearest classes of each query of a block in each batch of classes."""
    held = spark.sparkContext.broadcast((block["q"].to_numpy(), _unit(_matrix(block["embedding"].combine_chunks(), dim))))  # about QUERIES_AT_ONCE rows

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, y = held.value
        for b in batches:
            cls, x = np.asarray(b.column("cls")), _unit(_matrix(b.column("embedding"), dim))
            score = y @ x.T
            best = [np.lexsort((cls, -row))[: k + 1] for row in score]
            at = np.concatenate(best)
            of = np.repeat(np.arange(len(q)), [len(x) for x in best])
            yield pa.RecordBatch.from_arrays([pa.array(q[of]), pa.array(cls[at]), pa.array(score[of, at])], ["q", "cls", "score"])

    return _best(classes.select("cls", "embedding").mapInArrow(scan, "q long, cls long, score double"), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    """Twice the classes of each query that can be needed, so that last-digit differences to the exact scores lose none."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), "cls")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= 2 * (k + 1)).select("q", "cls")


def _answers(found: DataFrame, wanted: DataFrame, classes: DataFrame, asking: DataFrame, dim: int, k: int) -> DataFrame:
    """The k nearest rows of each asking row from its class's candidate classes, by the exact cosine of the original vectors."""
    own = asking.select("q", F.col("q").alias("cls")).distinct()  # other rows with the query's own vector
    pairs = found.union(own).distinct().join(wanted.select("q", F.col("embedding").alias("v")), "q").join(classes, "cls")

    def cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = _matrix(b.column("v"), dim), _matrix(b.column("embedding"), dim)
            x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
            score = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("cls"), b.column("ids"), pa.array(score)], ["q", "cls", "ids", "score"])

    scored = pairs.select("q", "cls", "ids", "v", "embedding").mapInArrow(cosine, "q long, cls long, ids array<long>, score double")
    # a class's candidates beyond the first k + 1 rows can't be among the k nearest
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = scored.select("q", "score", F.explode("ids").alias("vec_id")).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows = asking.distinct().join(top.select("q", "score", "vec_id"), "q").where("query_id <> vec_id")
    return rows.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_ann_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
