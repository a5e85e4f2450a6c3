"""Exact k-means on whole numbers with Yinyang bounds.

The first centroids are the vectors whose ids hash lowest. They are cut into a few groups once. Every vector carries its
cluster, an upper bound of the distance to that cluster's centroid and one lower bound for each group: no other centroid of the group
is nearer than that. A round moves the bounds by how far the centroids moved, then filters twice:

1. globally: a vector whose lower bounds all exceed its upper bound keeps its cluster (first by the moved upper
   bound, then by the exact distance);
2. by group: of the others, a group whose lower bound exceeds the best exact distance so far is passed over, and all
   centroids of the groups that are left are scanned exactly, ties to the smaller number.

Distances that decide are exact whole numbers; only bounds are floating, widened by a relative MARGIN
towards scanning, so rounding can cost time but never change a result. The vectors don't move: a round is one map
over Arrow batches, its state is written beside the vectors to the shared folder, and each task sends one row of sums
for each cluster it saw, which are added exactly as decimals; k rows reach the driver.

Cases: vectors that are null, have another number of components, or hold a null or non-finite one take no part, nor do
those with a component whose scaled value doesn't fit a long. Rows with equal or null ids are vectors of their own (a null
id hashes as an empty text; equal hashes are ordered by the vector). With fewer vectors than k there are as many clusters as
vectors. Equal centroids leave the later ones empty, and those stay where they are. Distances and sums that don't fit
a long come out null (they are still compared exactly). An empty table gives an empty result. Only the named
columns are read, so others can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

SCALE = 256
SIZE = 64
CLUSTERS = 40
ROUNDS = 5
SEED = "2"
#: About so many centroids in a group.
GROUP = 10
MARGIN = 1e-9
#: Up to these magnitudes sums of products stay exact in doubles, and in 64-bit integers.
IN_DOUBLE, IN_LONG = 1 << 20, 1 << 27


def whole(vectors: pa.Array, size: int) -> np.ndarray:
    """Scaled and floored components: 64-bit integers, or Python's where products could overflow."""
    values = np.floor(np.asarray(vectors.flatten(), np.float64).reshape(-1, size) * SCALE)
    found = values.astype(np.int64)
    return found.astype(object) if values.size and np.abs(values).max() > IN_LONG else found


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all of c."""
    most = max((int(abs(v).max()) for v in (x, c) if v.size), default=0)
    if most > IN_LONG:
        x, c = x.astype(object), c.astype(object)
    elif most <= IN_DOUBLE:
        x, c = x.astype(np.float64), c.astype(np.float64)
    found = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
    return found if found.dtype == object else found.astype(np.int64)


def _root(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def groups_of(centroids: np.ndarray, rounds: int = 5) -> list[np.ndarray]:
    """The centroids' numbers in groups of near ones (a few rounds of plain clustering over k points)."""
    n = max(1, len(centroids) // GROUP)
    points = centroids.astype(np.float64)
    middle = points[np.linspace(0, len(points) - 1, n).astype(int)] if len(points) else points
    at = np.zeros(len(points), int)
    for _ in range(rounds if len(points) else 0):
        at = ((points[:, None, :] - middle[None]) ** 2).sum(2).argmin(1)
        middle = np.array([points[at == g].mean(0) if (at == g).any() else middle[g] for g in range(n)])
    return [np.flatnonzero(at == g) for g in range(n) if (at == g).any()]


@dataclass
class Round:
    """What a round's tasks need, k by `size` numbers: centroids, their groups, and how far each centroid has moved."""

    centroids: np.ndarray
    groups: list[np.ndarray]
    moved: np.ndarray | None = None


@dataclass
class State:
    """Of each vector: cluster, squared distance if known exactly (else -1), bounds; scanned counts distances that were computed."""

    cluster: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    scanned: int = 0


def first_assignment(x: np.ndarray, now: Round) -> State:
    d = distances(x, now.centroids)
    cluster = np.array([int(r.argmin()) for r in d], np.int64) if d.dtype == object else d.argmin(1)
    rows = np.arange(len(x))
    roots = _root(d)
    upper = roots[rows, cluster]
    roots[rows, cluster] = np.inf
    lower = np.stack([roots[:, g].min(1) for g in now.groups], 1) if len(x) else np.zeros((0, len(now.groups)))
    return State(cluster, upper * (1 + MARGIN), lower * (1 - MARGIN), d.size)


def next_assignment(x: np.ndarray, old: State, now: Round) -> State:
    cluster = old.cluster.copy()
    upper = (old.upper + now.moved[cluster]) * (1 + MARGIN)
    lower = (old.lower - np.array([now.moved[g].max() for g in now.groups])) * (1 - MARGIN)
    lower = np.where(lower > 0, lower, -1.0)  # a bound that says nothing is below any distance
    state = State(cluster, upper, lower)
    # globally, by the moved bound and then by the exact distance to the vector's own centroid
    near = np.flatnonzero(lower.min(1) <= upper)
    own = now.centroids[cluster[near]] - x[near]
    best = (own * own).sum(1)
    upper[near] = _root(best) * (1 + MARGIN)
    state.scanned += len(near)
    left = lower[near].min(1) <= upper[near]
    near, best = near[left], best[left]
    before = cluster[near].copy()
    own_distance, own_group = _root(best) * (1 - MARGIN), np.empty(len(near), np.int64)
    for g, members in enumerate(now.groups):
        own_group[np.isin(before, members)] = g
    for g, members in enumerate(now.groups):
        # by group: the best distance falls as groups are scanned
        some = np.flatnonzero(lower[near, g] <= _root(best) * (1 + MARGIN))
        if not len(some):
            continue
        rows = near[some]
        d = distances(x[rows], now.centroids[members])
        state.scanned += d.size
        i = np.arange(len(rows))
        first = np.array([int(r.argmin()) for r in d], np.int64) if d.dtype == object else d.argmin(1)
        found, number = d[i, first], members[first]
        wins = (found < best[some]) | ((found == best[some]) & (number < cluster[rows]))
        roots = _root(d)
        roots[members[None, :] == before[some, None]] = np.inf  # the old centroid is put back below, if it lost
        roots[i[wins], first[wins]] = np.inf
        # a centroid that led until now and lost is one of the others of its group again
        lost = some[wins]
        led, led_by = cluster[near[lost]], _root(best[lost]) * (1 - MARGIN)
        lower[rows, g] = roots.min(1) * (1 - MARGIN)
        for h, other in enumerate(now.groups):
            mine = np.isin(led, other)
            at = near[lost[mine]]
            lower[at, h] = np.minimum(lower[at, h], led_by[mine])
        best[lost], cluster[near[lost]] = found[wins], number[wins]
    left_behind = cluster[near] != before
    at, g = near[left_behind], own_group[left_behind]
    lower[at, g] = np.minimum(lower[at, g], own_distance[left_behind])
    upper[near] = _root(best) * (1 + MARGIN)
    return state


def _state(b: pa.RecordBatch, groups: int) -> State:
    lower = np.asarray(b.column("lower").flatten(), np.float64).reshape(-1, groups)
    return State(np.asarray(b.column("cluster"), np.int64), np.array(b.column("upper"), np.float64), lower)


def _fits(values: np.ndarray) -> pa.Array:
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if v < 1 << 63 else None for v in values], pa.int64())


def kept_vectors(vectors: DataFrame, size: int = SIZE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and embedding of the rows that take part."""
    df = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    limit = float(1 << 63)
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & (x * SCALE >= -limit) & (x * SCALE < limit))
    return df.where((F.size("embedding") == size) & fits)


def first_centroids(kept: DataFrame, k: int, seed: str, size: int) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.orderBy(order, "embedding").select("embedding").limit(k).collect()  # k rows
    return whole(pa.array([r[0] for r in rows], pa.list_(pa.float64())), size)


def _assign(df: DataFrame, now: Round, size: int, fresh: bool) -> DataFrame:
    schema = f"vec_id {dict(df.dtypes)['vec_id']}, embedding array<double>, cluster int, upper double, lower array<double>, scanned long"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = whole(b.column("embedding"), size)
            s = first_assignment(x, now) if fresh else next_assignment(x, _state(b, len(now.groups)), now)
            bounds = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(now.groups)), pa.array(s.lower.ravel()))
            scanned = np.zeros(len(x), np.int64)
            scanned[0] = s.scanned
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), pa.array(s.cluster, pa.int32()), pa.array(s.upper), bounds, pa.array(scanned)], ["vec_id", "embedding", "cluster", "upper", "lower", "scanned"])

    return df.mapInArrow(make, schema)


def _new_centroids(state: DataFrame, old: np.ndarray, size: int) -> np.ndarray:
    """floor(sum / count) of each cluster's vectors; empty clusters keep their centroid."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for b in batches:
            x, cluster = whole(b.column("embedding"), size), np.asarray(b.column("cluster"))
            for c in np.unique(cluster):
                mine = x[cluster == c]
                n, s = total.get(int(c), (0, 0))
                total[int(c)] = (n + len(mine), s + mine.sum(0).astype(object))
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([n for n, _ in total.values()], pa.int64()), pa.array([[str(v) for v in s] for _, s in total.values()], pa.list_(pa.string()))],
                ["cluster", "n", "sums"],
            )

    parts = state.select("embedding", "cluster").mapInArrow(sums, "cluster int, n long, sums array<string>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("i", "s"))
    rows = each.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # k times `size` rows
    new = old.astype(object)
    for r in rows:
        new[r["cluster"], r["i"]] = int(r["s"]) // r["n"]
    most = max((abs(v) for v in new.ravel()), default=0)
    return new if most > IN_LONG else new.astype(np.int64)


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, size: int = SIZE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, embedding, cluster, exact squared distance, distances scanned for it) of every kept vector, and the final centroids."""
    kept = kept_vectors(vectors, size)
    centroids = first_centroids(kept, k, seed, size)
    if not len(centroids):
        return kept.select("vec_id", "embedding", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("scanned")).where("false"), centroids
    now = Round(centroids, groups_of(centroids))
    state = cut(_assign(kept, now, size, fresh=True))
    for _ in range(rounds):
        new = _new_centroids(state, now.centroids, size)
        step = (new - now.centroids).astype(np.float64)
        now = Round(new, now.groups, np.sqrt((step * step).sum(1)) * (1 + MARGIN))
        state = cut(_assign(state, now, size, fresh=False))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, at = whole(b.column("embedding"), size), np.asarray(b.column("cluster"))
            d = (now.centroids[at] - x).astype(object if max(abs(now.centroids).max(), abs(x).max() if x.size else 0) > IN_LONG else np.int64)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), b.column("cluster"), _fits((d * d).sum(1)), b.column("scanned")], ["vec_id", "embedding", "cluster", "distance", "scanned"])

    schema = f"vec_id {dict(state.dtypes)['vec_id']}, embedding array<double>, cluster int, distance long, scanned long"
    return state.select("vec_id", "embedding", "cluster", "scanned").mapInArrow(measure, schema), now.centroids


def op11_yinyang_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    found = found.drop("embedding", "scanned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count(F.when(F.col("distance").isNull(), 1)).alias("lost"))
    inertia = {r["cluster"]: None if r["lost"] else int(r["s"]) for r in sums.collect()}  # k rows
    total = None if None in inertia.values() else sum(inertia.values())
    fits = lambda v: v if v is not None and v < 1 << 63 else None
    rows = [(c, fits(v), fits(total), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, v in inertia.items()]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def _sql(rounds: int = ROUNDS, k: int = CLUSTERS) -> str:
    """Plain clustering: all distances in each round, least by (distance, number)."""
    parts = [
        f"e AS MATERIALIZED (SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings"
        f" WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v FROM (SELECT sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM e ORDER BY h, v LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        distance = "list_sum(list_transform(list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        parts.append(f"a{r} AS MATERIALIZED (SELECT row_id, min({{'d': CAST({distance} AS BIGINT), 'k': c.k}}) AS m FROM e, c{r} c GROUP BY row_id)")
        if r < rounds:
            parts.append(f"s{r} AS (SELECT m.k AS k, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM a{r} JOIN e USING (row_id))")
            parts.append(f"t{r} AS (SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM s{r} GROUP BY k, i)")
            parts.append(f"m{r} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM t{r} GROUP BY k)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON m.k = c.k)")
    last = (
        f"SELECT e.vec_id, CAST(a.m.k AS INTEGER) AS cluster, a.m.d AS distance, CAST(sum(a.m.d) OVER (PARTITION BY a.m.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.m.d) OVER () AS BIGINT) AS inertia,"
        f" sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} a JOIN e USING (row_id) JOIN c{rounds} c ON c.k = a.m.k"
    )
    return "WITH " + ",\n ".join(parts) + "\n" + last


SQL = _sql()
