"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

A document's set is that of its distinct k-word shingles, as 64-bit hashes. Documents with equal sets
form one class; everything below works on classes, so exact copies are never paired.

Tiles. Set sizes are put in bands so that two linked sets lie in one band or in neighbouring bands.
For a band with upper size hi, linked sets differ in at most H = hi * (1 - t) / t elements. The hash
range is cut into more than H segments; two linked sets then agree in at least one whole segment. A
tile is (band of the smaller set, segment, hash of the set's part in it), and a class goes to one
tile for each of its non-empty segments, in its own band and, if near enough, the one below. Agreement in empty
segments alone is possible only when both sets have unusually many of them (they are "sparse");
only such sets also go to the tiles of their empty segments. So no link can be missed.

Two linked sets agree in most segments, not in one: a class leaves as many of its most crowded tiles as
that bound allows (`candidates`), so a passage that many documents share brings no one together.

Links. First, each class of a tile is compared with one leader, the class whose tiles hold most classes. The tiles' members are told inside each Arrow batch and then among the batches' leaders, so no task
ever holds a hot tile whole. Links found join classes to components. Then, for tiles that still hold
several components, all pairs of classes of different components are compared, in blocks of
at most `BLOCK` classes a side. Pairs inside one component need no comparison: they can't change it.

Comparison. A signature of 1024 parity bits bounds the overlap from above: every differing bit stands
for at least one element that the sets don't share, so overlap <= (|A| + |B| - differing bits) / 2.
Pairs that pass get the exact intersection of their sorted arrays.

Cases: null and empty texts, and texts of white space, have an empty set and are linked with
nothing. Repeated rows are linked with each other as equal sets. Null doc_ids are kept; such a row's
component_id is the smallest id that isn't null in its component, or null. An empty table gives
an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, release, running, table
from .textkernel import mix, runs, shingle_sets, utf8

K = 5
NUM, DEN = 80, 100
BITS = 1024
BLOCK = 1024
HOT = 500
_U = np.uint64


def bands(num: int = NUM, den: int = DEN, top: int = 1 << 40) -> np.ndarray:
    """Upper sizes of the bands, a half apart or more: a set linked with one of band b has at most the upper size of band b + 1."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, out[-1] * den // num, out[-1] * 3 // 2))
    return np.array(out, np.int64)


def _differ(size: np.ndarray, num: int, den: int) -> np.ndarray:
    """Most elements in which a set of this size and a linked one differ, the size being the smaller's or the larger's."""
    return size * (den - num) // num


def class_keys(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each set; the lowest bit of the first is free."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.concatenate([np.zeros(1, _U), np.cumsum(mix(h ^ _U(salt)), dtype=_U)])
        out.append(mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(_U)))
    return out[0] & ~_U(1), out[1]


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """BITS parity bits of each set, as rows of 64-bit words."""
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    bit = (mix(h ^ _U(0xA4093822299F31D0)) >> _U(32)).astype(np.int64) % BITS
    odd = (np.bincount(owner * BITS + bit, minlength=n * BITS) & 1).astype(np.uint8).reshape(n, BITS)
    return np.packbits(odd, axis=1, bitorder="little").view(_U).reshape(n, BITS // 64)


def _filled(h: np.ndarray, at: np.ndarray, below: int, num: int, den: int) -> tuple[np.ndarray, ...]:
    """For the band of each set (or the one below): whether the set goes there, the band, its number of segments, and how many of the set's
    filled segments any linked set must share with it; then the set, segment and bounds of each filled segment."""
    upper, size = bands(num, den), np.diff(at)
    p = np.searchsorted(upper, size, "left") - below
    top = upper[np.maximum(p, 0)]
    most = _differ(top, num, den)
    use = (size > 0) & (p >= 0) & (most > 0)
    if below:  # only sets that a smaller one of that band can be linked with
        use &= size * num <= top * den
    k = np.where(use, most + most * 6 // 100 + 5, 1)
    first = np.concatenate([[0], np.cumsum(k)])
    owner = np.repeat(np.arange(len(size)), size)
    # sets are in rising hash order, so a segment is a run of its set
    seg = first[owner] + (((h >> _U(32)) * k[owner].astype(_U)) >> _U(32)).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]])) if len(seg) else np.zeros(0, np.int64)
    end = np.append(start[1:], len(seg))
    who = owner[start]
    # every element that only one of two linked sets has spoils one segment at most
    apart = 2 * size * (den - num) // (den + num) if below else _differ(size, num, den)
    need = np.where(use, np.bincount(who, minlength=len(size)) - np.minimum(apart, most), 0)
    return use, p, k, need, who, seg[start] - first[who], start, end


def needs(h: np.ndarray, at: np.ndarray, num: int = NUM, den: int = DEN) -> tuple[np.ndarray, np.ndarray]:
    """How many tiles in its own band, and in the one below, a set shares at least with every set linked there (0 or less: no bound)."""
    return tuple(_filled(h, at, below, num, den)[3] for below in (0, 1))


def tiles(h: np.ndarray, at: np.ndarray, num: int = NUM, den: int = DEN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tile keys of the sets, each key's set number, and 1 where it is of the band below."""
    parts = mix(h ^ _U(0x082EFA98EC4E6C89))
    total = np.concatenate([np.zeros(1, _U), np.cumsum(parts, dtype=_U)])
    keys, owners, sides = [np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for below in (0, 1):
        use, p, k, need, who, seg, start, end = _filled(h, at, below, num, den)
        key = mix(total[end] - total[start] + mix(seg.astype(_U) + (p[who].astype(_U) << _U(48))))
        good = use[who]
        keys.append(key[good])
        owners.append(who[good])
        for i in np.flatnonzero(use & (need < 1)):  # sparse: agreement may be in empty segments alone
            empty = np.setdiff1d(np.arange(k[i]), seg[who == i])
            keys.append(mix(mix(empty.astype(_U) + (_U(p[i]) << _U(48))) + _U(0x452821E638D01377)))
            owners.append(np.full(len(empty), i))
        sides.append(np.full(sum(map(len, keys)) - sum(map(len, sides)), below))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(sides)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, offsets = utf8(batch.column("text"))
    for i, j in runs(offsets):
        yield i, j, *shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)


def memberships(docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, text_hash, n (set size), cls and cls2 (hashes of the set), bits (its signature), need0 and need1 (see needs) of every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, h, at in _sets(b, k):
                c, d = class_keys(h, at)
                bits = pa.array([x.tobytes() for x in signatures(h, at)], pa.binary())
                rows = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("text_hash"), pa.array(np.diff(at)), _long(c), _long(d), bits, *map(pa.array, needs(h, at, num, den))], names)

    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    names = ["doc_id", "text_hash", "n", "cls", "cls2", "bits", "need0", "need1"]
    return df.mapInArrow(make, "doc_id long, text_hash long, n long, cls long, cls2 long, bits binary, need0 long, need1 long")


def tile_rows(docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """(tile, cls, lead) of the classes that share a tile: each with its Arrow batch's leader, and the batches' leaders with the tile's leader.

    In both class columns the lowest bit is 1 if the tile is of the band below the class's own.

    Most tiles have one class only and end here. They cross the shuffle packed: a batch's leaders of
    one part of the tiles are one row, with 4 bytes for a tile (its part stands for the other
    bits; a mix-up only adds a candidate) and 8 for a class. The other classes of a batch's tiles
    are already paired with their leader and only pass by, spread over all parts. A class appears
    once for each task at most.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = 4 * n
    schema = "part int, tiles binary, classes binary, leads binary"
    names = ["part", "tiles", "classes", "leads"]

    def packed(part: np.ndarray, columns: list[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
        order = np.argsort(part, kind="stable")
        columns = [c[order] for c in columns]
        edge = np.searchsorted(part[order], np.arange(parts + 1))
        some = np.flatnonzero(np.diff(edge))
        blobs = [pa.array([c[edge[i] : edge[i + 1]].tobytes() for i in some], pa.binary()) for c in columns]
        blobs += [pa.nulls(len(some), pa.binary())] * (width - len(blobs))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *blobs], names)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            keys, classes = [], []
            for _, _, h, at in _sets(b, k):
                c = class_keys(h, at)[0].view(np.int64)
                fresh = []
                for x in c.tolist():
                    fresh.append(x not in seen)
                    seen.add(x)
                key, owner, side = tiles(h, at, num, den)
                use = np.array(fresh, bool)[owner]
                keys.append(key[use])
                classes.append(c[owner[use]] | side[use])
            key = np.concatenate(keys) if keys else np.zeros(0, _U)
            if not len(key):
                continue
            cls = np.concatenate(classes)
            part = (key % _U(parts)).astype(np.int64)
            key = (key >> _U(32) << _U(32)) | part.astype(_U)
            order = np.argsort(key)
            key, cls, part = key[order], cls[order], part[order]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            lead = np.repeat(np.minimum.reduceat(cls, start), np.diff(np.append(start, len(key))))
            own = lead == cls
            yield from packed(part[own], [(key[own] >> _U(32)).astype(np.uint32), cls[own]], 3)
            if not own.all():
                # spread by class, so a tile that very many share goes to no one task
                yield from packed((mix(cls[~own].view(_U)) % _U(parts)).astype(np.int64), [key[~own], cls[~own], lead[~own]], 3)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes]] = []
        at = -1

        def flush() -> Iterator[pa.RecordBatch]:
            tile = np.frombuffer(b"".join(t for t, _ in held), np.uint32)
            cls = np.frombuffer(b"".join(c for _, c in held), np.int64)
            order = np.argsort(tile, kind="stable")
            tile = tile[order]
            new = np.concatenate([[True], tile[1:] != tile[:-1]])
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(tile)))
            many = np.repeat(size > 1, size)
            tile, cls = tile[many], cls[order[many]]
            if len(tile):
                start = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
                size = np.diff(np.append(start, len(tile)))
                low, high = (np.repeat(f.reduceat(cls, start), size) for f in (np.minimum, np.maximum))
                yield from rows((tile[low < high].astype(_U) << _U(32)) | _U(at), cls[low < high], low[low < high])

        def rows(tile: np.ndarray, cls: np.ndarray, lead: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(tile), 50_000):
                s = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays([_long(tile[s]), pa.array(cls[s]), pa.array(lead[s])], ["tile", "cls", "lead"])

        for b in batches:
            for part, tile, cls, lead in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if lead is not None:
                    yield from rows(np.frombuffer(tile, _U), np.frombuffer(cls, np.int64), np.frombuffer(lead, np.int64))
                    continue
                if part != at:
                    if held:
                        yield from flush()
                    held, at = [], part
                held.append((tile, cls))
        if held:
            yield from flush()

    found = docs.select("text").mapInArrow(make, schema)
    return found.repartition(n, "part").sortWithinPartitions("part").mapInArrow(meet, "tile long, cls long, lead long")


#: Bits of the table that marks the rows whose sets are needed: of fixed size, and only a first sieve.
MARKS = 1 << 25


def marks(wanted: DataFrame, key: str) -> Broadcast:
    """A table with the bits of the keys (hashes) of wanted set; MARKS / 8 bytes, whatever the input."""
    at = F.pmod(F.col(key), F.lit(MARKS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(`{key}`, 64L) as int))")
    words = wanted.select(F.floor(at / 64).cast("int").alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    held = np.zeros(MARKS // 64, np.int64)
    held[words["w"].to_numpy()] = words["b"].to_numpy()
    return wanted.sparkSession.sparkContext.broadcast(held.view(np.uint8))


def _marked(batch: pa.RecordBatch, key: str, held: np.ndarray) -> pa.RecordBatch:
    """The rows whose key may be among those of the table: all that are, and few others while they are fewer than MARKS."""
    at = np.asarray(batch.column(key)) % MARKS
    return batch.filter(pa.array((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))


def set_rows(docs: DataFrame, held: Broadcast, k: int = K) -> DataFrame:
    """cls, n and hashes (sorted set) of the rows of docs (mark, text) whose mark is held; others may be among them."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = _marked(b, "mark", held.value)
            for _, _, h, at in _sets(b, k) if b.num_rows else ():
                hashes = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), _long(h))
                yield pa.RecordBatch.from_arrays([_long(class_keys(h, at)[0]), pa.array(np.diff(at)), hashes], ["cls", "n", "hashes"])

    return docs.select("mark", "text").mapInArrow(make, "cls long, n long, hashes array<long>")


def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The exact intersection size of the two sorted arrays of each row."""
    for b in batches:
        left, right = b.column("hashes_a"), b.column("hashes_b")
        a, ao = np.asarray(left.flatten()).view(_U), np.asarray(left.offsets) - left.offsets[0].as_py()
        c, co = np.asarray(right.flatten()).view(_U), np.asarray(right.offsets) - right.offsets[0].as_py()
        sizes = [len(np.intersect1d(a[ao[i] : ao[i + 1]], c[co[i] : co[i + 1]], assume_unique=True)) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("n_a"), b.column("n_b"), pa.array(sizes, pa.int64())], ["a", "b", "n_a", "n_b", "shared"])


def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `apart`, the number of differing signature bits of each row."""
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), _U).reshape(b.num_rows, -1) for c in ("bits_a", "bits_b"))
        apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(apart)], ["a", "b", "n_a", "n_b", "apart"])


def bounded(pairs: DataFrame, classes: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """The pairs (a, b) whose bit counts leave room for a link."""
    side = lambda x: classes.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where((F.col("n_a") * num <= F.col("n_b") * den) & (F.col("n_b") * num <= F.col("n_a") * den))
    counted = both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(bound, "a long, b long, n_a long, n_b long, apart long")
    return counted.where((num + den) * (F.col("n_a") + F.col("n_b") - F.col("apart")) >= 2 * num * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """The bounded pairs (a, b) that link by the exact intersection. Sets are made again, only for the classes that pairs name."""
    needed = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct().join(classes.select("cls", "rep"), "cls")
    needed = needed.select(F.xxhash64("rep.id", "rep.text_hash").alias("mark"))
    texts = docs.select(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), F.xxhash64("text")).alias("mark"), "text")
    sets = cut(set_rows(texts, marks(needed, "mark"), k).dropDuplicates(["cls"]))
    release(docs.sparkSession)
    side = lambda x: sets.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("hashes").alias(f"hashes_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    exact = both.select("a", "b", "n_a", "n_b", "hashes_a", "hashes_b").mapInArrow(overlap, "a long, b long, n_a long, n_b long, shared long")
    return exact.where(den * F.col("shared") >= num * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node of each component of edges (a, b), by alternating large and small stars."""
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = cut(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(roots.select("node", F.col("node").alias("comp")))


def _block_pairs(num: int, den: int):  # noqa: ANN202
    """Pairs of different components inside each cell whose signatures leave room for a link; rows come sorted by cell."""

    def pairs(cls: np.ndarray, comp: np.ndarray, n: np.ndarray, bits: np.ndarray, side: np.ndarray) -> list[np.ndarray]:
        out, cross = [], len(np.unique(side)) > 1
        for i in range(len(cls) - 1):
            j = slice(i + 1, None)
            ok = comp[j] != comp[i]
            if cross:
                ok &= side[j] != side[i]
            if not ok.any():
                continue
            apart = np.bitwise_count(bits[j] ^ bits[i]).sum(1, dtype=np.int64)
            total = n[j] + n[i]
            ok &= (num + den) * (total - apart) >= 2 * num * total
            ok &= den * np.minimum(n[j], n[i]) >= num * np.maximum(n[j], n[i])
            hit = cls[j][ok]
            if len(hit):
                out.append(np.column_stack([np.maximum(hit, cls[i]), np.minimum(hit, cls[i])]))
        return out

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            cell, cls, comp, n, bits, side = parts
            start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            found = []
            for s, e in zip(start, np.append(start[1:], len(cell)), strict=True):
                if e - s > 1:
                    found += pairs(cls[s:e], comp[s:e], n[s:e], bits[s:e], side[s:e])
            if found:
                both = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            now = [np.asarray(b.column(c)) for c in ("cell", "cls", "comp", "n")]
            now.append(np.frombuffer(b"".join(b.column("bits").to_pylist()), _U).reshape(b.num_rows, -1))
            now.append(np.asarray(b.column("side")))
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            last = int(np.searchsorted(now[0], now[0][-1], "left"))  # the last cell may go on in the next batch
            if last:
                yield from flush([x[:last] for x in now])
            held = [x[last:] for x in now]
        if held is not None:
            yield from flush(held)

    return make


def rest_pairs(candidates: DataFrame, comp: DataFrame, classes: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Pairs of classes of different components in one tile that the signatures don't rule out."""
    rows = candidates.join(comp.select(F.col("node").alias("cls"), "comp"), "cls", "left")
    rows = rows.withColumn("comp", F.coalesce("comp", "cls"))
    mixed = rows.groupBy("tile").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count("*").alias("_n")).where("_lo <> _hi").select("tile", "_n")
    rows = cut(rows.join(mixed, "tile"))
    ranked = running(rows, ["tile"], ["cls"], F.pmod(F.xxhash64("cls"), F.lit(256)))
    block, blocks = F.floor(F.col("rank0") / BLOCK), F.ceil(F.col("_n") / BLOCK)
    cells = ranked.select("tile", "cls", "comp", block.alias("side"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    cell = F.xxhash64("tile", F.least("side", "other"), F.greatest("side", "other"))
    cells = cells.select(cell.alias("cell"), "cls", "comp", "side").join(classes.select("cls", "n", "bits"), "cls")
    cells = cells.select("cell", "cls", "comp", "n", "bits", "side").repartition("cell").sortWithinPartitions("cell")
    return cells.mapInArrow(_block_pairs(num, den), "a long, b long").distinct()


def candidates(found: DataFrame, classes: DataFrame) -> DataFrame:
    """(tile, cls, weight): tile mates that can still be linked; weight is how many classes all tiles of the class hold.

    A class shares at least `need` tiles of a band with every class linked there. So it may leave its need - 1
    tiles with most classes: of the tiles that two linked classes share, that with the fewest classes stays for both. Classes
    that share only a passage or some lines with others have fewer shared tiles than that and are gone.
    """
    rows = found.select("tile", F.col("cls").alias("m")).union(found.select("tile", "lead")).distinct()
    rows = rows.join(rows.groupBy("tile").agg(F.count("*").alias("_n")), "tile")
    bounds = F.explode(F.array(F.struct(F.col("cls").alias("m"), F.col("need0").alias("need")), F.struct(F.col("cls").bitwiseOR(F.lit(1)).alias("m"), F.col("need1").alias("need"))))
    rows = rows.join(classes.select(bounds.alias("_x")).select("_x.*"), "m")
    own = Window.partitionBy("m")  # a class has a bounded number of tiles
    rows = rows.withColumn("_place", F.row_number().over(own.orderBy(F.desc("_n"), "tile"))).withColumn("weight", F.sum("_n").over(own))
    return rows.where("_place >= need").select("tile", F.col("m").bitwiseAND(F.lit(-2)).alias("cls"), "weight")


def leader_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): every class of a tile with its leader, the one whose tiles hold most classes: of a group of near copies, that nearest to all others."""
    low = rows.groupBy("tile").agg(F.max_by("cls", F.struct("weight", "cls")).alias("lead"), F.min("cls").alias("_low"), F.max("cls").alias("_high")).where("_low <> _high")
    pairs = rows.join(low.select("tile", "lead"), "tile").where("cls <> lead")
    return pairs.select(F.greatest("cls", "lead").alias("a"), F.least("cls", "lead").alias("b")).distinct()


def classes_of(members: DataFrame) -> DataFrame:
    """One row for each set that isn't empty: its keys, smallest doc_id, a representative row, its signature and how many rows have it."""
    key = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "text_hash")
    kept = members.where("n > 0").groupBy("cls", "cls2", "n", "need0", "need1")
    return kept.agg(F.min("doc_id").alias("class_id"), F.min(key).alias("rep"), F.min("bits").alias("bits"), F.count("*").alias("copies"))


def linked_components(rows: DataFrame, classes: DataFrame, docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """(node, comp) of the classes that link with others, from candidate rows (tile, cls, weight): first each with its tile's leader, then what is left in blocks."""
    first = cut(linked(cut(bounded(leader_pairs(rows), classes, num, den)), classes, docs, k, num, den))
    release(docs.sparkSession)
    comp = cut(components(first))
    rest = cut(rest_pairs(rows, comp, classes, num, den))
    return comp if rest.isEmpty() else components(first.union(linked(rest, classes, docs, k, num, den)))


def answers(members: DataFrame, classes: DataFrame, comp: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, class_id and component_id of every row of members.

    Sets that over one in `HOT` rows have are at most HOT, and meet their rows by broadcast; rows with an empty set need no class. So no
    set's rows gather in one task.
    """
    near = classes.select("cls", "cls2", "n", "class_id", "copies").join(comp.select(F.col("node").alias("cls"), "comp"), "cls", "left")
    near = cut(near.withColumn("comp", F.coalesce("comp", "cls")))
    lowest = near.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    ids = cut(near.join(lowest, "comp").select("cls", "cls2", "n", "class_id", "component_id", "copies"))
    rows, keys = members.select("doc_id", "text_hash", "cls", "cls2", "n"), ["cls", "cls2", "n"]
    common = F.col("copies") > F.lit(members.count() / HOT)
    many, few = ids.where(common).drop("copies"), ids.where(~common).drop("copies")
    full, empty = rows.where("n > 0"), rows.where("n = 0").withColumns({"class_id": F.lit(None).cast("long"), "component_id": F.lit(None).cast("long")})
    out = full.join(F.broadcast(many), keys).unionByName(full.join(F.broadcast(many.select(*keys)), keys, "left_anti").join(few, keys, "left")).unionByName(empty)
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"))


def join_components(docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, text_hash, n_shingles, class_id (smallest id with an equal set) and component_id of every row of docs (doc_id, text)."""
    members = cut(memberships(docs, k, num, den))
    classes = cut(classes_of(members))
    found = cut(tile_rows(docs, k, num, den))
    release(docs.sparkSession)
    rows = cut(candidates(found, classes))
    del found
    release(docs.sparkSession)
    return answers(members, classes, linked_components(rows, classes, docs, k, num, den))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")
