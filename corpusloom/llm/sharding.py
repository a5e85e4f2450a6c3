"""Sharding by a minimax contiguous partition of ordered, atomic groups.

Rows with equal texts form one group, which no shard boundary splits. Groups are ordered by the
size of the whole group, largest first, then by their text's digest. The smallest capacity that
lets the ordered groups be cut into the given number of contiguous shards is found by binary
search, each try checked greedily; the groups are then cut there. A group larger than an even
share of what is left gets a shard of its own and the search goes on over the rest, so one
huge group doesn't leave the other shards uneven.

The order puts equal sizes together, so the whole sequence is known from one row for each
distinct group size. There are at most sqrt(2 * total bytes) distinct sizes, whatever the number
of rows, and only those are sent to the driver; rows and groups stay on the executors. Where a
cut falls between groups of equal size, they are numbered by a two-level running count.

Cases: a null text counts as no bytes and is of one group with the empty text. Repeated rows are
rows of their own in their text's group. Null doc_ids are kept and come first in slot order. An
empty table gives an empty result. With fewer groups than shards some shards stay empty.
Only the two named columns are read, so other columns can't clash.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, running, table

SHARDS = 40
OVERHEAD = 16
BUCKETS = 1024


def _fill(sizes: list[int], counts: list[int], sums: list[int], start: tuple[int, int], room: int) -> tuple[int, int]:
    """(run, groups of it) up to which groups from `start` fill at most `room`."""
    run, off = start
    base = sums[run] + off * sizes[run] if run < len(sizes) else sums[-1]
    to = bisect_right(sums, base + room) - 1
    if to >= len(sizes):
        return len(sizes), 0
    used = max(to, run)
    more = (base + room - sums[used]) // sizes[used] if sizes[used] else counts[used]
    more = min(int(more), counts[used])
    return (used + 1, 0) if more == counts[used] else (used, more)


def minimax_cuts(runs: list[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """Where each shard after the first begins, as (run number, groups of that run before it), for runs (group size, groups)."""
    sizes, counts = [s for s, _ in runs], [c for _, c in runs]
    sums = [0]
    for s, c in runs:
        sums.append(sums[-1] + s * c)
    cuts, at = [], (0, 0)

    def rest(p: tuple[int, int]) -> int:
        return sums[-1] - (sums[p[0]] + p[1] * sizes[p[0]] if p[0] < len(sizes) else sums[-1])

    def feasible(p: tuple[int, int], left: int, room: int) -> bool:
        for _ in range(left):
            p = _fill(sizes, counts, sums, p, room)
        return p[0] >= len(sizes)

    for left in range(shards, 1, -1):
        even = -(-rest(at) // left)
        low = max(even, sizes[at[0]] if at[0] < len(sizes) else 0)
        high = max(low, rest(at))
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if feasible(at, left, middle) else (middle + 1, high)
        # under the capacity found, the cut nearest to an even share that leaves the rest feasible, or else the fullest
        full, near = _fill(sizes, counts, sums, at, low), _fill(sizes, counts, sums, at, even)
        if near < full:
            run, off = near
            step = (run + 1, 0) if off + 1 == counts[run] else (run, off + 1)
            short = even - (rest(at) - rest(near))
            near = step if sizes[run] - short <= short or near == at else near
        at = near if near != at and feasible(near, left - 1, low) else full
        cuts.append(at)
    return cuts


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, group (the text's digest), shard and slot of every row of docs."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("group"),
        )
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("group_size"))
    runs = sorted(((r[0], r[1]) for r in groups.groupBy("group_size").count().collect()), reverse=True)
    cuts = minimax_cuts(runs, shards)
    # a size's groups all go to one shard unless a cut falls inside it
    spans: list[tuple[int, int, int, int]] = []
    bounds = [(0, 0), *cuts, (len(runs), 0)]
    for k in range(shards):
        (r0, o0), (r1, o1) = bounds[k], bounds[k + 1]
        for r in range(r0, min(r1 + 1, len(runs))):
            lo, hi = (o0 if r == r0 else 0), (o1 if r == r1 else runs[r][1])
            if hi > lo:
                spans.append((runs[r][0], lo, hi, k))
    totals = dict(runs)
    split = {s for s, lo, hi, _ in spans if (lo, hi) != (0, totals[s])}
    # one row for each distinct size, and at most `shards` more
    places = spark.createDataFrame(spans or [(-1, 0, 0, 0)], "group_size long, lo long, hi long, shard int")
    whole = groups.where(~F.col("group_size").isin(*split)) if split else groups
    placed = whole.join(places.drop("lo", "hi"), "group_size").select("group", "shard")
    if split:
        inside = groups.where(F.col("group_size").isin(*split))
        inside = running(inside, ["group_size"], ["group"], F.conv(F.substring(F.hex("group"), 1, 3), 16, 10).cast("int"))
        inside = inside.join(places.where(F.col("group_size").isin(*split)), "group_size").where("rank0 >= lo and rank0 < hi")
        placed = placed.unionByName(inside.select("group", "shard"))
    rows = cut(rows.join(placed, "group"))
    return running(rows, ["shard"], ["doc_id", "group"], F.pmod(F.xxhash64("doc_id", "group"), F.lit(BUCKETS))).select(
        "doc_id", "size", "text_crc32", "group", "shard", F.col("rank0").alias("slot")
    )


def op10_shard_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.lower(F.hex("group")).alias("group_md5"))
