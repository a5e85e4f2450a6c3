"""Best-fit packing of token sequences by exact-complement hashing.

Documents become token ids (with an end id), and only those longer than a sequence are cut, into
full pieces and one shorter last piece. How the pieces are combined depends on their lengths
alone, and there are at most `length` different lengths, so the plan is made from the count of
each length, whatever the number of documents:

1. From the longest length down, the gap that is left in its sequence is looked up among the
   lengths still available: a single piece, else a pair, else a triple that fills it exactly. A
   combination found is consumed as often as the availability counts allow, so every step
   uses up at least one length and the plan stays small.
2. What can't be completed exactly is packed best-fit decreasing, again with counts: a length goes to
   the open gap that it fills best, sequences with equal contents being handled together.

Pieces are then numbered inside their length by a two-level running count, and each number finds its
sequence and offset by a binary search in its length's part of the plan.

Words are tokenised once for each worker and remembered, since the tokenizer never merges over white space nor
between letters, digits and marks; results are the same as for whole texts. Texts with any character
outside a plain set (apostrophes, angle brackets, other scripts) are only cut at white space.

Cases: null and empty texts are packed as the end id alone. Repeated rows are packed as often as
they stand. Null doc_ids are kept. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, running, table

LENGTH = 2048
END_ID = 0
BUCKETS = 512
CACHE_WORDS = 800_000
TEXTS_AT_ONCE = 128
_split = re.compile(r"[^ \t\r\n]+").findall
#: Letters whose lower case and normal form stand alone, digits, white space, and marks that neither join letters nor begin a special token.
_OTHER = re.compile(r"[^A-Za-zÀ-ÖØ-öø-ÿ0-9 \t\r\n!\"#$%&()*+,\-./:;=?@\[\\\]^_`{|}~]").search
_plain = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \t\r\n]+").findall
_cache: dict[str, dict[str, bytes]] = {}
_held: dict[str, object] = {}


def _tokenizer(path: str):  # noqa: ANN202
    if path not in _held:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _held[path], _cache[path] = Tokenizer.from_file(path), {}
    return _held[path], _cache[path]


def _words(text: str) -> list[str]:
    """Parts of a text that the tokenizer treats alone: where all characters are plain, runs of letters, single digits and runs of marks, in lower case; else runs without white space."""
    return _split(text) if _OTHER(text) else _plain(text.lower())


def token_bytes(texts: list[str | None], path: str, end_id: int = END_ID) -> Iterator[bytes]:
    """The little-endian 32-bit ids of each text with the end id."""
    tok, cache = _tokenizer(path)
    end = np.array([end_id], "<u4").tobytes()
    for i in range(0, len(texts), TEXTS_AT_ONCE):
        words = [_words(t or "") for t in texts[i : i + TEXTS_AT_ONCE]]
        if len(cache) > CACHE_WORDS:
            cache.clear()
        fresh = list(set().union(*words).difference(cache))
        for w, e in zip(fresh, tok.encode_batch_fast(fresh, add_special_tokens=False), strict=True):
            cache[w] = np.array(e.ids, "<u4").tobytes()
        for w in words:
            yield b"".join(map(cache.__getitem__, w)) + end


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False, remember: bool = True) -> DataFrame:
    """doc_id, text_hash, piece, start, length and ids_crc32 (and ids) of every piece of docs (doc_id, text).

    Unless told to `remember`, a worker drops its tokenised words with each task, for steps of other kinds that follow.
    """
    names = ["doc_id", "text_hash", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    df = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = f"doc_id {dict(df.dtypes)['doc_id']}, text_hash long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, of = [], []
            for i, ids in enumerate(token_bytes(b.column("text").to_pylist(), path, end_id)):
                for p, s in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[s : s + 4 * length]
                    of.append(i)
                    rows.append((p, s // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
            if not rows:
                continue
            take = pa.array(of, pa.int64())
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("text_hash").take(take), *columns], names)
        if not remember:
            _held.clear()
            _cache.clear()

    return df.mapInArrow(make, schema)


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths of the pieces) of each kind of sequence, for counts of pieces by length."""
    have = np.zeros(length + 1, np.int64)
    for n, c in counts.items():
        have[n] = c
    out: list[tuple[int, tuple[int, ...]]] = []

    def consume(parts: tuple[int, ...]) -> None:
        times = min(int(have[p]) // parts.count(p) for p in parts)
        for p in parts:
            have[p] -= times
        out.append((times, parts))

    def complement(first: int, gap: int) -> tuple[int, ...] | None:
        """The single, pair or triple with the longest pieces that fills the gap exactly, beside one piece of length first."""
        have[first] -= 1
        try:
            if have[gap] > 0:
                return (gap,)
            a = np.arange(gap - 1, gap // 2, -1) if gap > 1 else np.zeros(0, np.int64)
            hit = np.flatnonzero((have[a] > 0) & (have[gap - a] > 0))
            if len(hit):
                return (int(a[hit[0]]), gap - int(a[hit[0]]))
            if gap % 2 == 0 and gap and have[gap // 2] > 1:
                return (gap // 2, gap // 2)
            there = np.flatnonzero(have[:gap] > 0)
            for x in there[::-1]:
                rest = gap - int(x)
                y = there[(there <= x) & (there < rest) & (2 * there >= rest)]
                z = rest - y
                ok = (have[z] > 0) & (y <= x)
                ok &= have[x] >= 1 + (y == x) + (z == x)
                ok &= have[y] >= 1 + (z == y)
                if ok.any():
                    k = int(np.flatnonzero(ok)[-1])
                    return (int(x), int(y[k]), int(z[k]))
            return None
        finally:
            have[first] += 1

    if have[length]:
        consume((length,))
    for n in range(length - 1, 0, -1):
        while have[n]:
            found = complement(n, length - n)
            if found is None:
                break
            consume((n, *found))
    # best fit decreasing over what is left; open: gap -> kinds of sequences with it
    gaps: list[int] = []
    open_: dict[int, list[list]] = defaultdict(list)

    def put(gap: int, times: int, parts: tuple[int, ...]) -> None:
        if not open_[gap]:
            insort(gaps, gap)
        open_[gap].append([times, parts])

    for n in range(length - 1, 0, -1):
        left = int(have[n])
        while left:
            k = bisect_left(gaps, n)
            if k == len(gaps):
                each = length // n  # no open sequence has room: new ones, each with as many as fit
                full, more = divmod(left, each)
                if full:
                    put(length - each * n, full, (n,) * each)
                if more:
                    put(length - more * n, 1, (n,) * more)
                break
            gap = gaps[k]
            kind = open_[gap].pop()
            if not open_[gap]:
                gaps.pop(k)
            each = gap // n
            times = min(kind[0], left // each)
            if times:
                put(gap - each * n, times, kind[1] + (n,) * each)
                left -= times * each
                if kind[0] > times:
                    put(gap, kind[0] - times, kind[1])
            else:
                put(gap - left * n, 1, kind[1] + (n,) * left)
                if kind[0] > 1:
                    put(gap, kind[0] - 1, kind[1])
                left = 0
    out += [(t, p) for kinds in open_.values() for t, p in kinds]
    return out


def places(made: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """For each length, rows (first number, first sequence, sequences, pieces of this length in each, first offset), by first number."""
    out: dict[int, list] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for times, parts in made:
        offset, i = 0, 0
        while i < len(parts):
            n, j = parts[i], i
            while j < len(parts) and parts[j] == n:
                j += 1
            out[n].append((used[n], sequence, times, j - i, offset))
            used[n] += times * (j - i)
            offset += n * (j - i)
            i = j
        sequence += times
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def pack(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """Adds sequence_id and offset to cut pieces."""
    spark = found.sparkSession
    counts = {r[0]: r[1] for r in found.groupBy("length").count().collect()}  # at most `length` rows
    made = [(t, tuple(sorted(p, reverse=True))) for t, p in plan(counts, length)]
    at = spark.sparkContext.broadcast(places(made))  # a few rows for each length
    order = ["doc_id", "text_hash", "piece"]
    ranked = running(found, ["length"], order, F.pmod(F.xxhash64(*order), F.lit(BUCKETS)))
    keep = found.columns
    schema = ", ".join([*(f"`{c}` {t}" for c, t in found.dtypes), "sequence_id long", "offset long"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, rank = np.asarray(b.column("length")), np.asarray(b.column("rank0"))
            sequence, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for x in np.unique(n):
                rows, mine = at.value[int(x)], n == x
                kind = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                k = rank[mine] - kind[:, 0]
                sequence[mine] = kind[:, 1] + k // kind[:, 3]
                offset[mine] = kind[:, 4] + (k % kind[:, 3]) * x
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])

    return ranked.select(*keep, "rank0").mapInArrow(make, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH, remember: bool = True) -> DataFrame:
    return pack(cut(pieces(docs, path or default_tokenizer(), length, remember=remember)), length)


def op6_pack_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pack_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
