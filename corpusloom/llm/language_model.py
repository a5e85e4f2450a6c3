"""LM scoring by a hashed maximum-entropy model with class-factored softmax and features of the words themselves.

The model starts from P0(word | history) = P(class | history) * P(word | class). Classes: one for the end of a text, one for each of
the most frequent training words, and the others for all remaining words by a hash of their last two bytes. P(class |
history) is a softmax over sums of weight rows: the classes of the three words before give n-gram
features (c1), (c1, c2) and skip features (c2), (c3), (c1, c3), each hashed to a row of one weight
table. P(word | class) is (count + 0.5) / (class tokens + 0.5 * (class words + 1)), so each class has room for
an unseen word and the probabilities add up to 1.

Training covers all training texts. In each of `ROUNDS` rounds the tasks take their share of the texts
(each text belongs to one round), make minibatch gradient updates (step sizes by row, from the sum of
squared gradients) starting from the common weights, and their weights are averaged row by row,
weighted by how often each task used the row. Averaging streams through fixed blocks of rows. Which texts a task trains on
follows the partitions of the input.

Features of the words themselves follow: the pair (w1, w), then the triple (w2, w1, w). Each step is
P(w | history) = (count(feature) + s * P'(w | history)) / (count(its history) + s), where P' is the step before and s is
k * (count(its history) + 1) ^ e (`STRENGTH`: k and e). That is the
exponential model P' * exp(weight) / Z whose weight for a feature is log(1 + count / (s * P')) and Z is 1 + count(history) / s:
the weights are set in closed form, not by gradient, and the probabilities still add up to 1. The counts cover every
feature of all training texts; a training text's own features are among them.

Counting and scoring: texts are packed into chunks of about `CHUNK` bytes. Word features are hashed to a table of at least 64 slots
for each byte of text, so its size grows with the input (two features in one slot are rare; a count is never taken as more than its history's).
Words frequent enough for a table of at most `FREQUENT` entries are looked up inside the tasks. All other words (by their whole hashes) and all
features meet in blocks of the key space, whose number grows with the input (`key_counts`); a chunk sends each of its keys once and gets the
count over all training texts back, so nothing that grows with the vocabulary is broadcast and a common key is no larger than a rare one.

Cases: null and empty texts consist of the end token alone. Null doc_ids are scored and count as held
out (their remainder is null). Repeated rows are counted and scored as often as they stand. Without training rows all
counts are 0, N and V are 0, and the class softmax is uniform. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .textkernel import mix, packed, runs, unpacked, utf8, word_bounds, word_hashes

FOLDS, HELD_OUT = 5, 1
CLASSES, WORD_CLASSES = 64, 31
ROWS = 1 << 14
ROUNDS = 2
FREQUENT = 1 << 18
BATCH = 4096
RATE = 0.4
BLOCK = 256
COUNTED = 1 << 19
CHUNK = 8 << 20
BLOCK_KEYS = 1 << 21
STRENGTH = ((4.0, 1.0), (2.0, 0.8))
END = np.uint64(0x5BD1E9955BD1E995)
_START = CLASSES


def _tokens(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with an end after each text, their tail codes (last two bytes), and the texts' offsets into them."""
    starts, ends, word_at = word_bounds(raw, at)
    n = len(at) - 1
    token_at = word_at + np.arange(n + 1)
    h = np.full(token_at[-1], END, np.uint64)
    tail = np.zeros(token_at[-1], np.int64)
    place = np.ones(token_at[-1], bool)
    place[token_at[1:] - 1] = False
    if len(starts):
        h[place] = word_hashes(raw, starts, ends)
        last, before = raw[ends - 1].astype(np.int64), np.where(ends - starts > 1, raw[np.maximum(ends - 2, 0)], 0).astype(np.int64)
        fold = lambda x: np.where((x >= 65) & (x <= 90), x + 32, x)
        tail[place] = fold(before) * 256 + fold(last)
    return h, tail, token_at


def tail_class(tail: np.ndarray) -> np.ndarray:
    """The class of a word that has none of its own."""
    spread = mix(tail.astype(np.uint64) + np.uint64(77)) >> np.uint64(40)
    return 1 + WORD_CLASSES + (spread % np.uint64(CLASSES - 1 - WORD_CLASSES)).astype(np.int64)


@dataclass
class Model:
    """What scoring needs, of fixed size: frequent words' hashes (sorted), counts, classes of the top words, and the weights."""

    words: np.ndarray
    counts: np.ndarray
    own: np.ndarray  # hashes of the words with a class of their own, sorted
    own_class: np.ndarray
    bias: np.ndarray
    norm: np.ndarray  # log10 of each class's denominator; 0 for classes of one word
    total: int
    distinct: int
    weights: np.ndarray

    def classes(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        out = tail_class(tail)
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
            hit = self.own[at] == h
            out[hit] = self.own_class[at[hit]]
        out[h == END] = 0
        return out

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Which of the hashes are frequent words'."""
        if not len(self.words):
            return np.zeros(len(h), bool)
        return self.words[np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)] == h


def features(cls: np.ndarray, token_at: np.ndarray) -> np.ndarray:
    """Rows of the weight table for each token, as short numbers (ROWS fit)."""
    place = np.arange(len(cls), dtype=np.int32) - np.repeat(token_at[:-1].astype(np.int32), np.diff(token_at))
    back = []
    for d in (1, 2, 3):
        c = np.full(len(cls), _START, np.uint16)
        c[d:] = cls[:-d] if d < len(cls) else cls[:0]
        c[place < d] = _START
        back.append(c)
    rows = np.empty((5, len(cls)), np.uint16)
    for k, (near, far) in enumerate(((0, None), (1, None), (2, None), (0, 1), (0, 2))):
        part = back[near].astype(np.uint64)
        if far is not None:
            part <<= np.uint64(16)
            part += back[far].astype(np.uint64) << np.uint64(24)
        part += np.uint64(k << 8)
        rows[k] = mix(part) % np.uint64(ROWS)
    return rows


def _probabilities(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, held: np.ndarray | None = None) -> np.ndarray:
    """Class probabilities of each token; `held` is room for two such tables, used again from batch to batch."""
    n = rows.shape[1]
    z, more = (np.empty((2, n, weights.shape[1]), np.float32) if held is None else held)[:, :n]
    np.take(weights, rows[0], 0, z, "clip")
    for r in rows[1:]:
        z += np.take(weights, r, 0, more, "clip")
    z += bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z *= 1 / (z @ np.ones(z.shape[1], np.float32))[:, None]
    return z


def class_scores(model: Model, cls: np.ndarray, token_at: np.ndarray) -> np.ndarray:
    """log10 P(class | history) of each token."""
    rows, out = features(cls, token_at), np.empty(len(cls))
    held = np.empty((2, BATCH, model.weights.shape[1]), np.float32)
    for i in range(0, len(cls), BATCH):
        p = _probabilities(model.weights, model.bias, rows[:, i : i + BATCH], held)
        out[i : i + BATCH] = np.log10(np.maximum(p[np.arange(len(p)), cls[i : i + BATCH]], 1e-30))
    return out


def update(weights: np.ndarray, squares: np.ndarray, used: np.ndarray, bias: np.ndarray, cls: np.ndarray, rows: np.ndarray, rate: float = RATE) -> None:
    """Minibatch gradient updates of the weights in place."""
    held, sorted_ = np.empty((2, BATCH, weights.shape[1]), np.float32), np.empty((BATCH, weights.shape[1]), np.float32)
    for i in range(0, len(cls), BATCH):
        part, want = rows[:, i : i + BATCH], cls[i : i + BATCH]
        g = _probabilities(weights, bias, part, held)
        g[np.arange(len(g)), want] -= 1
        for r in part.astype(np.uint16):  # ROWS fit; numbers this short are sorted by their digits
            order = np.argsort(r, kind="stable")
            r = r[order]
            start = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            row = r[start].astype(np.int64)
            step = np.add.reduceat(np.take(g, order, 0, sorted_[: len(g)], "clip"), start, axis=0)
            squares[row] += np.einsum("ij,ij->i", step, step)
            used[row] += np.diff(np.append(start, len(r)))
            step *= (rate / np.sqrt(squares[row] + 1.0))[:, None]
            weights[row] -= step


def _fold(column: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % FOLDS, F.lit(HELD_OUT))


def _packed_texts(held: list[pa.RecordBatch]) -> bytes:
    """doc_ids and texts as one compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for b in held:
            out.write_batch(b)
    return sink.getvalue().to_pybytes()


def _texts(body: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(body.as_buffer()).read_all().combine_chunks()


def chunked(docs: DataFrame, train: F.Column | None = None) -> DataFrame:
    """docs as rows of about CHUNK bytes of text (chunk, train, size, body), either of training texts or of others; written once, so a chunk stays what it is."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[pa.RecordBatch]] = {True: [], False: []}
        sizes = {True: 0, False: 0}

        def whole(learns: bool) -> pa.RecordBatch:
            number, body = held[learns][0]["rid"][:1], _packed_texts([x.select(["doc_id", "text"]) for x in held[learns]])
            out = pa.RecordBatch.from_arrays([number, pa.array([learns]), pa.array([sizes[learns]]), pa.array([body], pa.binary())], ["chunk", "train", "size", "body"])
            held[learns].clear()
            sizes[learns] = 0
            return out

        for b in batches:
            for learns in (True, False):
                part = b.filter(b["train"] if learns else pa.compute.invert(b["train"]))
                ends = np.cumsum(np.diff(utf8(part["text"])[1]))
                i = 0
                while i < part.num_rows:
                    before = ends[i - 1] if i else 0
                    j = min(part.num_rows, int(np.searchsorted(ends, before + CHUNK - sizes[learns], "left")) + 1)
                    held[learns].append(part.slice(i, j - i))
                    sizes[learns] += int(ends[j - 1] - before)
                    i = j
                    if sizes[learns] >= CHUNK:
                        yield whole(learns)
        for learns, parts in held.items():
            if parts:
                yield whole(learns)

    rows = docs.select("doc_id", "text", (_fold() != HELD_OUT if train is None else train).alias("train"), F.monotonically_increasing_id().alias("rid"))
    return cut(rows.mapInArrow(make, "chunk long, train boolean, size long, body binary"))


def _pieces(texts: pa.Array, lo: int = 0, hi: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Token hashes, tail codes and offsets of the texts from lo to before hi, in runs."""
    raw, offsets = utf8(texts.slice(lo, None if hi is None else hi - lo))
    for i, j in runs(offsets):
        yield _tokens(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def count_words(chunks: DataFrame) -> DataFrame:
    """w, tail and c of every token type of the chunks; counted over about COUNTED tokens at a time, then by Spark before and after the shuffle."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def counted() -> pa.RecordBatch:
            h, tail = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            w, first, c = np.unique(h, return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(tail[first].astype(np.int32)), pa.array(c)], ["w", "tail", "c"])

        for b in batches:
            for body in b["body"]:
                for h, tail, _ in _pieces(_texts(body)["text"]):
                    held.append((h, tail))
                    if sum(len(x) for x, _ in held) > COUNTED:
                        yield counted()
        if held:
            yield counted()

    return chunks.select("body").mapInArrow(make, "w long, tail int, c long").groupBy("w").agg(F.min("tail").alias("tail"), F.sum("c").alias("c"))


def prepare(counts: DataFrame, frequent: int = FREQUENT) -> Model:
    """A model without training from the count table; what is collected has at most about `frequent` rows."""
    levels = counts.groupBy("c").count().orderBy(F.desc("c")).limit(frequent + 1).collect()  # each level holds a word at least
    held, least = 0, None
    for c, n in levels:
        held += n
        if held > frequent:
            break
        least = c
    top = counts.where(F.col("c") >= least).toArrow() if least is not None else pa.table({"w": pa.array([], pa.int64()), "tail": pa.array([], pa.int32()), "c": pa.array([], pa.int64())})
    w, c = top["w"].to_numpy().view(np.uint64), top["c"].to_numpy()
    order = np.argsort(w)
    w, c = w[order], c[order]
    ranked = np.lexsort((w, -c))
    chosen = [i for i in ranked[: WORD_CLASSES + 1] if w[i] != END][:WORD_CLASSES]
    own, own_class = w[chosen], 1 + np.arange(len(chosen))
    order = np.argsort(own)
    # sums by tail over the words without a class of their own
    mine = np.append(own, END).view(np.int64).tolist()
    by_tail = counts.where(~F.col("w").isin(mine)).groupBy("tail").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()  # at most 65,536 rows
    tokens, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for tail, n, v in by_tail:
        k = int(tail_class(np.array([tail]))[0])
        tokens[k] += n
        types[k] += v
    norm = np.log10(tokens + 0.5 * (types + 1))
    norm[: 1 + len(chosen)] = 0
    tokens[1 : 1 + len(chosen)] = c[chosen]
    n_end = c[w == END]
    tokens[0] = n_end[0] if len(n_end) else 0
    if not len(n_end):
        ends = counts.where(F.col("w") == int(END.view(np.int64))).first()
        tokens[0] = ends["c"] if ends else 0
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    bias = np.log((tokens + 0.5) / (tokens.sum() + 0.5 * CLASSES)).astype(np.float32)
    return Model(w, c, own[order], own_class[order], bias, norm, int(total), int(distinct), np.zeros((ROWS, CLASSES), np.float32))


def train(chunks: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """One pass over the chunks' texts in `rounds` parts; after each, the tasks' weights are averaged."""
    context = chunks.sparkSession.sparkContext
    for r in range(rounds):
        held = context.broadcast(model)  # fixed size

        def learn(batches: Iterator[pa.RecordBatch], held=held, r=r) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            m = held.value
            weights, squares, used = m.weights.copy(), np.zeros(ROWS, np.float32), np.zeros(ROWS, np.int64)
            for b in batches:
                for body in b["body"]:
                    texts = _texts(body)["text"]
                    for h, tail, at in _pieces(texts, r * len(texts) // rounds, (r + 1) * len(texts) // rounds):
                        cls = m.classes(h, tail)
                        update(weights, squares, used, m.bias, cls, features(cls, at))
            for k in range(0, ROWS, BLOCK):
                if used[k : k + BLOCK].any():
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([weights[k : k + BLOCK].tobytes()], pa.binary()), pa.array([used[k : k + BLOCK].tobytes()], pa.binary())], ["block", "weights", "used"])

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list[np.ndarray]] = {}
            for b in batches:
                for k, w, u in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    use = np.frombuffer(u, np.int64)
                    if k not in sums:
                        sums[k] = [np.zeros((BLOCK, CLASSES)), np.zeros(BLOCK, np.int64)]
                    sums[k][0] += np.frombuffer(w, np.float32).reshape(BLOCK, CLASSES) * use[:, None]
                    sums[k][1] += use
            for k, (w, u) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([w.tobytes()], pa.binary()), pa.array([u.tobytes()], pa.binary())], ["block", "weights", "used"])

        schema = "block long, weights binary, used binary"
        pieces = chunks.select("body").mapInArrow(learn, schema)
        # first inside groups of tasks, then over all: no task gets every other task's block
        salted = pieces.repartition("block", F.spark_partition_id() % 16).mapInArrow(average_sums(average), schema)
        for row in salted.repartition("block").mapInArrow(average_sums(average), schema).collect():  # the weight table: fixed size
            use = np.frombuffer(row["used"], np.int64)
            mean = np.frombuffer(row["weights"], np.float32).reshape(BLOCK, CLASSES)
            block = model.weights[row["block"] : row["block"] + BLOCK]
            block[use > 0] = mean[use > 0]
        held.unpersist()
    return model


def average_sums(sums):  # noqa: ANN001, ANN201
    """The sums of weights by use, turned into means."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sums(batches):
            for k, w, u in zip(*(c.to_pylist() for c in b.columns), strict=True):
                use = np.frombuffer(u, np.int64)
                mean = np.frombuffer(w, np.float64).reshape(BLOCK, CLASSES) / np.maximum(use, 1)[:, None]
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([mean.astype(np.float32).tobytes()], pa.binary()), pa.array([u], pa.binary())], ["block", "weights", "used"])

    return make


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in rising order, how often each stands there, and the place of each value among them."""
    order = np.argsort(x)
    rising = x[order]
    new = np.ones(len(x), bool)
    np.not_equal(rising[1:], rising[:-1], out=new[1:])
    place = np.empty(len(x), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    start = np.flatnonzero(new)
    return rising[start], np.diff(np.append(start, len(x))), place


@dataclass
class Chunk:
    """A chunk's tokens, its distinct words in rising order with each token's place among them, and the slots of the tokens' word features."""

    h: np.ndarray
    tail: np.ndarray
    at: np.ndarray
    words: np.ndarray
    word: np.ndarray
    two: np.ndarray
    three: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, bits: int) -> Chunk:
        """Slots are the top `bits` bits of the features' hashes: those of (w1, w), and of (w2, w1, w) for all but a text's first token."""
        parts = list(_pieces(texts))
        h, tail = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
        at = np.concatenate([[0], *(np.diff(x[2]) for x in parts)]).cumsum()
        before = np.concatenate([[np.uint64(1)], h[:-1]])
        before[at[:-1]] = 1
        two = mix(mix(before + np.uint64(0xB1)) + h)
        past = np.concatenate([[np.uint64(0)], two[:-1]])
        three = mix(mix(past + np.uint64(0x731)) + h)
        keep = np.ones(len(h), bool)
        keep[at[:-1]] = False
        shift = np.uint64(64 - bits)
        words, _, word = _distinct(h)
        return cls(h, tail, at, words, word, two >> shift, three[keep] >> shift)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct slots in rising order, how often each stands here, and the place among them of each slot of `two` and `three`."""
        return _distinct(np.concatenate([self.two, self.three]))


def slot_bits(size: int) -> int:
    """Bits of a slot's number for so many bytes of text."""
    return min(60, max(20, int(size).bit_length()) + 6)


def _dealt(keys: np.ndarray, counts: np.ndarray, blocks: int, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Sorted keys of so many bits, as steps from one to the next, and their counts, by block of the key space."""
    low = np.array([(k << bits) // blocks for k in range(blocks)], np.uint64)
    at = np.append(np.searchsorted(keys, low), len(keys))
    for k in np.flatnonzero(np.diff(at)):
        part = slice(at[k], at[k + 1])
        yield int(k), packed(np.diff(keys[part], prepend=low[k])), packed(counts[part])


def key_counts(chunks: DataFrame, counts: DataFrame, model: Model, bits: int) -> DataFrame:
    """(chunk, block, c): how often the training texts have each of a chunk's rare words and slots, in their order.

    The key space is cut into blocks of about BLOCK_KEYS keys, first those of words, then those of slots; a chunk sends each key once to
    its block, where all chunks' counts meet.
    """
    spark = chunks.sparkSession
    held = spark.sparkContext.broadcast(model)
    size = chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (4 * BLOCK_KEYS)))  # a text has about one distinct slot for every four bytes
    of_words = max(1, -(-max(0, model.distinct - len(model.words)) // BLOCK_KEYS))
    least = int(model.counts.min()) if len(model.counts) else 1 << 62
    rest = counts.where(F.col("c") < least).select("w", "c")  # the words that aren't in the model
    names = ["chunk", "block", "keys", "counts"]
    types = (pa.int64(), pa.int32(), pa.binary(), pa.binary())

    def rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), types, strict=True)], names)

    def of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, learns, body in zip(b["chunk"].to_pylist(), b["train"].to_pylist(), b["body"], strict=True):
                chunk = Chunk.of(_texts(body)["text"], bits)
                words = chunk.words[~held.value.holds(chunk.words)]
                yield from rows([(number, *x) for x in _dealt(words, np.zeros(len(words), np.int64), of_words, 64)])
                keys, n, _ = chunk.keys()
                yield from rows([(number, of_words + k, *x) for k, *x in _dealt(keys, n if learns else np.zeros(len(n), np.int64), blocks, bits)])

    def of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, c = b["w"].to_numpy().view(np.uint64), b["c"].to_numpy()
            order = np.argsort(w)
            yield from rows([(None, *x) for x in _dealt(w[order], c[order], of_words, 64)])

    def meet(group: pa.Table) -> pa.Table:
        number, block = group["chunk"].to_pylist(), group["block"][0].as_py()
        keys = [np.cumsum(unpacked(x.as_buffer())) for x in group["keys"]]
        space, _, place = _distinct(np.concatenate(keys))
        counts = np.concatenate([unpacked(x.as_buffer()) for x in group["counts"]])
        sums = np.bincount(place, weights=counts, minlength=len(space)).astype(np.uint64)  # exact up to 2 ** 53
        sums = np.split(sums[place], np.cumsum([len(x) for x in keys])[:-1])
        out = [(i, block, packed(x)) for i, x in zip(number, sums, strict=True) if i is not None]
        return pa.table([pa.array([x[k] for x in out], types[k]) for k in range(3)], ["chunk", "block", "c"])

    schema = "chunk long, block int, keys binary, counts binary"
    both = chunks.select("chunk", "train", "body").mapInArrow(of_chunks, schema).union(rest.mapInArrow(of_counts, schema))
    return both.groupBy("block").applyInArrow(meet, "chunk long, block int, c binary")


def score(chunks: DataFrame, counts: DataFrame, model: Model, kind: str = "bigint") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every text of the chunks; counts are those of the training chunks' words."""
    held = chunks.sparkSession.sparkContext.broadcast(model)
    floor = float(np.log10(model.total + 0.5 * (model.distinct + 1)))
    bits = slot_bits(chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            for body, parts in zip(b["body"], b["parts"], strict=True):
                texts = _texts(body)
                chunk = Chunk.of(texts["text"], bits)
                there, place = m.holds(chunk.words), chunk.keys()[2]
                found = [unpacked(x["c"].as_buffer()) for x in sorted(parts or (), key=lambda x: x["block"].as_py())]
                found = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
                n_rare = int((~there).sum())
                if len(found) != n_rare + place.max() + 1:
                    raise ValueError("a chunk's counts don't fit its keys")
                of_words = np.empty(len(chunk.words), np.int64)
                of_words[there] = m.counts[np.searchsorted(m.words, chunk.words[there])]
                of_words[~there] = found[:n_rare]
                c = of_words[chunk.word]
                logs = np.log10(c + 0.5)
                classes = m.classes(chunk.h, chunk.tail)
                shared = (classes > WORD_CLASSES) | (classes > len(m.own))  # classes of several words
                p = 10 ** (class_scores(m, classes, chunk.at) - m.norm[classes] + np.where(shared, logs, 0.0))
                p = with_words(p, chunk.at, c, found[n_rare:][place])
                n = np.diff(chunk.at)
                owner = np.repeat(np.arange(len(n)), n)
                total = lambda x: np.bincount(owner, weights=x, minlength=len(n))  # noqa: E731, B023
                out = [pa.array(n), pa.array(total(c > 0).astype(np.int64)), pa.array(total(logs) - n * floor), pa.array(total(np.log10(np.maximum(p, 1e-300))))]
                yield pa.RecordBatch.from_arrays([texts["doc_id"].combine_chunks(), *out], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    parts = key_counts(chunks, counts, model, bits).groupBy("chunk").agg(F.collect_list(F.struct("block", "c")).alias("parts"))
    rows = chunks.select("chunk", "body").join(parts, "chunk", "left").select("body", "parts")
    return rows.mapInArrow(make, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def with_words(p: np.ndarray, at: np.ndarray, c: np.ndarray, found: np.ndarray) -> np.ndarray:
    """p of each token after the pair and triple features of the words: each step is (count + s * p) / (history's count + s).

    The history of a pair is its first word, or the start of a text (as many as ends); that of a triple is the pair before it.
    """
    two, three = found[: len(p)], np.zeros(len(p), np.int64)
    late = np.ones(len(p), bool)
    late[at[:-1]] = False
    three[late] = found[len(p) :]
    first, pair = np.repeat(c[at[1:] - 1], np.diff(at)), np.zeros(len(p), np.int64)
    first[late], pair[late] = c[np.flatnonzero(late) - 1], two[np.flatnonzero(late) - 1]
    for count, past, (k, e) in ((two, first, STRENGTH[0]), (three, pair, STRENGTH[1])):
        s = k * (past + 1.0) ** e
        p = (np.minimum(count, past) + s * p) / (past + s)
    return p


def score_documents(docs: DataFrame) -> DataFrame:
    """Learns from the training folds of docs and scores all rows."""
    chunks = chunked(docs)
    training = chunks.where("train")
    counts = cut(count_words(training))
    model = train(training, prepare(counts))
    found = score(chunks, counts, model, dict(docs.dtypes)["doc_id"])
    return found.select("doc_id", (_fold() == HELD_OUT).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def op3_maxent_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
