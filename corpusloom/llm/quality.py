"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a row of numeric features (`FEATURES`), counted by numpy over the UTF-8 bytes
of the whole text. Each feature is cut into quantile bins. Training is cyclic boosting: the features
are visited in turn, each time a shallow tree (two cuts, so three leaves) is fitted to the current
residuals over the feature's bins and a small step of it is added to the feature's lookup table.
After the main effects, the feature pairs whose four-quadrant tree would lower the loss most
get two-way tables, boosted in the same cyclic way. A score is the sigmoid of the intercept plus
one table entry for each feature and pair, added up for whole Arrow batches at once.

Labels are learnt from at most `max_rows` labelled rows (the smallest hashes of doc_id, so always the
same ones), which bounds what reaches the driver; everything else runs over all rows.

Cases: a null text counts as empty, and an empty text gets the score of all-zero features. Null
labels and labels of documents that don't exist are ignored; repeated label rows count as often as
they stand. Null doc_ids are scored, never learnt from, and count as held out (their remainder is
null). Without any usable label, or with one class only, every score is the smoothed share of
label 1. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .textkernel import runs, utf8, word_bounds, word_hashes

FOLDS, HELD_OUT = 3, 1
MAX_ROWS = 20_000
FEATURES = (
    "log_words", "mean_word", "word_spread", "long_words", "upper", "digits", "commas_stops", "symbols", "pipes", "exclaims", "repeat_marks",
    "non_ascii", "mark_words", "upper_words", "line_words", "short_lines", "repeat_lines", "distinct_words", "top_word", "repeat_words", "ends_stop", "slashes_ats",
)
_CLASS = np.zeros((8, 256), bool)
_CLASS[0, ord("A") : ord("Z") + 1] = True
_CLASS[1, ord("0") : ord("9") + 1] = True
_CLASS[2, [ord(c) for c in ".,;:'"]] = True
_CLASS[3, [ord(c) for c in "#$%&*+<=>^_~{}[]()\\\"`"]] = True
_CLASS[4, ord("|")] = True
_CLASS[5, [ord(c) for c in "!?"]] = True
_CLASS[6, 128:] = True
_CLASS[7, [ord(c) for c in "/@"]] = True
_MARK = _CLASS[2] | _CLASS[3] | _CLASS[4] | _CLASS[5] | _CLASS[7]


def _sums(mask: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


def _groups(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each owner: distinct values and the largest number of equal values."""
    if not len(values):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    sizes = np.diff(np.append(at, len(v)))
    most = np.zeros(n)
    np.maximum.at(most, o[at], sizes)
    return np.bincount(o[at], minlength=n).astype(float), most


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of the concatenated bytes."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)), np.float32)
    for i, j in runs(offsets):
        part, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        out[i:j] = _features(part, at)
    return out


def _features(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    n, size = len(at) - 1, np.maximum(np.diff(at), 1).astype(float)
    starts, ends, word_at = word_bounds(raw, at)
    lengths = (ends - starts).astype(float)
    n_words = np.diff(word_at)
    some = np.maximum(n_words, 1).astype(float)
    owner = np.repeat(np.arange(n), n_words)
    by = {k: _sums(_CLASS[k][raw], at) / size for k in range(8)}
    mark = np.concatenate([[0], np.cumsum(_MARK[raw])])
    marks = mark[ends] - mark[starts]
    upper = np.concatenate([[0], np.cumsum(_CLASS[0][raw])])
    uppers = upper[ends] - upper[starts]
    mean = _sums_of(lengths, word_at) / some
    spread = np.sqrt(np.maximum(_sums_of(lengths**2, word_at) / some - mean**2, 0))
    hashes = word_hashes(raw, starts, ends) if len(raw) else np.zeros(0, np.uint64)
    distinct, most = _groups(hashes, owner, n)
    twice = np.zeros(len(hashes), bool)
    twice[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    same = np.zeros(len(raw), bool)
    same[1:] = (raw[1:] == raw[:-1]) & _MARK[raw[1:]]
    # lines: words between line ends
    line_ends = np.concatenate([[0], np.cumsum(raw == 10)])
    line = line_ends[starts] if len(starts) else np.zeros(0, np.int64)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])
    line_at = np.flatnonzero(fresh)
    line_owner = owner[line_at]
    line_len = np.diff(np.append(line_at, len(starts)))
    n_lines = np.maximum(np.bincount(line_owner, minlength=n), 1).astype(float)
    mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * np.uint64(0x9E3779B97F4A7C15), dtype=np.uint64)])
    line_hash = mixed[np.append(line_at[1:], len(starts))] - mixed[line_at] if len(line_at) else np.zeros(0, np.uint64)
    line_distinct, _ = _groups(line_hash, line_owner, n)
    last = raw[np.maximum(at[1:] - 1, 0)] if len(raw) else np.zeros(n, np.uint8)
    return np.column_stack(
        [
            np.log1p(n_words), mean, spread, _sums(lengths > 14, word_at) / some, by[0], by[1], by[2], by[3], by[4], by[5], _sums(same, at) / size,
            by[6], _sums_of(marks / np.maximum(lengths, 1) > 0.25, word_at) / some, _sums((uppers > 1) & (uppers * 2 > lengths - marks), word_at) / some,
            n_words / n_lines, np.bincount(line_owner, weights=line_len < 4, minlength=n) / n_lines, 1 - np.maximum(line_distinct, 1) / n_lines,
            distinct / some, most / some, _sums(twice, word_at) / some, np.isin(last, [46, 33, 63, 10]) & (np.diff(at) > 0), by[7],
        ]
    )


def _sums_of(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
    return total[edges[1:]] - total[edges[:-1]]


@dataclass
class Model:
    """Lookup tables over binned features. `edges[f]` are the bins' upper bounds of feature f."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += values[np.searchsorted(edges, x[:, f], "left")]
        for (f, g), (ef, eg), values in zip(self.pairs, self.pair_edges, self.pair_tables, strict=True):
            total += values[np.searchsorted(ef, x[:, f], "left"), np.searchsorted(eg, x[:, g], "left")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _quantiles(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Leaf values by bin of the best tree with two cuts, from the gradient and curvature sums of the bins."""
    cg, ch = np.cumsum(g), np.cumsum(h)

    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, -1
        g0, h0 = (cg[lo - 1], ch[lo - 1]) if lo else (0.0, 0.0)
        lg, lh = cg[lo : hi - 1] - g0, ch[lo : hi - 1] - h0
        tg, th = cg[hi - 1] - g0, ch[hi - 1] - h0
        gains = _gain(lg, lh, ridge) + _gain(tg - lg, th - lh, ridge) - _gain(tg, th, ridge)
        k = int(np.argmax(gains))
        return float(gains[k]), lo + k + 1

    bounds = [0, len(g)]
    for _ in range(2):
        options = [best(a, b) for a, b in zip(bounds, bounds[1:], strict=False)]
        gain, where = max(options)
        if where < 0 or gain <= 1e-9:
            break
        bounds = sorted([*bounds, where])
    values = np.empty(len(g))
    for a, b in zip(bounds, bounds[1:], strict=False):
        values[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return values


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, rate: float = 0.15, ridge: float = 5.0, n_pairs: int = 8, pair_bins: int = 8, pair_rounds: int = 40) -> Model:
    """Cyclic boosting of main effects, then of the pairs that promise most."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    model = Model(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    total = np.full(len(y), model.intercept)
    width = x.shape[1]
    model.edges = [_quantiles(x[:, f], bins) for f in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    place = [np.searchsorted(e, x[:, f], "left") for f, e in enumerate(model.edges)]
    for _ in range(rounds):
        for f in range(width):
            n = len(model.tables[f])
            if n == 1:
                continue
            p = 1 / (1 + np.exp(-total))
            step = rate * _tree(np.bincount(place[f], y - p, n), np.bincount(place[f], p * (1 - p), n), ridge)
            model.tables[f] += step
            total += step[place[f]]
    coarse = [_quantiles(x[:, f], pair_bins) for f in range(width)]
    at = [np.searchsorted(e, x[:, f], "left") for f, e in enumerate(coarse)]
    p = 1 / (1 + np.exp(-total))
    promise = []
    for f in range(width):
        for g in range(f + 1, width):
            shape = (len(coarse[f]) + 1, len(coarse[g]) + 1)
            if min(shape) < 2:
                continue
            cell = at[f] * shape[1] + at[g]
            gs = np.bincount(cell, y - p, shape[0] * shape[1]).reshape(shape).cumsum(0).cumsum(1)
            hs = np.bincount(cell, p * (1 - p), shape[0] * shape[1]).reshape(shape).cumsum(0).cumsum(1)
            a, b = slice(None, -1), slice(None, -1)
            quadrant = [gs[a, b], gs[a, -1:] - gs[a, b], gs[-1:, b] - gs[a, b], gs[-1, -1] - gs[a, -1:] - gs[-1:, b] + gs[a, b]]
            weight = [hs[a, b], hs[a, -1:] - hs[a, b], hs[-1:, b] - hs[a, b], hs[-1, -1] - hs[a, -1:] - hs[-1:, b] + hs[a, b]]
            promise.append((float(sum(_gain(q, w, ridge) for q, w in zip(quadrant, weight, strict=True)).max()), f, g))
    for _, f, g in sorted(promise, reverse=True)[:n_pairs]:
        model.pairs.append((f, g))
        model.pair_edges.append((coarse[f], coarse[g]))
        model.pair_tables.append(np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1)))
    for _ in range(pair_rounds):
        for (f, g), values in zip(model.pairs, model.pair_tables, strict=True):
            p = 1 / (1 + np.exp(-total))
            cell = at[f] * values.shape[1] + at[g]
            gs = np.bincount(cell, y - p, values.size).reshape(values.shape)
            hs = np.bincount(cell, p * (1 - p), values.size).reshape(values.shape)
            # a shallow tree: the best cut of f, then the best cuts of g on either side
            cg, ch = gs.sum(1).cumsum(), hs.sum(1).cumsum()
            gains = _gain(cg[:-1], ch[:-1], ridge) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1], ridge)
            k = int(np.argmax(gains)) + 1
            step = np.empty_like(values)
            step[:k] = _tree(gs[:k].sum(0), hs[:k].sum(0), ridge)
            step[k:] = _tree(gs[k:].sum(0), hs[k:].sum(0), ridge)
            values += rate * step
            total += rate * step.reshape(-1)[cell]
    return model


def feature_rows(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and a float array of FEATURES for each row, whole texts."""
    df = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes if c != "_text"), "features array<float>"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(*utf8(b.column("_text")))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), lists], [*keep, "features"])

    return df.mapInArrow(make, schema)


def lessons(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id and quality of at most max_rows labels of the training folds whose documents are in docs (doc_id), those with the smallest hashes of doc_id."""
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    usable = labels.where((fold != HELD_OUT) & F.col("quality").isNotNull()).select("doc_id", "quality")
    return usable.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)


def learn(rows: DataFrame, chosen: DataFrame, max_rows: int = MAX_ROWS, **settings: float) -> Model:
    """A model from feature rows (doc_id, features) and the chosen labels (doc_id, quality), which are at most max_rows."""
    found = rows.select("doc_id", "features").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows).toArrow()
    x = np.array(found["features"].combine_chunks().flatten(), np.float32).reshape(-1, len(FEATURES))
    y = (found["quality"].to_numpy() > 0).astype(float)
    order = np.lexsort([*x.T[::-1], y])  # the fit doesn't depend on the order in which rows came
    return fit(x[order], y[order], **settings)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """Feature rows with `score` in place of the features."""
    held = rows.sparkSession.sparkContext.broadcast(model)  # some tens of KB
    keep = [c for c in rows.columns if c != "features"]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes if c != "features"), "score double"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column("features").flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(held.value.score(x))], [*keep, "score"])

    return rows.mapInArrow(make, schema)


def passing(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that the model scores at `least` or more, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                yield part.filter(pa.array(held.value.score(features(*utf8(part.column(text_col)))) >= least))

    return docs.mapInArrow(make, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, text_hash, held_out, score and predicted for every row of docs."""
    rows = cut(feature_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), keep=("doc_id", "text_hash")))
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    found = scored(rows, learn(rows, cut(lessons(rows, labels, max_rows)), max_rows))
    return found.select("doc_id", "text_hash", F.coalesce(fold == HELD_OUT, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")
