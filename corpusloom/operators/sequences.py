"""The matching-blocks similarity of two texts, in numpy: the same number as that of the standard library's matcher with its rule on frequent characters.

The matcher takes the longest run of equal characters (the earliest on ties), then does the same left and right of it. In a
second text of 200 characters or more, characters that make up over a hundredth of it start no run; they only lengthen one.
Here all runs of a pair are found once, by sorting the places where both texts agree by diagonal; a
rectangle left or right of a block clips them, so a step is one vectorised comparison and no text is scanned again. What both texts
have of each character bounds the similarity from above, so pairs that can't reach what is asked aren't compared at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the measure: how much of a text counts, and the rule on frequent characters.
MOST = 6000
FREQUENT_FROM, FREQUENT_PART = 200, 100
#: Characters share this many counters in the bound, which only makes it larger.
COUNTERS = 1 << 12


def codes(text: str | None, most: int = MOST) -> np.ndarray:
    return np.frombuffer((text or "")[:most].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def most_ratio(a: np.ndarray, b: np.ndarray) -> float:
    """No less than the ratio: characters in common, whatever their order."""
    if not len(a) + len(b):
        return 1.0
    both = np.minimum(np.bincount(a % COUNTERS, minlength=COUNTERS), np.bincount(b % COUNTERS, minlength=COUNTERS))
    return 2.0 * int(both.sum()) / (len(a) + len(b))


def _runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start in a, start in b, length) of the diagonal runs of equal characters that may start one."""
    order = np.argsort(b, kind="stable")
    letters, first, count = np.unique(b[order], return_index=True, return_counts=True)
    if len(b) >= FREQUENT_FROM:
        rare = count <= len(b) // FREQUENT_PART + 1
        letters, first, count = letters[rare], first[rare], count[rare]
    if not len(letters):
        return (np.zeros(0, np.int64),) * 3
    at = np.minimum(np.searchsorted(letters, a), len(letters) - 1)
    i = np.flatnonzero(letters[at] == a)
    n = count[at[i]]
    ia = np.repeat(i, n)
    jb = order[np.repeat(first[at[i]] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    key = np.sort((jb - ia + len(a)) * (len(a) + 1) + ia)  # by diagonal, then along it
    begins = np.flatnonzero(np.diff(key, prepend=-2) != 1)
    length = np.diff(np.append(begins, len(key)))
    diagonal, start = np.divmod(key[begins], len(a) + 1)
    return start, start + diagonal - len(a), length


def _same(x: np.ndarray, y: np.ndarray) -> int:
    """How many elements from the start on are equal."""
    for step in (32, len(x)):
        differ = np.flatnonzero(x[:step] != y[:step])
        if len(differ):
            return int(differ[0])
        if step >= len(x):
            break
    return len(x)


def ratio(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the characters in matching blocks by all characters; 1 for two empty texts."""
    if not len(a) + len(b):
        return 1.0
    total = 0
    open_ = [(0, len(a), 0, len(b), *_runs(a, b))]
    while open_:
        a0, a1, b0, b1, start, other, length = open_.pop()
        skip = np.maximum(np.maximum(a0 - start, b0 - other), 0)
        size = np.minimum(np.minimum(length, a1 - start), b1 - other) - skip
        inside = np.flatnonzero(size > 0)
        start, other, length, size = start[inside] + skip[inside], other[inside] + skip[inside], size[inside], size[inside]
        if len(size):
            longest = np.flatnonzero(size == size.max())
            k = longest[np.lexsort((other[longest], start[longest]))[0]]
            i, j, n = int(start[k]), int(other[k]), int(size[k])
        else:  # frequent characters can still match where the rectangle begins
            i, j, n = a0, b0, 0
        back = min(i - a0, j - b0)
        grown = _same(a[i - back : i][::-1], b[j - back : j][::-1]) if back else 0
        i, j, n = i - grown, j - grown, n + grown
        ahead = min(a1 - i - n, b1 - j - n)
        n += _same(a[i + n : i + n + ahead], b[j + n : j + n + ahead]) if ahead else 0
        if n:
            total += n
            if a0 < i and b0 < j:
                open_.append((a0, i, b0, j, start, other, length))
            if i + n < a1 and j + n < b1:
                open_.append((i + n, a1, j + n, b1, start, other, length))
    return 2.0 * total / (len(a) + len(b))


def with_ratio(pairs: DataFrame, a: str, b: str, need: Column | None = None, most: int = MOST) -> DataFrame:
    """Adds `ratio` of two texts' first `most` characters (the measure's own limit); null where it can't reach `need`. A null text counts as empty."""
    df = pairs.withColumn("_need", F.lit(None).cast("double") if need is None else need.cast("double"))
    names = pairs.columns
    schema = ", ".join([*(f"`{c}` {t}" for c, t in pairs.dtypes), "ratio double"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y, least in zip(batch.column(a).to_pylist(), batch.column(b).to_pylist(), batch.column("_need").to_pylist(), strict=True):
                x, y = codes(x, most), codes(y, most)
                found.append(None if least is not None and most_ratio(x, y) < least else ratio(x, y))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.float64())], [*names, "ratio"])

    return df.mapInArrow(make, schema)
