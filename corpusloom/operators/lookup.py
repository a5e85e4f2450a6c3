"""Lookups and matches beyond plain equality: fallback chains, prefixes, ranges, substrings, time windows and best similarity.

A lookup table is broadcast only if its size, as counted, is within SMALL rows; beyond that Spark chooses the join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import dice, tokens
from . import sequences
from .select import pick_best

SMALL = 100_000


def checked_broadcast(df: DataFrame, most: int = SMALL) -> DataFrame:
    """df with a broadcast hint if it has at most `most` rows (counting stops there), or as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def fallback(df: DataFrame, sources: list[tuple[DataFrame, str, str]], key: str, default: object = None) -> DataFrame:
    """Adds `value` and `hit`: the value of the first source that has the key. A source is (table, its key column, its value column) with distinct keys."""
    out = df
    for i, (table, k, v) in enumerate(sources):
        out = out.join(table.select(F.col(k).alias(key), F.col(v).alias(f"_v{i}")), key, "left")
    values = [F.col(f"_v{i}") for i in range(len(sources))]
    hit = F.coalesce(*[F.when(v.isNotNull(), F.lit(i)) for i, v in enumerate(values)])
    value = F.coalesce(*values, F.lit(default)) if default is not None else F.coalesce(*values)
    return out.withColumn("value", value).withColumn("hit", hit).drop(*[f"_v{i}" for i in range(len(sources))])


def longest_prefix(df: DataFrame, table: DataFrame, code: str, lengths: tuple[int, ...], default: object = None) -> DataFrame:
    """Adds `value` of the longest of the given prefixes of the code that stands in the table (prefix, value)."""
    table = checked_broadcast(table)
    out, found = df, []
    for n in sorted(lengths, reverse=True):
        part = table.where(F.length("prefix") == n).select(F.col("prefix").alias(f"_p{n}"), F.col("value").alias(f"_v{n}"))
        out = out.join(part, F.substring(F.col(code), 1, n) == F.col(f"_p{n}"), "left")
        found.append(F.col(f"_v{n}"))
    value = F.coalesce(*found, *([F.lit(default)] if default is not None else []))
    return out.withColumn("value", value).drop(*[f"_{x}{n}" for n in lengths for x in "pv"])


def range_bucket(value: Column, ranges: list[tuple[int, int, str]], default: str | None = None) -> Column:
    """The label of the first range (low, high, both included) that holds the value."""
    out = F.when(value.between(ranges[0][0], ranges[0][1]), ranges[0][2])
    for low, high, label in ranges[1:]:
        out = out.when(value.between(low, high), label)
    return out.otherwise(F.lit(default))


def substring_match(df: DataFrame, table: DataFrame, name: str, term: str, order: list[Column], least: int = 4, held: str | None = None) -> DataFrame:
    """Each row with its first (by order) entry of a small table whose term is in the name, or holds the name (or the column `held`); names and terms under `least` letters don't match."""
    long = (F.length(name) >= least) & (F.length(term) >= least)
    hit = long & (F.contains(F.col(name), F.col(term)) | F.contains(F.col(term), F.col(held or name)))
    return pick_best(df.join(checked_broadcast(table), hit), [name], order)


def window_pairs(left: DataFrame, right: DataFrame, key: str, start: str, when: str, days: int) -> DataFrame:
    """Left rows (numbered in _row) with the right rows of their key whose date lies 0 to `days` days after the start.

    Dates are put in buckets of `days` + 1 days and joined on (key, bucket), so a key with many rows
    is spread over its buckets and no pair far outside the window is formed.
    """
    size = days + 1
    number = lambda c: F.floor(F.unix_date(F.col(c).cast("date")) / size)
    a = left.withColumn("_row", F.monotonically_increasing_id()).withColumn("_bucket", F.explode(F.array(number(start), number(start) + 1)))
    b = right.withColumn("_bucket", number(when))
    gap = F.datediff(F.col(when), F.col(start))
    return a.join(b, [key, "_bucket"]).withColumn("days", gap).where(F.col("days").between(0, days)).drop("_bucket")


def window_match(left: DataFrame, right: DataFrame, key: str, start: str, when: str, days: int, order: list[Column]) -> DataFrame:
    """For each left row its best right row in the window, if any."""
    return pick_best(window_pairs(left, right, key, start, when, days), ["_row"], order).drop("_row")


def by_key_or_place(chunks: DataFrame, answers: DataFrame, group: str, chunk: str, key: str, place: str) -> DataFrame:
    """Chunks with their answers, by key; by place in groups whose answers have no key at all. Both are one equality join on a tagged key."""
    keyed = answers.groupBy(group).agg((F.count(key) > 0).alias("_keyed"))
    right = answers.join(keyed, group).withColumn("_k", F.when(F.col("_keyed"), F.col(key)).otherwise(F.col(place))).drop(key, place, "_keyed")
    left = chunks.join(keyed, group, "left").withColumn("_k", F.when(F.coalesce("_keyed", F.lit(True)), F.col(chunk)).otherwise(F.col(place)))
    return left.join(right, [group, "_k"], "left").drop("_k", "_keyed")


def greedy_assign(pairs: DataFrame, key: str, visit: list[str], prefer: list[str], left_id: str, right_id: str) -> DataFrame:
    """One-to-one matches inside each key: left rows in the order of `visit`, each taking its first unused right row by `prefer`.

    Each choice depends on those before it, so a key's candidate pairs (already limited to a window) are walked in order: a task sorts
    the pairs of its keys and they pass by in batches, without a call or a frame for each key.
    """
    kinds = dict(pairs.dtypes)
    order = [*visit, left_id, *prefer, right_id]
    names = [key, left_id, right_id]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, done, used = object(), set(), set()  # the key, its left rows that have found one, and its right rows in use
        for b in batches:
            keep = []
            for i, (k, x, y) in enumerate(zip(*(b.column(c).to_pylist() for c in names), strict=True)):
                if k != own:
                    own, done, used = k, set(), set()
                if x not in done and y not in used:
                    done.add(x)
                    used.add(y)
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(keep, pa.int64())) for c in names], names)

    rows = pairs.select(*dict.fromkeys([key, *order])).repartition(key).sortWithinPartitions(key, *(F.col(c).asc_nulls_last() for c in order))
    return rows.select(*names).mapInArrow(walk, ", ".join(f"`{c}` {kinds[c]}" for c in names))


def dice_pairs(a: DataFrame, b: DataFrame, least: float, id_a: str, id_b: str, within: Sequence[str] = ()) -> DataFrame:
    """(within, id_a, id_b, ta, tb, score) of rows of a (within, id_a, ta) and b (within, id_b, tb) whose token sets have a Dice score of at least `least` (over 0).

    Candidates share a token: a Dice score of at least t needs a common token among each side's first
    (1 - t / (2 - t)) of tokens in a global order, here by rising document frequency (prefix filter), so frequent words form no pairs.
    """
    frequency = a.select(F.explode("ta").alias("token")).union(b.select(F.explode("tb"))).groupBy("token").agg(F.count("*").alias("df"))

    def prefix(df: DataFrame, key: str, column: str) -> DataFrame:
        rows = df.select(*within, key, F.size(column).alias("_n"), F.explode(column).alias("token")).join(frequency, "token")
        place = F.row_number().over(Window.partitionBy(*within, key).orderBy("df", "token"))
        # no rounding may leave out a token, so a hair is taken off
        keep = F.col("_n") - F.ceil(F.col("_n") * (least / (2 - least)) - 1e-9) + 1
        return rows.withColumn("_place", place).where(F.col("_place") <= keep).select(*within, key, "token")

    pairs = prefix(a, id_a, "ta").join(prefix(b, id_b, "tb"), [*within, "token"]).select(*within, id_a, id_b).distinct()
    return pairs.join(a, [*within, id_a]).join(b, [*within, id_b]).withColumn("score", dice(F.col("ta"), F.col("tb"))).where(F.col("score") >= least)


def best_token_match(source: DataFrame, target: DataFrame, least: float, id_a: str = "a", id_b: str = "b", text: str = "text") -> DataFrame:
    """For each source the target with the largest Dice score of token sets, at least `least`; ties go to the smaller target id."""
    a = source.select(F.col(id_a), tokens(F.col(text)).alias("ta"))
    b = target.select(F.col(id_b), tokens(F.col(text)).alias("tb"))
    return pick_best(dice_pairs(a, b, least, id_a, id_b).select(id_a, id_b, "score"), [id_a], [F.desc("score"), F.col(id_b)])


# Fixed values of the combined measure: the weights of its two parts.
DICE_PART, RATIO_PART = 0.65, 0.35
#: Up to so many rows and characters, one side of the combined measure is held by every task.
HELD, HELD_CHARACTERS = 20_000, 20_000_000
_ORDERED = ("string", "bigint", "int", "smallint", "tinyint")  # ids that Python orders as Spark does


def _plain(text: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


class _Held:
    """Texts of a small side with the places of each of their words, to be met by one text after the other."""

    def __init__(self, texts: list[str], least: float) -> None:
        self.texts, self.least = texts, least
        words = [self.words(t) for t in texts]
        self.sizes, self.lengths = np.array([len(w) for w in words]), np.array([min(len(t), sequences.MOST) for t in texts])
        places: dict[str, list[int]] = {}
        for i, ws in enumerate(words):
            for w in ws:
                places.setdefault(w, []).append(i)
        self.places = {w: np.array(at) for w, at in places.items()}

    @staticmethod
    def words(text: str) -> set[str]:
        return {w for w in text.split(" ") if len(w) >= 3}

    def near(self, text: str) -> list[tuple[int, float, float]]:
        """(place, Dice part, what the whole may reach) of the held texts that words and lengths leave open."""
        words = self.words(text)
        met = [self.places[w] for w in words if w in self.places]
        if not met:
            return []
        both, all_ = np.bincount(np.concatenate(met), minlength=len(self.texts)), self.sizes + len(words)
        at = np.flatnonzero(2.0 * both >= ((self.least - RATIO_PART) / DICE_PART - 1e-9) * all_)
        part, size = DICE_PART * (2.0 * both[at] / all_[at]), min(len(text), sequences.MOST)
        most = part + RATIO_PART * (2.0 * np.minimum(self.lengths[at], size) / (self.lengths[at] + size))
        return [(int(i), float(p), float(m)) for i, p, m in zip(at, part, most, strict=True) if m >= self.least - 1e-9]

    def score(self, i: int, text: str, part: float, need: float, turned: bool) -> float | None:
        """The combined measure, or null if it can't reach what is needed. turned: the held text is the second one."""
        x, y = sequences.codes(self.texts[i]), sequences.codes(text)
        if sequences.most_ratio(x, y) < (need - 1e-9 - part) / RATIO_PART:
            return None
        return part + RATIO_PART * (sequences.ratio(y, x) if turned else sequences.ratio(x, y))


def _held_rows(df: DataFrame, within: Sequence[str], key: str) -> list[tuple] | None:
    """(within, id, plain text) of df without nulls if it is small and its ids are of a plain kind, else None; counting stops at the limit."""
    if dict(df.dtypes)[key] not in _ORDERED:
        return None
    rows = df.dropna(how="any").limit(HELD + 1)
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("_t")), F.lit(0))).first()
    return [tuple(r) for r in rows.collect()] if n <= HELD and size <= HELD_CHARACTERS else None


def _best_of_held(held: list[tuple], rows: DataFrame, least: float, within: Sequence[str], id_a: str, id_b: str, first: bool) -> DataFrame:
    """(within, id_a, id_b, score), where one side is held by every task and the other's rows (within, id, _t) pass by once, where they are: neither texts nor pairs are shuffled.

    first: the source is held, and each task gives the best row it has seen for each source text. Otherwise the target is, and each source row meets its best at once.
    """
    spark, n = rows.sparkSession, len(within)
    groups: dict[tuple, dict[str, object]] = {}
    for *g, i, t in held:  # equal texts are one: of targets the smallest id stays, of sources all
        texts = groups.setdefault(tuple(g), {})
        texts[t] = [*texts.get(t, ()), i] if first else min(i, texts.get(t, i))
    made = spark.sparkContext.broadcast({g: (list(texts), list(texts.values())) for g, texts in groups.items()})
    own, other = (id_a, id_b) if first else (id_b, id_a)
    kinds = dict(rows.dtypes)

    def batch(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], schema.field(k).type) for k in range(len(schema))], schema=schema)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = {g: (_Held(texts, least), ids) for g, (texts, ids) in made.value.items()}
        best: dict[tuple, tuple] = {}  # first: (group, place) -> (score, id)
        schema = None
        for b in batches:
            schema = schema or pa.schema([*(b.schema.field(k) for k in range(n + 1)), pa.field("_place", pa.int32()), pa.field("score", pa.float64())])
            out, known = [], {}
            for *g, i, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                g = tuple(g)
                if g not in sides:
                    continue
                side = sides[g][0]
                if first:
                    for at, part, most in side.near(t):
                        top = best.get((g, at), (least, None))
                        if most < top[0] - 1e-9:
                            continue
                        score = side.score(at, t, part, top[0], False)
                        if score is not None and score >= least and (top[1] is None or score > top[0] or (score == top[0] and i < top[1])):
                            best[g, at] = (score, i)
                    continue
                if (g, t) not in known:
                    mine = (least, None)
                    for at, part, most in sorted(side.near(t), key=lambda x: -x[2]):
                        if most < mine[0] - 1e-9:
                            break
                        score = side.score(at, t, part, mine[0], True)
                        if score is not None and score >= least and (mine[1] is None or score > mine[0] or (score == mine[0] and sides[g][1][at] < sides[g][1][mine[1]])):
                            mine = (score, at)
                    known[g, t] = mine
                score, at = known[g, t]
                if at is not None:
                    out.append((*g, i, at, score))
            if out:
                yield batch(out, schema)
        if best:
            yield batch([(*g, i, at, score) for (g, at), (score, i) in best.items()], schema)

    fields = ", ".join(f"`{c}` {kinds[c]}" for c in (*within, other))
    found = rows.dropna(how="any").select(*within, other, "_t").mapInArrow(make, f"{fields}, _place int, score double")
    if first:
        found = pick_best(found, [*within, "_place"], [F.desc("score"), F.col(id_b)])
    ids = [(*g, k, i) for g, texts in groups.items() for k, x in enumerate(texts.values()) for i in (x if first else [x])]
    kind = ", ".join([*(f"`{c}` {kinds[c]}" for c in within), "_place int", f"`{own}` {'string' if held and isinstance(held[0][n], str) else 'long'}"])
    columns = kind.split(", ")
    types = [pa.string() if c.endswith("string") else pa.int32() if c.endswith("_place int") else pa.int64() for c in columns]
    names = spark.createDataFrame(pa.table([pa.array([i[k] for i in ids], t) for k, t in enumerate(types)], [c.split(" ")[0].strip("`") for c in columns]))
    return found.join(F.broadcast(names), [*within, "_place"]).select(*within, id_a, id_b, "score")


def best_similar(source: DataFrame, target: DataFrame, least: float, within: Sequence[str] = (), id_a: str = "a", id_b: str = "b", text: str = "text") -> DataFrame:
    """(within, id_a, id_b, score): each source's target of the same `within` with the largest combined similarity, if at least `least`; ties go to the smaller target id.

    The measure is 0.65 of the Dice score of words of three letters or digits and more, and 0.35 of the matching-blocks ratio. As the
    ratio is at most 1, and at most what the two lengths allow, only pairs that can reach `least` are compared letter by letter. Null texts, `within` or ids match nothing.
    If one side is small, every task holds it and the other side's rows meet it where they are; else texts that share words meet by shuffles, equal ones once.
    """
    floor = (least - RATIO_PART) / DICE_PART
    if floor <= 0:
        raise ValueError(f"least must be over {RATIO_PART}: below it texts without a common word could match")
    sides = source.select(*within, id_a, _plain(text).alias("_t")), target.select(*within, id_b, _plain(text).alias("_t"))
    kinds = [dict(x.dtypes) for x in sides]
    if all(kinds[0][c] == kinds[1][c] for c in within) and kinds[1][id_b] in _ORDERED:
        if (held := _held_rows(sides[0], within, id_a)) is not None:
            out = _best_of_held(held, sides[1], least, within, id_a, id_b, True)
            return out.withColumn(id_a, F.col(id_a).cast(kinds[0][id_a]))
        if (held := _held_rows(sides[1], within, id_b)) is not None:
            out = _best_of_held(held, sides[0], least, within, id_a, id_b, False)
            return out.withColumn(id_b, F.col(id_b).cast(kinds[1][id_b]))
    plain = _plain(text)
    a = source.select(*within, id_a, plain.alias("_t"), F.sha2(plain, 256).alias("_a"))
    b = target.where(F.col(id_b).isNotNull()).groupBy(*within, plain.alias("_u")).agg(F.min(id_b).alias(id_b)).withColumn("_b", F.sha2("_u", 256))
    words = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda w: F.length(w) >= 3))
    left = a.select(*within, "_a", "_t").distinct().select(*within, "_a", "_t", words(F.col("_t")).alias("ta"))
    right = b.select(*within, "_b", "_u", id_b, words(F.col("_u")).alias("tb"))
    pairs = dice_pairs(left, right, floor - 1e-9, "_a", "_b", within)
    size = lambda c: F.least(F.length(c), F.lit(6000))
    most = 2 * F.least(size("_t"), size("_u")) / (size("_t") + size("_u"))
    open_ = pairs.where(DICE_PART * F.col("score") + RATIO_PART * most >= least - 1e-9)
    need = (least - 1e-9 - DICE_PART * F.col("score")) / RATIO_PART
    scored = sequences.with_ratio(open_.select(*within, "_a", id_b, "score", "_t", "_u"), "_t", "_u", need).where("ratio is not null").withColumn("score", DICE_PART * F.col("score") + RATIO_PART * F.col("ratio"))
    best = pick_best(scored.where(F.col("score") >= least).select(*within, "_a", id_b, "score"), [*within, "_a"], [F.desc("score"), F.col(id_b)])
    return a.where(F.col(id_a).isNotNull()).select(*within, id_a, "_a").join(best, [*within, "_a"]).select(*within, id_a, id_b, "score")


def two_way_overlap(source: DataFrame, target: DataFrame, least: float, within: Sequence[str], id_a: str = "a", id_b: str = "b", text: str = "text") -> DataFrame:
    """By `within`: the share of rows matched each way, the mean score of the matches, and how many matches a matched row of the other side draws on average; 0 where there is nothing."""

    def way(x: DataFrame, y: DataFrame, i: str, j: str, name: str) -> DataFrame:
        found = best_similar(x, y, least, within, i, j, text)
        drawn = found.groupBy(*within, j).agg(F.count("*").alias("_n"), F.sum("score").alias("_s"))
        sums = drawn.groupBy(*within).agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), F.count("*").alias("_d"))
        both = x.groupBy(*within).agg(F.count("*").alias("_all")).join(sums, list(within), "left")
        return both.select(*within, (F.coalesce("_n", F.lit(0)) / F.col("_all")).alias(f"{name}_overlap"), (F.col("_s") / F.col("_n")).alias(f"{name}_score"), (F.col("_n") / F.col("_d")).alias(f"{name}_fan_in"))

    both = way(source, target, id_a, id_b, "a_to_b").join(way(target, source, id_b, id_a, "b_to_a"), list(within), "full")
    return both.fillna(0.0, [c for c in both.columns if c not in within])


PREFIX, GRAM = 100, 16


def anchors(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, gram, place): hashes of the 16-character windows that are the smallest (the leftmost on ties) of some 85 neighbouring ones, so of any 100 characters, and where they begin.

    Two texts that share 100 characters share the hash of the smallest window among them, at the same place of the 100. Texts under 100 characters have none.
    """
    kind = dict(texts.dtypes)[key]
    span = PREFIX - GRAM + 1

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(GRAM)], np.uint64)
        for b in batches:
            of, grams, places = [np.zeros(0, int)], [np.zeros(0, np.uint64)], [np.zeros(0, int)]
            for i in range(b.num_rows):
                value = b.column(1)[i].as_py()
                if value is None or len(value) < PREFIX:
                    continue
                points = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
                h = np.zeros(len(points) - GRAM + 1, np.uint64)
                for k in range(GRAM):
                    h += points[k : k + len(h)] * power[k]
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                at = np.arange(len(h))
                done = 1
                while done < span:  # where the smallest of each `span` windows is, by doubling
                    step = min(done, span - done)
                    at = np.where(h[at[:-step]] <= h[at[step:]], at[:-step], at[step:])
                    done += step
                at = np.unique(at)
                of.append(np.full(len(at), i))
                grams.append(h[at])
                places.append(at)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(of))), pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(places), pa.int32())], [key, "gram", "place"])

    return texts.select(key, text).mapInArrow(make, f"`{key}` {kind}, gram long, place int")


def _windows_at(texts: DataFrame, key: str, text: str, at: str) -> DataFrame:
    """(key, h): SHA-256 of the 100 characters that begin at each place of the list `at`; equal ones of a text are one."""
    kind = dict(texts.dtypes)[key]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, found = [], []
            for i in range(b.num_rows):
                t = b.column(1)[i].as_py()
                mine = {t[a : a + PREFIX] for a in b.column(2)[i].as_py() if 0 <= a <= len(t) - PREFIX}
                of += [i] * len(mine)
                found += [hashlib.sha256(w.encode("utf-8", "surrogatepass")).digest() for w in mine]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(of, pa.int64())), pa.array(found, pa.binary())], [key, "h"])

    return texts.select(key, text, at).mapInArrow(make, f"`{key}` {kind}, h binary")


def prefix_contained(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, first_id): the smallest other key whose text holds this text's first 100 characters, or the other way round.

    A text's anchors meet the (hash, place) of anchors of prefixes, which says where a prefix may begin; the 100 characters there then meet
    prefixes by their digest. So a frequent passage costs a text some rows for each place in a prefix, not one for each prefix that has it. Equal prefixes
    are one, and of a prefix only the two smallest keys on either side count, so a prefix that very many texts share costs a row for each of them.
    """
    rows = texts.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.length("t") >= PREFIX)
    heads = rows.select("k", F.left("t", F.lit(PREFIX)).alias("t"))
    starts = heads.select("k", F.unhex(F.sha2("t", 256)).alias("h"))
    low = starts.groupBy("h").agg(F.min("k").alias("lo"))
    second = starts.join(low, "h").where("k <> lo").groupBy("h").agg(F.min("k").alias("next"))
    low = low.join(second, "h", "left").select("h", "lo", "next")
    inner = anchors(heads, "k", "t").select("gram", F.col("place").alias("_in")).distinct()
    spots = anchors(rows, "k", "t").join(inner, "gram").select("k", (F.col("place") - F.col("_in")).alias("at")).where("at >= 0").groupBy("k").agg(F.collect_set("at").alias("at"))
    holds = low.join(_windows_at(rows.join(spots, "k"), "k", "t", "at"), "h")
    # a text that holds a prefix meets the prefix's smallest other owner
    owner = holds.select("k", F.when(F.col("k") == F.col("lo"), F.col("next")).otherwise(F.col("lo")).alias("other")).where("other is not null")
    # a prefix's owners meet the smallest other text that holds it
    first = holds.groupBy("h").agg(F.min("k").alias("lo"))
    after = holds.select("h", "k").join(first, "h").where("k <> lo").groupBy("h").agg(F.min("k").alias("next"))
    holder = starts.join(first.join(after, "h", "left"), "h").select("k", F.when(F.col("k") == F.col("lo"), F.col("next")).otherwise(F.col("lo")).alias("other")).where("other is not null")
    return owner.union(holder).groupBy("k").agg(F.min("other").alias("first_id")).withColumnRenamed("k", key)
