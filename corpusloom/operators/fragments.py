"""Words broken by extraction, put together again by a dictionary that is learnt from the corpus.

The dictionary is a table of words, counted by the texts that hold them and pruned by that count; it may be as large as the
corpus makes it, so it is never sent whole to anyone. Every text lists what it might need (its tokens, joins of up to five
neighbours, and what is left of them without a short word stuck to an end). Nearly all of that is a common word or none at all, so tasks hold a sieve of
fixed size (the commonest words, and bits that tell what isn't a word); only what it leaves open meets the dictionary by key, and each text gets back
what are words. Where all words are common, nothing is left open and texts stay in their tasks. The walk over a text's tokens then is a small helper in the task.

A repair is kept only if it leaves fewer unknown tokens and passes the checks on numbers and names (`text.repair_accepted`).
Texts without tokens stay as they are; null texts are kept and never repaired. Rows with equal keys are told apart by their text.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import repair_accepted
from ..session import work_folder

# Words that stick to others, in the order in which they are tried, and how far joins look ahead.
STICKY = ("and", "the", "for", "are", "was", "has", "its", "our", "all", "can", "may", "will", "not", "but", "also", "more", "most")
AHEAD = 4
SHORTEST = 4
#: So many lookups leave a task together, and so many characters of texts are repaired together.
MOST_LOOKUPS, MOST_CHARACTERS = 50_000, 1_000_000
#: The sieve: so many common words at most, so many bits (in pieces as Spark makes them), and so many characters of tokens whose marks a worker remembers.
MOST_COMMON, SIEVE_BITS, PIECE, REMEMBERED = 1_500_000, 1 << 27, 1 << 15, 2_000_000
#: Kinds of tokens: letters that aren't a common word; may be parted from a sticky word; with lookups that the sieve leaves open.
UNKNOWN, STUCK, OPEN = 1, 2, 4
#: Strings are numbers of their bytes modulo this prime: joined ones follow from their parts, and products fit into 64 bits.
PRIME, BLANK = 4_294_967_291, 32
TIMES = [pow(256, n, PRIME) for n in range(64)]
#: Spreads numbers over the bits.
SPREAD = 0x9E3779B97F4A7C15
#: Longer tokens aren't remembered one by one.
LONG = 100
#: A sticky word leaves more than two letters beside it.
BESIDE = 2
#: Words of one or two letters; a corpus with broken words would teach many others.
SHORT_WORDS = ("a", "i", "am", "an", "as", "at", "be", "by", "do", "go", "he", "if", "in", "is", "it", "me", "my", "no", "of", "on", "or", "so", "to", "up", "us", "we")


def learn(texts: DataFrame, text: str, least: int) -> DataFrame:
    """(word, texts): lower-case runs of letters that stand in at least so many texts, without short ones that aren't known."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)))
    found = texts.select(F.explode(words).alias("word")).where((F.length("word") > 2) | F.col("word").isin(*SHORT_WORDS))
    return found.groupBy("word").agg(F.count("*").alias("texts")).where(F.col("texts") >= least)


def _stuck(token: str) -> tuple[tuple[str, str, bool], ...]:
    """(what is left, sticky word, at the end) for each sticky word at an end of the token, ends first."""
    return _ends(token) if len(token) <= LONG else _ends.__wrapped__(token)


@lru_cache(50_000)
def _ends(token: str) -> tuple[tuple[str, str, bool], ...]:
    low = token.lower()
    if not low.endswith(STICKY) and not low.startswith(STICKY):
        return ()
    ends = [(token[: -len(w)], token[-len(w) :], True) for w in STICKY if low.endswith(w) and len(token) > len(w) + BESIDE]
    return *ends, *((token[len(w) :], token[: len(w)], False) for w in STICKY if low.startswith(w) and len(token) > len(w) + BESIDE)


def _loosened(token: str) -> tuple[str, str] | None:
    """The first way to cut a token in two, whatever the parts: (first part, second)."""
    for left, word, at_end in _stuck(token):
        return (left, word) if at_end else (word, left)
    return None


def _parted(token: str, words: set[str]) -> list[str] | None:
    """A token cut so that what remains beside one sticky word (or two at the end) is a word."""
    for left, word, at_end in _stuck(token):
        if left.lower() in words:
            return [left, word] if at_end else [word, left]
        if at_end:
            for rest, second, second_at_end in _stuck(left):
                if second_at_end and rest.lower() in words:
                    return [rest, second, word]
    return None


def candidates(tokens: list[str]) -> set[str]:
    """Everything that the walk may look up, in lower case."""
    out = {t.lower() for t in tokens}
    for i, t in enumerate(tokens):
        joined = t
        if len(t) > SHORTEST - 1:
            for left, word, at_end in _stuck(t):
                out.update((left.lower(), word.lower()))
                if at_end:
                    out.update(x.lower() for rest, second, end in _stuck(left) if end for x in (rest, second))
        for last in tokens[i + 1 : i + 1 + AHEAD]:
            cut = _loosened(last)
            if cut:
                out.update(((joined + cut[0]).lower(), cut[1].lower()))
            joined += last
            out.add(joined.lower())
    return out


def _fine(part: list[str], words: set[str]) -> bool:
    """Whether all of these tokens are words of more than two letters."""
    for t in part:
        if len(t) < 3 or t.lower() not in words:
            return False
    return True


def changes(tokens: list[str], words: set[str], places: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int, list[str]]]:
    """(place, how many tokens, what they become) from the left: the longest joins that are words, else stuck words parted.

    places: in order, the tokens where that may be, and how many tokens after each may be joined to it at most.
    """
    i = 0
    for at, most in places:
        if at < i:
            continue
        first = tokens[at]
        taken: list[str] | None = None
        more = most
        while more:
            part = tokens[at : at + more + 1]
            whole = "".join(part)
            if len(whole) >= SHORTEST and whole.lower() in words and not _fine(part, words):
                taken = [whole]
                break
            cut = _loosened(part[-1])
            if cut:
                head = "".join(part[:-1]) + cut[0]
                if len(head) >= SHORTEST and head.lower() in words:
                    taken = [head, cut[1]]
                    break
            more -= 1
        if taken:
            if first[0].isupper():
                taken[0] = taken[0][0].upper() + taken[0][1:]
        elif len(first) > SHORTEST - 1:
            taken = _parted(first, words)
        if taken:
            yield at, more + 1, taken
        i = at + more + 1


def walk(tokens: list[str], words: set[str]) -> list[str]:
    """Tokens with the longest joins that are words, from the left; else with stuck words parted."""
    out: list[str] = []
    i = 0
    for at, n, made in changes(tokens, words, ((k, min(AHEAD, len(tokens) - 1 - k)) for k in range(len(tokens)))):
        out += tokens[i:at] + made
        i = at + n
    return out + tokens[i:]


def _number(coded: bytes) -> int:
    return int.from_bytes(coded) % PRIME


def _times(coded: bytes) -> int:
    """What the number of a string before these bytes is multiplied with."""
    return TIMES[len(coded)] if len(coded) < len(TIMES) else pow(256, len(coded), PRIME)


def _place(number: int, shift: int) -> int:
    return (number * SPREAD & 0xFFFFFFFFFFFFFFFF) >> shift


class Sieve:
    """What tasks know of a dictionary: its commonest words, and bits that are set for all of its words (with a blank after them) and all that these begin with.

    A string whose bit isn't set is no word, or begins none; one whose bit is set may be one. whole: all words are common.
    """

    def __init__(self, common: pa.Array, bits: bytes, whole: bool) -> None:
        self.common, self.raw, self.bits, self.whole = set(common.to_pylist()), bits, np.frombuffer(bits, np.uint8), whole
        self.shift = 64 - (8 * len(bits) - 1).bit_length()
        self._forget()

    def _forget(self) -> None:
        self.marks, self.size = _Marks(self), 0
        # five by mark: the token's number and what a string before it is multiplied with, those of its first part if it's cut in two, and its kind
        self.figures = array("Q")
        self.cuts: dict[int, str] = {}
        self.own: dict[int, list[str]] = {}

    def set_at(self, numbers: np.ndarray) -> np.ndarray:
        at = (numbers * np.uint64(SPREAD) >> np.uint64(self.shift)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def open(self, found: Iterable[str]) -> list[str]:
        """Of these strings those that aren't common and may be words."""
        return [x for x in found if x not in self.common and self.raw[(at := _place(_number(x.encode() + b" "), self.shift)) >> 3] >> (at & 7) & 1]

    def _marked(self, low: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The marks of tokens in lower case, and their columns."""
        if self.size > REMEMBERED:
            self._forget()
        at = np.array(list(map(self.marks.__getitem__, low)), np.int64)
        return at, list(np.frombuffer(self.figures, np.uint64).reshape(-1, 5)[at].T)

    def joins(self, lows: list[list[str]], made: list[tuple[int, str]] | None = None) -> tuple[list[str], np.ndarray, list[tuple[int, int]]]:
        """Tokens of texts in lower case, one text after the other; their kinds; the places for `changes`. The lookups that are neither common nor told by the bits go to `made`, with the place of a token."""
        low, lengths = [x for y in lows for x in y], list(map(len, lows))
        if not low:
            return [], np.zeros(0, np.uint64), []
        at, (number, times, cut_number, cut_times, kind) = self._marked(low)
        ends, most = np.repeat(np.cumsum(lengths), lengths), np.zeros(len(low), np.int64)
        live = np.flatnonzero(self.set_at(number))
        so_far = number[live]
        for more in range(1, AHEAD + 1):
            inside = live + more < ends[live]
            live, so_far = live[inside], so_far[inside]
            then = live + more
            cut = np.flatnonzero(cut_times[then])
            cut = cut[self.set_at((((so_far[cut] * cut_times[then[cut]] + cut_number[then[cut]]) % PRIME) * 256 + BLANK) % PRIME)]
            so_far = (so_far * times[then] + number[then]) % PRIME
            whole = self.set_at((so_far * 256 + BLANK) % PRIME)
            most[live[cut]] = most[live[whole]] = more
            if made is not None:
                heads = ((i, "".join(low[i : i + more]) + self.cuts[at[i + more]]) for i in live[cut].tolist())
                wholes = ((i, "".join(low[i : i + more + 1])) for i in live[whole].tolist())
                made += [x for y in (heads, wholes) for x in y if x[1] not in self.common]
            going = self.set_at(so_far)
            live, so_far = live[going], so_far[going]
        if made is not None:
            made += [(i, x) for i in np.flatnonzero(kind & np.uint64(OPEN)).tolist() for x in self.own[at[i]]]
        places = np.flatnonzero((kind & np.uint64(STUCK)).astype(np.int64) + most)
        return low, kind, list(zip(places.tolist(), most[places].tolist(), strict=True))

    def lookups(self, texts: list[str]) -> list[set[str]]:
        """What the walks over texts may look up, without what the sieve tells."""
        lows = list(map(lowered, texts))
        made: list[tuple[int, str]] = []
        self.joins([x or [] for x in lows], made)
        out: list[set[str]] = [set(self.open(candidates(t.split()))) if x is None else set() for t, x in zip(texts, lows, strict=True)]
        of = np.repeat(np.arange(len(lows)), [len(x or []) for x in lows]).tolist()
        for i, x in made:
            out[of[i]].add(x)
        return out

    def repaired(self, texts: list[str], known: set[str], own: set[str]) -> Iterator[tuple[str, int, int]]:
        """(text, unknown tokens before and after). known: the common words and `own`, those of these texts' lookups that are words besides."""
        unknown = lambda tokens: sum([x.isalpha() and x.lower() not in known for x in tokens])
        lows = list(map(lowered, texts))
        low, kind, places = self.joins([x or [] for x in lows])
        before = (kind & np.uint64(UNKNOWN)).astype(np.int64)
        if own:
            before[[i for i in np.flatnonzero(before).tolist() if low[i] in own]] = 0
        sums = [0, *np.cumsum(before).tolist()]
        tokens = [x for t, y in zip(texts, lows, strict=True) if y is not None for x in t.split()]
        found = changes(tokens, known, places)
        at, n, made = next(found, (len(tokens), 0, []))
        end = 0
        for t, y in zip(texts, lows, strict=True):
            if y is None:
                plain = t.split()
                after = walk(plain, known)
                yield " ".join(after), unknown(plain), unknown(after)
                continue
            begin, end = end, end + len(y)
            out, i, more = [], begin, 0
            while at < end:
                out += tokens[i:at] + made
                more += (unknown(made) if len(made) > 1 else 0) - sums[at + n] + sums[at]  # one that is made is a word
                i = at + n
                at, n, made = next(found, (len(tokens), 0, []))
            count = sums[end] - sums[begin]
            yield " ".join(out + tokens[i:end]), count, count + more


class _Marks(dict):
    """By token in lower case its mark, made when it's first asked for."""

    def __init__(self, sieve: Sieve) -> None:
        super().__init__()
        self.sieve = sieve

    def __missing__(self, low: str) -> int:
        s, coded, mark = self.sieve, low.encode(), len(self)
        common, kind, first, times = low in s.common, 0, b"", 0
        number = int.from_bytes(coded) % PRIME
        cut = _loosened(low) if low.endswith(STICKY) or low.startswith(STICKY) else None
        if cut:
            s.cuts[mark], first = cut[0], cut[0].encode()
            times = _times(first)
            left = candidates([low]) - {low}
            own = s.open(left | {low})
            kind = STUCK * (bool(own) or not left.isdisjoint(s.common))
        else:
            own = None if common or s.whole else s.open((low,))
        if own:
            s.own[mark] = own
            kind += OPEN
        if not common and low.isalpha():
            kind += UNKNOWN
        s.figures.extend((number, _times(coded), _number(first), times, kind))
        s.size += len(low)
        self[low] = mark
        return mark


def lowered(text: str) -> list[str] | None:
    """The tokens in lower case; None where joined tokens may have another lower case than each has, or another length."""
    low = text.lower()
    return None if len(low) != len(text) or "Σ" in text else low.split()


def _numbers(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[pa.RecordBatch]:
    """(at): the bits of words and of all that they begin with."""
    for b in batches:
        found: set[int] = set()
        for word in b.column(0).to_pylist():
            x = 0
            for c in word.encode():
                x = (x * 256 + c) % PRIME
                found.add(_place(x, shift))
            found.add(_place((x * 256 + BLANK) % PRIME, shift))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["at"])


class Sent:
    """A sieve on its way to the tasks; it's made there only."""

    def __init__(self, common: pa.Array, bits: bytes, whole: bool) -> None:
        self.of = common, bits, whole

    def __reduce__(self) -> tuple:
        return Sieve, self.of


def sieve(words: DataFrame) -> Sent:
    """The sieve of a dictionary (word, texts): the words that stand in most texts as far as all with as many are MOST_COMMON at most."""
    left, least, whole = MOST_COMMON, None, True
    for r in words.groupBy("texts").agg(F.count("*").alias("n")).orderBy(F.desc("texts")).collect():
        if r["n"] > left:
            whole = False
            break
        left, least = left - r["n"], r["texts"]
    common = words.where(F.col("texts") >= least if least is not None else F.lit(False)).select("word").toArrow().column(0).combine_chunks()
    shift, bits = 64 - (SIEVE_BITS - 1).bit_length(), bytearray(SIEVE_BITS // 8)
    at = words.select("word").mapInArrow(lambda batches: _numbers(batches, shift), "at long")
    for r in at.groupBy(F.floor(F.col("at") / PIECE).alias("piece")).agg(F.bitmap_construct_agg(F.col("at") % PIECE).alias("bits")).collect():
        bits[r["piece"] * PIECE // 8 : (r["piece"] + 1) * PIECE // 8] = r["bits"]
    return Sent(common, bytes(bits), whole)


def _pieces(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in lists of MOST_CHARACTERS and at most one text more, nulls as empty ones."""
    out, size = [], 0
    for t in texts.to_pylist():
        out.append(t or "")
        size += len(out[-1])
        if size >= MOST_CHARACTERS:
            yield out
            out, size = [], 0
    if out:
        yield out


def looked_up(batches: Iterator[pa.RecordBatch], key: str, known: Sieve | None = None) -> Iterator[pa.RecordBatch]:
    """(key, _hash, words) from batches of (key, _hash, text), in batches of MOST_LOOKUPS and at most one text more: without a sieve, a text's lookups are many times its size."""
    for b in batches:
        words: list[list[str]] = []
        first = size = 0
        found = (x for texts in _pieces(b.column(2)) for x in (known.lookups(texts) if known else (candidates(t.split()) for t in texts)))
        for i, x in enumerate(found):
            words.append(sorted(x))
            size += len(x)
            if size >= MOST_LOOKUPS or i == b.num_rows - 1:
                part = b.slice(first, len(words))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(words, pa.list_(pa.string()))], [key, "_hash", "words"])
                first, size, words = i + 1, 0, []


def _lookups(texts: DataFrame, key: str, text: str, known: Broadcast[Sieve] | None = None) -> DataFrame:
    """(key, _hash, word) of what each text may need, without what the sieve tells."""
    df = texts.where(F.col(text).isNotNull()).select(key, F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    found = df.mapInArrow(lambda batches: looked_up(batches, key, known and known.value), f"`{key}` {dict(df.dtypes)[key]}, _hash long, words array<string>")
    return found.select(key, "_hash", F.explode("words").alias("word"))


def known_words(texts: DataFrame, key: str, text: str, words: DataFrame, known: Broadcast[Sieve]) -> DataFrame:
    """(key, _hash, _words): of each text's lookups those that are in the dictionary, besides the common words."""
    found = _lookups(texts, key, text, known).join(words.select("word"), "word", "left_semi")
    return found.groupBy(key, "_hash").agg(F.collect_set("word").alias("_words"))  # repeated rows look up the same words


def counted(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """(key, _hash, word, tokens, longer) from batches of (key, _hash, tokens, longer): how often each word of a text stands in either list; a text without words keeps a row."""
    none = pa.array([], pa.string())
    for b in batches:
        of: list[int] = []
        parts: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        for i in range(b.num_rows):
            tokens, longer = (b.column(k)[i].values if b.column(k)[i].is_valid else none for k in (2, 3))
            both = pa.concat_arrays([tokens, longer]).dictionary_encode()
            place, n = both.indices.to_numpy(), len(both.dictionary)
            if n:
                parts.append((both.dictionary, np.bincount(place[: len(tokens)], minlength=n), np.bincount(place[len(tokens) :], minlength=n)))
            else:
                parts.append((pa.nulls(1, pa.string()), np.zeros(1, int), np.zeros(1, int)))
            of += [i] * max(n, 1)
            if len(of) >= MOST_LOOKUPS or i == b.num_rows - 1:
                at, (words, own, long) = pa.array(of, pa.int64()), zip(*parts, strict=True)
                columns = [b.column(0).take(at), b.column(1).take(at), pa.concat_arrays(words), pa.array(np.concatenate(own)), pa.array(np.concatenate(long))]
                yield pa.RecordBatch.from_arrays(columns, [key, "_hash", "word", "tokens", "longer"])
                of, parts = [], []


def validity(texts: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """(key, unknown, suspicious, needs_repair) of each text: tokens of letters that aren't words, single letters other than a and i, and whether a longer text needs repair.

    It does if under 60 % of its longer words are valid, over 15 % are very long, or a connecting word is stuck between others.
    """
    column = F.col(text)
    tokens = F.filter(F.split(F.lower(column), r"(?U)\s+"), lambda t: F.regexp_like(t, F.lit(r"^\p{L}+\z")))
    longer = F.transform(F.regexp_extract_all(column, F.lit("[A-Za-z]{3,}"), F.lit(0)), F.lower)
    rows = texts.select(key, F.xxhash64(text).alias("_hash"), tokens.alias("_tokens"), longer.alias("_longer"))
    rows = rows.mapInArrow(lambda batches: counted(batches, key), f"`{key}` {dict(texts.dtypes)[key]}, _hash long, word string, tokens long, longer long")
    rows = rows.join(words.select("word", F.lit(True).alias("known")).distinct(), "word", "left")
    sums = rows.groupBy(key, "_hash").agg(
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("tokens"))), F.lit(0)).alias("unknown"),
        F.coalesce(F.sum(F.when((F.length("word") == 1) & ~F.col("word").isin("a", "i"), F.col("tokens"))), F.lit(0)).alias("suspicious"),
        F.coalesce(F.sum("longer"), F.lit(0)).alias("_n"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("longer"))), F.lit(0)).alias("_good"),
        F.coalesce(F.sum(F.when(F.length("word") >= 12, F.col("longer"))), F.lit(0)).alias("_long"),
    )
    own = texts.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_at"), F.coalesce(F.length(text) >= 80, F.lit(False)).alias("_enough"), F.coalesce(F.regexp_like(text, F.lit("[a-z]{6,}(and|the|of|to)[a-z]{4,}")), F.lit(False)).alias("_run"))
    both = own.join(sums, F.col("_key").eqNullSafe(F.col(key)) & (F.col("_at") == F.col("_hash")))
    need = F.col("_enough") & (F.col("_n") > 0) & ((F.col("_good") < F.col("_n") * 0.6) | (F.col("_long") > F.col("_n") * 0.15) | F.col("_run"))
    return both.select(key, "unknown", "suspicious", need.alias("needs_repair"))


def with_words(texts: DataFrame, key: str, text: str, words: DataFrame, known: Broadcast[Sieve]) -> DataFrame:
    """texts with `_words`, the words among their lookups besides the common ones."""
    found = known_words(texts, key, text, words, known).select(F.col(key).alias("_key"), F.col("_hash").alias("_at"), "_words")
    rows = texts.withColumn("_hash", F.xxhash64(text))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_at"))
    return rows.join(found, same, "left").drop("_key", "_at", "_hash").withColumn("_words", F.coalesce("_words", F.array().cast("array<string>")))


def repair(texts: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """texts with `repaired`, `unknown_before`, `unknown_after` and `kept`; where a repair isn't kept, repaired is the text."""
    # written once, as the sieve and the lookups read it
    path = work_folder(texts.sparkSession, "words")
    words.groupBy("word").agg(F.max("texts" if "texts" in words.columns else F.lit(1)).alias("texts")).where("word is not null").write.parquet(path)
    words = texts.sparkSession.read.parquet(path)
    told = sieve(words)
    sent = texts.sparkSession.sparkContext.broadcast(told)
    df = texts.withColumn("_words", F.array().cast("array<string>")) if told.of[2] else with_words(texts, key, text, words, sent)
    names = df.columns
    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), "repaired string, unknown_before int, unknown_after int"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, of = names.index(text), names.index("_words")
        known = sent.value.common
        for b in batches:
            first = 0
            for part in _pieces(b.column(at)):
                rows = b.slice(first, len(part))
                own = set(rows.column(of).flatten().to_pylist())
                if own:  # for these texts only, on a set of this task
                    known = set(known) if known is sent.value.common else known
                    known |= own
                done = list(sent.value.repaired(part, known, own))
                if own:
                    known -= own
                columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), (pa.string(), pa.int32(), pa.int32()), strict=True)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], [*names, "repaired", "unknown_before", "unknown_after"])
                first += len(part)

    df = df.mapInArrow(make, schema)
    kept = F.coalesce((F.col("unknown_after") < F.col("unknown_before")) & repair_accepted(F.col(text), F.col("repaired")), F.lit(False))
    return df.withColumn("kept", kept).withColumn("repaired", F.when(F.col("kept"), F.col("repaired")).otherwise(F.col(text))).drop("_words")
