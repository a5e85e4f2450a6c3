"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The rank file is turned into the library's form once, on the driver: every byte gets a printable
character (the byte-to-character mapping), every token is written in those characters, and each way to cut a
token into two others becomes a merge, so that any neighbours whose bytes join to a token merge by that
token's rank. A piece that is itself a token is taken whole. The tokenizer travels as one broadcast text whose size
is that of the vocabulary. Two cuts of one token can compete only where they overlap (a token that begins as it
ends); tests hold such texts, and every code point, against the rank file's own library.

Each match of the pattern is a piece. A worker writes pieces that it sees for the first time in mapped characters, has the library
merge many of them at once, and remembers their ids and offsets (up to CACHE_BYTES) in arrays, from which a text's ids are gathered. Long
texts go through in blocks of BLOCK characters, each cut before white space: matches of such patterns never run from other characters into it,
except that they may begin with one space.

An offset pair holds the characters that a token touches: a token that ends inside a character, and the next
one, both name it. Decoding maps each id's characters back to bytes by the reversed table, over the whole document,
so characters split between tokens come back whole; `decode(..., as_text=True)` replaces bytes that are no
UTF-8 (ids cut inside a character).

Cases: null and empty texts have no ids, and decode to nothing. Null doc_ids are kept and repeated rows stand
alone. An empty table gives an empty result. Texts of any length are encoded whole. Only the named columns are read, so
others can't clash. Unknown or null ids fail when decoding.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BLOCK = 1 << 20
CACHE_BYTES = 64 << 20
PIECES_AT_ONCE = 50
#: The characters of Unicode's White_Space property.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_before_space = re.compile(f"(?<=[^{SPACES}])(?=[{SPACES}])").search
_held: dict[str, Encoder] = {}


def byte_characters() -> list[str]:
    """The character of each byte: itself where Latin-1 prints it, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file (a line holds a token in base64 and its rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokenizer_json(path: str) -> str:
    """The tokenizers library's form of a rank file; every cut of a token into two others is a merge with its rank."""
    from tokenizers import Tokenizer, models

    ranks, shown = read_ranks(path), byte_characters()
    written = {token: "".join(map(shown.__getitem__, token)) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        cuts = ((token[:i], token[i:]) for i in range(1, len(token)))
        merges += [(written[a], written[b]) for a, b in cuts if a in ranks and b in ranks]
    return Tokenizer(models.BPE(vocab={written[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)).to_str()


def _blocks(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > BLOCK:
        found = _before_space(text, at + BLOCK)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class Encoder:
    """One worker's tokenizer with what it remembers: the number of each piece, and by number where its ids begin, how many they are and its characters."""

    def __init__(self, made: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.find = Tokenizer.from_str(made), regex.compile(pattern).findall
        self.tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")  # mapped pieces hold none
        self.shown = dict(enumerate(byte_characters()))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.first, self.count, self.length = (np.zeros(0, np.int64) for _ in range(3))
        self.ids, self.starts, self.ends = (np.zeros(0, np.int32) for _ in range(3))
        self.size = 0

    def _learn(self, pieces: set[str]) -> None:
        fresh = list(pieces.difference(self.known))
        if not fresh:
            return
        raw = [p.encode() for p in fresh]
        mapped = [r.decode("latin-1").translate(self.shown) for r in raw]
        lines = ["\n".join(mapped[i : i + PIECES_AT_ONCE]) for i in range(0, len(mapped), PIECES_AT_ONCE)]
        found = self.tokenizer.encode_batch(lines, add_special_tokens=False)
        base = np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
        ids = np.concatenate([np.array(e.ids, np.int32) for e in found])
        places = np.concatenate([np.array(e.offsets, np.int64).reshape(-1, 2) + b for e, b in zip(found, base.tolist(), strict=True)])
        # an id's piece, and its bytes in it: places count mapped characters, which are bytes, and a line feed after each piece
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        at = np.cumsum(size + 1) - size - 1
        first = np.searchsorted(places[:, 0], at)
        count = np.diff(np.append(first, len(ids)))
        of = np.repeat(np.arange(len(raw)), count)
        # from bytes to characters: a character begins at each byte that doesn't continue one
        whole = np.frombuffer(b"".join(raw), np.uint8)
        character = np.cumsum((whole & 0xC0) != 0x80) - 1
        begin = np.cumsum(size) - size
        low, high = (character[places[:, k] - at[of] + begin[of] - k] - character[begin[of]] + k for k in (0, 1))
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
        self.first, self.count = np.append(self.first, first + len(self.ids)), np.append(self.count, count)
        self.length = np.append(self.length, np.fromiter(map(len, fresh), np.int64, len(fresh)))
        self.ids, self.starts, self.ends = np.append(self.ids, ids), np.append(self.starts, low.astype(np.int32)), np.append(self.ends, high.astype(np.int32))
        self.size += 150 * len(fresh) + int(size.sum()) + 12 * len(ids)

    def _some(self, blocks: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if self.size > CACHE_BYTES:
            self._forget()
        cut = list(map(self.find, blocks))
        self._learn(set().union(*cut))
        out = []
        for pieces in cut:
            numbers = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
            count, length = self.count[numbers], self.length[numbers]
            at = np.repeat(self.first[numbers] - np.cumsum(count) + count, count) + np.arange(count.sum())
            shift = np.repeat(np.cumsum(length) - length, count)
            out.append((self.ids[at], self.starts[at] + shift, self.ends[at] + shift))
        return out

    def texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text ids, and the first and behind-last character of each. Blocks of several texts are learnt together."""
        blocks = [(i, b) for i, t in enumerate(texts) for b in _blocks(t)]
        parts: list[list] = [[] for _ in texts]
        base, at = [0] * len(texts), 0
        while at < len(blocks):
            held, to = 0, at
            while to < len(blocks) and held < BLOCK:
                held, to = held + len(blocks[to][1]), to + 1
            for (i, b), (ids, starts, ends) in zip(blocks[at:to], self._some([b for _, b in blocks[at:to]]), strict=True):
                parts[i].append((ids, starts + base[i], ends + base[i]) if base[i] else (ids, starts, ends))
                base[i] += len(b)
            at = to
        for p in parts:
            yield p[0] if len(p) == 1 else tuple(np.concatenate(x) for x in zip(*p, strict=True))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), kind))


def _slices(batches: Iterator[pa.RecordBatch], weight: str) -> Iterator[pa.RecordBatch]:
    """Batches again, cut so that one holds about BLOCK characters or ids, or a single row."""
    for batch in batches:
        at, held = 0, 0
        for i, x in enumerate(batch.column(weight)):
            if held >= BLOCK:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += 1 + (len(x.as_py()) if weight == "text" and x.is_valid else len(x.values) if x.is_valid else 0)
        if at < batch.num_rows:
            yield batch.slice(at)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids, starts and ends (characters) of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    text, pattern = tokenizer_json(path or default_ranks()), pattern or default_pattern()
    made, name = spark.sparkContext.broadcast(text), hashlib.md5(f"{pattern}\n{text}".encode()).hexdigest()  # as large as the vocabulary
    df = docs.select("doc_id", "text")
    schema = f"doc_id {dict(df.dtypes)['doc_id']}, ids array<int>, starts array<long>, ends array<long>"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _held:  # a worker keeps its encoder, and what that remembers, for its next tasks
            _held.clear()
            _held[name] = Encoder(made.value, pattern)
        encoder = _held[name]
        for b in _slices(batches, "text"):
            found = list(encoder.texts([t or "" for t in b.column("text").to_pylist()]))
            columns = [_lists([f[i] for f in found], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], ["doc_id", "ids", "starts", "ends"])

    return df.mapInArrow(make, schema)


def decode(encoded: DataFrame, path: str | None = None, as_text: bool = False) -> DataFrame:
    """encoded (with a column `ids`) and `decoded`: the bytes of its ids, or as_text the text, with U+FFFD for bytes that are no UTF-8."""
    spark = encoded.sparkSession
    back = {c: b for b, c in enumerate(byte_characters())}
    shown = byte_characters()
    names = {rank: "".join(map(shown.__getitem__, token)) for token, rank in read_ranks(path or default_ranks()).items()}
    tokens = spark.sparkContext.broadcast([names.get(i) for i in range(max(names) + 1)])  # a vocabulary
    keep = [c for c in encoded.columns if c != "decoded"]
    df = encoded.select(*keep)
    kind, name = (pa.string(), "string") if as_text else (pa.binary(), "binary")
    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), f"decoded {name}"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_of = [None if t is None else bytes(map(back.__getitem__, t)) for t in tokens.value]
        for b in _slices(batches, "ids"):
            out = [b"".join(map(table_of.__getitem__, x.values.to_numpy().tolist())) if x.is_valid else b"" for x in b.column("ids")]
            out = [x.decode("utf-8", "replace") for x in out] if as_text else out
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, kind)], [*keep, "decoded"])

    return df.mapInArrow(make, schema)


def split_characters(starts: Column, ends: Column) -> Column:
    """How many tokens end inside a character: the next one begins before their end."""
    after = F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0)))
    return F.size(F.filter(F.zip_with(after, ends, lambda s, e: s < e), lambda x: x))


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(table(spark, sf_dir, "documents"))
    found = decode(found.withColumn("n_split", split_characters(F.col("starts"), F.col("ends")).cast("long")).drop("starts", "ends"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "n_split",
    )
