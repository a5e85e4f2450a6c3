from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import byte_bpe

DOCS = "doc_id long, text string, ids string, starts string, decoded string"


@pytest.fixture(scope="module")
def plain():  # noqa: ANN201
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=byte_bpe.default_pattern(), mergeable_ranks=byte_bpe.read_ranks(byte_bpe.default_ranks()), special_tokens={})


@pytest.fixture(scope="module")
def encoder() -> byte_bpe.Encoder:
    return byte_bpe.Encoder(byte_bpe.tokenizer_json(byte_bpe.default_ranks()), byte_bpe.default_pattern())


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _same(plain, encoder: byte_bpe.Encoder, text: str) -> None:  # noqa: ANN001
    """Ids are those of the rank file's own library; offsets name the characters that hold each token's bytes."""
    want = plain.encode_ordinary(text)
    [(ids, starts, ends)] = encoder.texts([text])
    assert ids.tolist() == want, text[:80]
    of = [i for i, c in enumerate(text) for _ in c.encode()]
    at = 0
    for k, s, e in zip(want, starts.tolist(), ends.tolist(), strict=True):
        n = len(plain.decode_single_token_bytes(k))
        assert (s, e) == (of[at], of[at + n - 1] + 1)
        at += n


def test_whole_table(spark: SparkSession, sf_dir: str, plain) -> None:  # noqa: ANN001
    found = {r["doc_id"]: r for r in byte_bpe.op12_byte_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    for r in docs:
        ids, got = plain.encode_ordinary(r["text"] or ""), found[r["doc_id"]]
        assert (got["n_tokens"], got["ids_sha256"], got["decoded_sha256"]) == (len(ids), _sha(",".join(map(str, ids)).encode()), _sha((r["text"] or "").encode()))


def test_odd_texts(plain, encoder: byte_bpe.Encoder) -> None:  # noqa: ANN001
    texts = [
        "", " ", "\n\n  a", "don't I'LL we've 'sup ''s x's", "tabs\tand\r\nlines \x0b\x0c\x1c\x1d\x85\xa0end  x​x᠎x", "①② ½ 12 345", "漢字かな交じり文 العربية हिन्दी", "😀😀👩‍👩‍👧 é", "<|endoftext|>",
        "a" * 5000, "." * 333, " " * 1000 + "x", "ab" * 3000 + " " + "=" * 999, "\x00\x01\x7f\xad", "﻿x�", "x 　 y　z",
    ]
    for t in texts:
        _same(plain, encoder, t)


def test_periodic_texts_whose_cuts_compete(plain, encoder: byte_bpe.Encoder) -> None:  # noqa: ANN001
    ranks, rng = byte_bpe.read_ranks(byte_bpe.default_ranks()), random.Random(5)
    overlapping = [t for t in ranks if any(t.endswith(t[:i]) and 2 * i != len(t) and t[:i] in ranks and t[i:] in ranks and t[:-i] in ranks for i in range(1, len(t)))]
    assert len(overlapping) > 100
    for token in overlapping:
        word = token.decode("utf-8", "ignore")
        for n in (1, 2, 3, 5, 8, 13):
            _same(plain, encoder, word * n)
        for _ in range(5):
            _same(plain, encoder, "".join(rng.choice([word, word[:1], word[-1:], word[1:]]) for _ in range(12)))


def test_every_code_point(plain, encoder: byte_bpe.Encoder) -> None:  # noqa: ANN001
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for i in range(0, len(points), 5000):
        text = "".join(f"a{c} {c}1{c}.{c} " for c in points[i : i + 5000])
        assert next(encoder.texts([text]))[0].tolist() == plain.encode_ordinary(text)


def test_long_texts_go_through_in_blocks(plain, encoder: byte_bpe.Encoder, monkeypatch: pytest.MonkeyPatch) -> None:  # noqa: ANN001
    monkeypatch.setattr(byte_bpe, "BLOCK", 50)
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 20_000)
    rng = random.Random(3)
    for _ in range(20):
        _same(plain, encoder, "".join(rng.choice(["word", " ", "  ", "\n", "é", "漢字", "😀", "x" * 70, "'s", "12"]) for _ in range(300)))


def test_nulls_repeats_names_and_empty_table(spark: SparkSession) -> None:
    rows = [(1, None, "", "", ""), (2, "", "", "", ""), (None, "a b", "", "", ""), (None, "a b", "", "", "")]
    found = byte_bpe.decode(byte_bpe.encode(spark.createDataFrame(rows, DOCS))).collect()
    assert sorted((r["doc_id"] or 0, len(r["ids"]), bytes(r["decoded"])) for r in found) == [(0, 2, b"a b"), (0, 2, b"a b"), (1, 0, b""), (2, 0, b"")]
    assert byte_bpe.decode(byte_bpe.encode(spark.createDataFrame([], DOCS))).count() == 0


def test_split_characters(spark: SparkSession) -> None:
    docs = spark.createDataFrame([(1, "x 𐍈𐍉 y", "", "", "")], DOCS)
    found = byte_bpe.encode(docs).withColumn("n", byte_bpe.split_characters(F.col("starts"), F.col("ends")))
    cut = found.select(F.explode(F.transform("ids", lambda i: F.array(i))).alias("ids"))
    assert found.first()["n"] > 0 and any("�" in r["decoded"] for r in byte_bpe.decode(cut, as_text=True).collect())
    assert byte_bpe.decode(found, as_text=True).first()["decoded"] == "x 𐍈𐍉 y"
