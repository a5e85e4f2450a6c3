from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import SparkSession

from corpusloom.llm import packing

DOCS = "doc_id long, text string, piece string, start string, rank0 string"


def _pieces(rows: list[tuple]) -> dict[tuple, tuple]:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    out = {}
    for doc_id, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for p, s in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[s : s + 2048], "<u4").tobytes()
            out[doc_id, p] = (s, len(part) // 4, zlib.crc32(part))
    return out


def _holds(found: list, length: int = 2048) -> int:
    spans = defaultdict(list)
    for r in found:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in spans.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
    return len(spans)


def test_whole_table(spark: SparkSession, sf_dir: str) -> None:
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = packing.op6_pack_complement(spark, sf_dir).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == _pieces(rows)
    total = sum(r["length"] for r in found)
    assert _holds(found) <= 1.03 * -(-total // 2048) + 1


def test_odd_texts_are_tokenised_as_whole_texts(spark: SparkSession) -> None:
    texts = [
        None, "", " \n", "don't I'LL we've 'sup ''s", "ÀÉ Straße İstanbul ﬁne ①②", "á é́", "<|endoftext|> <|startoftext|>x", "3.14%%% ###x|y|z", "漢字かな交じり文 العربية हिन्दी", "😀😀👩‍👩‍👧", "x y z\x0bq\x85r",
        "A" * 3000, "ab " * 5000, "\x00\x01", "it's <|endoftext|>it's", "é'a 'd 'D'D",
    ]
    rows = [(i, t, "", "", "") for i, t in enumerate(texts)]
    found = packing.pack_documents(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == _pieces([r[:2] for r in rows])
    _holds(found)


def test_repeats_null_ids_and_empty_table(spark: SparkSession) -> None:
    rows = [(None, "a b c", "", "", ""), (None, "a b c", "", "", ""), (3, "a b c", "", "", ""), (3, "a b c", "", "", "")]
    found = packing.pack_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == 4 and _holds(found) == 1
    assert packing.pack_documents(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_once(seed: int) -> None:
    rng = random.Random(seed)
    counts = {rng.randrange(1, 2049): rng.randrange(1, 60) for _ in range(rng.randrange(1, 400))}
    made = packing.plan(counts)
    used = defaultdict(int)
    for times, parts in made:
        assert times > 0 and sum(parts) <= 2048
        for p in parts:
            used[p] += times
    assert dict(used) == counts
    sequences, total = sum(t for t, _ in made), sum(n * c for n, c in counts.items())
    large = sum(c for n, c in counts.items() if n > 1024)
    assert sequences <= 1.25 * max(-(-total // 2048), large) + 2


def test_exact_complements_come_first() -> None:
    made = packing.plan({2000: 5, 48: 3, 40: 4, 8: 9, 1000: 2, 700: 1, 348: 1})
    full = [p for t, p in made for _ in range(t) if sum(p) == 2048]
    assert sorted(sorted(p) for p in full if 2000 in p) == [[8, 40, 2000], [8, 40, 2000], [48, 2000], [48, 2000], [48, 2000]]
