from __future__ import annotations

import gzip
import hashlib
import json
import os
import zlib

from pyspark.sql import SparkSession

from corpusloom.llm import warc

PAGES = "page_id long, url string, html string, digest string, first string"


def _want(rows: list[tuple]) -> list[tuple]:
    out = []
    payload = lambda r: (r[2] or "").encode()
    for r in rows:
        data = payload(r)
        ids = [x[0] for x in rows if payload(x) == data and x[0] is not None]
        first = min(ids) if ids and len(data) >= 100 else None
        again = first is not None and r[0] != first
        out.append((r[0], len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return out


def _found(df) -> list[tuple]:  # noqa: ANN001
    return [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()]


ROWS = [
    (5, "http://a/é b\r\nX: y", "é" * 60 + "\r\n\r\nWARC/1.1\r\n", "", ""), (3, "http://b", "é" * 60 + "\r\n\r\nWARC/1.1\r\n", "", ""), (9, None, "x" * 99, None, None), (10, "u", "x" * 99, "", ""),
    (11, "u", None, "", ""), (12, "u", "", "", ""), (None, "u", "y" * 400_000, "", ""), (14, "u", "y" * 400_000, "", ""), (20, "w", "z" * 100, "", ""), (20, "w", "z" * 100, "", ""), (21, "w", "z" * 100, "", ""),
]


def test_round_trip(spark: SparkSession) -> None:
    folder = warc.archive(spark.createDataFrame(ROWS, PAGES), pages_per_file=4, keep=True)
    back = warc.read_archives(spark, folder)
    assert sorted(map(str, _found(back))) == sorted(map(str, _want(ROWS)))
    for r in back.where("payload is not null").collect():
        assert hashlib.sha256(bytes(r["payload"])).hexdigest() == r["payload_digest"]
    path = folder.removeprefix("file://")
    total = 0
    for name in os.listdir(f"{path}/index"):
        if not name.endswith(".jsonl"):
            continue
        members = open(f"{path}/members/{name.removesuffix('.jsonl')}.warc.gz", "rb").read()
        whole = gzip.decompress(open(f"{path}/whole/{name.removesuffix('.jsonl')}.warc.gz", "rb").read())
        parts = []
        for line in open(f"{path}/index/{name}"):
            at = json.loads(line)
            parts.append(zlib.decompress(members[at["offset"] : at["offset"] + at["length"]], 31))
        assert b"".join(parts) == whole == gzip.decompress(members)
        total += len(parts)
    assert total == len(ROWS)


def test_whole_table_and_empty_table(spark: SparkSession, sf_dir: str) -> None:
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted(_found(warc.op2_warc_normalise(spark, sf_dir))) == sorted(_want(rows))
    empty = spark.createDataFrame([], PAGES)
    assert warc.read_archives(spark, warc.archive(empty)).count() == 0


def test_archives_are_dealt_to_many_tasks(spark: SparkSession) -> None:
    """20 archives: each is rewritten in a task of its own, and reading them back takes as many."""
    pages = spark.range(200).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(cast(id as string), 100) as html")
    folder = warc.archive(pages, pages_per_file=10)
    assert len([n for n in os.listdir(folder.removeprefix("file://") + "/index") if n.endswith(".jsonl")]) == 20
    assert os.listdir(folder.removeprefix("file://") + "/whole") == []  # dropped once the members stand
    back = warc.read_archives(spark, folder)
    assert back.rdd.getNumPartitions() >= 20 and back.count() == 200
    again = f"{folder}/twice"
    names = warc.cut(warc.write_archives(pages, _made(again), 20))
    assert names.rdd.getNumPartitions() == 20
    first = warc.normalise(names, again)
    assert first.rdd.getNumPartitions() == 20 and first.groupBy().sum("records").first()[0] == 200
    assert first.groupBy().sum("records").first()[0] == 200  # a task that is run again after its archive was dropped


def _made(folder: str) -> str:
    for part in ("whole", "members", "index"):
        os.makedirs(f"{folder.removeprefix('file://')}/{part}")
    return folder
