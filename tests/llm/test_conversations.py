from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections.abc import Iterator

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import conversations

from ..oracle import differences

ROWS = "conv_id long, turn long, role string, text string, audit string, kind string, part string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _damage(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def _grammar(initials: str) -> bool:
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def _cheapest(rows: list[tuple[str, str, bool, int]]) -> tuple[int, str, list[tuple[str, str]]]:
    """(cost, audit, repaired rows), forwards: for what the kept initials leave open (x: nothing yet) the least (cost, audit)."""
    due = {"x": "user", "s": "user", "u": "assistant", "a": "user"}
    best = {"x": (0, "", [])}

    def inserts(b: dict) -> dict:
        for _ in range(3):
            for s, (c, a, r) in list(b.items()):
                t = due[s][0]
                made = (c + 5, a + "I", [*r, (due[s], "")])
                b[t] = min(b.get(t, made), made)
        return b

    best = inserts(best)
    for role, text, gone, extra in rows:
        new: dict = {}

        def offer(s: str, made: tuple) -> None:
            new[s] = min(new.get(s, made), made)

        for s, (c, a, r) in best.items():
            offer(s, (c + 2, a + "D", r))
            if gone:
                continue
            if role[:1] == due[s][0] or (s == "x" and role[:1] == "s"):
                offer(role[0], (c + extra, a + "K", [*r, (role, text)]))
            offer(due[s][0], (c + extra + 1, a + "R", [*r, (due[s], text)]))
        best = inserts(new)
    return min(best[s] for s in "xa" if s in best)


def _plain(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in _damage([r for r in rows if r[0] == conv])]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, marked, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), 5 * (fault == "truncated")))
        turns = [t for t, _, _ in mine if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, repaired = _cheapest(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *count.values(), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def _found(spark: SparkSession, rows: list[tuple], parts: int = 3) -> list[tuple]:
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], ROWS).repartition(parts)
    return sorted((tuple(r[n] for n in NAMES) for r in conversations.repair(df).collect()), key=repr)


def _made(rng: random.Random, conv: int, n: int) -> list[tuple]:
    texts = ["Yes.", "No!", "open end", " ", "", "Why?  \n", "x" * 2000 + ".", "é?", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    return [(conv, rng.choice([*range(n + 2), None]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_whole_table(spark: SparkSession, sf_dir: str) -> None:
    found = conversations.op13_repair_conversations(spark, sf_dir)
    assert differences(found, conversations.SQL, sf_dir) == []
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r[n] for n in NAMES) for r in found.collect()), key=repr) == _plain(rows)


def test_against_forward_search(spark: SparkSession) -> None:
    rng = random.Random(11)
    rows = [r for conv in range(150) for r in _made(rng, conv, rng.randrange(1, 14))]
    rows += [(None, *r[1:]) for r in _made(rng, 0, 6)]
    assert _found(spark, rows) == _plain(rows)


@pytest.fixture
def many_partitions(spark: SparkSession) -> Iterator[None]:
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_long_conversations_cross_partitions(spark: SparkSession, many_partitions: None) -> None:
    rng = random.Random(12)
    rows = [r for conv, n in ((1, 3), (2, 900), (3, 2), (4, 400), (5, 1)) for r in _made(rng, conv, n)]
    rows += [(6, t, "user" if t % 2 else "assistant", f"Text {t}.") for t in range(500)]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], ROWS)
    ordered = conversations.ordered_faults(conversations.damaged(df))
    assert ordered.groupBy("conv_id").agg(F.countDistinct("part").alias("n")).agg(F.max("n")).first()[0] > 1
    assert _found(spark, rows) == _plain(rows)


def test_partitions_that_hold_one_stretch(spark: SparkSession, many_partitions: None) -> None:
    rows = [*_made(random.Random(13), 7, 300), (8, 1, "user", "Yes.")]
    assert _found(spark, rows) == _plain(rows)


@pytest.mark.parametrize("n", range(5))
def test_audit_is_the_least_of_all(n: int) -> None:
    """Every audit of short conversations, by trying all."""
    rng = random.Random(n)
    for _ in range(40):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.random() < 0.2, rng.choice([0, 0, 5])) for _ in range(n)]
        s = conversations.Stretch()
        for role, gone, extra in rows:
            s.add(None, role, b"", 1, "blank" if gone else "truncated" if extra else None)
        known = s.distances(conversations.END)
        letters, _ = s.walk(known, conversations.START, True)
        audit = "".join(letters)
        tried = []
        for steps in itertools.product(*([["D"], ["D", "K", "R"]][not gone] for _, gone, _ in rows)):
            for gaps in itertools.product(range(3), repeat=n + 1):
                text, cost = "", 0
                for i in range(n + 1):
                    text, cost = text + "I" * gaps[i], cost + 5 * gaps[i]
                    if i < n:
                        text, cost = text + steps[i], cost + {"D": 2, "K": rows[i][2], "R": 1 + rows[i][2]}[steps[i]]
                if cost <= known[0][0] and _possible(text, [r[0] for r in rows]):
                    tried.append((cost, text))
        assert (known[0][0], audit) == min(tried)


def _possible(audit: str, roles: list[str]) -> bool:
    """Whether some choice of user or assistant for each rerole and insert satisfies the grammar."""
    at, options = 0, []
    for c in audit:
        if c == "I":
            options.append("ua")
        else:
            options += {"K": [roles[at][0]], "R": ["ua"], "D": []}[c]
            at += 1
    return any(_grammar("".join(x)) for x in itertools.product(*options))


def test_empty_table_and_all_dropped(spark: SparkSession) -> None:
    assert _found(spark, []) == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert _found(spark, [(dropped, 0, "user", "Yes.")]) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
