"""Conversation structure repair by shortest paths over small costs.

A conversation's rows, in order, are the layers of a graph with four states each (what the kept roles spell so far): start,
after a system row, after a user row, after an assistant row. Keep, rerole and delete lead to the next layer,
insert stays in its own. Costs are at most MOST, so distances to the end are found with Dial's bucket queue (a ring of
buckets in place of a heap), from the end backwards; all of them are recorded, and the audit is
walked from the start along tight arcs (those whose cost is the difference of the distances at their ends), the
ASCII-least letter first. No optimal audit begins another one, so that walk gives the least.

Nothing but the last digest needs a conversation in one place. Rows without their texts (only digests of them) are range
partitioned in order, and a long conversation may lie in many partitions. Of such, each partition first reports the
distances between the states at both ends of its stretch (four runs of the queue); these are chained from the end,
so each stretch knows its distances to the end of the conversation; then the states are chained from the start. A
partition has at most two stretches that cross its bounds, so two rows for each partition pass the driver.
Texts meet their decisions only at the end, in order, as a stream through SHA-256, which has to read a conversation in sequence:
that task holds one row at a time, however long the conversation is.

Cases: null roles and texts count as one space; in the damage's key so do a null conv_id and turn. Rows without a conv_id are one
conversation. Rows without a turn come first. Rows of one turn are ordered by role, then by their text's MD5 digest (the
contract leaves that order open); equal ones are one row with a count, and all but the first are duplicates. A role
without letters has no initial and can't be kept. Empty texts are blank; texts of any length are read whole. An empty table gives
an empty result. Only the four named columns are read, so others can't clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
MOST = REROLE + TRUNCATED
#: Buckets in the ring: distances in it differ by less than the largest cost and two inserts, the most between two states.
RING = MOST + 2 * INSERT + 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the role that is due in a state, that role, its initial, and from which states a state is reached by the role due.
NEXT = (USER, USER, ASSISTANT, USER)
DUE = ("user", "user", "assistant", "user")
BACK = ((), (), (START, SYSTEM, ASSISTANT), (USER,))
#: Distances to the end from each state behind the last row.
END = (0, 2 * INSERT, INSERT, 0)
WHITE = " \t\n\x0b\f\r"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (1 or 2) of the rows that the damage leaves."""
    blank = F.lit(" ")
    text, role = F.coalesce(F.col("text"), blank), F.coalesce(F.col("role"), blank)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    df = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.pmod(F.crc32(key), F.lit(20)).alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return df.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def _last(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(WHITE)), F.lit(1))


def _digest() -> Column:
    return F.unhex(F.md5("text")).alias("digest")


def faults(rows: DataFrame) -> DataFrame:
    """Rows without texts: conv_id, turn, role, digest, copies, and the first fault of the first copy (the others of one that isn't blank are duplicates)."""
    last = _last(F.col("text"))
    slim = rows.select("conv_id", "turn", "role", _digest(), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"), "copies")
    slim = cut(slim.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("copies")))
    when = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = slim.where("not blank").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min(when).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    found = slim.join(first, same, "left")
    fault = F.when(F.col("blank"), "blank").when(~when.eqNullSafe(F.col("first")), "duplicate").when(F.col("truncated"), "truncated")
    return found.select("conv_id", "turn", "role", "digest", "copies", fault.alias("fault"))


@dataclass
class Stretch:
    """Consecutive rows of one conversation: initials, and of each row whether it must go, is truncated, and how many more copies follow it."""

    conv: object = None
    initials: list[str] = field(default_factory=list)
    gone: list[bool] = field(default_factory=list)
    extra: list[int] = field(default_factory=list)  # the cost of keeping a truncated row
    more: list[int] = field(default_factory=list)
    rows: list[tuple] = field(default_factory=list)

    def add(self, turn: object, role: str, digest: bytes, copies: int, fault: str | None) -> None:
        self.initials.append(role[:1])
        self.gone.append(fault in ("blank", "duplicate"))
        self.extra.append(TRUNCATED if fault == "truncated" else 0)
        self.more.append(copies - 1)
        self.rows.append((turn, role, digest))

    def distances(self, ends: tuple[int | None, ...]) -> list[list[int]]:
        """Cheapest costs to the end from every state before each row and behind the last, if the states there cost `ends` (None: can't end there); copies that must go cost nothing here."""
        n = len(self.initials)
        known: list[list[int]] = [[-1] * 4 for _ in range(n + 1)]
        ring: list[list[tuple[int, int]]] = [[] for _ in range(RING)]
        waiting = 0
        for state, d in enumerate(ends):
            if d is not None:
                ring[d % RING].append((n, state))
                waiting += 1
        now = min(d for d in ends if d is not None)
        while waiting:
            bucket = ring[now % RING]
            while bucket:
                i, state = bucket.pop()
                waiting -= 1
                if known[i][state] >= 0:
                    continue
                known[i][state] = now
                before = known[i - 1] if i else None
                if before and before[state] < 0:
                    ring[(now + DELETE) % RING].append((i - 1, state))
                    waiting += 1
                can = before and not self.gone[i - 1]
                for p in BACK[state]:
                    if known[i][p] < 0:
                        ring[(now + INSERT) % RING].append((i, p))
                        waiting += 1
                    if can and before[p] < 0:
                        keeps = self.initials[i - 1] == DUE[p][0]
                        ring[(now + self.extra[i - 1] + (0 if keeps else REROLE)) % RING].append((i - 1, p))
                        waiting += 1
                if state == SYSTEM and can and self.initials[i - 1] == "s" and before[START] < 0:
                    ring[(now + self.extra[i - 1]) % RING].append((i - 1, START))
                    waiting += 1
            now += 1
        return known

    def across(self) -> list[list[int]]:
        """[state before][state behind]: cheapest costs over the stretch."""
        columns = [self.distances(tuple(0 if s == e else None for s in range(4)))[0] for e in range(4)]
        return [[columns[e][s] for e in range(4)] for s in range(4)]

    def walk(self, known: list[list[int]], state: int, last: bool) -> tuple[list[str], int]:
        """The letters at each row (inserts before it first; behind the last row one more entry), and the state they end in."""
        n, letters = len(self.initials), []
        for i in range(n):
            mine = ""
            while True:
                d = known[i][state]
                if known[i + 1][state] >= 0 and known[i + 1][state] + DELETE == d:
                    mine += "D"
                    break
                if known[i][NEXT[state]] >= 0 and known[i][NEXT[state]] + INSERT == d:
                    mine, state = mine + "I", NEXT[state]
                    continue
                d -= self.extra[i]
                initial = self.initials[i]
                kept = NEXT[state] if initial == DUE[state][0] else SYSTEM if initial == "s" and state == START else None
                if kept is not None and known[i + 1][kept] == d:
                    mine, state = mine + "K", kept
                else:
                    mine, state = mine + "R", NEXT[state]
                break
            letters.append(mine + "D" * self.more[i])
        tail = ""
        while last and known[n][state]:
            tail, state = tail + "I", NEXT[state]
        return [*letters, tail], state


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[Stretch]:
    now: Stretch | None = None
    for b in batches:
        for conv, turn, role, digest, copies, fault in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "copies", "fault")), strict=True):
            if now is None or conv != now.conv:
                if now:
                    yield now
                now = Stretch(conv)
            now.add(turn, role, digest, copies, fault)
    if now:
        yield now


def _crossing(ordered: DataFrame, task) -> list[dict]:  # noqa: ANN001
    """task(part, stretch, first) of the first and last stretch in each partition: at most two rows for each partition."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ends = None, []

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal part
            for b in batches:
                if b.num_rows and part is None:
                    part = b.column("part")[0].as_py()
                yield b

        for s in _stretches(seen()):
            ends = [ends[0], s] if ends else [s]
        if ends:
            out = [json.dumps(task(part, s, i == 0)) for i, s in enumerate(ends)]
            yield pa.RecordBatch.from_arrays([pa.array(out)], ["found"])

    return [json.loads(r[0]) for r in ordered.mapInArrow(make, "found string").collect()]


@dataclass
class Crossing:
    """What stretches of conversations that cross partitions need: the distances behind them, their first state, and the row before them."""

    ends: dict[tuple[int, bool], tuple] = field(default_factory=dict)
    starts: dict[tuple[int, bool], int] = field(default_factory=dict)
    before: dict[tuple[int, bool], str] = field(default_factory=dict)

    def of(self, part: int, first: bool, last: bool) -> tuple[int, bool] | None:
        """The key of a stretch that crosses, if it does; one that is first and last in its partition is named as first."""
        key = (part, first)
        return key if (first or last) and key in self.ends else None


def crossing(ordered: DataFrame) -> Crossing:
    """Chains the stretches of each conversation that lies in several partitions."""
    found = _crossing(ordered, lambda part, s, first: {"part": part, "first": first, "conv": repr(s.conv), "across": s.across(), "initial": s.initials[-1]})
    found.sort(key=lambda r: (r["part"], not r["first"]))
    chains: list[list[dict]] = []
    for r in found:
        if chains and chains[-1][-1]["part"] != r["part"] and chains[-1][-1]["conv"] == r["conv"]:
            chains[-1].append(r)
        else:
            chains.append([r])
    made = Crossing()
    chains = [c for c in chains if len(c) > 1]
    for c in chains:
        ends = END
        for r in reversed(c):
            made.ends[r["part"], r["first"]] = ends
            ends = tuple(min(d + e for d, e in zip(row, ends, strict=True) if d >= 0) for row in r["across"])
        for a, b in zip(c, c[1:], strict=False):
            made.before[b["part"], b["first"]] = a["initial"]
    last = {(c[-1]["part"], c[-1]["first"]) for c in chains}

    def maps(part: int, s: Stretch, first: bool) -> dict:
        key = made.of(part, first, True)
        known = s.distances(made.ends[key]) if key else None
        return {"part": part, "first": first, "to": [s.walk(known, state, key in last)[1] for state in range(4)] if known else []}

    if chains:
        to = {(r["part"], r["first"]): r["to"] for r in _crossing(ordered, maps)}
        for c in chains:
            state = START
            for r in c:
                key = (r["part"], r["first"])
                made.starts[key] = state
                state = to[key][state]
    return made


def decisions(ordered: DataFrame, links: Crossing) -> DataFrame:
    """For each stretch a row with its audit, cost and illegal neighbours (kind 0), and for each row that gives text, or has inserts beside it, its new role (kind 1)."""
    types = dict(ordered.dtypes)
    last_of = {k for k, ends in links.ends.items() if ends == END}
    schema = f"conv_id {types['conv_id']}, kind int, part int, audit string, cost long, illegal long, turn {types['turn']}, role string, digest binary, before array<string>, new_role string, after array<string>"

    def summed(s: Stretch, part: int, first: bool, last: bool) -> Iterator[tuple]:
        key = links.of(part, first, last)
        state, ends = (links.starts[key], links.ends[key]) if key else (START, END)
        letters, _ = s.walk(s.distances(ends), state, key is None or key in last_of)
        cost, previous = 0, links.before.get(key) if key else None
        illegal = 0
        for i, initial in enumerate(s.initials):
            illegal += s.more[i] + (previous is not None and previous + initial not in ("su", "ua", "au"))
            previous = initial
        kept, pending = [], []
        for i, mine in enumerate(letters):
            before, new_role = [], None
            for c in mine:
                if c == "I":
                    before.append(DUE[state])
                    state, cost = NEXT[state], cost + INSERT
                elif c == "D":
                    cost += DELETE
                else:
                    keeps_system = c == "K" and s.initials[i] == "s"
                    new_role = s.rows[i][1] if c == "K" else DUE[state]
                    state, cost = SYSTEM if keeps_system else NEXT[state], cost + s.extra[i] + (c == "R")
            if i == len(s.rows):
                pending = before
            elif before or new_role is not None:
                kept.append([i, before, new_role, []])
        if pending:  # behind the last row
            if not kept or kept[-1][0] != len(s.rows) - 1:
                kept.append([len(s.rows) - 1, [], None, []])
            kept[-1][3] = pending
        yield (s.conv, 0, part, "".join(letters), cost, illegal, None, None, None, None, None, None)
        for i, before, new_role, after in kept:
            yield (s.conv, 1, part, None, None, None, *s.rows[i], before, new_role, after)

    names = [x.split()[0] for x in schema.split(", ")]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, fields = None, None

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal part, fields
            for b in batches:
                if b.num_rows and part is None:
                    part, fields = b.column("part")[0].as_py(), b.schema
                yield b

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [fields.field("conv_id").type, pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), fields.field("turn").type, pa.string(), pa.binary(), pa.list_(pa.string()), pa.string(), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        out: list[tuple] = []
        waiting, first = None, True
        for s in _stretches(seen()):
            if waiting:
                out += summed(waiting, part, first, False)
                first = False
            waiting = s
            if len(out) > 20_000:
                yield batch(out)
                out = []
        if waiting:
            out += summed(waiting, part, first, True)
        if out:
            yield batch(out)

    return ordered.mapInArrow(make, schema)


def digests(kept: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired rows. Decisions and texts are sorted into the conversations' order and read as one stream."""
    order = ["conv_id", "turn", "role", "digest"]
    texts = rows.where(_last(F.col("text")) != "").select("conv_id", "turn", "role", _digest(), F.lit(None).cast("array<string>").alias("before"), F.lit(None).cast("string").alias("new_role"), F.lit(None).cast("array<string>").alias("after"), F.col("text").cast("binary").alias("text"))
    asks = kept.select(*order, "before", "new_role", "after", F.lit(None).cast("binary").alias("text"))
    both = asks.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order, F.col("before").isNull())
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, repaired_sha256 string"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, sha, empty, ask, kind = None, None, True, None, None

        def put(*parts: bytes) -> None:
            nonlocal empty
            if not empty:
                sha.update(b"\n")
            empty = False
            for p in parts:
                sha.update(p)

        def close() -> None:
            """Ends the open decision: what stands behind its row."""
            nonlocal ask
            if ask:
                for r in ask[2]:
                    put(r.encode(), b":")
            ask = None

        for b in batches:
            kind = b.schema.field("conv_id").type
            for i in range(b.num_rows):
                c = b.column("conv_id")[i].as_py()
                if sha is None or c != conv:
                    if sha:
                        close()
                        done.append((conv, sha.hexdigest()))
                    conv, sha, empty = c, hashlib.sha256(), True
                if b.column("before")[i].is_valid:
                    close()
                    key = tuple(b.column(x)[i].as_py() for x in ("turn", "role", "digest"))
                    ask = [key, b.column("new_role")[i].as_py(), b.column("after")[i].as_py(), False]
                    for r in b.column("before")[i].as_py():
                        put(r.encode(), b":")
                elif ask and ask[1] is not None and not ask[3] and ask[0] == tuple(b.column(x)[i].as_py() for x in ("turn", "role", "digest")):
                    put(ask[1].encode(), b":", b.column("text")[i].as_buffer())
                    ask[3] = True
        if sha:
            close()
            done.append((conv, sha.hexdigest()))
            for at in range(0, len(done), 10_000):
                ids, found = zip(*done[at : at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(found)], ["conv_id", "repaired_sha256"])

    return both.mapInArrow(make, schema)


def ordered_faults(rows: DataFrame) -> DataFrame:
    """The faults of damaged rows, range partitioned in the conversations' order, with the number of each row's partition."""
    order = ["conv_id", "turn", "role", "digest"]
    found = faults(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(found.withColumn("part", F.spark_partition_id()))


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of the conversations (conv_id, turn, role, text) after the damage: counts of faults, cheapest cost, audit and digest."""
    rows = damaged(conversations)
    ordered = ordered_faults(rows)
    made = cut(decisions(ordered, crossing(ordered)))
    stretch = F.struct("part", "audit")
    audits = made.where("kind = 0").groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(stretch)), lambda s: s["audit"]), "").alias("audit"),  # a string for each partition that the conversation lies in
        F.sum("cost").alias("cost"),
        F.sum("illegal").alias("illegal"),
    )
    fault, more = F.col("fault"), F.col("copies") - 1
    counts = ordered.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"),
        F.sum(F.when(fault == "blank", F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(fault == "blank", 0).when(fault == "duplicate", F.col("copies")).otherwise(more)).alias("duplicate"),
        F.sum(F.when(fault == "truncated", 1).otherwise(0)).alias("truncated"),
    )
    hashes = digests(made.where("kind = 1"), rows)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    every = conversations.select("conv_id").distinct()
    for part in (audits, counts, hashes):
        every = every.unionByName(part, allowMissingColumns=True)
    every = every.groupBy("conv_id").agg(*(F.max(n).alias(n) for n in names))
    none = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return every.select("conv_id", *(F.coalesce(F.col(n), F.lit(none.get(n, 0))).cast("string" if n in none else "long").alias(n) for n in names))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


def _sql() -> str:
    """The damage with its checksum by a table of bytes, faults by windows, and the cheapest edits forwards: for each state the least (cost, audit, rows) so far."""
    best = lambda *x: f"list_min([{', '.join(x)}])"
    step = lambda x, cost, letter, line: f"{{'c': {x}.c + {cost}, 'a': {x}.a || {letter}, 'r': {x}.r || {line}}}"
    inf = "{'c': CAST(1000000000000 AS BIGINT), 'a': '', 'r': ''}"
    drop = lambda x: step(x, DELETE, "'D'", "''")
    put = lambda x, role: step(x, INSERT, "'I'", f"chr(10) || '{role}:'")

    def take(x: str, role: str) -> str:
        keep = f"ini = '{role[0]}'"
        made = step(x, f"extra + CASE WHEN {keep} THEN 0 ELSE {REROLE} END", f"CASE WHEN {keep} THEN 'K' ELSE 'R' END", f"chr(10) || CASE WHEN {keep} THEN role ELSE '{role}' END || ':' || text")
        return f"CASE WHEN gone THEN {inf} ELSE {made} END"

    keep_system = f"CASE WHEN ini = 's' AND NOT gone THEN {step('b1', 'extra', chr(39) + 'K' + chr(39), 'chr(10) || role || chr(58) || text')} ELSE {inf} END"
    arcs = f"{drop('b1')} AS n1, {best(drop('b2'), keep_system)} AS n2, {best(drop('b3'), take('b1', 'user'), take('b2', 'user'), take('b4', 'user'))} AS n3, {best(drop('b4'), take('b3', 'assistant'))} AS n4"
    opened = f"n1 AS b1, n2 AS b2, {best('n3', put('n1', 'user'), put('n2', 'user'), put('n4', 'user'))} AS b3, n4"
    closed = f"b1, b2, b3, {best('n4', put('b3', 'assistant'))} AS b4"
    white = r"[\x20\x09-\x0D]"
    return rf"""WITH RECURSIVE bytes AS MATERIALIZED (SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS tab FROM range(256) t(b)),
 k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS key FROM conversations),
 f AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), key), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault FROM k, bytes),
 d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM f WHERE fault <> 0),
 n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d),
 m AS (SELECT *, regexp_replace(text, '{white}+$', '') AS bare, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM n),
 r AS MATERIALIZED (SELECT conv_id, turn, i, role, text, left(role, 1) AS ini, bare = '' AS blank, bare <> '' AND again AS duplicate, bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated, bare = '' OR again AS gone,
   CASE WHEN bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS extra, prior IS NOT NULL AND left(prior, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM m),
 w(conv_id, i, b1, b2, b3, b4) AS (
   SELECT conv_id, CAST(0 AS BIGINT), {closed} FROM (SELECT conv_id, {opened} FROM (SELECT DISTINCT conv_id, {{'c': CAST(0 AS BIGINT), 'a': '', 'r': ''}} AS n1, {inf} AS n2, {inf} AS n3, {inf} AS n4 FROM conversations))
   UNION ALL
   SELECT conv_id, i, {closed} FROM (SELECT conv_id, i, {opened} FROM (SELECT w.conv_id AS conv_id, r.i AS i, {arcs} FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1))),
 e AS (SELECT conv_id, arg_max({best('b1', 'b4')}, i) AS b FROM w GROUP BY conv_id),
 s AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(illegal) AS illegal FROM r GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
 e.b.c AS cost, e.b.a AS audit, sha256(substr(e.b.r, 2)) AS repaired_sha256 FROM e LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""


SQL = _sql()
