"""Streaming versions of the batch patterns: monthly and hourly counts with late data, deduplication and sessions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import work_folder


def stream(spark: SparkSession, path: str, files: int = 8) -> DataFrame:
    """A folder or file of Parquet as a stream, a few files at a time. Times without a zone become UTC times, as watermarks need them.

    The path is given as a pattern that only it matches: a plain path would have to be a folder.
    """
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{path[:-1]}[{path[-1]}]")
    zoneless = [f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"]
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def lateness(spark: SparkSession, path: str, column: str = "ts") -> str:
    """The whole spread of a table's times and a second: with a watermark that much behind, no row is late, in whatever order its files are read."""
    time = F.col(column).cast("timestamp")
    spread = spark.read.parquet(path).agg((F.unix_micros(F.max(time)) - F.unix_micros(F.min(time))).alias("us")).first()["us"] or 0
    return f"{spread // 1_000_000 + 2} seconds"


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    rows = events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type")
    return rows.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


SHARDS = 16
_COUNTED = "kind string, start timestamp, event_type string, shard int, n long, total double, event_id long, ts timestamp, held int"


def counts_with_late(events: DataFrame, size_s: int = 3600, late: str = "1 day") -> DataFrame:
    """Windowed counts whose state holds only windows that the watermark hasn't passed, with a side output of the rows that came too late.

    Rows of `kind`: `open` (a window's counts so far, again whenever they change), `closed` (its last counts, when the watermark has
    passed it) and `late` (one row of a window that is closed, with its event_id and time); `held` is how many windows the key then holds. A
    key is an event type and a shard of it, so a type with a third of all rows is spread over SHARDS keys; its windows close
    with its next rows. Spark's own window aggregation would drop late rows without a trace.
    """
    keys = ["event_type", "shard"]
    state = "start array<long>, n array<long>, total array<double>"

    def count(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        windows = {s: [n, t] for s, n, t in zip(*held.get, strict=True)} if held.exists else {}
        passed = held.getCurrentWatermarkMs() // 1000
        out: list[tuple] = []
        changed: set[int] = set()
        for f in frames:
            start = f["ts"].astype("int64") // 10**9 // size_s * size_s if str(f["ts"].dtype).endswith("[ns]") else f["ts"].astype("datetime64[s]").astype("int64") // size_s * size_s
            late_rows = start + size_s <= passed
            for s, i, ts, v in zip(start[late_rows], f["event_id"][late_rows], f["ts"][late_rows], f["value"][late_rows], strict=True):
                out.append(("late", s, 1, v, i, ts))
            sums = f["value"][~late_rows].groupby(start[~late_rows]).agg(["size", "sum"])
            for s, n, t in zip(sums.index, sums["size"], sums["sum"], strict=True):
                mine = windows.setdefault(int(s), [0, 0.0])
                mine[0], mine[1] = mine[0] + int(n), mine[1] + float(t)
                changed.add(int(s))
        for s in sorted(windows):
            if s + size_s <= passed:
                out.append(("closed", s, *windows.pop(s), None, None))
            elif s in changed:
                out.append(("open", s, *windows[s], None, None))
        if windows:
            order = sorted(windows)
            held.update((order, [windows[s][0] for s in order], [windows[s][1] for s in order]))
        elif held.exists:
            held.remove()
        if out:
            f = pd.DataFrame(out, columns=["kind", "start", "n", "total", "event_id", "ts"])
            f["start"], f["event_id"], f["ts"] = pd.to_datetime(f["start"], unit="s"), f["event_id"].astype("Int64"), pd.to_datetime(f["ts"])
            yield f.assign(event_type=key[0], shard=key[1], held=len(windows))[[c.split()[0] for c in _COUNTED.split(", ")]]

    rows = events.withWatermark("ts", late).withColumn("value", F.coalesce("value", F.lit(0.0))).withColumn("shard", F.pmod(F.xxhash64("event_id"), F.lit(SHARDS)).cast("int"))
    return rows.select("event_id", "ts", "event_type", "value", "shard").groupBy(*keys).applyInPandasWithState(count, _COUNTED, state, "update", GroupStateTimeout.NoTimeout)


def settled(outputs: DataFrame) -> DataFrame:
    """start, event_type, n, total of what `counts_with_late` wrote (with the number of the batch): the last counts of each window and shard, and the late rows."""
    counted = outputs.where("kind <> 'late'").groupBy("start", "event_type", "shard").agg(F.max_by("n", "number").alias("n"), F.max_by("total", "number").alias("total"))
    every = counted.select("start", "event_type", "n", "total").unionByName(outputs.where("kind = 'late'").select("start", "event_type", "n", "total"))
    return every.groupBy("start", "event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def unique_events(events: DataFrame, key: str = "event_id", late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    rows = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return rows.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def drain(result: DataFrame, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """Runs a stream over all data that is there, with its state and progress in the shared folder, and returns what it wrote.

    In `update` mode each batch holds new values of changed keys; the last one of each key counts, or without keys all rows come with the `number` of their batch. In `complete` mode each batch
    holds the whole result, also what a watermark hasn't passed; the last batch counts.
    """
    spark = result.sparkSession
    folder = work_folder(spark, "stream")
    if mode == "append":
        query = result.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.read.schema(result.schema).parquet(f"{folder}/out")

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/number={number}")

    query = result.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema(f"{_ddl(result)}, _batch int, number int").parquet(f"{folder}/out")
    if mode == "update" and keys is None:
        return rows.drop("_batch")
    if mode == "complete":
        last = rows.agg(F.max("number")).first()[0]
        return rows.where(F.col("number") == F.lit(-1 if last is None else last)).select(*result.columns)
    values = [c for c in result.columns if c not in keys]
    return rows.groupBy(*keys).agg(*(F.max_by(c, "_batch").alias(c) for c in values)).select(*result.columns)
