"""What the operators share: the shared folder, cut lineage, and running totals that no hot key can pile into one task."""

from __future__ import annotations

import gc
import tempfile
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of the word rule, as bytes: space and 0x09 to 0x0D.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: The same word rule as a regular expression.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new local one where that is unset and all runs on this machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="corpusloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """df written once to the shared folder: later readers don't compute it again, and lost executors lose nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of plans that nothing refers to any more, before the next large step.

    Python's references go first, then the driver's; each round frees what the one before it has let go.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def running(df: DataFrame, keys: list[str], order: list[Column | str], bucket: Column, value: Column | None = None) -> DataFrame:
    """Adds `rank0` (rows before this one in its group) and, with a value, `before` (their values' sum) in the order (bucket, order).

    A group is first summed by bucket (partial sums before the shuffle), the few bucket sums are
    accumulated, and rows are then only ordered inside one (group, bucket). So a group that holds
    a third of all rows is spread over as many tasks as it has buckets. bucket must not decrease
    along the wanted order, or the order is that of (bucket, order), which suits any use that
    only needs some fixed order. Keys and bucket must not be null. df is read twice, so pass a
    cheap or a cut one.
    """
    at = [*keys, "_bucket"]
    value = F.lit(0).cast("long") if value is None else value
    df = df.withColumn("_bucket", bucket).withColumn("_value", value)
    ahead = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*at).agg(F.count("*").alias("_n"), F.sum("_value").alias("_v"))
    sums = sums.select(*at, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_v").over(ahead), F.lit(0)).alias("_v0"))
    inside = Window.partitionBy(*at).orderBy(*order)
    prior = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(sums, at)
        .withColumn("rank0", F.col("_n0") + F.row_number().over(inside) - 1)
        .withColumn("before", F.col("_v0") + F.coalesce(F.sum("_value").over(prior), F.lit(0)))
        .drop("_bucket", "_value", "_n0", "_v0")
    )
