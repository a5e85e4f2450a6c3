"""Sessions with the settings that the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "corpusloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with UTC times and adaptive execution; `settings` use _ for the dots of Spark's names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for k, v in (fixed | {k.replace("_", "."): v for k, v in settings.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, or a local one where that is unset and all runs on this machine (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return f"{base}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), name)
