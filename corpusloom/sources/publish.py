"""Tables that are replaced in one step: a folder for each version, and a pointer that a single rename swaps.

A writer writes a new version beside the others, and only then renames a small pointer file over the one that readers look at. A
writer that dies before that leaves the old version in place; what it wrote is never named by the pointer, and `sweep` removes it. A
reader resolves the pointer once, so it keeps reading the version it began with while others publish. The version before is the
backup: `roll_back` points to it again. All of it goes through Hadoop's file API, so it works where Spark's paths do; the store must have an atomic
rename (HDFS and local disks have, plain object stores need a committer of their own).
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


class Published:
    """A table at a path, by version."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._context = self._fs.FileContext.getFileContext(self._of("x").toUri(), spark.sparkContext._jsc.hadoopConfiguration())

    def _of(self, *parts: str) -> Any:  # noqa: ANN401
        return self._fs.Path("/".join([self.path, *parts]))

    def versions(self) -> list[str]:
        """All versions that were begun, oldest first; names sort by number."""
        if not self._context.util().exists(self._of("versions")):
            return []
        return sorted(s.getPath().getName() for s in self._context.util().listStatus(self._of("versions")) if s.isDirectory())

    def _pointed(self) -> list[str]:
        """The versions that the pointer names: the current one, then the earlier ones that are kept."""
        if not self._context.util().exists(self._of(POINTER)):
            return []
        stream = self._context.open(self._of(POINTER))
        try:
            return bytes(stream.readAllBytes()).decode().split()
        finally:
            stream.close()

    def current(self) -> str | None:
        return next(iter(self._pointed()), None)

    def _point(self, versions: list[str]) -> None:
        """Writes a pointer beside the real one and renames it over that, which readers see as one step."""
        fresh = self._of(f"_{POINTER}-{uuid.uuid4().hex}")
        file_system = fresh.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        stream = file_system.create(fresh, True)
        try:
            stream.write(bytearray("\n".join(versions).encode()))
        finally:
            stream.close()
        gateway = self.spark.sparkContext._gateway
        options = gateway.new_array(self._fs.Options.Rename, 1)
        options[0] = self._fs.Options.Rename.OVERWRITE
        self._context.rename(fresh, self._of(POINTER), options)

    def write(self, df: DataFrame) -> str:
        """Writes df as a new version that no reader sees yet, and returns its name."""
        seen = [int(v[1:9]) for v in self.versions()]
        name = f"v{max(seen, default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"  # two writers at once get names of their own
        df.write.parquet(f"{self.path}/versions/{name}")
        return name

    def publish(self, df: DataFrame, keep: int = 1) -> str:
        """Writes df and makes it current; `keep` versions before it stay as backups."""
        before = self._pointed()
        name = self.write(df)
        self._point([name, *before[:keep]])
        return name

    def read(self, version: str | None = None) -> DataFrame:
        """The current version, or a named one. What is read stays that version whatever is published later."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"nothing is published at {self.path}")
        return self.spark.read.parquet(f"{self.path}/versions/{version}")

    def roll_back(self) -> str:
        """Makes the version before current again."""
        pointed = self._pointed()
        if len(pointed) < 2:
            raise FileNotFoundError(f"no backup at {self.path}")
        self._point(pointed[1:])
        return pointed[1]

    def sweep(self) -> list[str]:
        """Removes versions that the pointer doesn't name: those of dead writers and old ones. Run it when no writer or reader of them is at work."""
        pointed = set(self._pointed())
        gone = [v for v in self.versions() if v not in pointed]
        for v in gone:
            self._context.delete(self._of("versions", v), True)
        return gone
