"""Versions of a set of tables, of which readers see whole ones only.

A rebuild writes a new version beside the old ones. Its last act is one small file that names it;
until then, and for ever if the rebuild dies, readers see the version before. Readers that began
with an old version go on reading it, as its files are not touched.

    store/versions/<version>/<table>/...      the files of each version
    store/published/...                       one row for each version that was completed
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from linkloom.sources import files

_SCHEMA = "number long, version string"


class Snapshots:
    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.store = spark, store.rstrip("/")

    def folder(self, version: str) -> str:
        return f"{self.store}/versions/{version}"

    def begin(self) -> str:
        """The name of a new version. Nothing is seen of it before it is published."""
        return uuid.uuid4().hex

    def published(self) -> list[str]:
        """All completed versions, the oldest first."""
        if not files.exists(self.spark, f"{self.store}/published"):
            return []
        rows = self.spark.read.schema(_SCHEMA).parquet(f"{self.store}/published").collect()
        return [r["version"] for r in sorted(rows)]

    def current(self) -> str | None:
        done = self.published()
        return done[-1] if done else None

    def publish(self, version: str) -> None:
        """Make ``version`` the one that is read. The row is written as one file, which a commit
        moves to its place at once or not at all."""
        number = len(self.published())
        row = self.spark.createDataFrame([(number, version)], _SCHEMA)
        row.coalesce(1).write.mode("append").parquet(f"{self.store}/published")

    def drop_old(self, keep: int = 2) -> None:
        """Delete the files of all published versions but the last ``keep``."""
        for version in self.published()[:-keep]:
            files.delete(self.spark, self.folder(version))
