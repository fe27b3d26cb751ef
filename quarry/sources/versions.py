"""Versioned tables in a folder, each version committed by a marker.

A version is written whole: its tables first, then an empty marker file. Readers
only see versions that have the marker, so a job that dies while writing leaves a
folder nobody reads, and the next attempt at that version replaces it. The folder
is reached through Hadoop's file systems, so it may lie in any shared store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_MARKER = "_COMMITTED"


class Versions:
    """The committed versions under ``path``; a version is a number from 0 up."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    @staticmethod
    def _name(version: int) -> str:
        return f"v{version:018d}"

    def complete(self) -> list[int]:
        """Committed versions, oldest first."""
        fs, where = self._at()
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        found = sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())
        return [v for v in found if fs.exists(self._at(self._name(v), _MARKER)[1])]

    def latest(self) -> int | None:
        found = self.complete()
        return found[-1] if found else None

    def write(self, version: int, **tables: DataFrame) -> None:
        """Write a version's tables as Parquet, then commit it. A version of
        that number, complete or not, is replaced."""
        self.drop(version)
        for name, df in tables.items():
            df.write.parquet("/".join([self.path, self._name(version), name]))
        fs, marker = self._at(self._name(version), _MARKER)
        fs.create(marker, True).close()

    def table_path(self, version: int, name: str) -> str:
        return "/".join([self.path, self._name(version), name])

    def read(self, version: int, name: str) -> DataFrame:
        return self.spark.read.parquet(self.table_path(version, name))

    def drop(self, version: int) -> None:
        """Delete a version; its marker goes first, so that no reader sees half of it."""
        fs, marker = self._at(self._name(version), _MARKER)
        fs.delete(marker, False)
        fs.delete(self._at(self._name(version))[1], True)

    def keep_last(self, n: int) -> None:
        for version in self.complete()[:-n]:
            self.drop(version)
