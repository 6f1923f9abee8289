"""Tables that are replaced as a whole: written aside, then switched to by one rename.

A version is a folder that no reader knows yet. A pointer, a text file of a few bytes, names the
version in use; it is written beside and renamed over the old one through Hadoop's file system,
which does that as one step where the file system can (HDFS, local disks; object stores replace a
small file in one request). A reader resolves the pointer once. So a job lost at any point leaves
the old rows or the new ones, never none or some of both. The version before stays for readers
that have resolved it; older ones, and those that were never switched to, go with the next switch.
There is one writer a table at a time.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Versions that stay: the one in use and the one before.
KEPT_VERSIONS = 2


class Switch:
    """Versions of the tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _hadoop(self, path: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return jvm, at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _pointer(self, table: str) -> str:
        return f"{self.root}/_current/{table}"

    def versions(self, table: str) -> list[str]:
        """Names of the versions in use, newest first; none for a table that never was switched."""
        jvm, at, files = self._hadoop(self._pointer(table))
        try:
            stream = files.open(at)
        except Py4JJavaError as e:
            if "FileNotFoundException" in str(e.java_exception.getClass()):
                return []
            raise
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
        finally:
            stream.close()

    def current(self, table: str) -> str | None:
        """Folder of the version in use."""
        known = self.versions(table)
        return self.folder(table, known[0]) if known else None

    def folder(self, table: str, name: str) -> str:
        return f"{self.root}/_versions/{table}/{name}"

    def stage(self, rows: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> str:
        """Write a version that no reader sees; returns its name. ``rows`` may read the table itself."""
        name = uuid.uuid4().hex
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        writer.parquet(self.folder(table, name))
        return name

    def staged(self, table: str, name: str) -> DataFrame:
        """The rows of a version, in use or not."""
        return self.spark.read.parquet(self.folder(table, name))

    def switch(self, table: str, name: str) -> None:
        """From now on readers see this version."""
        kept = [name, *[v for v in self.versions(table) if v != name]][:KEPT_VERSIONS]
        aside = self._pointer(f"_{table}-{name}")
        jvm, at, files = self._hadoop(aside)
        stream = files.create(at, True)
        stream.write(bytearray("\n".join(kept).encode()))
        stream.close()
        fs = jvm.org.apache.hadoop.fs
        option = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
        option[0] = getattr(fs, "Options$Rename").OVERWRITE
        files_of = fs.FileContext.getFileContext(at.toUri(), self.spark._jsc.hadoopConfiguration())
        files_of.rename(at, fs.Path(self._pointer(table)), option)
        self._forget(table, kept)

    def _forget(self, table: str, kept: list[str]) -> None:
        jvm, at, files = self._hadoop(f"{self.root}/_versions/{table}")
        for found in files.listStatus(at):
            if found.getPath().getName() not in kept:
                files.delete(found.getPath(), True)

    def replace(self, rows: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> None:
        self.switch(table, self.stage(rows, table, partition_by))
