"""Folder operations through Hadoop's file system API, on whatever storage a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Written after all data files of a folder; a folder without it does not count.
COMMITTED = "_COMMITTED"


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _child(self, *names: str):
        return self._path("/".join([self.path, *names]))

    def list(self) -> list[str]:
        root = self._path(self.path)
        if not self._fs.exists(root):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(root)]

    def committed(self, name: str) -> bool:
        return self._fs.exists(self._child(name, COMMITTED))

    def commit(self, name: str) -> None:
        self._fs.create(self._child(name, COMMITTED), True).close()

    def revoke(self, name: str) -> None:
        self._fs.delete(self._child(name, COMMITTED), False)

    def bytes(self, name: str) -> int:
        return int(self._fs.getContentSummary(self._child(name)).getLength())

    def remove(self, name: str) -> None:
        self._fs.delete(self._child(name), True)
