"""A small state kept as numbered files in a folder of any file system Spark can reach."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class StateLog:
    """The newest state wins; it appears by a rename, so a reader never sees half of one."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._files = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, name)

    def _names(self) -> list[str]:
        if not self._files.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._folder)]
        return sorted(name for name in names if name.endswith(".json") and name[0] != "_")

    def read(self) -> dict:
        """The newest state, or an empty one."""
        names = self._names()
        if not names:
            return {}
        stream = self._files.open(self._path(names[-1]))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, state: dict) -> None:
        """Add a state; the one before it is kept, older ones go."""
        names = self._names()
        name = f"{int(names[-1].partition('.')[0]) + 1 if names else 0:020d}.json"
        unfinished = self._path(f"_{name}")
        stream = self._files.create(unfinished, True)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        self._files.rename(unfinished, self._path(name))
        for old in self._names()[:-2]:
            self._files.delete(self._path(old), False)

    def complete(self, folder: str) -> bool:
        """Whether a table folder has been written to its end."""
        return self._files.exists(self._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS"))

    def children(self, folder: str) -> list[str]:
        """Names of what lies in a folder."""
        place = self._jvm.org.apache.hadoop.fs.Path(folder)
        return [s.getPath().getName() for s in self._files.listStatus(place)] if self._files.exists(place) else []

    def move(self, folder: str, to: str) -> None:
        """Rename a folder that has been written to its end; readers see all of it or nothing."""
        place = self._jvm.org.apache.hadoop.fs.Path(to)
        self._files.mkdirs(place.getParent())
        if not self._files.rename(self._jvm.org.apache.hadoop.fs.Path(folder), place):
            raise OSError(f"could not move {folder} to {to}")

    def remove(self, folder: str) -> None:
        self._files.delete(self._jvm.org.apache.hadoop.fs.Path(folder), True)
