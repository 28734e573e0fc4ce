"""Files and folders of any store that Spark reaches, handled from the driver.

These are for lists of files and small notes beside tables; rows go through Spark.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Store:
    """The file system of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def files(self, folder: str, suffix: str = ".parquet") -> list[tuple[str, int]]:
        """Paths and sizes of all files below a folder that end in `suffix`; none if it is not there."""
        if not self.exists(folder):
            return []
        found, each = [], self._fs.listFiles(self._path(folder), True)
        while each.hasNext():
            status = each.next()
            if status.getPath().getName().endswith(suffix):
                found.append((status.getPath().toString(), status.getLen()))
        return sorted(found)

    def folders(self, folder: str) -> list[str]:
        """Names of the folders directly in a folder."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)) if s.isDirectory())

    def move(self, source: str, target: str) -> None:
        """Move one file; a target left by a move that did not end is replaced. A move that has ended is no error."""
        if not self.exists(source):
            if self.exists(target):
                return
            raise FileNotFoundError(source)
        if self.exists(target):
            self._fs.delete(self._path(target), False)
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def note(self, path: str) -> dict | None:
        """A small JSON file, or None if it is not there."""
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_note(self, path: str, value: dict) -> None:
        """Write a small JSON file under another name first, so that it is there whole or not at all."""
        draft = f"{path}.draft"
        stream = self._fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(json.dumps(value), "utf-8"))
        finally:
            stream.close()
        self._fs.delete(self._path(path), False)
        if not self._fs.rename(self._path(draft), self._path(path)):
            raise OSError(f"cannot write {path}")
