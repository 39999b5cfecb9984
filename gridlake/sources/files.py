"""Small files beside the data, through Hadoop's file system (any store that Spark can read)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Read, write and list under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path, self._io = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if there is no folder."""
        if not self._fs.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self.path(folder))]

    def modified(self, name: str) -> int:
        """Milliseconds since the epoch of the last change."""
        return int(self._fs.getFileStatus(self.path(name)).getModificationTime())

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file in one step; False if the name is taken.

        The text goes to a file of its own first and gets its name by a rename, so
        a reader sees all of it or nothing.
        """
        if self._fs.exists(self.path(name)):
            return False
        folder, _, last = name.rpartition("/")
        hidden = f"{folder}/.{last}-{uuid.uuid4().hex}"
        out = self._fs.create(self.path(hidden), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self._fs.exists(self.path(name)) or not self._fs.rename(self.path(hidden), self.path(name)):
            self._fs.delete(self.path(hidden), False)
            return False
        return True

    def move(self, name: str, to: str) -> None:
        """Give a file or folder another name, in place of whatever has that; nothing if there is no such file."""
        source, target = self.path(name), self.path(to)
        if not self._fs.exists(source):
            return
        if not self._fs.delete(target, True):
            self._fs.mkdirs(target.getParent())
        if not self._fs.rename(source, target):
            raise OSError(f"{source.toString()} cannot be moved to {target.toString()}")

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)
