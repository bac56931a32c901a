"""Small file operations on the store's file system, whichever one Hadoop serves the path with."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


# Letters that Hadoop and Spark read as patterns wherever a path is given.
PATTERN_LETTERS = set("*?[]{}\\")


class Storage:
    def __init__(self, spark: SparkSession, root: str):
        if PATTERN_LETTERS & set(root):
            raise ValueError(f"A store's root may not hold any of * ? [ ] {{ }} \\: {root}")
        self._jvm = spark._jvm
        path = self._path(root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self._fs.makeQualified(path).toString()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def make_dir(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        """Remove a file or folder; one that is already gone is fine."""
        self._fs.delete(self._path(path), True)

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength()

    def matches(self, pattern: str) -> list[str]:
        return self._paths(self._fs.globStatus(self._path(pattern)))

    def children(self, folder: str) -> list[str]:
        """What stands in a folder; nothing if it is gone, or a file."""
        try:
            found = self._paths(self._fs.listStatus(self._path(folder)))
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "FileNotFoundException":
                return []
            raise
        return [path for path in found if path != folder]

    def _paths(self, statuses) -> list[str]:
        """All paths in one answer of the JVM, however many there are."""
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)
        joined = self._jvm.scala.collection.mutable.ArraySeq.make(paths).mkString("\n")
        return joined.split("\n") if joined else []

    def newest(self, folder: str) -> float:
        """When a file in the folder was last written, in seconds; when the folder was, if it has none."""
        millis = self._fs.getFileStatus(self._path(folder)).getModificationTime()
        files = self._fs.listFiles(self._path(folder), True)
        while files.hasNext():
            millis = max(millis, files.next().getModificationTime())
        return millis / 1000

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"Could not move {source} to {target}")

    def publish(self, folder: str, name: str, text: str) -> None:
        """Write a small file that readers see whole or not at all: hidden name first, then rename."""
        hidden = self._path(f"{folder}/.{name}")
        out = self._fs.create(hidden, False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        if not self._fs.rename(hidden, self._path(f"{folder}/{name}")):
            raise OSError(f"Could not publish {folder}/{name}")
