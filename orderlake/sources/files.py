"""Folders and small files of any file system that Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Small files and folders of whatever file system a path names."""

    def __init__(self, spark: SparkSession, base: str):
        self._jvm = spark._jvm
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(base).getFileSystem(configuration)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._path(folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(folder))]

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files below a folder."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Write beside the file, then put it in place."""
        partial = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self._fs.create(self._path(partial), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.delete(path)
        if not self._fs.rename(self._path(partial), self._path(path)):
            raise OSError(f"cannot write {path}")

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._path(folder))

    def move(self, path: str, to: str) -> None:
        self.make(to.rpartition("/")[0])
        if not self._fs.rename(self._path(path), self._path(to)):
            raise OSError(f"cannot move {path} to {to}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
