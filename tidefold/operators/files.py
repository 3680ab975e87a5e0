"""Small files of the lake through Hadoop's file systems.

Publishing needs a file system whose exclusive creation and rename are atomic, as on HDFS or a local disk; on object stores
that lack both, two writers could publish one version.  One writer per lake is safe on any store.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(self.at(name)))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def exists(self, name: str) -> bool:
        return bool(self.fs.exists(self.path(self.at(name))))

    def write(self, name: str, text: str) -> None:
        """Write a file whose name nobody else uses."""
        out = self.fs.create(self.path(self.at(name)), False)
        out.write(text.encode("utf-8"))
        out.close()

    def create(self, name: str, text: str, stale: float = 60.0) -> bool:
        """Write a new file; False if it exists already or another writer is at it.

        The text becomes visible at once, whole: it is written under a name of its own, an exclusively
        created lock decides between writers, and the draft gets the name.  A lock that a
        dead writer left behind is removed after ``stale`` seconds.
        """
        target, lock = self.path(self.at(name)), self.path(self.at(f"{name}.lock"))
        if self.fs.exists(target):
            return False
        draft = self.path(self.at(f"{name}.{uuid.uuid4().hex}.draft"))
        out = self.fs.create(draft, False)
        out.write(text.encode("utf-8"))
        out.close()
        if self.fs.createNewFile(lock) and not self.fs.exists(target):
            done = bool(self.fs.rename(draft, target))
            self.fs.delete(lock, False)
            return done
        self.fs.delete(draft, False)
        if not self.fs.exists(target) and self.fs.exists(lock):
            if time.time() - self.fs.getFileStatus(lock).getModificationTime() / 1000 > stale:
                self.fs.delete(lock, False)
        return False

    def list(self, folder: str, recursive: bool = False) -> list[tuple[str, int, int]]:
        """(path, bytes, modification time in ms) of the files in a folder."""
        top = self.path(self.at(folder))
        if not self.fs.exists(top):
            return []
        found, files = [], self.fs.listFiles(top, recursive)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return found

    def delete(self, path: str) -> bool:
        return bool(self.fs.delete(self.path(path), True))

    def absolute(self, path: str) -> str:
        return self.fs.makeQualified(self.path(path)).toString()
