"""A session's file system, for the few small files and renames that stores commit with.

Paths go through the Hadoop file system of the session, so they may lie in any store the
cluster mounts.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession

_MOVES = threading.Lock()


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str = "") -> list[str]:
        """Names of what lies in a folder; none if there is no such folder."""
        if not self.exists(folder):
            return []
        return sorted(st.getPath().getName() for st in self.fs.listStatus(self.path(folder)))

    def age_s(self, name: str) -> float:
        import time
        return time.time() - self.fs.getFileStatus(self.path(name)).getModificationTime() / 1000

    def make(self, folder: str) -> None:
        self.fs.mkdirs(self.path(folder))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def read_text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def move_new(self, source: str, target: str) -> bool:
        """Rename ``source`` to ``target``; False, and nothing done, where that exists already.

        HDFS renames atomically without replacing; on a local disk the lock does so among
        the threads of one process.
        """
        fs = self.jvm.org.apache.hadoop.fs
        none = getattr(fs, "Options$Rename").NONE
        options = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
        options[0] = none
        with _MOVES:
            if self.exists(target):
                return False
            try:
                fs.FileContext.getFileContext(self.path("").toUri(), self.conf).rename(
                    self.path(source), self.path(target), options)
            except Exception:
                if self.exists(target) and self.exists(source):
                    return False
                raise
        return True
