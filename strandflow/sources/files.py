"""Small files in whatever store Spark reads: read, replaced whole, deleted."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Files under ``root`` by their path from there, through the cluster's file system classes."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._gateway = root.rstrip("/"), spark.sparkContext._gateway
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.root).getFileSystem(self._conf)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _at(self, name: str):
        return self._fs.makeQualified(self._hadoop.Path(self.path(name)))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def read(self, name: str) -> str | None:
        if not self._fs.exists(self._at(name)):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Written beside its place and renamed over it, so readers see the old text or the new."""
        target, beside = self._at(name), self._at(f"{name}.{uuid.uuid4().hex}")
        stream = self._fs.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
            stream.hsync()
        finally:
            stream.close()
        kind = getattr(self._hadoop, "Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        self._hadoop.FileContext.getFileContext(target.toUri(), self._conf).rename(beside, target, options)

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
