"""Small metadata files next to the data, on any file system Spark can write."""

from __future__ import annotations

import json
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_renaming = threading.Lock()


class AlreadyThereError(RuntimeError):
    """Another writer created the file first."""


class SharedFiles:
    """Create-once JSON files through the file system of the session."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        hadoop_path = self._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self._conf), hadoop_path

    def create(self, path: str, content: dict) -> None:
        """Write one JSON line; fails when the file exists, so that of two
        writers with the same number only one succeeds. The file is written
        aside and renamed, so a reader never sees half of it."""
        fs, target = self._open(path)
        aside = self._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.aside")
        stream = fs.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(content) + "\n", "utf-8"))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            with _renaming:  # a local file system checks and renames in two steps
                context.rename(aside, target, how)
        except Py4JJavaError as error:
            fs.delete(aside, False)
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise AlreadyThereError(path) from None
            raise

    def put(self, path: str, content: bytes) -> None:
        """Write a small new file."""
        fs, target = self._open(path)
        stream = fs.create(target, False)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()

    def read(self, path: str) -> dict:
        fs, source = self._open(path)
        stream = fs.open(source)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def remove(self, path: str) -> None:
        """Delete a folder this process made for its own intermediate results."""
        fs, folder = self._open(path)
        fs.delete(folder, True)

    def names(self, path: str) -> list[str]:
        """Names directly below a folder, sorted; none when it does not exist."""
        fs, folder = self._open(path)
        if not fs.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(folder))

    def stamps(self, path: str) -> list[tuple[str, int, int]]:
        """(name, length, modification time) of the files directly below a folder."""
        fs, folder = self._open(path)
        return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime())
                      for s in fs.listStatus(folder))

    def leaf_folders(self, path: str, depth: int) -> list[str]:
        """Folders ``depth`` levels below ``path``, as paths relative to it."""
        if depth == 0:
            return [""]
        found = []
        for name in self.names(path):
            if not name.startswith(("_", ".")):
                found += [f"{name}/{rest}".rstrip("/")
                          for rest in self.leaf_folders(f"{path}/{name}", depth - 1)]
        return found


def parquet_files(spark: SparkSession, folders: list[str], base: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of the Parquet files below the folders.

    Only the listing is read: the content column is never selected.
    """
    reader = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
              .option("recursiveFileLookup", "true"))
    return reader.load(folders).select("path", "length", "modificationTime")


def file_inventory(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
