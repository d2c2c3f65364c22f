"""A log of numbered versions, one small file each, that several writers append to.

A writer reads the newest version, makes the next one from it and creates that file only if it is
not there yet. Whoever loses the race reads again and makes its version anew, so that no version is
lost and none is written over. A file appears whole or not at all. The file system has to rename
without overwriting as one step (HDFS does; on a local disk a hard link serves).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

ATTEMPTS = 100


class Contended(Exception):
    """Other writers were faster ``ATTEMPTS`` times in a row."""


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text; False if there is one already."""
    target, fs = _path(spark, path)
    fs.mkdirs(target.getParent())
    temporary, _ = _path(spark, f"{target.getParent()}/_new-{uuid.uuid4().hex}")
    if fs.getUri().getScheme() == "file":
        ours, theirs = temporary.toUri().getPath(), target.toUri().getPath()
        with open(ours, "w", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(ours, theirs)
        except FileExistsError:
            return False
        finally:
            os.unlink(ours)
        return True
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode()))
    out.close()
    return rename_if_absent(spark, temporary, target)


def rename_if_absent(spark: SparkSession, temporary, target) -> bool:
    """Rename through the file context, which refuses to write over a file."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    hadoop = jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(temporary, target,
                       gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
    except Py4JJavaError as error:
        context.delete(temporary, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    target, fs = _path(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it is gone already."""
    target, fs = _path(spark, path)
    fs.delete(target, True)


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    folder: str

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in names(self.spark, self.folder)
                if n.endswith(".json") and not n.startswith("_")]

    def read(self, version: int) -> dict:
        target, fs = _path(self.spark, self._file(version))
        stream = fs.open(target)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(
                stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def newest(self) -> dict | None:
        versions = self.versions()
        return self.read(versions[-1]) if versions else None

    def commit(self, make: Callable[[dict | None], dict]) -> dict:
        """Append what ``make`` says to follow the newest version; it may be called repeatedly."""
        for _ in range(ATTEMPTS):
            newest = self.newest()
            version = newest["version"] + 1 if newest else 1
            entry = {**make(newest), "version": version}
            if put_if_absent(self.spark, self._file(version), json.dumps(entry)):
                return entry
        raise Contended(self.folder)

    def _file(self, version: int) -> str:
        return f"{self.folder.rstrip('/')}/{version:020d}.json"
