"""Small files beside the tables, on local disks or on whatever Hadoop's file systems reach.

The store needs five things of a place: a text, replacing a text whole or not at all, whether one exists, removing one, and
a folder's files with their sizes.
"""

from __future__ import annotations

import os
import uuid
from pathlib import Path
from typing import Protocol

from pyspark import SparkContext
from pyspark.sql import SparkSession


class Files(Protocol):
    def text(self, path: str) -> str: ...

    def replace(self, path: str, text: str) -> None: ...

    def exists(self, path: str) -> bool: ...

    def remove(self, path: str) -> None: ...

    def listing(self, folder: str) -> dict[str, int]: ...


class LocalFiles:
    """A folder that is mounted under one path wherever it is used."""

    def text(self, path: str) -> str:
        return Path(path).read_text(encoding="utf-8")

    def replace(self, path: str, text: str) -> None:
        target = Path(path)
        target.parent.mkdir(parents=True, exist_ok=True)
        temporary = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
        temporary.write_text(text, encoding="utf-8")
        os.replace(temporary, target)

    def exists(self, path: str) -> bool:
        return Path(path).exists()

    def remove(self, path: str) -> None:
        Path(path).unlink(missing_ok=True)

    def listing(self, folder: str) -> dict[str, int]:
        return {p.name: p.stat().st_size for p in Path(folder).glob("part-*")}


class HadoopFiles:
    """Any path that the session's executors can read, such as on an object store."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.conf)

    def text(self, path: str) -> str:
        at, fs = self._at(path)
        if not fs.exists(at):
            raise FileNotFoundError(path)
        stream = fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        at, fs = self._at(path)
        temporary = self.jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{at.getName()}.{uuid.uuid4().hex}")
        stream = fs.create(temporary, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.conf)
        over = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = SparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = over
        context.rename(fs.makeQualified(temporary), fs.makeQualified(at), options)

    def exists(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.exists(at)

    def remove(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, False)

    def listing(self, folder: str) -> dict[str, int]:
        at, fs = self._at(folder)
        if not fs.exists(at):
            return {}
        return {s.getPath().getName(): s.getLen() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")}


def files_of(spark: SparkSession, root: str) -> Files:
    """Local files for plain paths, Hadoop's for URIs."""
    return HadoopFiles(spark) if "://" in root or root.startswith("file:") else LocalFiles()
