"""Shared-storage helpers: small files, folder listings and scratch folders.

Everything goes through Hadoop's file system API, so a path may be local or on the cluster's
shared storage. Only names and small JSON documents pass through the driver.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


class PathTaken(RuntimeError):
    """A file that must be new exists already."""


class Storage:
    """File operations on the storage a session can reach."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        """Names directly inside a folder; a missing folder is empty."""
        fs, target = self._open(path)
        if not fs.exists(target):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(target))

    def bytes_under(self, path: str) -> int:
        """Total size of all files below a folder."""
        fs, target = self._open(path)
        return fs.getContentSummary(target).getLength() if fs.exists(target) else 0

    def read_text(self, path: str) -> str:
        fs, target = self._open(path)
        stream = fs.open(target)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_text(self, path: str, text: str) -> None:
        """Write a new file so that it is either absent or whole: it is filled under another name."""
        fs, target = self._open(path)
        draft = self._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise PathTaken(path)

    def decoded(self, uri: str) -> str:
        """The path that a file's metadata give as a URI, where blanks and such are escaped."""
        return self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(uri)).toString()

    def move(self, path: str, to: str) -> None:
        fs, target = self._open(path)
        if not fs.rename(target, self._jvm.org.apache.hadoop.fs.Path(to)):
            raise OSError(f"{path} could not be moved to {to}")

    def plain(self, path: str) -> str:
        """A path as it was given: without the ``file:`` that the catalog puts before local ones."""
        return path.removeprefix("file://").removeprefix("file:") if path.startswith("file:/") else path

    def remove(self, path: str) -> None:
        fs, target = self._open(path)
        fs.delete(target, True)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", ""
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="changeloom-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, unique folder name below the scratch root."""
    return f"{scratch_root(spark)}/changeloom/{label}-{uuid.uuid4().hex}"
