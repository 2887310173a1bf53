"""Small file system helpers that work wherever the session's paths point."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# The scratch folder of each application.
_scratch: dict[str, str] = {}


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def literal_path(path: str) -> str:
    """Escape glob characters, so that a listed path names just its own file."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``."""
    system, target = _file_system(spark, path)
    return system.exists(target)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one small file."""
    system, target = _file_system(spark, path)
    out = system.create(target)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def create_new(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one small file that must not be there yet."""
    system, target = _file_system(spark, path)
    try:
        out = system.create(target, False)
    except Py4JJavaError as failed:
        if "FileAlreadyExists" in str(failed.java_exception) or system.exists(target):
            raise FileExistsError(path) from failed
        raise
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """The content of one small file."""
    system, target = _file_system(spark, path)
    source = system.open(target)
    try:
        return bytes(source.readAllBytes())
    finally:
        source.close()


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Every file below a folder, in order: its path from there and its bytes.  For folders of bounded size."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    root = system.makeQualified(target).toUri().getPath().rstrip("/")
    found, out = system.listFiles(target, True), []
    while found.hasNext():
        status = found.next()
        out.append((status.getPath().toUri().getPath()[len(root) + 1 :], status.getLen()))
    return sorted(out)


def list_top(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The folders and the files of some bytes right below a folder, in order; nothing deeper is looked at."""
    system, target = _file_system(spark, path)
    found = [(status.getPath().toString(), status.isDirectory(), status.getLen()) for status in system.listStatus(target)]
    return sorted(name for name, folder, _ in found if folder), sorted(name for name, folder, size in found if not folder and size)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders right below a folder, in order; none where it is missing."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().toString() for status in system.listStatus(target) if status.isDirectory())


def move(spark: SparkSession, source: str, target: str, size: int) -> bool:
    """Move a file of ``size`` bytes to a place of its own; can be repeated.  Whether it is there then."""
    system, old = _file_system(spark, source)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if system.exists(old):
        if system.exists(new):  # a copy that broke off, where the store has no real move
            system.delete(new, False)
        system.mkdirs(new.getParent())
        return bool(system.rename(old, new))
    return bool(system.exists(new)) and system.getFileStatus(new).getLen() == size


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all that is in it."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table, in a folder that every executor can reach.

    The folder is made in the session's ``spark.checkpoint.dir``, or in a temporary folder only where
    that is unset and the session runs on one machine (tests).  It is removed when the application ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.gettempdir()
        _scratch[app] = f"{root.rstrip('/')}/hitlake-{uuid.uuid4().hex}"
        system, target = _file_system(spark, _scratch[app])
        system.mkdirs(target)
        system.deleteOnExit(target)
    return f"{_scratch[app]}/{label}-{uuid.uuid4().hex}"
