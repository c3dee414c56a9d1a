"""Small driver-side file operations, on whatever file system a path names."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    length: int
    modified: int


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def listing(spark: SparkSession, path: str) -> list[Entry]:
    """Visible entries directly under a folder; empty when there is none."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    found = [
        Entry(str(s.getPath()), s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime())
        for s in fs.listStatus(where)
    ]
    return [e for e in found if not e.name.startswith(("_", "."))]


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _open(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


# Writers of one driver take turns; between drivers the file system decides.
_PUBLISHING = threading.Lock()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a file in full or not at all; fail if the path is taken.

    Every writer has a draft of its own, which is renamed to the path. Of
    several drivers one wins where a rename never replaces a file (HDFS).
    """
    fs, where = _open(spark, path)
    if fs.exists(where):
        raise FileExistsError(path)
    fs.mkdirs(where.getParent())
    _, draft = _open(spark, f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    with _PUBLISHING:
        if fs.exists(where) or not fs.rename(draft, where):
            fs.delete(draft, False)
            raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds."""
    fs, where = _open(spark, path)
    fs.delete(where, True)


def move_file(spark: SparkSession, path: str, folder: str) -> str:
    """Move one file into a folder; fail if the name is taken there."""
    fs, source = _open(spark, path)
    _, target = _open(spark, f"{folder.rstrip('/')}/{source.getName()}")
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise FileExistsError(str(target))
    return str(target)


def plain_path(spark: SparkSession, uri: str) -> str:
    """Path of a file as Spark reports it, without URI escapes."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
