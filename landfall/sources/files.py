"""Folders and small files, through the file system that Spark would use for them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

#: Files that are open at a time where only their beginnings are read.
OPEN_FILES = 16


def _target(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The path and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; nothing happens if it is not there."""
    target, system = _target(spark, path)
    system.delete(target, True)


def make(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it, where they are not there yet."""
    target, system = _target(spark, path)
    system.mkdirs(target)


def listed(spark: SparkSession, path: str) -> dict[str, int]:
    """What lies in a folder, by name, with the time of its last change in seconds; nothing if the folder is not there."""
    target, system = _target(spark, path)
    if not system.exists(target):
        return {}
    return {s.getPath().getName(): s.getModificationTime() // 1000 for s in system.listStatus(target)}


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder has a path of this pattern."""
    target, system = _target(spark, pattern)
    return bool(system.globStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    target, system = _target(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_lines(spark: SparkSession, addresses: Sequence[str], separator: bytes | None = None) -> list[tuple[str, str | None]]:
    """The path of each file and its first line that is not blank; nothing for a file without any.

    Lines end as in Spark's text source, compressed files are read by the codec of their name, and a mark of the encoding
    is no part of a line. No file is read beyond the buffer that holds that line.
    """
    hadoop, uri = spark._jvm.org.apache.hadoop, spark._jvm.java.net.URI
    settings = spark._jsparkSession.sessionState().newHadoopConf()
    codecs = hadoop.io.compress.CompressionCodecFactory(settings)

    def first(address: str) -> tuple[str, str | None]:
        path = hadoop.fs.Path(uri(address))
        stream, codec = path.getFileSystem(settings).open(path), codecs.getCodec(path)
        try:
            plain = stream if codec is None else codec.createInputStream(stream)
            lines = hadoop.util.LineReader(plain, *([] if separator is None else [separator]))
            line, mark = hadoop.io.Text(), "\ufeff"
            while lines.readLine(line):
                text, mark = line.toString().removeprefix(mark), ""
                if text.strip(" "):
                    return path.toString(), text
            return path.toString(), None
        finally:
            stream.close()

    with ThreadPoolExecutor(OPEN_FILES) as pool:
        return list(pool.map(first, addresses))


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file whole by a rename. Whether it was put: not if there is one of that name already."""
    target, system = _target(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.exists(target) and system.rename(draft, target):
        return True
    system.delete(draft, False)
    return False
