"""Folders and small files in whatever store their paths name."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path and the file system that holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.exists(at)


def remove_folder(spark: SparkSession, path: str) -> None:
    at, files = _at(spark, path)
    files.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no folder."""
    at, files = _at(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """The innermost ``column=value`` folders under a path, as paths relative to it."""
    at, files = _at(spark, path)
    found = []
    for f in files.listStatus(at):
        name = f.getPath().getName()
        if f.isDirectory() and "=" in name:
            found += [f"{name}/{p}" for p in partition_folders(spark, f"{path.rstrip('/')}/{name}")] or [name]
    return sorted(found)


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet."""
    at, files = _at(spark, path)
    try:
        out = files.create(at, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise FileExistsError(path) from None
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    at, files = _at(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_marks(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of files."""
    marks = []
    for path in paths:
        at, files = _at(spark, path)
        status = files.getFileStatus(at)
        marks.append((path, status.getLen(), status.getModificationTime()))
    return marks
