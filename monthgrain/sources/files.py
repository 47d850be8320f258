"""Looking into folders through the cluster's own file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its object."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = file_system(spark, path)
    return fs.exists(folder)


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """Put a small text file in place of the one that is there; nobody sees half of it."""
    fs, target = file_system(spark, path)
    _, beside = file_system(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small text file; None if there is none."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, by one call; none if it is not there."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
