"""Small operations on files of any store that Spark reaches, by Hadoop's file systems."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str):
    """The file system of a path, and the path there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = at(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    files, where = at(spark, path)
    files.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    files, where = at(spark, target)
    files.mkdirs(where.getParent())
    if not files.rename(at(spark, source)[1], where):
        raise OSError(f"{source} could not be moved to {target}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """The file is there whole or not at all."""
    files, where = at(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(where)
    out.write(text.encode())
    out.close()
    move(spark, where.toString(), path)


def get_text(spark: SparkSession, path: str) -> str | None:
    files, where = at(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    files, where = at(spark, pattern)
    return [f.getPath().toString() for f in files.globStatus(where) or []]


def data_files(spark: SparkSession, path: str) -> Iterator[str]:
    """Data files below a folder, by their path from there."""
    files, where = at(spark, path)
    if not files.exists(where):
        return
    base, found = files.makeQualified(where).toUri().getPath().rstrip("/") + "/", files.listFiles(where, True)
    while found.hasNext():
        name = found.next().getPath().toUri().getPath().removeprefix(base)
        if not any(part[0] in "_." for part in name.split("/")):
            yield name
