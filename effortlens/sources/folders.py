"""Names and removal of folders through the cluster's own file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder; none when it does not exist."""
    store, path = _path(spark, folder)
    return [s.getPath().getName() for s in store.listStatus(path)] if store.exists(path) else []


def delete(spark: SparkSession, folder: str) -> None:
    store, path = _path(spark, folder)
    store.delete(path, True)


def new_below(folder: str) -> str:
    """A name below a folder that nothing else has."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def exists(spark: SparkSession, folder: str) -> bool:
    store, path = _path(spark, folder)
    return store.exists(path)


def put(spark: SparkSession, folder: str, target: str) -> None:
    """Give a folder another name; what stood there goes first."""
    store, path = _path(spark, folder)
    _, final = _path(spark, target)
    store.delete(final, True)
    store.mkdirs(final.getParent())
    if not store.rename(path, final):
        raise OSError(f"cannot rename {folder} to {target}")


def write_text(spark: SparkSession, file: str, text: str) -> None:
    """A small file, complete under its name or not there at all."""
    store, path = _path(spark, f"{file}.part")
    out = store.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()
    put(spark, f"{file}.part", file)


def read_text(spark: SparkSession, file: str) -> str | None:
    """What ``write_text`` wrote; null when it is not there."""
    store, path = _path(spark, file)
    if not store.exists(path):
        return None
    size = store.getFileStatus(path).getLen()
    into = spark._jvm.java.io.ByteArrayOutputStream()
    stream = store.open(path)
    try:
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, into, int(size) + 1, False)
    finally:
        stream.close()
    return into.toString("UTF-8")
