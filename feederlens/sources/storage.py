"""Access to the cluster file system through Hadoop, so that any path scheme works."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _hadoop_path(spark, path)
    return fs.exists(found)


def delete(spark: SparkSession, path: str) -> bool:
    fs, found = _hadoop_path(spark, path)
    return fs.delete(found, True)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, found = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(found)) if fs.exists(found) else []


def listing(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Files of a folder, without hidden ones: full path -> (bytes, time of the last change)."""
    fs, found = _hadoop_path(spark, path)
    there = fs.listStatus(found) if fs.exists(found) else []
    return {
        s.getPath().toString(): (s.getLen(), s.getModificationTime())
        for s in there if s.isFile() and s.getPath().getName()[0] not in "._"
    }


def age_seconds(spark: SparkSession, path: str) -> float:
    """Time since the folder or file was last changed."""
    fs, found = _hadoop_path(spark, path)
    return time.time() - fs.getFileStatus(found).getModificationTime() / 1000


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """Whether the folder has its new name; an existing one is left alone."""
    fs, found = _hadoop_path(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    return not fs.exists(target) and fs.rename(found, target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as a new file; it appears under its name only when it is whole."""
    fs, found = _hadoop_path(spark, path)
    part = found.suffix(f".{uuid.uuid4().hex}")
    stream = fs.create(part)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(part, found):
        raise OSError(f"could not create {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, found = _hadoop_path(spark, path)
    stream = fs.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table write into a folder was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def shared_folder(spark: SparkSession, given: str | None = None) -> str:
    """Folder for intermediate tables: the one the cluster names, else the one given."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or given
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set and no shared folder was given")
    return folder


@contextmanager
def staged(df: DataFrame, given: str | None = None) -> Iterator[DataFrame]:
    """The frame as a written table, for use by several outputs; removed at the end."""
    spark = df.sparkSession
    path = f"{shared_folder(spark, given)}/feederlens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)
