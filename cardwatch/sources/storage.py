"""Small files on the cluster's storage, through Hadoop's file systems (any store that Spark reads)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return fs.exists(hpath)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's entries; none if there is no folder."""
    fs, hpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def data_files(spark: SparkSession, path: str) -> set[str]:
    """Full paths of a folder's data files (names that Spark's readers don't skip)."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return set()
    found = [s.getPath() for s in fs.listStatus(hpath) if s.isFile()]
    return {p.toString() for p in found if not p.getName().startswith(("_", "."))}


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, record: dict) -> None:
    """Write one record so that no reader sees half of it: to a hidden name first, then renamed."""
    fs, hpath = _fs(spark, path)
    _, hidden = _fs(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(json.dumps(record).encode()))
    finally:
        stream.close()
    if fs.exists(hpath):
        fs.delete(hpath, False)
    if not fs.rename(hidden, hpath):
        raise OSError(f"can't rename to {path}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete one file."""
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, False)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it."""
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time, where the storage can."""
    fs, hpath = _fs(spark, path)
    fs.setTimes(hpath, millis, -1)
