"""Small metadata calls on any Hadoop file system, made from the driver."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in one call however many there are."""
    fs, hadoop_path = _open(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(hadoop_path) or [])


def sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Bytes of the files that match a glob pattern."""
    fs, hadoop_path = _open(spark, pattern)
    return {s.getPath().toString(): s.getLen() for s in fs.globStatus(hadoop_path) or []}


def folder_sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Folders of the files that match a glob pattern, with the bytes of these files."""
    found: dict[str, int] = {}
    for path, size in sizes(spark, pattern).items():
        folder = path.rpartition("/")[0]
        found[folder] = found.get(folder, 0) + size
    return found


def complete_folders(spark: SparkSession, base: str, label: str) -> list[int]:
    """Numbers n of the folders ``<base>/<label>=<n>`` that a finished job wrote."""
    markers = matching(spark, f"{base}/{label}=*/_SUCCESS")
    return sorted(int(m.split("/")[-2].partition("=")[2]) for m in markers)


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written."""
    fs, hadoop_path = _open(spark, path)
    return time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small driver-side file such as a table spec."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
