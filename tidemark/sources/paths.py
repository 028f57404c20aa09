"""Small files beside the data, through the file system that the data lives in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system's object."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    fs, at = file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file appears under its name only when it is complete, and replaces an earlier one."""
    fs, at = file_system(spark, path)
    _, draft = file_system(spark, f"{at.getParent()}/_{at.getName()}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(at, False)
    fs.rename(draft, at)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write the file if there is none of that name; False if somebody else was first.

    The file system decides between two writers: only one of them gets to create the name."""
    fs, at = file_system(spark, path)
    fs.mkdirs(at.getParent())
    if not fs.createNewFile(at):
        return False
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)
