"""Small file-system helpers that work on any path Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, empty if it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a place that is not there yet, making its parents."""
    fs, to = _open(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(_open(spark, source)[1], to):
        raise OSError(f"cannot move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _open(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a text file, packed or not; only the start of the file is read."""
    fs, target = _open(spark, path)
    jvm = spark._jvm
    factory = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    codec = factory.getCodec(target)
    stream = fs.open(target)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()
