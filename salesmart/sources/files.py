"""Small text files on the lake's file system: marks, indexes and pointers."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of a Hadoop path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, sorted; none if it does not exist."""
    fs, p = hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False if it is there already (nobody's file is ever replaced)."""
    fs, p = hadoop(spark, path)
    try:
        out = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).lines()
        return lines.collect(jvm.java.util.stream.Collectors.joining("\n"))
    finally:
        stream.close()
