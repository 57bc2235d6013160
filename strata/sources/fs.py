"""Filesystem calls through the session's Hadoop FileSystem (any scheme the cluster knows).

Metadata only -- existence, sizes, names, markers, deletes -- never table content.
Every caller goes through these few functions so the py4j access sits in one
place.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hadoop_fs(spark: SparkSession, path: str):
    """(Hadoop ``Path``, its ``FileSystem``) for ``path`` under the session's configuration."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form (``file:/x``, ``s3a://b/x``) as Spark reports paths."""
    p, fs = hadoop_fs(spark, path)
    return fs.makeQualified(p).toString()


def total_size(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file, or of all files under a folder; None when the path does not exist."""
    p, fs = hadoop_fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else None


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the direct children of ``folder`` (empty if it does not exist)."""
    p, fs = hadoop_fs(spark, folder)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def create_marker(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a small file that must not exist yet; False if it does (another writer has the claim)."""
    p, fs = hadoop_fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "Exist" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    p, fs = hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    p, fs = hadoop_fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, recursive))
