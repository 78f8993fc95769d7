"""Small Hadoop-filesystem helpers (existence, listing, delete) and the
shared scratch root.  Paths may be any Hadoop URI (file:, hdfs:, s3a:, ...)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (empty if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole or not at all; False if it exists already."""
    fs, p = _fs(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(p) or not fs.rename(draft, p):
        fs.delete(draft, False)
        return False
    return True


def scratch_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster: ``ensure_checkpoint_dir`` refuses that)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/sensorlake-{prefix}-{uuid.uuid4().hex[:12]}"
