"""Small files through the cluster's own file systems."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    fs = spark._jvm.org.apache.hadoop.fs
    p = fs.Path(path)
    return fs, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, files = _hadoop(spark, path)
    return files.exists(p)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, sorted; none if there is no such folder."""
    _, p, files = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(p) if s.isFile()) if files.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    _, p, files = _hadoop(spark, path)
    stream = files.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file and rename it over the old one in one step."""
    fs, current, files = _hadoop(spark, path)
    new = fs.Path(posixpath.join(posixpath.dirname(path), f".{posixpath.basename(path)}-{uuid.uuid4().hex}"))
    out = files.create(new, False)
    out.write(bytearray(text.encode()))
    out.close()
    new, current = files.makeQualified(new), files.makeQualified(current)
    kind = getattr(fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.valueOf("OVERWRITE")
    fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration()).rename(new, current, how)
