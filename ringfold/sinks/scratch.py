"""Short-lived folders in the storage that driver and executors share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from ..errors import ConfigError


def file_system(spark: SparkSession, path: str):
    """Hadoop's Path class, the path as one, and its file system."""
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at = kind(path)
    return kind, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir. Where that is unset, local sessions get a temporary folder; clusters get an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ConfigError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="ringfold-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A new path in the shared storage, deleted at the end."""
    path = shared_path(spark, "scratch")
    try:
        yield path
    finally:
        _, at, fs = file_system(spark, path)
        fs.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None if there is none."""
    _, at, fs = file_system(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file whole: to another name first, which then takes the place of the old one in one step."""
    kind, at, fs = file_system(spark, path)
    part = kind(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(part, at, how)
