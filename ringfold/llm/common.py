"""Shared pieces of the llm operators: the work folder, staged tables and the word pattern."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: A word: a run of anything but ASCII white space (space, tab, line feed, VT, FF, CR).
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share.

    The cluster names that folder in spark.checkpoint.dir. Only where it is unset (local tests)
    is a temporary folder of this machine used.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="ringfold-")
        spark.sparkContext._conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/ringfold/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs left. Spark removes shuffles and broadcasts only after the driver's own garbage is
    collected, which long loops of small jobs put off while they pile up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def uncompiled(spark: SparkSession) -> Iterator[None]:
    """For loops of many small jobs that write their results: plans are run operator by operator, so that the driver does not compile a
    class for each stage of each round, whose bounds differ, and keep it in its memory. Results are the same."""
    key = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a work path that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, which may not have it installed. Once for each context."""
    context = spark.sparkContext
    if getattr(context, "_ringfold_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="ringfold-")) / f"{top.name}.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in top.rglob("*.py"):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(str(out))
    context._ringfold_shipped = True


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow with a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
