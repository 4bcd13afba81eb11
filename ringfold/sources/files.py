"""Files as tables, with declared columns. Nothing is inferred from the first row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..errors import ConfigError
from ..types import spark_schema

FORMATS = ("csv", "json", "parquet", "orc")


def load(spark: SparkSession, path: str | list[str], fmt: str, columns: dict[str, str], key: tuple[str, ...] = (), **options: str) -> DataFrame:
    """columns: CQL types by name. Rows that don't fit fail the read."""
    if fmt not in FORMATS:
        raise ConfigError(f"no such format: {fmt!r}; {FORMATS}")
    options = {"header": "true", "mode": "FAILFAST"} | options if fmt == "csv" else {"mode": "FAILFAST"} | options if fmt == "json" else options
    return spark.read.format(fmt).schema(spark_schema(columns, key)).options(**options).load(path)
