"""Tokens: where on the ring a partition key lies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def native(*keys: str) -> Column:
    """A 64-bit token of all keys, in generated code."""
    return F.xxhash64(*keys)


def portable(key: str) -> Column:
    """A 60-bit token that other engines can compute: the first 15 hexadecimal digits of the key text's MD5."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10).cast("long")
