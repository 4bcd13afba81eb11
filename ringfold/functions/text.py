"""Query text, cursors and error classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised_query(q: Column) -> Column:
    """Upper case, single spaces, literals as '?'."""
    q = F.regexp_replace(F.upper(F.trim(q)), r"\s+", " ")
    return F.regexp_replace(F.regexp_replace(q, "'[^']*'", "'?'"), r"\b\d+\b", "?")


def query_hash(q: Column) -> Column:
    return F.substring(F.md5(normalised_query(q)), 1, 12)


def cursor(value: Column) -> Column:
    """An opaque page cursor."""
    return F.base64(F.encode(value.cast("string"), "UTF-8"))


def from_cursor(text: Column) -> Column:
    return F.decode(F.unbase64(text), "UTF-8")


def error_status(message: Column) -> Column:
    """503 for an error that says the service is away or slow, 500 for others."""
    away = r"(?i)no host|unavailable|timed? ?out|timeout|connection|overload"
    return F.when(message.rlike(away), 503).otherwise(500)


def prefix(c: Column, start: str) -> Column:
    return c.startswith(start)


def elapsed(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def per_second(n: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, n / seconds).otherwise(F.lit(0.0))


def megabytes_per_second(n_bytes: Column, seconds: Column) -> Column:
    return per_second(n_bytes / (1 << 20), seconds)
