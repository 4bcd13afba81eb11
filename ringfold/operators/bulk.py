"""Scans, counts and coverage by token range.

Ranges are a list on the driver, bounded by the number of parts asked for. Equal parts of the
ring are found by arithmetic in generated code; others by a broadcast join with the list. Counts
are combined on the map side, so a shuffle carries a row for each range and task.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import BulkError, ConfigError
from ..ranges import FULL, PORTABLE, Ring, TokenRange

#: Ranges counted in one pass over a table.
PER_PASS = 64
RANGE_SCHEMA = "range_id int, lo decimal(20,0), hi decimal(20,0), wraps boolean"


def range_id(token: Column, parts: int, ring: Ring = PORTABLE) -> Column:
    """Which of `parts` equal ranges of the portable ring holds a token. The remainder belongs to the last."""
    if ring.low != 0:
        raise ConfigError("equal parts by arithmetic are for rings that start at 0")
    step = ring.size // parts
    return F.least(F.floor(token / step), F.lit(parts - 1)).cast("int") if step & (step - 1) else F.least(
        F.shiftrightunsigned(token, step.bit_length() - 1), F.lit(parts - 1)
    ).cast("int")


def count_by_range(df: DataFrame, token: Column, parts: int, ring: Ring = PORTABLE) -> DataFrame:
    """range_id, lo, hi, n of every equal range, empty ones too. Tokens lo and hi are both included."""
    step = ring.size // parts
    counted = df.groupBy(range_id(token, parts, ring).alias("range_id")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(parts).select(
        F.col("id").cast("int").alias("range_id"),
        (F.col("id") * step).alias("lo"),
        F.when(F.col("id") == parts - 1, F.lit(ring.high)).otherwise((F.col("id") + 1) * step - 1).alias("hi"),
    )
    return every.join(F.broadcast(counted), "range_id", "left").select("range_id", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def in_range(token: Column, one: TokenRange) -> Column:
    above, below = token > one.start, token <= one.end
    return (above | below) if one.wraps else (above & below)


def range_scan(df: DataFrame, token: Column, one: TokenRange) -> DataFrame:
    return df.filter(in_range(token, one))


def range_table(spark: SparkSession, ranges: list[TokenRange]) -> DataFrame:
    return spark.createDataFrame([(i, r.start, r.end, r.wraps) for i, r in enumerate(ranges)], _schema())


def _schema():
    from pyspark.sql import types as T

    return T.StructType(
        [T.StructField("range_id", T.IntegerType()), T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()), T.StructField("wraps", T.BooleanType())]
    )


def coverage(df: DataFrame, token: Column, ranges: list[TokenRange]) -> DataFrame:
    """covers (0, 1, 2 for more), n: rows by how many ranges hold their token. One pass, a shuffle of three rows a task."""
    held = _sum([in_range(F.col("token"), r).cast("int") for r in ranges])
    covers = F.least(held, F.lit(2)).cast("int").alias("covers")
    return df.select(token.alias("token")).groupBy(covers).agg(F.count("*").alias("n"))


def _sum(terms: list[Column]) -> Column:
    """A balanced sum, so that long lists make no deep expression."""
    while len(terms) > 1:
        terms = [functools.reduce(Column.__add__, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0] if terms else F.lit(0)


def count_ranges(df: DataFrame, token: Column, ranges: list[TokenRange], ring: Ring = FULL) -> int:
    """Rows in all ranges. Fails, with what was counted, if ranges fail; a partial count is never returned as whole."""
    try:  # one pass for every PER_PASS ranges
        total = 0
        for i in range(0, len(ranges), PER_PASS):
            tests = [F.count_if(in_range(F.col("token"), r)).alias(f"n{k}") for k, r in enumerate(ranges[i : i + PER_PASS])]
            total += sum(df.select(token.alias("token")).agg(*tests).first())
        return total
    except Exception:  # noqa: BLE001  which ranges fail, and what the others hold, is found apart
        total, failed = 0, {}
    for i, r in enumerate(ranges):
        try:
            total += range_scan(df, token, r).count()
        except Exception as e:  # noqa: BLE001  gathered, and raised below
            failed[i] = e
    if failed:
        raise BulkError(f"{len(failed)} of {len(ranges)} ranges failed", total, failed)
    return total


def group_by_replicas(spark: SparkSession, ranges: list[TokenRange]) -> DataFrame:
    rows = spark.createDataFrame([(i, list(r.replicas)) for i, r in enumerate(ranges)], "range_id int, replicas array<string>")
    return rows.groupBy(F.array_join(F.array_sort("replicas"), ",").alias("replica_set")).agg(
        F.count("*").alias("n_ranges"), F.array_join(F.transform(F.array_sort(F.collect_list("range_id")), lambda x: x.cast("string")), ",").alias("range_ids")
    )
