"""Mutation logs merged to tables: last write wins, conditional writes, counters, time to live.

A log is a DataFrame; a merge is an aggregation by key, combined on the map side. Only
conditional updates need a key's writes in order, and fold each key's in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import ConfigError


def last_write_wins(log: DataFrame, key: str, writetime: list[str], values: list[str]) -> DataFrame:
    """The values of each key's newest write. writetime: columns that order writes totally."""
    newest = log.groupBy(key).agg(F.max_by(F.struct(*values), F.struct(*writetime)).alias("row"))
    return newest.select(key, *[F.col(f"row.{c}").alias(c) for c in values])


def column_last_write_wins(log: DataFrame, key: str, writetime: str, values: list[str], is_set: str = "set_{}", deleted: str = "deleted") -> DataFrame:
    """Per column, the newest write that sets it (to null too); a row's newest delete hides what is not newer.

    is_set: the boolean column that says whether a write sets a column; deleted: marks row deletes.
    """
    gone = F.coalesce(F.max(F.when(F.col(deleted), F.col(writetime))), F.lit(-(2**63)))
    parts = [F.max(F.when(F.col(is_set.format(c)) & ~F.col(deleted), F.struct(writetime, c))).alias(c) for c in values]
    merged = log.groupBy(key).agg(gone.alias("__gone"), *parts)
    live = [F.when(F.col(f"{c}.{writetime}") > F.col("__gone"), F.col(f"{c}.{c}")).alias(c) for c in values]
    some = [F.coalesce(F.col(f"{c}.{writetime}") > F.col("__gone"), F.lit(False)) for c in values]
    exists = some[0]
    for s in some[1:]:
        exists = exists | s
    return merged.filter(exists).select(key, *live)


def insert_if_not_exists(log: DataFrame, key: str, order: list[Column], *value: str) -> DataFrame:
    """Each attempt with applied (only the first of a key) and the values that stand."""
    w = W.partitionBy(key).orderBy(*order)
    applied = (F.row_number().over(w) == 1).alias("applied")
    return log.select("*", applied, *[F.first(c).over(w).alias(f"standing_{c}") for c in value])


def conditional_fold(log: DataFrame, key: str, seq: str, version: str = "expected", value: str = "value") -> DataFrame:
    """Ordered conditional writes of each key: key, seq, applied, version after it, value after it.

    op insert applies if the key is absent, update and delete if the version is the expected one
    (null: if the key exists). A key's writes are streamed in order, so no key is held as a whole.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = object(), (None, None)
        for batch in batches:
            out = []
            for k, s, op, want, v in batch[[key, seq, "op", version, value]].itertuples(index=False):
                if k != now:
                    now, state = k, (None, None)
                at, _ = state
                exists = at is not None
                if op == "insert":
                    applied = not exists
                    state = (1, v) if applied else state
                else:
                    applied = exists and (pd.isna(want) or want == at)
                    if applied:
                        state = (None, None) if op == "delete" else (at + 1, v)
                out.append((k, s, applied, *state))
            frame = pd.DataFrame(out, columns=[key, seq, "applied", "version", value])
            yield frame.assign(version=frame["version"].astype("Int64"))

    kinds = {f.name: f.dataType.simpleString() for f in log.schema}
    schema = f"{key} {kinds[key]}, {seq} {kinds[seq]}, applied boolean, version long, {value} {kinds[value]}"
    return log.repartition(key).sortWithinPartitions(key, seq).mapInPandas(fold, schema)


def counters(log: DataFrame, key: list[str], delta: str) -> DataFrame:
    return log.groupBy(*key).agg(F.sum(delta).alias("value"))


def live_at(df: DataFrame, writetime: str, ttl: str, as_of: Column) -> DataFrame:
    """Rows whose time to live is not over. Times in seconds; a null ttl lives for ever."""
    return df.filter(F.col(ttl).isNull() | (F.col(writetime) + F.col(ttl) > as_of))


def batch(*logs: DataFrame, counter: list[bool]) -> DataFrame:
    """The union of a batch's mutations. Counters and other writes don't mix."""
    if len(set(counter)) > 1:
        raise ConfigError("a batch holds counter updates or other writes, not both")
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log, allowMissingColumns=True)
    return out
