"""Retry decisions as a table: which failure is tried again, and where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Writes that may be repeated if they are marked idempotent.
REPEATABLE = ("SIMPLE", "BATCH", "UNLOGGED_BATCH")


def decision(
    kind: str | Column, retry_num: Column, max_retries: int, *, data_retrieved: Column, received: Column, required: Column,
    idempotent: Column, write_type: Column,
) -> Column:
    """RETRY, RETRY_NEXT_HOST or RETHROW for a failure of kind read, write, unavailable or request."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(retry_num >= max_retries, "RETHROW")
        .when(kind == "read", F.when(yes(data_retrieved) | yes(received >= required), "RETRY").otherwise("RETHROW"))
        .when(kind == "write", F.when(yes(idempotent) & yes(write_type.isin(*REPEATABLE)), "RETRY").otherwise("RETHROW"))
        .when(kind == "unavailable", F.when(retry_num == 0, "RETRY_NEXT_HOST").otherwise("RETRY"))
        .when(kind == "request", "RETRY_NEXT_HOST")
        .otherwise("RETHROW")
    )


def decisions(matrix: DataFrame, max_retries: int = 3) -> DataFrame:
    c = F.col
    return matrix.withColumn(
        "decision",
        decision(
            c("kind"), c("retry_num"), max_retries, data_retrieved=c("data_retrieved"), received=c("received"), required=c("required"),
            idempotent=c("idempotent"), write_type=c("write_type"),
        ),
    )
