"""Per-sensor windows of a stream: at most so many readings, none older than so many seconds.

State is a key's readings within the window; it is bounded by the row cap, removed once the watermark (the
newest reading less the window) has passed the key's last reading by the window, and is kept by the state store, so a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .windows import file_stream, run_to_end

MAX_ROWS, MAX_SECONDS = 1000, 300.0


def trimmed(at: list[float], values: list[float], max_rows: int, max_seconds: float) -> tuple[list[float], list[float]]:
    """The newest readings within both limits, in order of time."""
    rows = sorted(zip(at, values))
    rows = [r for r in rows if r[0] >= rows[-1][0] - max_seconds][-max_rows:]
    return [r[0] for r in rows], [r[1] for r in rows]


def sensor_windows(spark: SparkSession, path: str, max_rows: int = MAX_ROWS, max_seconds: float = MAX_SECONDS) -> DataFrame:
    """user_id, n, avg_value of each sensor's last window."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # nothing of the key is in any window to come
            state.remove()
            return
        at, values = state.get if state.exists else ([], [])
        at, values = list(at), list(values)
        for batch in batches:
            at, values = trimmed(at + batch["at"].tolist(), values + batch["value"].tolist(), max_rows, max_seconds)
        state.update((at, values))
        state.setTimeoutTimestamp(max(int((at[-1] + max_seconds) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"user_id": [key[0]], "last_at": [at[-1]], "n": [len(at)], "avg_value": [sum(values) / len(values)]})

    at = (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at")
    events = file_stream(spark, path).withColumn("time", F.col("ts").cast("timestamp")).withWatermark("time", f"{int(max_seconds)} seconds")
    stream = events.select("user_id", "time", at, "value").groupBy("user_id").applyInPandasWithState(
        step, "user_id long, last_at double, n long, avg_value double", "at array<double>, value array<double>", "update", GroupStateTimeout.EventTimeTimeout
    )
    last = run_to_end(stream, "update").groupBy("user_id").agg(F.max_by(F.struct("n", "avg_value"), "last_at").alias("w"))
    return last.select("user_id", F.col("w.n").alias("n"), F.round("w.avg_value", 4).alias("avg_value"))
