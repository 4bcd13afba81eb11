"""Sliding windows, alerts and gaps of keyed time series, in event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sliding_stats(df: DataFrame, key: str, ts: str, value: str, interval: str) -> DataFrame:
    """For each reading, average, least, greatest and number of the key's readings in the interval up to it."""
    frame = f"OVER (PARTITION BY {key} ORDER BY {ts} RANGE BETWEEN INTERVAL {interval} PRECEDING AND CURRENT ROW)"
    return df.select(
        "*",
        F.expr(f"avg({value}) {frame}").alias("avg_value"),
        F.expr(f"min({value}) {frame}").alias("min_value"),
        F.expr(f"max({value}) {frame}").alias("max_value"),
        F.expr(f"count(*) {frame}").alias("n"),
    )


def last_rows_stats(df: DataFrame, key: str, order: list[Column], value: str, rows: int) -> DataFrame:
    """The same over the key's last `rows` readings."""
    w = W.partitionBy(key).orderBy(*order).rowsBetween(1 - rows, 0)
    return df.select("*", F.avg(value).over(w).alias("avg_value"), F.count("*").over(w).alias("n"))


def capped_stats(df: DataFrame, key: str, ts: str, tie: str, values: list[str], interval: str, rows: int) -> DataFrame:
    """Windows that end with a reading and hold what is both in the interval and among the key's last `rows` readings: n, and
    average, least and greatest of each value. Both frames end with the reading, so the shorter one is the window; readings of one
    time are in one interval frame, and count by tie among the last rows.
    """
    spans = {
        "t": f"OVER (PARTITION BY {key} ORDER BY {ts} RANGE BETWEEN INTERVAL {interval} PRECEDING AND CURRENT ROW)",
        "r": f"OVER (PARTITION BY {key} ORDER BY {ts}, {tie} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)",
    }
    frames = [F.expr(f"struct(count(*) {s} AS n, {', '.join(f'{f}({v}) {s} AS {f}_{v}' for v in values for f in ('avg', 'min', 'max'))})").alias(f"__{k}") for k, s in spans.items()]
    names = ["n", *[f"{f}_{v}" for v in values for f in ("avg", "min", "max")]]
    short = F.when(F.col("__t.n") <= F.col("__r.n"), F.col("__t")).otherwise(F.col("__r"))
    return df.select("*", *frames).withColumn("__w", short).select(*df.columns, *[F.col(f"__w.{c}").alias(c) for c in names])


def sensor_summary(stats: DataFrame, key: str, ts: str, rules: list[Column] | None = None) -> DataFrame:
    """One row over the last window of each key: keys, readings in windows, unweighted mean of averages. rules: adds
    n_alerts, the number of rules that readings break, over all readings."""
    broken = [F.sum(sum((F.coalesce(r, F.lit(False)).cast("long") for r in rules), F.lit(0))).alias("alerts")] if rules else []
    last = stats.groupBy(key).agg(F.max_by("n", ts).alias("n"), F.max_by("avg_value", ts).alias("avg_value"), *broken)
    total = [F.coalesce(F.sum("alerts"), F.lit(0)).alias("n_alerts")] if rules else []
    return last.agg(F.count("*").alias("n_sensors"), F.sum("n").alias("n_readings"), F.round(F.avg("avg_value"), 2).alias("mean_of_means"), *total)


def alerts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a reading breaks; one reading can break several."""
    hits = F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()])
    return df.withColumn("alert", F.explode(F.array_compact(hits)))


def gaps(df: DataFrame, key: str, ts: str, limit_seconds: float) -> DataFrame:
    """Per key: gaps between consecutive readings, their average and greatest, and how many are over the limit."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = (micros - F.lag(micros).over(W.partitionBy(key).orderBy(ts))) / 1e6
    return df.select(key, gap.alias("gap")).groupBy(key).agg(
        F.count("gap").alias("n_gaps"), F.round(F.avg("gap"), 3).alias("avg_gap"), F.round(F.max("gap"), 3).alias("max_gap"),
        F.count_if(F.col("gap") > limit_seconds).alias("n_long"),
    )


def collected(df: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Per key: number of readings, first and last value by time, without gathering the readings."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min_by(value, ts).alias("first_value"), F.max_by(value, ts).alias("last_value"))


def latest_per_key(df: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter(F.col("rn") <= n)
