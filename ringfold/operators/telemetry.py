"""Query telemetry, host health and rates. Time is a parameter; nothing reads the wall clock."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Brackets of percentiles are sketched to one in so many rows.
ACCURACY = 100_000


def query_stats(df: DataFrame, ts: str, ms: Column, ok: Column, as_of: Column, interval: str) -> DataFrame:
    """One row over what is newer than as_of - interval: number, average, least and greatest ms, success rate, queries a second."""
    seconds = F.expr(f"unix_seconds(timestamp'2000-01-01' + INTERVAL {interval}) - unix_seconds(timestamp'2000-01-01')")
    recent = df.filter(F.col(ts) > as_of - F.expr(f"INTERVAL {interval}"))
    return recent.agg(
        F.count("*").alias("n"), F.round(F.avg(ms), 4).alias("avg_ms"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"),
        F.round(F.avg(ok.cast("double")), 4).alias("success_rate"), F.round(F.count("*") / seconds, 6).alias("qps"),
    )


def error_counts(df: DataFrame, failed: Column, kind: str) -> DataFrame:
    return df.filter(failed & F.col(kind).isNotNull()).groupBy(F.col(kind).alias("error_type")).agg(F.count("*").alias("n"))


def top_queries(df: DataFrame, digest: Column, k: int = 10) -> DataFrame:
    counted = df.groupBy(digest.alias("query_hash")).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "query_hash").limit(k)


def last_per_host(df: DataFrame, host: str, ts: str, *values: str) -> DataFrame:
    last = df.groupBy(host).agg(F.max_by(F.struct(ts, *values), ts).alias("last"))
    return last.select(host, *[F.col(f"last.{c}").alias(c) for c in (ts, *values)])


def newest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Bounded retention: the newest n rows."""
    return df.orderBy(*order).limit(n)


def cluster_rollup(df: DataFrame, group: str, healthy: Column, connections: Column, latency: Column) -> DataFrame:
    """Hosts up and down (all that is not up), connections, mean latency without nulls and zeros."""
    return df.groupBy(group).agg(
        F.count_if(healthy).alias("healthy"), F.count_if(~F.coalesce(healthy, F.lit(False))).alias("unhealthy"),
        F.sum(connections).alias("connections"), F.round(F.avg(F.nullif(latency, F.lit(0.0))), 4).alias("avg_latency"),
    )


def in_flight(protocol: Column) -> Column:
    """Requests that a connection carries at once, by protocol version."""
    return F.when(protocol >= 3, 32768).otherwise(128)


def latency_percentiles(df: DataFrame, ms: str, ps: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Percentiles between ranks 1 + p * (n - 1), exact; nulls are left out, no values give nulls."""
    found = _at_places(df, ms, ps, lambda n, p: n * p + F.lit(1 - p), F.lit(0))
    return found.select(*[F.round(f"p{i}", 4).alias(f"p{round(100 * p)}") for i, p in enumerate(ps)])


def exclusive_percentile(df: DataFrame, ms: str, p: float) -> DataFrame:
    """The percentile between ranks p * (n + 1), exact; past the ends, on the line of the last two values."""
    return _at_places(df, ms, (p,), lambda n, p: n * p + F.lit(p), F.lit(1)).select(F.col("p0").alias("value"))


def _at_places(df: DataFrame, ms: str, ps: tuple[float, ...], place: Callable[[Column, float], Column], room: Column) -> DataFrame:
    """One row: p0, p1, ... for each p the value at place(n, p) among n ascending values, ranks from 1, linear between two ranks.

    A first pass sketches a bracket around each place. A second counts the values in it one by one and all below and all above as
    one, combined on the map side. So a task orders about 8 / ACCURACY of the rows at most, one bracket each. The
    sketch decides no value: a place outside its bracket would give null. room: ranks that must lie above the lower one.
    """
    v = F.col("v")
    rows = df.select(F.col(ms).cast("double").alias("v")).filter(v.isNotNull())
    ends = [e for p in ps for e in (max(0.0, p - 4 / ACCURACY), min(1.0, p + 4 / ACCURACY))]
    first = rows.agg(F.struct(F.count("*").alias("n"), F.percentile_approx("v", ends, ACCURACY).alias("ends")).alias("first"))
    end = lambda k: F.col("first.ends")[k]
    sides = [F.when(v < end(2 * i), -1).when(v > end(2 * i + 1), 1).otherwise(0) for i in range(len(ps))]
    dealt = F.array(*[F.struct(F.lit(i).alias("i"), s.alias("side"), F.when(s == 0, v).alias("one"), v.alias("v")) for i, s in enumerate(sides)])
    parts = rows.withColumn("first", first.scalar()).select(F.col("first.n").alias("n"), F.inline(dealt))
    parts = parts.groupBy("i", "side", "one").agg(F.count("*").alias("k"), F.min("v").alias("low"), F.max("v").alias("high"), F.max("n").alias("n"))
    parts = parts.withColumn("to", F.sum("k").over(W.partitionBy("i").orderBy("side", "one"))).withColumn("from", F.col("to") - F.col("k") + 1)
    out = []
    for i, p in enumerate(ps):
        at = place(F.col("n"), p)
        rank = F.greatest(F.lit(1), F.least(F.floor(at), F.col("n") - room))
        value = lambda r: F.max(F.when(
            (F.col("i") == i) & (F.col("from") <= r) & (r <= F.col("to")),  # noqa: B023
            F.when(r == F.col("to"), F.col("high")).when((r == F.col("from")) | (F.col("low") == F.col("high")), F.col("low")),
        ))
        a, b = value(rank), value(F.least(rank + 1, F.col("n")))
        out.append((a + (b - a) * F.max(at - rank)).alias(f"p{i}"))
    return parts.agg(*out)


def histogram(df: DataFrame, keys: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Cumulative buckets (value at most le) by keys; le null is all."""
    counts = [F.count_if(F.col(value) <= b).alias(f"le_{b:g}".replace(".", "_")) for b in bounds]
    return df.groupBy(*keys).agg(*counts, F.count("*").alias("total"), F.round(F.sum(value), 2).alias("sum_value"))


def windowed_rates(df: DataFrame, ts: str, interval: str, ok: Column, slow: Column) -> DataFrame:
    """Tumbling windows: number, rate a second, success ratio, slow fraction."""
    w = F.window(F.col(ts).cast("timestamp"), interval)
    seconds = (F.unix_seconds(F.col("w.end")) - F.unix_seconds(F.col("w.start"))).alias("seconds")
    counted = df.groupBy(w.alias("w")).agg(F.count("*").alias("n"), F.count_if(ok).alias("good"), F.count_if(slow).alias("slow"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", seconds, "good", "slow").select(
        "window_start", "n", F.round(F.col("n") / F.col("seconds"), 6).alias("rate"), F.round(F.col("good") / F.col("n"), 4).alias("success_ratio"),
        F.round(F.col("slow") / F.col("n"), 4).alias("slow_fraction"),
    )


def outcome_split(df: DataFrame, ok: Column) -> DataFrame:
    return df.agg(F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"), F.count("*").alias("total"))


def connection_summary(df: DataFrame, up: Column, protocol: Column) -> DataFrame:
    """Hosts up, down and in all, and the requests that those up carry at once."""
    alive = F.coalesce(up, F.lit(False))
    return df.agg(
        F.count_if(alive).alias("up"), F.count_if(~alive).alias("down"), F.count("*").alias("total"),
        F.sum(F.when(alive, in_flight(protocol))).alias("in_flight"),
    )


def bucket_quantile(df: DataFrame, keys: list[str], value: str, bounds: list[float], q: float) -> DataFrame:
    """A quantile from cumulative buckets, linear within its bucket; past the last bound, the last bound."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("total"), *[F.count_if(F.col(value) <= b).alias(f"__{i}") for i, b in enumerate(bounds)])
    rank, out = F.col("total") * F.lit(q), F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low, below = (bounds[i - 1], F.col(f"__{i - 1}")) if i else (0.0, F.lit(0))
        inside = F.col(f"__{i}") - below
        at = F.lit(float(low)) + F.lit(float(bounds[i] - low)) * F.when(inside > 0, (rank - below) / inside).otherwise(1.0)
        out = F.when(F.col(f"__{i}") >= rank, at).otherwise(out)
    return counted.select(*keys, F.round(out, 4).alias("quantile"))
