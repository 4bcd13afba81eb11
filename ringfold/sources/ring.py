"""Tables as partitions of the ring: a range column for pruning, and a source that plans by ranges."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.tokens import portable
from ..operators.bulk import range_id
from ..ranges import PORTABLE, TokenRange, split_proportionally, whole


def ring_table(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Add token and range_id."""
    token = portable(key)
    return df.withColumns({"token": token, "range_id": range_id(token, parts)})


def write_ring(df: DataFrame, key: str, parts: int, path: str) -> None:
    """Store a table by range_id, so that scans of ranges read their folders only."""
    ring_table(df, key, parts).repartition("range_id").write.partitionBy("range_id").parquet(path)


def read_ring(spark: SparkSession, path: str, ranges: list[int] | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if ranges is None else rows.filter(F.col("range_id").isin(ranges))


class RangePartition(InputPartition):
    def __init__(self, number: int, one: TokenRange) -> None:
        super().__init__(number)
        self.one = one


class RingReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.parts = int(options.get("parts", 8))

    def partitions(self) -> list[InputPartition]:
        ranges = split_proportionally(whole(self.parts, PORTABLE), self.parts, PORTABLE)
        return [RangePartition(i, r) for i, r in enumerate(ranges)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        one = partition.one
        yield partition.value, one.start, one.end, one.wraps


class RingSource(DataSource):
    """spark.read.format("ring"): a row for each token range, one in each partition, to be joined or mapped over."""

    @classmethod
    def name(cls) -> str:
        return "ring"

    def schema(self) -> str:
        return "range_id int, lo long, hi long, wraps boolean"

    def reader(self, schema) -> RingReader:
        return RingReader(self.options)
