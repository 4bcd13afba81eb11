"""Tables: their keys, their order and how they are loaded."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import ConfigError


@dataclass(frozen=True)
class TableMeta:
    """A table's partition key (drives its token), clustering key and clustering order."""

    name: str
    partition_key: tuple[str, ...]
    clustering_key: tuple[str, ...] = ()
    descending: frozenset[str] = field(default_factory=frozenset)

    def order(self):
        """Sort columns within a partition."""
        return [F.col(c).desc() if c in self.descending else F.col(c).asc() for c in self.clustering_key]


TABLES = {
    t.name: t
    for t in (
        TableMeta("region", ("r_regionkey",)),
        TableMeta("nation", ("n_nationkey",)),
        TableMeta("customer", ("c_custkey",)),
        TableMeta("supplier", ("s_suppkey",)),
        TableMeta("part", ("p_partkey",)),
        TableMeta("orders", ("o_orderkey",)),
        TableMeta("lineitem", ("l_orderkey",), ("l_linenumber",)),
        TableMeta("events", ("user_id",), ("ts",), frozenset({"ts"})),
    )
}


def identifier(name: str) -> str:
    """The name, if it is one that may stand in built SQL: letters, digits and underscores."""
    if not name or not all(c.isalnum() or c == "_" for c in name):
        raise ConfigError(f"not an identifier: {name!r}")
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{identifier(name)}.parquet")


def clustered(df: DataFrame, meta: TableMeta, partitions: int | None = None) -> DataFrame:
    """Rows as the table stores them: a partition key's rows together, in clustering order."""
    dealt = df.repartition(partitions, *meta.partition_key) if partitions else df.repartition(*meta.partition_key)
    return dealt.sortWithinPartitions(*meta.partition_key, *meta.order())
