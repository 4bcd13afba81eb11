"""A session over a data folder: parameterised queries, prepared queries, paged reads and query metrics."""

from __future__ import annotations

import time
from abc import ABC, abstractmethod
from collections import deque
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from .catalog import TABLES, identifier, table
from .errors import ConfigError, guarded
from .functions.text import query_hash
from .operators.paging import PagedResult, StreamConfig

METRICS = "query string, seconds double, success boolean, error_type string, rows long, kind string, at double"


@dataclass(frozen=True)
class QueryMetrics:
    query: str
    seconds: float
    success: bool
    error_type: str | None
    rows: int | None
    kind: str
    at: float


class MetricsCollector(ABC):
    """Where an engine reports its queries. A collector's error never fails a query."""

    @abstractmethod
    def record(self, one: QueryMetrics) -> None: ...


class RecentMetrics(MetricsCollector):
    """The last `most` queries; frame() gives them for the telemetry operators."""

    def __init__(self, most: int = 10_000) -> None:
        self.rows: deque[QueryMetrics] = deque(maxlen=most)

    def record(self, one: QueryMetrics) -> None:
        self.rows.append(one)

    def frame(self, spark: SparkSession) -> DataFrame:
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([tuple(asdict(r).values()) for r in self.rows], METRICS)
        return rows.withColumn("query_hash", query_hash(F.col("query")))


class Prepared:
    """A query whose parameters are bound at each call."""

    def __init__(self, engine: Engine, text: str) -> None:
        self.engine, self.text = engine, text

    def __call__(self, **parameters: object) -> DataFrame:
        return self.engine.query(self.text, parameters)


class Engine:
    """Tables of a folder as views. Use in a with block, or close()."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: list[str] | None = None, collectors: tuple[MetricsCollector, ...] = ()) -> None:
        self.spark, self.sf_dir, self.collectors, self.closed = spark.newSession(), sf_dir, collectors, False
        for name in tables or list(TABLES):
            table(self.spark, sf_dir, name).createOrReplaceTempView(identifier(name))

    def query(self, text: str, parameters: dict | list | None = None) -> DataFrame:
        """A lazy result. Parameters are :names or ?; they are bound and never spliced into the text."""
        if self.closed:
            raise ConfigError("the engine is closed")
        return guarded(lambda: self.spark.sql(text, args=parameters or None))

    def prepare(self, text: str) -> Prepared:
        return Prepared(self, text)

    def execute(self, text: str, parameters: dict | list | None = None) -> list[Row]:
        """The whole result, for results that fit on the driver."""
        return self._timed(text, "simple", lambda: self.query(text, parameters).collect())

    def one(self, text: str, parameters: dict | list | None = None) -> Row | None:
        """The first row, or None."""
        return self._timed(text, "simple", lambda: self.query(text, parameters).first())

    def stream(self, text: str, parameters: dict | list | None = None, config: StreamConfig | None = None) -> PagedResult:
        """The result in pages."""
        return PagedResult(self.query(text, parameters), config)

    def _timed(self, text: str, kind: str, action: Callable):
        began, error, rows = time.monotonic(), None, None
        try:
            out = guarded(action)
            rows = len(out) if isinstance(out, list) else int(out is not None)
            return out
        except Exception as e:
            error = type(e).__name__
            raise
        finally:
            found = QueryMetrics(text, time.monotonic() - began, error is None, error, rows, kind, time.time())
            for c in self.collectors:
                try:
                    c.record(found)
                except Exception:  # noqa: BLE001, S110  a collector never fails a query
                    pass

    def close(self) -> None:
        self.closed = True

    def __enter__(self) -> Engine:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
