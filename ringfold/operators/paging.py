"""Reads in pages: streamed to the driver one partition at a time, or as relational pages.

Rows never gather on the driver beyond a page and the partition it comes from.
"""

from __future__ import annotations

import contextlib
import itertools
import logging
import threading
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import ConfigError, QueryTimeout
from ..functions.text import cursor, from_cursor

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class StreamConfig:
    """fetch_size rows a page; max_pages (0 or None: all); page_callback(page number, rows in it)."""

    fetch_size: int = 1000
    max_pages: int | None = None
    page_callback: Callable[[int, int], None] | None = None
    timeout_seconds: float | None = None

    def __post_init__(self) -> None:
        if self.fetch_size < 1:
            raise ConfigError("fetch_size is 1 at least")


class PagedResult:
    """Pages or rows of a DataFrame. close() cancels what runs and may be called again; a with block closes.

    timeout_seconds holds for the whole read.
    """

    def __init__(self, df: DataFrame, config: StreamConfig | None = None) -> None:
        config = config or StreamConfig()
        self.config, self.schema, self.page_number, self.closed = config, df.schema, 0, False
        self._group = f"ringfold-{uuid.uuid4().hex}"
        self._context = df.sparkSession.sparkContext
        self._df = df.limit(config.max_pages * config.fetch_size) if config.max_pages else df
        self._late = False

    def pages(self) -> Iterator[list[Row]]:
        timer = None
        if self.config.timeout_seconds:
            timer = threading.Timer(self.config.timeout_seconds, self._expire)
            timer.daemon = True
            timer.start()
        try:
            with self._grouped():
                rows = self._df.toLocalIterator(prefetchPartitions=True)
            while not self.closed and (page := self._page(rows)):
                self.page_number += 1
                if self.config.page_callback:
                    try:
                        self.config.page_callback(self.page_number, len(page))
                    except Exception:  # a callback's error never ends the read
                        log.exception("page callback")
                yield page
            if self._late:
                raise QueryTimeout(f"not read within {self.config.timeout_seconds} s")
        except Exception:
            if self._late:
                raise QueryTimeout(f"not read within {self.config.timeout_seconds} s") from None
            if not self.closed:
                raise
        finally:
            if timer:
                timer.cancel()

    def _page(self, rows: Iterator[Row]) -> list[Row]:
        with self._grouped():
            return list(itertools.islice(rows, self.config.fetch_size))

    @contextlib.contextmanager
    def _grouped(self) -> Iterator[None]:
        """Jobs started here belong to this read; the thread's own group holds again afterwards."""
        names = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
        before = [self._context.getLocalProperty(n) for n in names]
        self._context.setJobGroup(self._group, "paged read", True)
        try:
            yield
        finally:
            for n, value in zip(names, before):
                self._context.setLocalProperty(n, value)

    def __iter__(self) -> Iterator[Row]:
        return itertools.chain.from_iterable(self.pages())

    def _expire(self) -> None:
        self._late = True
        self.close()

    def close(self) -> None:
        if not self.closed:
            self.closed = True
            self._context.cancelJobGroup(self._group)

    cancel = close

    def __enter__(self) -> PagedResult:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def with_page(df: DataFrame, order: list[Column], size: int, slice_rows: Column | None = None) -> DataFrame:
    """Add page, from 1, in a total order.

    Pages come from counts of value ranges of the first order column (which is range-partitioned), not from one task
    that numbers all rows: each range is numbered on its own and starts where those before it end. slice_rows: the number of a row's value range, ascending
    in the order; without it there is one range, for tables that one task can sort.
    """
    part = slice_rows if slice_rows is not None else F.lit(0)
    ranged = df.withColumn("__slice", part)
    starts = _starts(ranged.groupBy("__slice").agg(F.count("*").alias("__n")))
    number = F.row_number().over(W.partitionBy("__slice").orderBy(*order)) + F.col("__start")
    return ranged.join(starts, "__slice").withColumn("page", (F.floor((number - 1) / size) + 1).cast("long")).drop("__slice", "__start")


def _starts(counts: DataFrame) -> DataFrame:
    """__slice and __start: the rows of all slices before. Slices are summed in blocks of 1024, so that no task orders them all."""
    counts = counts.withColumn("__block", F.floor(F.col("__slice") / 1024))
    before = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = counts.groupBy("__block").agg(F.sum("__n").alias("__n")).select("__block", before(W.orderBy("__block")).alias("__base"))
    own = counts.withColumn("__own", before(W.partitionBy("__block").orderBy("__slice"))).join(blocks, "__block")
    return own.select("__slice", (F.col("__base") + F.col("__own")).alias("__start"))


def first_pages(df: DataFrame, order: list[Column], size: int, pages: int) -> DataFrame:
    return df.orderBy(*order).limit(size * pages)


def cursor_page(df: DataFrame, token: Column, after: int | None, limit: int) -> DataFrame:
    """A page by ascending token with next_cursor and has_next; one row more is read to know whether there are others."""
    rows = df.withColumn("token", token)
    if after is not None:
        rows = rows.filter(F.col("token") > after)
    rows = rows.orderBy("token").limit(limit + 1)
    rows = rows.withColumn("__k", F.row_number().over(W.orderBy("token")))
    more = F.max("__k").over(W.partitionBy()) > limit
    return rows.withColumn("has_next", more).filter(F.col("__k") <= limit).withColumn("next_cursor", cursor(F.col("token"))).drop("__k")


__all__ = ["PagedResult", "StreamConfig", "cursor_page", "first_pages", "from_cursor", "with_page"]
