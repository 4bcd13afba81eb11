"""Exports by token range with a manifest: complete or failed, and resumed where they stopped.

Ranges are written in groups, one Spark job a group, each group to its own folder. A finished
group is named in the manifest, and a run over the same output skips it. A failed group raises, with the
manifest as it stands.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import BulkError
from ..operators.bulk import range_id
from ..ranges import PORTABLE
from . import render
from .scratch import file_system, read_text, write_text


@dataclass
class Progress:
    """What an export has done. Kept as JSON beside the output."""

    output: str
    format: str
    total_ranges: int
    rows: int = 0
    seconds: float = 0.0
    completed: list[int] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)

    @property
    def is_complete(self) -> bool:
        return len(self.completed) == self.total_ranges

    @property
    def percentage(self) -> float:
        return 100.0 * len(self.completed) / self.total_ranges if self.total_ranges else 0.0

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0

    def save(self, spark: SparkSession) -> None:
        write_text(spark, f"{self.output}.progress", json.dumps(asdict(self)))

    @classmethod
    def load(cls, spark: SparkSession, output: str) -> Progress | None:
        text = read_text(spark, f"{output}.progress")
        return cls(**json.loads(text)) if text else None


WRITERS: dict[str, Callable] = {"csv": render.write_csv, "jsonl": render.write_jsonl, "parquet": render.write_parquet}


def register_format(name: str, writer: Callable[..., None]) -> None:
    """Add a sink: a function of a DataFrame, a path and options."""
    WRITERS[name] = writer


def export(
    df: DataFrame, token: Column, output: str, fmt: str = "parquet", ranges: int = 16, per_job: int = 4,
    on_progress: Callable[[Progress], None] | None = None, **options: object,
) -> Progress:
    """Write a table by equal ranges of the portable ring."""
    spark = df.sparkSession
    done = Progress.load(spark, output)
    if done is None or (done.format, done.total_ranges) != (fmt, ranges):
        done = Progress(output, fmt, ranges)
    done.errors = {}
    ranged = df.withColumn("__range", range_id(token, ranges, PORTABLE))
    for first in range(0, ranges, per_job):
        group = [r for r in range(first, min(first + per_job, ranges)) if r not in done.completed]
        if not group:
            continue
        seen, began = Observation(), time.monotonic()
        rows = ranged.filter(F.col("__range").isin(group)).drop("__range").observe(seen, F.count("*").alias("n"))
        path = f"{output}/ranges-{group[0]:06d}-{group[-1]:06d}"
        _, at, fs = file_system(spark, path)
        fs.delete(at, True)  # what an interrupted run left; the manifest does not name it
        try:
            WRITERS[fmt](rows, path, **options)
        except Exception as e:
            done.errors[str(group[0])] = str(e)[:500]
            done.save(spark)
            raise BulkError(f"ranges {group} failed", done, {group[0]: e}) from e
        done.rows += seen.get["n"]
        done.seconds += time.monotonic() - began
        done.completed += group
        done.save(spark)
        if on_progress:
            on_progress(done)
    return done
