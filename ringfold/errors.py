"""Errors of the engine. Spark's own errors pass through unchanged; others are wrapped in QueryError."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import PySparkException

T = TypeVar("T")


class RingError(Exception):
    """Base of all errors of the engine."""


class QueryError(RingError):
    """A query failed for a reason that is not Spark's."""


class ConfigError(RingError):
    """A parameter makes no sense."""


class BulkError(RingError):
    """Some ranges of a bulk operation failed; `partial` holds what the others gave, `failed` the errors by range."""

    def __init__(self, message: str, partial: object = None, failed: dict | None = None) -> None:
        super().__init__(message)
        self.partial, self.failed = partial, failed or {}


class QueryTimeout(RingError):
    """A query was cancelled after its time was up."""


def guarded(action: Callable[[], T]) -> T:
    """Run an action; wrap what is neither Spark's nor the engine's own error."""
    try:
        return action()
    except (PySparkException, RingError):
        raise
    except Exception as e:
        raise QueryError(str(e)) from e
