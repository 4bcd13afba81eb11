"""Collection updates: lists, sets and maps. An update that leaves nothing gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_null(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def list_append(xs: Column, more: Column) -> Column:
    return or_null(F.concat(xs, more))


def list_prepend(xs: Column, more: Column) -> Column:
    return or_null(F.concat(more, xs))


def list_remove(xs: Column, gone: Column) -> Column:
    """All elements equal to one of gone; other repeats stay."""
    return or_null(F.filter(xs, lambda x: ~F.array_contains(gone, x)))


def set_add(xs: Column, more: Column) -> Column:
    return or_null(F.array_sort(F.array_union(xs, more)))


def set_remove(xs: Column, gone: Column) -> Column:
    return or_null(F.array_sort(F.array_except(xs, gone)))


def map_merge(m: Column, new: Column) -> Column:
    """Entries of new replace those of m."""
    return or_null(F.map_concat(F.map_filter(m, lambda k, v: ~F.map_contains_key(new, k)), new))


def map_put(m: Column, key: Column, value: Column) -> Column:
    return map_merge(m, F.create_map(key, value))


def map_delete(m: Column, key: Column) -> Column:
    return or_null(F.map_filter(m, lambda k, v: k != key))
