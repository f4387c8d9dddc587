"""Retrieval metrics over two arrays of content ids: what was retrieved, best first, and what was expected."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def recall_at(retrieved: Column, expected: Column, k: int = 5) -> Column:
    """The share of expected ids, repeats counted, among the first k; 0 where nothing is expected."""
    first = F.slice(retrieved, 1, k)
    return F.when(F.size(expected) == 0, F.lit(0.0)).otherwise(F.size(F.filter(expected, lambda e: F.array_contains(first, e))) / F.size(expected))


def precision_at(retrieved: Column, expected: Column, k: int = 5) -> Column:
    """The share of the first k, repeats counted, that is expected. With fewer than k retrieved it is of those; 0 of none."""
    first = F.slice(retrieved, 1, k)
    return F.when(F.size(first) == 0, F.lit(0.0)).otherwise(F.size(F.filter(first, lambda r: F.array_contains(expected, r))) / F.size(first))


def reciprocal_rank(retrieved: Column, expected: Column) -> Column:
    """1 / place of the first expected id, over all that was retrieved; 0 without one."""
    places = F.filter(F.transform(retrieved, lambda r, i: F.when(F.array_contains(expected, r), i + 1)), lambda p: p.isNotNull())
    return F.coalesce(F.lit(1.0) / F.get(places, F.lit(0)), F.lit(0.0))


def unique_ids(ids: Column) -> Column:
    """Distinct ids in the order of their first places, without empty ones."""
    return F.filter(F.array_distinct(ids), lambda x: x != "")


def middle_last(results: Column) -> Column:
    """Best results to both ends: places 1, 3, 5 ... and then back ... 6, 4, 2. Two or fewer stay."""
    n = F.size(results)
    there = F.filter(results, lambda _, i: i % 2 == 0)
    back = F.reverse(F.filter(results, lambda _, i: i % 2 == 1))
    return F.when(n <= 2, results).otherwise(F.concat(there, back))
