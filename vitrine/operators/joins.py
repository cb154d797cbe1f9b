"""Joins of a large side to a keyed table whose size is not known in advance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join to a table with one row per key, or few.

    A plain equality join: nothing runs while the query is built. Adaptive execution broadcasts the
    right side if what its stage has produced is small, and otherwise splits the partitions of the
    left side that a frequent key has made large, so such a key is shared by several tasks.
    """
    return left.join(right, list(on), how)


def null_safe_anti(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of the left side whose key (null included) the right side lacks."""
    other = right.select(F.col(key).alias("_key"))
    matches: Column = left[key].eqNullSafe(other["_key"])
    return left.join(other, matches, "left_anti")
