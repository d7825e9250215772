"""Joins of many rows with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def many_to_one(many: DataFrame, one: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Joins `many`, where a key may hold a large share of the rows, to `one`.

    Spark splits the partition of a hot key only when both sides come straight from
    a shuffle made for the join. `one` is mostly an aggregate on the very keys, whose
    partitioning Spark would reuse; null-safe equality gives the join its own
    (small) shuffle, and NULL keys meet. `one` carries a row per key; `how` is inner,
    left, left_semi or left_anti.
    """
    renamed = one.select(
        *(F.col(k).alias(f"__one_{k}") for k in keys),
        *(c for c in one.columns if c not in keys),
    )
    on = [F.col(k).eqNullSafe(F.col(f"__one_{k}")) for k in keys]
    return many.join(renamed, on, how).drop(*(f"__one_{k}" for k in keys))
