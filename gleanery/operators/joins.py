"""Joins whose small side is broadcast only after its size was checked."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000  # of one number each: a few MB


def free_name(taken: list[str], stem: str) -> str:
    """A column name that none of ``taken`` has, whatever its case."""
    low = {c.lower() for c in taken}
    k = 0
    while f"{stem}{k}".lower() in low:
        k += 1
    return f"{stem}{k}"


def by_keys(rows: DataFrame, keys: DataFrame, column: str, how: str, save: Callable[[DataFrame], DataFrame] = lambda df: df.checkpoint(), most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` (``how``: left_semi or left_anti) by whether their ``column``, as a number, is among ``keys`` (one column of
    numbers); null is a key like any other.

    The keys are materialised and counted first.  Up to ``most`` are broadcast, so that the rows stay where they are;
    more are joined by a shuffle of both sides.
    """
    (name,) = keys.columns
    key = free_name(rows.columns, "_key")
    keys = save(keys.select(F.col(name).cast("long").alias(key)).distinct())
    if keys.count() <= most:
        keys = F.broadcast(keys)
    return rows.join(keys, F.col(column).cast("long").eqNullSafe(F.col(key)), how)
