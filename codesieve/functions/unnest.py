"""Rows of array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, keep: Sequence[str], array: Column | str, item: str, at: str | None = None) -> DataFrame:
    """``keep`` and one row per element that is not null, with its 0-based place in ``at``.

    Uses the outer form of explode: ahead of the plain form Spark puts a filter for empty arrays, sinks
    it below all projections, and so computes a derived array again and again.
    """
    made = F.posexplode_outer(array).alias(at, item) if at else F.explode_outer(array).alias(item)
    return df.select(*keep, made).where(F.col(item).isNotNull())


def unnest_structs(df: DataFrame, keep: Sequence[str], array: Column | str, at: str | None = None) -> DataFrame:
    """As :func:`unnest`, with the fields of the elements as columns."""
    rows = unnest(df, keep, array, "_item", at)
    return rows.select(*keep, *([at] if at else []), "_item.*")
