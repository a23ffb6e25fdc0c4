"""Joins on keys of which some rows may be null: nulls are a key like any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_same(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``df`` with the columns of ``side`` of the same keys; the keys stand once."""
    other = {c: f"__same_{i}" for i, c in enumerate(keys)}
    same = [F.col(c).eqNullSafe(F.col(o)) for c, o in other.items()]
    return df.join(side.withColumnsRenamed(other), on=same, how=how).drop(*other.values())
