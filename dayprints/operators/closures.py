"""User functions: vectorised maps, filters, flat maps and keyed reductions.

Built-in columns are the first choice; these are for logic that has none. All of
them receive Arrow batches as pandas objects, never single rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


HELD_KEYS = 100_000  # partial results a task holds before it passes them on


def map_column(fn: Callable[..., pd.Series], ddl: str, *columns: str) -> Column:
    """A column computed by ``fn`` from batches of the given columns."""
    return F.pandas_udf(fn, ddl)(*columns)


def filter_rows(df: DataFrame, fn: Callable[..., pd.Series], *columns: str) -> DataFrame:
    """Rows for which ``fn`` gives true."""
    return df.where(map_column(fn, "boolean", *columns))


def flat_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], ddl: str) -> DataFrame:
    """Any number of output rows per batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)
    return df.mapInPandas(run, ddl)


def reduce_by_key(df: DataFrame, keys: list[str], value: str,
                  fn: str | Callable[[pd.Series], object]) -> DataFrame:
    """Reduce ``value`` per key by an associative, commutative ``fn``.

    Partitions are reduced before the shuffle, batch by batch, so a hot key sends
    about one row per partition.
    """
    ddl = df.select(*keys, value).schema

    def reduced_rows(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby(keys, as_index=False, dropna=False)[value].agg(fn)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            batch = reduced_rows(batch)
            held = batch if held is None else reduced_rows(pd.concat([held, batch]))
            if len(held) > HELD_KEYS:
                yield held
                held = None
        if held is not None:
            yield held

    reduced = df.select(*keys, value).mapInPandas(partial, ddl)
    return reduced.groupBy(*keys).applyInPandas(reduced_rows, ddl)
