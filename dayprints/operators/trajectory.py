"""Ordered computations over a user's track and over sample times."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.functions.geo import euclid
from dayprints.functions.time import epoch_millis
from dayprints.operators.ordered import neighbours, previous, row_numbers

ORDER = ["ts", "event_id"]
POSITION = ["longitude", "latitude"]


def step(at: Callable[..., Column]) -> Column:
    """Distance of a point to the one before; ``at(column, offset)`` gives a row's neighbours."""
    return euclid(at("longitude") - at("longitude", -1), at("latitude") - at("latitude", -1))


def _at(shift: int) -> Callable[..., Column]:
    return lambda c, offset=0: F.col(f"__{c}{offset + shift}" if offset + shift else c)


def _offsets(columns: Sequence[str], offsets: Sequence[int]) -> dict[str, tuple[int, Column]]:
    return {f"__{c}{o}": (o, F.col(c)) for c in columns for o in offsets}


def step_distance(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distance of each point to the one before; a key's first point has none."""
    out = neighbours(df, keys, ORDER, _offsets(POSITION, [-1]))
    return out.select(*df.columns, step(_at(0)).alias("step")).where("step is not null")


def haar_detail(df: DataFrame, keys: list[str], value: str | Callable[..., Column],
                columns: Sequence[str] = (), reach: int = 0) -> DataFrame:
    """Level-1 Haar detail and smooth of a series, as absolute values.

    Both are symmetric three-point filters; the series is closed into a ring. The series is a
    column, or a function of ``at(column, offset)`` over ``columns`` of the row and of up to
    ``reach`` rows before it, like ``step``: then a key's first ``reach`` rows have no value, and
    one pass gives the series and both of its neighbours. Rows with a null are left out first.
    """
    if isinstance(value, str):
        columns, series = [value], lambda at: at(value)
    else:
        series = value
    x, before, after = (series(_at(shift)) for shift in (0, -1, 1))
    rows = neighbours(df.dropna(subset=list(columns)), keys, ORDER,
                      _offsets(columns, [*range(-reach - 1, 0), 1]),
                      ends={"__first": ("first", x), "__last": ("last", x)})
    around = F.coalesce(before, "__last") + F.coalesce(after, "__first")
    return rows.where(x.isNotNull()).select(
        *df.columns, F.abs((2 * x - around) / 4).alias("detail"),
        F.abs((2 * x + around) / 4).alias("smooth"))


def tail_slice(df: DataFrame, keys: list[str], far: int = 1100, near: int = 900) -> DataFrame:
    """The rows from the ``far``-th last up to before the ``near``-th last, by time."""
    out = row_numbers(df, keys, ORDER, "back", descending=True)
    return out.where((F.col("back") <= far) & (F.col("back") > near))


def sample_gap(df: DataFrame, keys: list[str]) -> DataFrame:
    """Milliseconds since the key's previous sample."""
    out = previous(df.withColumn("ms", epoch_millis("ts")), keys, ORDER, {"pms": F.col("ms")})
    return (out.withColumn("gap_ms", F.col("ms") - F.col("pms"))
            .where("gap_ms is not null").drop("ms", "pms"))


def interval_hist(gaps: DataFrame, keys: list[str], bins: int = 15) -> DataFrame:
    """Counts of gaps in equal-width bins between a key's smallest and largest gap.

    The last bin includes its upper edge; bins without a gap are left out.
    """
    # count equal gaps first: what follows sees distinct gaps, not samples
    counted = gaps.groupBy(*keys, "gap_ms").agg(F.count(F.lit(1)).alias("n"))
    ends = counted.groupBy(*keys).agg(F.min("gap_ms").alias("lo"), F.max("gap_ms").alias("hi"))
    width = F.greatest(F.col("hi") - F.col("lo"), F.lit(1))
    counted = counted.join(ends, on=keys)
    bin_ = F.least(F.floor((F.col("gap_ms") - F.col("lo")) * bins / width), F.lit(bins - 1))
    return counted.groupBy(*keys, bin_.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
