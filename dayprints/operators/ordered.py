"""Ordered computations that stay balanced when one key, or one second of it, holds most rows.

A plain window over a key sorts the whole key in one task. Here the rows of all keys, in the
order of key, time and tie-break, are cut into ranges of about equal size, whatever the keys are;
the splitters come from a bounded sample, and any splitters give the same results. Rows are
windowed inside (key, range). What must cross a border comes from few rows: the rows at the edges
of the ranges see each other in one more window, and a running value starts from a carried row.
Nothing is joined, so null keys and null times are groups like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 32  # sampled rows per range
_R = "__range"
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
          "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def _order(cols: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in cols]


def _splitters(df: DataFrame, by: Sequence[str], fan: int) -> Column:
    """Three levels of splitters for ``fan`` ** 3 ranges, as a literal.

    The sample is that of the smallest hashes: one pass that keeps a bounded number of rows.
    """
    n = fan ** 3
    sample = (df.select(F.struct(*by).alias("row")).orderBy(F.xxhash64("row"))
              .limit(SAMPLE * n).agg(F.array_sort(F.collect_list("row")).alias("rows")))

    def splitter(t: Column) -> Column:
        return F.get("rows", F.floor(t * F.size("rows") / n).cast("int"))

    def level(step: int) -> Column:  # the inner splitters of every node
        return F.transform(F.sequence(F.lit(0), F.lit(n // (step * fan) - 1)), lambda node:
                           F.transform(F.sequence(F.lit(1), F.lit(fan - 1)), lambda k:
                                       splitter(node * (step * fan) + k * step)))

    tree = sample.select(F.struct(F.array(level(fan * fan), level(fan), level(1)).alias("tree")))
    text = tree.select(F.to_json(tree.columns[0], _EXACT)).first()[0]
    return F.from_json(F.lit(text), tree.schema[0].dataType, _EXACT)["tree"]  # is folded


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str],
           ranges: int | None = None) -> DataFrame:
    """Add ``__range``: rows of smaller (keys, order) have no larger range.

    The functions below do this themselves; several of them in a row over the same keys and order
    share the ranges of a table that has them, and keep the column.
    """
    if _R in df.columns:
        return df
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fan = max(2, round(ranges ** (1 / 3)))
    by = [*keys, *order]
    tree = _splitters(df, by, fan)
    kind = ",".join(f"`{c}`:{df.schema[c].dataType.simpleString()}" for c in by)
    out = df.withColumns({"__row": F.struct(*by).cast(f"struct<{kind}>"), _R: F.lit(0)})
    for level in range(3):
        node = F.get(tree[level], F.col(_R))
        below = F.size(F.filter(node, lambda s: s <= F.col("__row")))
        out = out.withColumn(_R, F.col(_R) * fan + below)
    return out.drop("__row")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, tuple],
            descending: bool = False) -> DataFrame:
    """Add running ``sum`` or ``max`` columns up to and including each row.

    ``order`` starts with the timestamp and ends with a unique tie-break;
    ``values`` maps a new column to ``("sum" | "max", Column)``.
    """
    fns = {"sum": F.sum, "max": F.max}
    keys = list(keys)
    rows = ranged(df, keys, order).withColumns(
        {name: value for name, (_, value) in values.items()})
    before = (Window.partitionBy(*keys).orderBy(*_order([_R], descending))
              .rowsBetween(Window.unboundedPreceding, -1))
    totals = rows.groupBy(*keys, _R).agg(
        *[fns[fn](name).alias(name) for name, (fn, _) in values.items()])
    carried = totals.select(*keys, _R, *[fns[fn](name).over(before).alias(name)
                                         for name, (fn, _) in values.items()])
    first = F.lit(True).alias("__carried")  # sorts in front of the rows of its range
    every = rows.withColumn("__carried", F.lit(False)).unionByName(
        carried.select("*", first), allowMissingColumns=True)
    inside = (Window.partitionBy(*keys, _R)
              .orderBy(F.col("__carried").desc(), *_order(order, descending))
              .rowsBetween(Window.unboundedPreceding, 0))
    out = every.withColumns({name: fns[fn](name).over(inside)
                             for name, (fn, _) in values.items()})
    return out.where(~F.col("__carried")).select(
        *[c for c in df.columns if c not in values], *values)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn",
                descending: bool = False) -> DataFrame:
    """Add the 1-based position of each row within its key."""
    return running(df, keys, order, {name: ("sum", F.lit(1).cast("bigint"))}, descending)


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               values: dict[str, tuple[int, Column]],
               ends: dict[str, tuple[str, Column]] | None = None) -> DataFrame:
    """Add columns from the rows before (offset -1, -2, ..) and behind (1, 2, ..) within the key.

    ``values`` maps a new column to (offset, Column); it is null beyond the key's ends. All
    offsets come from one window. ``ends`` maps a new column to ("first" | "last", Column): the
    key's first or last value that is not null, of an expression over the new columns too. It is
    set on the rows near a border of a range, among which are the first and the last rows of
    every key, as many as the largest offset; elsewhere it is null.
    """
    keys, ends = list(keys), ends or {}
    offsets = sorted({offset for offset, _ in values.values()})
    reach = max(map(abs, offsets))
    packed = {offset: F.struct(*[value.alias(name) for name, (at, value) in values.items()
                                 if at == offset]) for offset in offsets}
    names = {offset: f"__at{i}" for i, offset in enumerate(offsets)}

    def found(window):
        return {names[o]: (F.lag(packed[o], -o) if o < 0 else F.lead(packed[o], o)).over(window)
                for o in offsets}

    inside = Window.partitionBy(*keys, _R).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(*order)
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = (F.lag(F.lit(1), reach).over(inside).isNull()
            | F.lead(F.lit(1), reach).over(inside).isNull())
    rows = ranged(df, keys, order).withColumns({**found(inside), "__edge": edge})
    fixed = rows.where("__edge").withColumns({
        name: F.coalesce(name, value) for name, value in found(across).items()})

    def unpacked(rows):
        return rows.select(*df.columns, *[F.col(names[at])[name].alias(name)
                                          for name, (at, _) in values.items()])

    fixed = unpacked(fixed).withColumns({
        name: (F.first if which == "first" else F.last)(value, ignorenulls=True).over(whole)
        for name, (which, value) in ends.items()})
    return unpacked(rows.where(~F.col("__edge"))).unionByName(fixed, allowMissingColumns=True)


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column],
             descending: bool = False, ring: bool = False) -> DataFrame:
    """Add columns holding the preceding row's values (null on a key's first row).

    With ``descending`` the preceding row is the next one in time; with ``ring``
    a key's first row is preceded by its last one.
    """
    packed = F.struct(*[value.alias(name) for name, value in values.items()])
    ends = {"__end": ("first" if descending else "last", packed)} if ring else None
    out = neighbours(df, keys, order, {"__prev": (1 if descending else -1, packed)}, ends)
    prev = F.coalesce("__prev", "__end") if ring else F.col("__prev")
    return out.select(*df.columns, *[prev[name].alias(name) for name in values])
