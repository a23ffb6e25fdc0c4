"""Calls, applications and social places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.functions.sensors import first_allowed_place
from dayprints.functions.time import ms_to_s, slot48, week_label, week_start
from dayprints.operators import filters
from dayprints.operators.ordered import row_numbers

USER = ["service", "user"]
DAY = [*USER, "day"]
WEEK_LABELS = ("monday", "published")


def weekly(df: DataFrame, keys: list[str], aggregates: list[Column],
           label: str = "monday") -> DataFrame:
    """Aggregate per user-week; the column ``week`` dates the week.

    ``monday`` groups by the Monday of the week. ``published`` groups by
    (calendar year, ISO week) and dates the pair as a Monday-counted week, as
    tables written before do; it splits weeks at the turn of the year.
    """
    if label not in WEEK_LABELS:
        raise ValueError(f"label must be one of {WEEK_LABELS}")
    if label == "monday":
        return df.groupBy(*keys, week_start("day").alias("week")).agg(*aggregates)
    year, week = F.year("day").alias("__year"), F.weekofyear("day").alias("__week")
    out = df.groupBy(*keys, year, week).agg(*aggregates)
    return (out.withColumn("week", week_label("__year", "__week"))
            .select(*keys, "week", *[c for c in out.columns
                                     if c not in (*keys, "__year", "__week")]))


def _outgoing() -> Column:
    share = F.count_if(F.col("call_type") == "OUTGOING") * 100 / F.count(F.lit(1))
    return F.floor(share).cast("int").alias("outgoing_pct")


def _number() -> Column:
    return F.coalesce("destination_number", F.lit(""))


def call_weeks(calls: DataFrame, since: str, label: str = "monday") -> DataFrame:
    """Outgoing share and contact entropy of each user-week in one aggregate.

    Entropy counts only calls after ``since`` and is null for weeks without any.
    """
    number = F.when(F.col("day") > F.lit(since).cast("date"), _number())
    return weekly(calls, USER, [
        _outgoing(),
        F.log2(F.nullif(F.count_distinct(number), F.lit(0))).alias("entropy")], label)


def outgoing_pct(calls: DataFrame, label: str = "monday") -> DataFrame:
    """Outgoing calls in whole percent of all calls, per user-week."""
    return weekly(calls, USER, [_outgoing()], label)


def contact_entropy(calls: DataFrame, since: str, label: str = "monday") -> DataFrame:
    """log2 of the distinct numbers called; a missing number is one contact."""
    return weekly(filters.since(calls, since), USER,
                  [F.log2(F.count_distinct(_number())).alias("entropy")], label)


def contact_entropy_shannon(calls: DataFrame, since: str) -> DataFrame:
    """Entropy of the call shares; equals ``contact_entropy`` for even shares."""
    rows = filters.since(calls, since).withColumn("number", _number())
    n = weekly(rows, [*USER, "number"], [F.count(F.lit(1)).alias("n")])
    return n.groupBy(*USER, "week").agg(
        (F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")).alias("entropy"))


def app_rows(df: DataFrame) -> DataFrame:
    """One row per application entry: arrays of {name, duration} flattened."""
    kept = [c for c in df.columns if c not in ("apps", "app", "duration")]
    return df.where("apps is not null").select(*kept, F.inline("apps").alias("app", "duration"))


def app_usage(df: DataFrame) -> DataFrame:
    """Seconds per (user-day, slot, application), without launchers and zeros."""
    sums = (app_rows(df).withColumn("slot", slot48("ts"))
            .groupBy(*DAY, "slot", "app").agg(ms_to_s(F.sum("duration")).alias("time")))
    return filters.launcher(sums)


def zip_explode(df: DataFrame, left: str, right: str) -> DataFrame:
    """Parallel arrays to rows, pairing up to the shorter one."""
    kept = [c for c in df.columns if c not in (left, right)]
    n = F.least(F.size(left), F.size(right))
    pairs = F.slice(F.arrays_zip(left, right), F.lit(1), n)
    return df.select(*kept, F.inline(pairs))


def call_register(calls: DataFrame) -> DataFrame:
    return calls.select(
        F.date_format("ts", "HH:mm:ss").alias("time"), "duration",
        F.col("destination_number").alias("number"), F.col("call_type").alias("type"), *DAY)


def calls_apps_outer(calls: DataFrame, apps: DataFrame) -> DataFrame:
    """User-days with calls or applications, with the size of either side.

    Both sides are reduced to one row per user-day before the join.
    """
    c = calls.groupBy(*DAY).agg(F.count(F.lit(1)).alias("calls"))
    a = apps.groupBy(*DAY).agg(F.count(F.lit(1)).alias("app_rows"))
    return c.join(a, on=DAY, how="full_outer").fillna(0, ["calls", "app_rows"])


def social_places(df: DataFrame) -> DataFrame:
    """First allowed place of each sample, in time order within the user-week.

    One row per list entry: (user, week, pos, place). The position comes from a
    two-level count, so a user-week is never held by one task.
    """
    rows = (df.withColumn("week", week_start("day"))
            .withColumn("place", first_allowed_place("places")).where("place is not null"))
    return row_numbers(rows, ["user", "week"], ["ts", "event_id"], "pos").select(
        "user", "week", "pos", "place")


def collect_per_key(df: DataFrame, keys: list[str], order: list[str], value: Column,
                    piece_rows: int = 10_000) -> DataFrame:
    """Ordered list of values per key, in pieces of at most ``piece_rows``.

    (keys, piece, values): concatenating a key's pieces gives the whole list.
    """
    rows = row_numbers(df.withColumn("__value", value), keys, order, "__pos")
    piece = F.floor((F.col("__pos") - 1) / piece_rows).alias("piece")
    listed = F.array_sort(F.collect_list(F.struct("__pos", "__value")))
    return rows.groupBy(*keys, piece).agg(
        F.transform(listed, lambda s: s["__value"]).alias("values"))
