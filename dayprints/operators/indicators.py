"""Indicators of a user-day, and daily distances of app and wearable."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayprints.functions.sensors import actigraphy_level, is_active
from dayprints.functions.time import BIN_SECONDS, BINS, bin288, time_text
from dayprints.operators import filters
from dayprints.operators.ordered import running
from dayprints.session import measured

USER_DAY = ["user", "day"]


def gyradius(df: DataFrame) -> DataFrame:
    """Root mean squared distance to the day's centroid, in degrees."""
    return filters.no_sentinel(df).groupBy(*USER_DAY).agg(
        F.sqrt(F.var_pop("longitude") + F.var_pop("latitude")).alias("gyradius"))


def last_in_bin(df: DataFrame) -> DataFrame:
    """The last activity level of each five-minute bin (bin 288 is off the axis)."""
    rows = (df.withColumn("level", actigraphy_level("actigraphy")).where("level is not null")
            .withColumn("bin", bin288("ts")))
    return rows.groupBy(*USER_DAY, "bin").agg(
        F.max_by("level", F.struct("ts", "event_id")).alias("level"))


def circadian(df: DataFrame) -> DataFrame:
    """Cosinor fit of the day's activity on 288 bins, absent bins counting as 1.

    The axis closes at 24 h, so bins 0 and 287 share their angle and the normal
    equations are constant: [[288, 1, 0], [1, 144.5, 0], [0, 0, 143.5]]. Only
    the deviations from 1 have to be summed. Mesor is the mean of the fit,
    amplitude its maximum above that, acrophase the time of the first grid maximum.
    """
    bins = last_in_bin(filters.with_actigraphy(df))
    step = 2 * math.pi / (BINS - 1)
    angle = F.col("bin") * step
    off = F.when(F.col("bin") < BINS, F.col("level") - 1).otherwise(0.0)
    sums = bins.groupBy(*USER_DAY).agg(
        (F.sum(off) + BINS).alias("s0"),
        (F.sum(off * F.cos(angle)) + 1).alias("s1"),
        F.sum(off * F.sin(angle)).alias("s2"))
    det = BINS * 144.5 - 1
    fit = sums.select(
        *USER_DAY,
        ((F.col("s0") * 144.5 - F.col("s1")) / det).alias("b0"),
        ((F.col("s1") * BINS - F.col("s0")) / det).alias("b1"),
        (F.col("s2") / 143.5).alias("b2"))

    def wave(k: Column) -> Column:
        return F.col("b1") * F.cos(k * step) + F.col("b2") * F.sin(k * step)

    # the grid maximum is one of the two grid points around the fitted peak
    peak = F.pmod(F.atan2("b2", "b1"), F.lit(2 * math.pi)) / step
    below, above = F.floor(peak), F.pmod(F.floor(peak) + 1, F.lit(BINS - 1))
    flat = F.abs("b1") + F.abs("b2") < 1e-12
    better = F.when(wave(above) > wave(below), above).otherwise(below)
    index = F.when(flat, F.lit(0)).otherwise(F.pmod(better, F.lit(BINS - 1))).cast("int")
    mesor = F.col("b0") + F.col("b1") / BINS
    return fit.withColumn("index", index).select(
        *USER_DAY,
        (F.col("index") * BIN_SECONDS).alias("acrophase_s"),
        time_text(F.col("index") * BIN_SECONDS).alias("acrophase"),
        mesor.alias("mesor"),
        (F.col("b0") + wave(F.col("index")) - mesor).alias("amplitude"))


def active_runs(df: DataFrame) -> DataFrame:
    """Runs of consecutive active samples of a user-day: first and last minute.

    A run is known by the number of inactive samples before it. Every user-day
    keeps at least one row, with nulls where no sample was active.
    """
    rows = filters.with_activity(df).withColumn("active", is_active("activity"))
    rows = running(rows, USER_DAY, ["ts", "event_id"], {"run": ("sum", 1 - F.col("active"))})
    minute = F.when(F.col("active") == 1, F.hour("ts") * 60 + F.minute("ts"))
    return rows.groupBy(*USER_DAY, "run").agg(
        F.min(minute).alias("first_minute"), F.max(minute).alias("last_minute"))


def standing_periods(df: DataFrame, minutes: int = 30) -> DataFrame:
    """Number of active runs of at least ``minutes`` in each user-day, 0 if none."""
    long = F.col("last_minute") - F.col("first_minute") >= minutes
    return active_runs(df).groupBy(*USER_DAY).agg(
        F.count_if(long).cast("int").alias("active_periods"))


def daily_distance(df: DataFrame) -> DataFrame:
    """Kilometres per user-day of the phone."""
    return filters.app_distance(df).groupBy(*USER_DAY).agg(
        (F.sum("distance") / 1000).alias("km"))


def tail_align(left: DataFrame, right: DataFrame, left_name: str = "app_km",
               right_name: str = "wearable_km") -> DataFrame:
    """The last days of two daily series side by side, as many as both have.

    Windows run over one row per user-day, after aggregation.
    """
    last = Window.partitionBy("user").orderBy(F.col("day").desc())
    def ranked(df: DataFrame, name: str) -> DataFrame:
        return df.select("user", F.col("km").alias(name), F.row_number().over(last).alias("back"))
    return ranked(left, left_name).join(ranked(right, right_name), on=["user", "back"])


def source_means(aligned: DataFrame) -> DataFrame:
    return aligned.groupBy("user").agg(
        F.avg("app_km").alias("app_mean"), F.avg("wearable_km").alias("wearable_mean"))


def perf_fit(runs: DataFrame) -> DataFrame:
    """Line through ln(seconds per day) against days, over all runs."""
    y = F.ln(F.col("seconds") / F.col("days"))
    x = F.col("days").cast("double")
    return runs.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def zscore(df: DataFrame, keys: list[str], value: str, ddof: int = 1) -> DataFrame:
    """(x - mean) / std within ``keys``, or over all rows if there are none."""
    mean, std = F.avg(value), F.stddev_samp(value) if ddof else F.stddev_pop(value)
    if not keys:
        of_all = df.agg(F.struct(mean.alias("mean"), std.alias("std"))).scalar()  # one pass for both
        z = F.when(of_all["std"] > 0, (F.col(value) - of_all["mean"]) / of_all["std"])
        return df.withColumn("z", z)
    stats = measured(df.groupBy(*keys).agg(mean.alias("__mean"), std.alias("__std")))
    z = F.when(F.col("__std") > 0, (F.col(value) - F.col("__mean")) / F.col("__std"))
    return df.join(stats, on=keys).withColumn("z", z).drop("__mean", "__std")


def vector_zscore(df: DataFrame, key: str, vector: str, ddof: int = 1) -> DataFrame:
    """Standardise every position of a vector column: (key, dim, z)."""
    rows = df.select(key, F.posexplode(vector).alias("dim", "x"))
    return zscore(rows.withColumn("x", F.col("x").cast("double")), ["dim"], "x", ddof).select(
        key, "dim", "z")
