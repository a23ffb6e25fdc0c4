"""Half-hour slots of a user-day: long tables, vectors, at-home."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.functions.geo import at_home
from dayprints.functions.sensors import source_label
from dayprints.functions.time import SLOTS, slot48

DAY = ["service", "user", "day"]


def with_slot(df: DataFrame) -> DataFrame:
    return df.withColumn("slot", slot48("ts"))


def slot_agg(df: DataFrame, value: Column, keys: Sequence[str]) -> DataFrame:
    """One row per key: an aggregate with map-side partials, one shuffle."""
    return df.groupBy(*keys).agg(value.alias("value"))


def distance_slots(df: DataFrame) -> DataFrame:
    rows = with_slot(df).withColumn("source", source_label("source"))
    return slot_agg(rows, F.sum("distance"), [*DAY, "source", "slot"])


def distance_var_slots(df: DataFrame) -> DataFrame:
    rows = with_slot(df).withColumn("source", source_label("source"))
    return slot_agg(rows, F.var_pop("distance"), [*DAY, "source", "slot"])


def speed_slots(df: DataFrame) -> DataFrame:
    return slot_agg(with_slot(df), F.avg("speed"), [*DAY, "slot"])


def speed_var_slots(df: DataFrame) -> DataFrame:
    return slot_agg(with_slot(df), F.var_pop("speed"), [*DAY, "slot"])


def at_home_slots(df: DataFrame) -> DataFrame:
    """Most frequent of at home / away in the slot; a tie counts as at home."""
    home = with_slot(df).withColumn("home", at_home("latitude", "longitude"))
    return slot_agg(home, F.when(F.avg("home") >= 0.5, 1).otherwise(0), [*DAY, "slot"])


def slot_base(df: DataFrame) -> DataFrame:
    """Every slot measure in one pass over the samples, per source.

    Speeds and at-home have no source in their key; ``slot_measures`` folds the
    moments of the (few) sources together without going back to the samples.
    """
    rows = (with_slot(df).withColumn("source", source_label("source"))
            .withColumn("home", at_home("latitude", "longitude")))
    return rows.groupBy(*DAY, "source", "slot").agg(
        F.sum("distance").alias("distance_sum"),
        F.var_pop("distance").alias("distance_var"),
        F.count("speed").alias("n"),
        F.avg("speed").alias("speed_avg"),
        F.var_pop("speed").alias("speed_var"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("home").alias("home_n"))


def fold_sources(base: DataFrame) -> DataFrame:
    """Speed mean, speed variance and at-home per slot out of ``slot_base``."""
    n, mean = F.sum("n"), F.sum(F.col("speed_avg") * F.col("n")) / F.sum("n")
    # pooled variance: within plus between the sources
    square = F.sum((F.col("speed_var") + F.col("speed_avg") * F.col("speed_avg")) * F.col("n"))
    return base.groupBy(*DAY, "slot").agg(
        mean.alias("speed_mean"),
        F.greatest(square / n - mean * mean, F.lit(0.0)).alias("speed_var"),
        F.when(F.sum("home_n") * 2 >= F.sum("rows"), 1).otherwise(0).alias("home"))


def _wide(df: DataFrame, keys: Sequence[str], kind: str, of_slot) -> DataFrame:
    """``slot1 .. slot48`` by one aggregate over ``keys``; ``of_slot`` gives a slot's value."""
    default = -1.0 if kind == "mean" else 0.0
    wide = df.groupBy(*keys).agg(*[of_slot(F.col("slot") == i).cast("double").alias(f"slot{i + 1}")
                                   for i in range(SLOTS)])
    names = [f"slot{i + 1}" for i in range(SLOTS)]
    value = (lambda c: F.when(F.col(c) > 0, F.col(c))) if kind == "mean" else F.col
    return wide.select(*keys, F.lit(kind).alias("type"),
                       *[F.coalesce(value(c), F.lit(default)).alias(c) for c in names])


def slot_vector(slots: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    """``slot1 .. slot48`` columns out of (keys, slot, value), one row for each slot.

    ``mean`` keeps positive values only and marks the rest -1; ``var`` and
    ``home`` fill with 0.
    """
    return _wide(slots, keys, kind, lambda here: F.max(F.when(here, F.col("value"))))


def distance_vector(df: DataFrame, digits: int = 6) -> DataFrame:
    """The vectors of ``distance_slots`` straight from the samples: one shuffle of partial sums."""
    rows = with_slot(df).withColumn("source", source_label("source"))
    return _wide(rows, [*DAY, "source"], "mean", lambda here: F.round(
        F.sum(F.when(here, F.col("distance"))), digits))
