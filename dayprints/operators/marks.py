"""High-water marks: which user-days are new, and how marks move on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayprints.session import broadcast_if_small

KEY = ["service", "user"]


def mark_lookup(df: DataFrame, marks: DataFrame, data_type: str) -> DataFrame:
    """Add ``mark``, the last processed day of the row's (service, user)."""
    mine = (marks.where(F.col("data_type") == data_type)
            .groupBy(*KEY).agg(F.max("date").alias("mark")))
    return df.join(broadcast_if_small(mine), on=KEY, how="left")


def incremental(df: DataFrame, marks: DataFrame, data_type: str, as_of: str,
                lag: int = 2) -> DataFrame:
    """Rows after the user's mark (if any) on days closed ``lag`` days ago."""
    closed = df.where(F.col("day") < F.date_sub(F.lit(as_of).cast("date"), lag))
    return (mark_lookup(closed, marks, data_type)
            .where(F.col("mark").isNull() | (F.col("day") > F.col("mark"))).drop("mark"))


def day_header(rows: DataFrame, data_type: str) -> DataFrame:
    return (rows.select(*KEY, F.col("day").alias("date")).distinct()
            .withColumn("data_type", F.lit(data_type)))


def latest_mark(header: DataFrame) -> DataFrame:
    return header.groupBy(*KEY, "data_type").agg(F.max("date").alias("date")).select(
        *KEY, "date", "data_type")


def marks_other(marks: DataFrame, current: DataFrame) -> DataFrame:
    """Marks that the current run does not handle."""
    return unstored(marks, current, [*KEY, "date", "data_type"]).select(
        *KEY, "date", "data_type")


def marks_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old marks of users without a new one, plus the new ones."""
    return unstored(old, new, KEY).unionByName(new)


def union_marks(updated: DataFrame, others: DataFrame) -> DataFrame:
    return updated.unionByName(others)


def new_headers(header: DataFrame, stored: DataFrame) -> DataFrame:
    """Headers not stored yet, so that a rerun appends nothing."""
    return unstored(header, stored, [*KEY, "date"])


def unstored(rows: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not among the stored ones; nulls equal each other."""
    side = stored.select(*[F.col(c).alias(f"__{c}") for c in key])
    return rows.join(side, on=[F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key],
                     how="left_anti")
