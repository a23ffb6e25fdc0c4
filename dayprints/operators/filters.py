"""Row filters. Each is a plain predicate, so it reaches the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayprints.functions.time import day, from_millis, date_document_millis


def mobility(df: DataFrame) -> DataFrame:
    return df.where("distance is not null and speed is not null and latitude is not null "
                    "and longitude is not null and accuracy < 200")


def geo(df: DataFrame) -> DataFrame:
    return df.where("longitude > -180 and longitude < 180 and latitude > -90 and latitude < 90 "
                    "and accuracy < 200")


def stationary(df: DataFrame) -> DataFrame:
    return geo(df).where("speed < 0.5")


def calls(df: DataFrame) -> DataFrame:
    return df.where("type = 'callreg'")


def with_actigraphy(df: DataFrame) -> DataFrame:
    return df.where("actigraphy is not null")


def with_activity(df: DataFrame) -> DataFrame:
    return df.where("activity is not null")


def no_sentinel(df: DataFrame) -> DataFrame:
    """Drop positions the phone reports as -1."""
    return df.where("longitude <> -1 and latitude <> -1")


def app_distance(df: DataFrame) -> DataFrame:
    return df.where("speed < 3 and accuracy < 100 and distance > 0 and day <> date'1970-01-01'")


def positive(nested: DataFrame) -> DataFrame:
    """Nested text rows with a positive distance and speed, as typed columns."""
    a, c, h = "body.attributes.", "body.coordinates.", "header."
    return nested.where(F.col("body.attributes").isNotNull()).select(
        F.col(h + "service").alias("service"),
        F.col(h + "user").alias("user"),
        from_millis(date_document_millis(h + "creation_date_time")).alias("ts"),
        F.col(a + "distance").try_cast("double").alias("distance"),
        F.col(a + "speed").try_cast("double").alias("speed"),
        F.col(c + "altitude").try_cast("double").alias("altitude"),
        F.col(c + "accuracy").try_cast("double").alias("accuracy"),
    ).where("distance > 0 and speed > 0 and accuracy < 200").withColumn("day", day("ts"))


def settled(df: DataFrame, as_of: str, lag: int = 4) -> DataFrame:
    """Days that are closed ``lag`` days before ``as_of``."""
    return df.where(F.col("day") < F.date_sub(F.lit(as_of).cast("date"), lag))


def since(df: DataFrame, date: str) -> DataFrame:
    return df.where(F.col("day") > F.lit(date).cast("date"))


def launcher(apps: DataFrame, name: str = "app", seconds: str = "time") -> DataFrame:
    """Drop launchers and applications used for less than a second."""
    return apps.where(~F.col(name).contains("launcher") & (F.col(seconds) != 0))


def moving(df: DataFrame) -> DataFrame:
    return no_sentinel(df).where("accuracy < 100 and speed < 270")


def place(df: DataFrame) -> DataFrame:
    """Slow accurate positions; an altitude of 0 means unknown and becomes 600."""
    return no_sentinel(df).where("accuracy < 90 and speed < 0.5").withColumn(
        "altitude", F.when(F.col("altitude") == 0, F.lit(600.0)).otherwise(F.col("altitude")))


def service(df: DataFrame, name: str, data_type: str | None = None) -> DataFrame:
    out = df.where(F.col("service") == name)
    return out if data_type is None else out.where(F.col("data_type") == data_type)
