"""Readers for the datapoint formats. Every reader has a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayprints import schemas
from dayprints.functions.time import day, from_millis, parse_ts
from dayprints.operators import filters


def read_datapoints(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """Flat datapoints. ``fmt`` may also name a warehouse connector."""
    return spark.read.format(fmt).schema(schemas.DATAPOINTS).options(**options).load(path)


def with_time(points: DataFrame, text: str = "creation_datetime") -> DataFrame:
    """Add ``ts`` and ``day``; rows whose time does not parse get nulls."""
    return points.withColumn("ts", parse_ts(text)).withColumn("day", day("ts"))


def parsed(points: DataFrame, text: str = "creation_datetime") -> DataFrame:
    return with_time(points, text).where(F.col("ts").isNotNull())


def rejected(points: DataFrame, text: str = "creation_datetime") -> DataFrame:
    """How many rows have no usable time, per service."""
    return (with_time(points, text).where(F.col("ts").isNull())
            .groupBy("service").agg(F.count(F.lit(1)).alias("rejected")))


def read_nested(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """Document-store rows whose leaves are all text."""
    return spark.read.format(fmt).schema(schemas.NESTED).options(**options).load(path)


def read_text_sorted(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in order, by a distributed range sort.

    The second key lets copies of one line spread over several ranges.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.orderBy("value", F.monotonically_increasing_id())


def read_wearable(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Daily distances of a wearable export: (date, km)."""
    rows = spark.read.schema(schemas.WEARABLE).json(path, multiLine=multi_line)
    return wearable_days(rows)


def wearable_days(rows: DataFrame) -> DataFrame:
    return rows.select(F.inline("activities-distance")).select(
        F.col("dateTime").try_cast("date").alias("date"),
        F.col("value").try_cast("double").alias("km"))


def read_points(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Flat points as (longitude, latitude) without nulls and -1 markers."""
    rows = spark.read.schema(schemas.FLAT_POINT).json(path)
    typed = rows.select(*[F.col(c).try_cast("double").alias(c) for c in rows.columns])
    kept = typed.where("longitude is not null and longitude <> -1")
    if strict:
        kept = kept.where("accuracy < 200 and speed < 0.5")
    return kept.select("longitude", "latitude")


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    """Position documents as flat rows."""
    b = "body."
    docs = spark.read.schema(schemas.GEO_DOCUMENT).json(path)
    return docs.select(
        F.col("header.user").alias("user"),
        F.col("header.schema_id.name").alias("schema_name"),
        from_millis(F.col(b + "effective_time_frame.date_time.`$date`")).alias("ts"),
        *[F.col(f"{b}coordinates.{c}").alias(c)
          for c in ("longitude", "latitude", "altitude", "accuracy")],
        *[F.col(f"{b}attributes.{c}").alias(c) for c in ("speed", "distance")],
    ).withColumn("day", day("ts"))


def read_wifi(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.schema(schemas.WIFI_DOCUMENT).json(path)
    return docs.select(
        F.col("header.user").alias("user"),
        from_millis(F.col("body.effective_time_frame.date_time.`$date`")).alias("ts"),
        F.col("body.wifis").alias("wifis"))


def read_geo_and_wifi(spark: SparkSession, geo_path: str, wifi_path: str):
    """The two inputs of the place clustering, filtered and typed."""
    return filters.place(read_geo(spark, geo_path)), read_wifi(spark, wifi_path)
