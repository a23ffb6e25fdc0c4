"""Selection of datapoints by sensor type and user."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Schema names stored for each sensor type.
SCHEMA_NAMES = {
    "imu": ["acceleration_time_series", "gyroscope_time_series", "magnetic_time_series",
            "angular_velocity_time_series", "magnetic_field_time_series"],
    "geo": ["Location of Google", "geo_google"],
    "geowithplaces": ["geo_google"],
    "activity": ["physical_activity", "activity"],
    "google_activity": ["google_activity"],
    "callreg": ["call"],
    "audiofeatures": ["audiofeatures"],
    "bluetooth": ["bluetooth"],
    "wifis": ["wifi"],
    "steps": ["step_count"],
    "appusage": ["appsusage"],
    "actigraphy": ["actigraphy"],
    "light": ["light"],
}


def extract(df: DataFrame, data_type: str, users: DataFrame | Iterable[str] = (),
            schema_name: str = "schema_name", time_period: dict | None = None) -> DataFrame:
    """Rows of a sensor type, for the given users (all of them if blank).

    ``users`` may be a list or, for many users, a DataFrame with a ``user`` column.
    ``time_period`` is accepted and not applied, as callers expect.
    """
    rows = df.where(F.col(schema_name).isin(SCHEMA_NAMES[data_type]))
    if isinstance(users, DataFrame):
        return rows.join(users.select("user").distinct(), on="user", how="left_semi")
    users = [u for u in users if u]
    return rows.where(F.col("user").isin(users)) if users else rows


def write_extract(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
