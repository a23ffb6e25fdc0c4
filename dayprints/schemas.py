"""Declared input and output schemas (DDL text); nothing is inferred from data."""

from __future__ import annotations

# One wide row per sample of any sensor type; unused sensor columns are null.
DATAPOINTS = """
    event_id bigint, service string, user string, creation_datetime string, type string,
    distance double, speed double, latitude double, longitude double, altitude double,
    accuracy double, source string, actigraphy array<string>,
    activity array<struct<name:string,confidence:double>>,
    places array<struct<placetype:array<int>>>, wifis array<string>,
    date_time string, duration bigint, destination_number string, call_type string,
    apps array<struct<name:string,duration:bigint>>
"""

# Document-store rows: every leaf is text.
NESTED = """
    header struct<user:string, service:string, creation_date_time:string,
                  acquisition_provenance:string>,
    body struct<attributes:struct<distance:string, speed:string>,
                coordinates:struct<altitude:string, accuracy:string>>
"""

# Position documents; the sample time is an epoch in milliseconds.
GEO_DOCUMENT = """
    header struct<schema_id:struct<name:string>, user:string>,
    body struct<coordinates:struct<longitude:double, latitude:double, altitude:double,
                                   accuracy:double>,
                attributes:struct<speed:double, distance:double>,
                effective_time_frame:struct<date_time:struct<`$date`:bigint>>>
"""

WIFI_DOCUMENT = """
    header struct<user:string>,
    body struct<wifis:array<string>,
                effective_time_frame:struct<date_time:struct<`$date`:bigint>>>
"""

WEARABLE = "`activities-distance` array<struct<dateTime:string, value:string>>"

FLAT_POINT = "longitude string, latitude string, accuracy string, speed string"

MARKS = "service string, user string, date date, data_type string"

CLUSTERS = """
    user string, creationTimeStamp bigint, longitude double, latitude double, radius double,
    weight double, LS1 double, LS2 double, SS1 double, SS2 double, N bigint, dimensions int,
    altitude double, wifi string, bluetooth string, activities string, places string,
    type_cluster string
"""
