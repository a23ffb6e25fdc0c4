"""Sources and sinks S1-S10: rows are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog.common import SQL, points, rnd, stage_json
from dayprints.catalog.filters import nested
from dayprints.functions.time import epoch_millis
from dayprints.operators import filters
from dayprints.session import scratch_path
from dayprints.sources import datapoints, events, extract, tables

FLAT = ["event_id", "service", "user", "creation_datetime", "type", "distance", "speed",
        "latitude", "longitude", "altitude", "accuracy", "source", "actigraphy", "activity",
        "places", "wifis", "date_time", "duration", "destination_number", "call_type", "apps"]


def scan_datapoints(spark, sf):
    path = stage_json(points(spark, sf).select(*FLAT), "datapoints")
    rows = datapoints.parsed(datapoints.read_datapoints(spark, path))
    return rows.select("event_id", "service", "user", "ts", "day", "distance", "latitude",
                       F.size("apps").alias("apps"), F.coalesce("call_type", F.lit("")).alias("call_type"))


def scan_nested(spark, sf):
    path = stage_json(nested(points(spark, sf)), "nested")
    rows = datapoints.read_nested(spark, path)
    return rows.select("header.user", "header.service", "header.creation_date_time",
                       "body.attributes.distance", "body.attributes.speed",
                       "body.coordinates.altitude", "body.coordinates.accuracy").select(
        "user", "service", "creation_date_time",
        *[F.col(c).try_cast("double").alias(c)
          for c in ("distance", "speed", "altitude", "accuracy")])


def _store(spark):
    return {"path": scratch_path(spark, "tables")}


def read_table(spark, sf):
    """A stored mark table read by name (as Parquet; JDBC needs a database)."""
    store = _store(spark)
    tables.write_table(events.marks(spark, sf), "last_modification", store, "overwrite")
    return tables.read_table(spark, "last_modification", store)


def write_table(spark, sf):
    """Child rows of the first days written anew, those of the later days appended."""
    store, rows = _store(spark), points(spark, sf).select("service", "user", "day", "distance")
    half = F.col("day") < "2024-01-16"
    tables.write_table(rows.where(half), "distance", store, "overwrite")
    tables.write_table(rows.where(~half), "distance", store)
    return tables.read_table(spark, "distance", store)


def sql_view(spark, sf):
    points(spark, sf).createOrReplaceTempView("data")
    return spark.sql("""
        select event_id, service, user, day, distance, speed from data
        where distance is not null and speed is not null and latitude is not null
          and longitude is not null and accuracy < 200""")


def extract_by_type(spark, sf):
    """Position datapoints of all users, written as JSON."""
    rows = points(spark, sf).select("event_id", "user", "schema_name", "longitude", "latitude")
    path = scratch_path(spark, "extract")
    extract.write_extract(extract.extract(rows, "geo", [""]), path)
    return spark.read.schema(
        "event_id bigint, user string, schema_name string, longitude double, latitude double"
    ).json(path)


def read_text_sort(spark, sf):
    path = scratch_path(spark, "text")
    events.table(spark, sf, "documents").select("text").write.text(path)
    return datapoints.read_text_sorted(spark, path)


def read_wearable(spark, sf):
    """Daily kilometres of each week, one export document per user and week."""
    days = points(spark, sf).where("event_type = 'view'").groupBy("user", "day").agg(
        (F.sum("distance") / 1000).alias("km"))
    week = F.date_trunc("week", "day")
    entry = F.struct(F.col("day").cast("string").alias("dateTime"),
                     rnd("km").cast("string").alias("value"))
    docs = days.groupBy("user", week.alias("week")).agg(
        F.collect_list(entry).alias("activities-distance"))
    path = stage_json(docs.select("activities-distance"), "wearable")
    return datapoints.read_wearable(spark, path, multi_line=False)


def points_filter(spark, sf):
    flat = points(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in (
        "longitude", "latitude", "accuracy", "speed")])
    return datapoints.read_points(spark, stage_json(flat, "points"), strict=True)


def _geo_documents(rows):
    return rows.select(
        F.struct(F.struct(F.col("schema_name").alias("name")).alias("schema_id"),
                 "user").alias("header"),
        F.struct(F.struct("longitude", "latitude", "altitude", "accuracy").alias("coordinates"),
                 F.struct("speed", "distance").alias("attributes"),
                 _time_frame()).alias("body"))


def _time_frame():
    at = F.struct(epoch_millis("ts").alias("$date"))
    return F.struct(at.alias("date_time")).alias("effective_time_frame")


def read_geo_wifi(spark, sf):
    """Filtered positions and wifi scans out of two document files."""
    rows = points(spark, sf)
    geo_path = stage_json(_geo_documents(rows), "geo")
    wifi_path = stage_json(rows.where("wifis is not null").select(
        F.struct("user").alias("header"), F.struct("wifis", _time_frame()).alias("body")), "wifi")
    geo, wifi = datapoints.read_geo_and_wifi(spark, geo_path, wifi_path)
    return geo.select("user", "ts", F.col("altitude").alias("value"), F.lit("geo").alias("kind")
                      ).unionByName(wifi.select(
                          "user", "ts", F.size("wifis").cast("double").alias("value"),
                          F.lit("wifi").alias("kind")))


def app_distance_documents(spark, sf):
    """Kilometres per user-day read from position documents."""
    path = stage_json(_geo_documents(points(spark, sf)), "geo")
    rows = filters.app_distance(datapoints.read_geo(spark, path))
    return rows.groupBy("user", "day").agg(rnd(F.sum("distance") / 1000).alias("km"))


QUERIES = {
    "scan_datapoints": scan_datapoints,
    "scan_nested": scan_nested,
    "read_jdbc": read_table,
    "write_table": write_table,
    "sql_view": sql_view,
    "extract_by_type": extract_by_type,
    "read_text_sort": read_text_sort,
    "read_wearable": read_wearable,
    "points_filter": points_filter,
    "read_geo_wifi": read_geo_wifi,
    "app_distance_documents": app_distance_documents,
}

ORACLES = {
    "scan_datapoints": SQL + """
        select event_id, service, "user", case when event_id % 2 = 0
            then date_trunc('millisecond', ts) else date_trunc('second', ts) end as ts,
          day, distance, latitude, 2::integer as apps, call_type from dp""",
    "scan_nested": SQL + """
        select "user", service, '{"$date": ' || (epoch_us(ts) // 1000) || '}' as creation_date_time,
          distance, speed, altitude, accuracy from dp""",
    "read_jdbc": SQL + "," + events.MARKS_SQL + ' select * from marks',
    "write_table": SQL + ' select service, "user", day, distance from dp',
    "sql_view": SQL + """ select event_id, service, "user", day, distance, speed from dp
        where accuracy < 200""",
    "extract_by_type": SQL + """ select event_id, "user", schema_name, longitude, latitude from dp
        where schema_name in ('Location of Google', 'geo_google')""",
    "read_text_sort": """select unnest(string_split(text, chr(10))) as value from documents""",
    "read_wearable": SQL + """ select day as date, round(sum(distance) / 1000, 6) as km from dp
        where event_type = 'view' group by "user", day""",
    "points_filter": SQL + """ select longitude, latitude from dp
        where longitude <> -1 and accuracy < 200 and speed < 0.5""",
    "read_geo_wifi": SQL + """
        select "user", date_trunc('millisecond', ts) as ts,
          case when altitude = 0 then 600 else altitude end as value, 'geo' as kind
        from dp where longitude <> -1 and latitude <> -1 and accuracy < 90 and speed < 0.5
        union all select "user", date_trunc('millisecond', ts), 6::double, 'wifi'
        from dp where wifi is not null""",
    "app_distance_documents": SQL + """
        select "user", day, round(sum(distance) / 1000, 6) as km from dp
        where speed < 3 and accuracy < 100 and distance > 0 group by "user", day""",
}
