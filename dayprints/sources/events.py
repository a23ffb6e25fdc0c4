"""Datapoints out of the ``events`` table, in Spark and as the equal SQL.

``events`` is the only given table with a user and a time. Columns that a query does
not use are pruned, so the scan reads only what it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31"
MARK_DATE = "2024-01-10"
SINCE = "2024-01-08"

# column -> expression, the same in both dialects but for the name of the text type
_SCALARS = {
    "event_id": "event_id",
    "user_id": "user_id",
    "event_type": "event_type",
    "service": "concat('svc', cast(user_id % 3 as string))",
    "user": "cast(user_id as string)",
    "ts": "ts",
    "day": "cast(ts as date)",
    "distance": "value",
    "speed": "cast((event_id * 13) % 40 as double) / cast(10 as double)",
    "accuracy": "cast((event_id * 37) % 300 as double)",
    "latitude": "case when event_id % 17 = 0 "
                "then cast(1 as double) + cast(event_id % 1009 as double) / cast(100 as double) "
                "else cast(event_id % 5 as double) / cast(100 as double) + "
                "cast((event_id * 7919) % 201 - 100 as double) / cast(1000000 as double) end",
    "longitude": "case when event_id % 17 = 0 "
                 "then cast(2 as double) + cast(event_id % 997 as double) / cast(100 as double) "
                 "else cast(event_id % 5 as double) / cast(100 as double) + "
                 "cast((event_id * 104729) % 201 - 100 as double) / cast(1000000 as double) end",
    "altitude": "case when event_id % 7 = 0 then cast(0 as double) "
                "else cast(600 + (event_id * 11) % 50 as double) end",
    "source": "case event_id % 4 when 0 then 'garmin' when 1 then 'fitbit' "
              "when 2 then 'phone' else 'googlefit' end",
    "type": "case when event_type in ('click', 'purchase') then 'callreg' "
            "when event_type = 'view' then 'geo' when event_type = 'signup' then 'activity' "
            "else 'wifi' end",
    "schema_name": "case event_type when 'click' then 'call' when 'purchase' then 'geo_google' "
                   "when 'view' then 'Location of Google' when 'signup' then 'activity' "
                   "else 'wifi' end",
    "k": "cast(regexp_extract(props, '[0-9]+', 0) as bigint)",
    "duration": "cast(floor(value * 10) as bigint)",
    "destination_number": "case when event_id % 29 = 0 then null "
                          "else cast((event_id * 31) % 7 as string) end",
    "call_type": "case when event_type = 'purchase' then 'OUTGOING' else 'INCOMING' end",
    "app": "case when event_type = 'error' then 'launcher.home' else event_type end",
    "app_ms": "cast(floor(value * 100) as bigint)",
    "node": "concat(case user_id % 3 when 0 then 'leaf' when 1 then 'spine' else 'dr' end, "
            "cast(user_id % 6 as string))",
    "result": "event_type in ('error', 'purchase')",
}

_SPARK_ONLY = {
    "creation_datetime": "concat(date_format(ts, if(event_id % 2 = 0, "
                         "'yyyy-MM-dd HH:mm:ss.SSS', 'yyyy-MM-dd HH:mm:ss')), ' UTC')",
    "date_time": "concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' UTC')",
    "actigraphy": "case when event_type = 'signup' then null "
                  "when event_id % 23 = 0 then cast(array() as array<string>) "
                  "else array(cast(k as string), cast((k * 3) % 50 as string), "
                  "cast((k * 7) % 50 as string)) end",
    "activity": "case when event_type <> 'error' then array("
                "named_struct('name', 'still', 'confidence', cast((event_id * 11) % 100 as double)),"
                "named_struct('name', 'walking', 'confidence', cast((event_id * 7) % 100 as double)),"
                "named_struct('name', 'tilting', 'confidence', cast(k as double))) end",
    "places": "case when event_type <> 'view' then array(named_struct('placetype', array("
              "cast(event_id % 50 as int), cast(event_id % 16 as int), "
              "cast((event_id * 3) % 30 as int)))) end",
    "wifis": "case when event_type in ('error', 'signup') then array("
             "concat('h', event_id % 11, ' -', 40 + event_id % 50), "
             "concat('h', 11 + event_id % 7, ' -', 35 + (event_id * 3) % 60), "
             "concat('h', 18 + event_id % 5, ' -', 9 + (event_id * 7) % 90), "
             "concat('h', 23 + event_id % 13, ' -', 20 + (event_id * 5) % 70), "
             "concat('h', 36 + event_id % 3, ' -', 30 + (event_id * 17) % 65), "
             "concat('h', 39 + event_id % 17, ' -', 9 + (event_id * 29) % 80)) end",
    "apps": "array(named_struct('name', app, 'duration', app_ms), "
            "named_struct('name', 'maps', 'duration', (event_id * 97) % 3000))",
}

_SQL_ONLY = {
    "creation_datetime": "strftime(ts, '%Y-%m-%d %H:%M:%S') || case when event_id % 2 = 0 then "
                         "'.' || lpad(cast(extract('millisecond' from ts) % 1000 as varchar), 3, "
                         "'0') else '' end || ' UTC'",
    "actigraphy": "case when event_type = 'signup' then null "
                  "when event_id % 23 = 0 then [] else [k, (k * 3) % 50, (k * 7) % 50] end",
    "top_activity": "case when event_type <> 'error' then list_max(["
                    "{'c': cast((event_id * 11) % 100 as double), 'n': 'still'}, "
                    "{'c': cast((event_id * 7) % 100 as double), 'n': 'walking'}, "
                    "{'c': cast(k as double), 'n': 'tilting'}]).n end",
    "placetype": "case when event_type <> 'view' then "
                 "[event_id % 50, event_id % 16, (event_id * 3) % 30] end",
    "wifi": "case when event_type in ('error', 'signup') then ["
            "{'h': 'h' || event_id % 11, 'p': 40 + event_id % 50}, "
            "{'h': 'h' || (11 + event_id % 7), 'p': 35 + (event_id * 3) % 60}, "
            "{'h': 'h' || (18 + event_id % 5), 'p': 9 + (event_id * 7) % 90}, "
            "{'h': 'h' || (23 + event_id % 13), 'p': 20 + (event_id * 5) % 70}, "
            "{'h': 'h' || (36 + event_id % 3), 'p': 30 + (event_id * 17) % 65}, "
            "{'h': 'h' || (39 + event_id % 17), 'p': 9 + (event_id * 29) % 80}] end",
    "sod": "hour(ts) * 3600 + minute(ts) * 60 + cast(floor(extract('second' from ts)) as bigint)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_datapoint_columns(table(spark, sf_dir, "events"))


def with_datapoint_columns(rows: DataFrame) -> DataFrame:
    scalars = rows.selectExpr("*", *[f"{e} as {c}" for c, e in _SCALARS.items()
                                     if c not in rows.columns])
    return scalars.selectExpr("*", *[f"{e} as {c}" for c, e in _SPARK_ONLY.items()])


def _duck(expr: str) -> str:
    return expr.replace(" as string)", " as varchar)")


# The same rows for the SQL check; start a query with it.
SQL = (
    "with dp0 as (select "
    + ", ".join(f'{_duck(e)} as "{c}"' for c, e in _SCALARS.items())
    + " from events), dp as (select *, "
    + ", ".join(f'{e} as "{c}"' for c, e in _SQL_ONLY.items())
    + " from dp0)"
)


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored mark table: some users have a mobility mark, some a clustering one."""
    users = datapoints(spark, sf_dir).select("service", "user", "user_id").distinct()
    date = F.lit(MARK_DATE).cast("date")
    mobility = users.where("user_id % 3 = 0").select(
        "service", "user", date.alias("date"), F.lit("mobility").alias("data_type"))
    clustering = users.where("user_id % 2 = 0").select(
        "service", "user", F.date_add(date, 2).alias("date"),
        F.lit("clustering").alias("data_type"))
    return mobility.unionByName(clustering)


MARKS_SQL = f"""
    marks as (
      select distinct service, "user", date '{MARK_DATE}' as date, 'mobility' as data_type
      from dp where user_id % 3 = 0
      union all
      select distinct service, "user", date '{MARK_DATE}' + 2 as date, 'clustering' as data_type
      from dp where user_id % 2 = 0)"""
