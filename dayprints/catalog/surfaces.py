"""User functions, keyed aggregates, run metrics, silhouette: X1, X2, A19, A21."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog.common import NEW_SQL, SOURCE_SQL, SQL, points, rnd
from dayprints.catalog.slots import KEY, slot_vector
from dayprints.operators import closures, silhouette as sil
from dayprints.session import cut_lineage


def udf_surface(spark, sf):
    """A map, a filter and a flat map given as Python functions."""
    rows = points(spark, sf).select("event_id", "speed", "distance")
    kmh = closures.map_column(lambda speed: speed * 3.6, "double", "speed")
    kept = closures.filter_rows(rows.withColumn("kmh", kmh), lambda d: d > 1.0, "distance")
    long = closures.flat_map(
        kept, lambda pdf: pdf.melt("event_id", ["kmh", "distance"], "name", "value"),
        "event_id bigint, name string, value double")
    return long.withColumn("value", rnd("value"))


def reduce_by_key(spark, sf):
    rows = points(spark, sf).select("service", "day", "distance")
    return closures.reduce_by_key(rows, ["service", "day"], "distance", "max")


def keyed_agg_surface(spark, sf):
    """Sums, counts, means, variances and lists per key by built-in aggregates."""
    return points(spark, sf).groupBy("service", "user").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("distance")).alias("total"),
        rnd(F.avg("distance"), 8).alias("mean"), rnd(F.var_pop("distance")).alias("var"),
        F.max("day").alias("last_day"), F.count_distinct("day").alias("days"))


def run_metrics(spark, sf):
    """User-days, whatever their sources, and filled slots of the written vectors."""
    filled = sum((F.col(f"slot{i + 1}") > 0).cast("bigint") for i in range(48))
    vectors = cut_lineage(slot_vector(spark, sf))
    return vectors.agg(F.count_distinct(F.struct(*KEY)).alias("user_days"),
                       F.sum(filled).alias("filled_slots"))


def silhouette(spark, sf):
    """How well the five usual places of a user separate; far positions are noise."""
    rows = points(spark, sf).select("user", "event_id", "longitude", "latitude", F.expr(
        "case when event_id % 17 = 0 then -1 else event_id % 5 end").alias("label"))
    return sil.silhouette(rows, "user").withColumn("silhouette", rnd("silhouette", 8))


QUERIES = {
    "udf_surface": udf_surface,
    "reduce_by_key": reduce_by_key,
    "keyed_agg_surface": keyed_agg_surface,
    "run_metrics": run_metrics,
    "silhouette": silhouette,
}

ORACLES = {
    "udf_surface": SQL + """
        select event_id, 'kmh' as name, round(speed * 3.6::double, 6) as value from dp where distance > 1
        union all select event_id, 'distance', round(distance, 6) from dp where distance > 1""",
    "reduce_by_key": SQL + " select service, day, max(distance) as distance from dp group by all",
    "keyed_agg_surface": SQL + """
        select service, "user", count(*) as n, round(sum(distance), 6) as total,
          round(avg(distance), 8) as mean, round(var_pop(distance), 6) as var,
          max(day) as last_day, count(distinct day) as days from dp group by service, "user\"""",
    "run_metrics": NEW_SQL + f""", s as (
          select service, "user", day, {SOURCE_SQL} as source, slot0,
            round(sum(distance), 6) as value from new group by all)
        select count(distinct (service, "user", day)) as user_days,
          count(*) filter (where value > 0) as filled_slots from s""",
    "silhouette": SQL + """, p as (
          select "user", event_id, longitude as x, latitude as y,
            case when event_id % 17 = 0 then -1 else event_id % 5 end as l from dp),
        d as (
          select a."user", a.event_id, a.l as own, b.l,
            sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) as total,
            count(*) as n
          from p a join p b on a."user" = b."user" group by all),
        q as (
          select "user", event_id, max(n) filter (where l = own) as size,
            max(case when l = own and n > 1 then total / (n - 1) end) as a,
            min(total / n) filter (where l <> own) as b from d group by all)
        select "user", round(avg(case when size = 1 then 0
          else coalesce((b - a) / nullif(greatest(a, b), 0), 0) end), 8) as silhouette
        from q where b is not null group by "user\"""",
}
