"""Slot aggregates and vectors: A1-A6."""

from __future__ import annotations

from dayprints.catalog.common import (AS_OF, HAVERSINE_SQL, HOME_KM_SQL, MOBILITY_SQL, NEW_SQL,
                                      SOURCE_SQL, SQL, new_rows, points, rnd)
from dayprints.operators import filters, slots

KEY = ["service", "user", "day"]


def _slots(fn, digits=6):
    def run(spark, sf):
        return fn(new_rows(spark, sf)).withColumn("value", rnd("value", digits))
    return run


def at_home_slots(spark, sf):
    return slots.at_home_slots(filters.settled(filters.mobility(points(spark, sf)), AS_OF))


def slot_vector(spark, sf):
    """48 half-hour distances of each user-day and source."""
    return slots.distance_vector(new_rows(spark, sf))


def slot_vector_var(spark, sf):
    long = slots.distance_var_slots(new_rows(spark, sf)).withColumn("value", rnd("value"))
    return slots.slot_vector(long, [*KEY, "source"], "var")


def slot_vector_home(spark, sf):
    return slots.slot_vector(at_home_slots(spark, sf), KEY, "home")


def slot_measures(spark, sf):
    """All slot measures from one pass over the samples."""
    base = slots.slot_base(new_rows(spark, sf))
    return slots.fold_sources(base).select(
        *KEY, "slot", rnd("speed_mean").alias("speed_mean"), rnd("speed_var").alias("speed_var"),
        "home")


QUERIES = {
    "distance_slots": _slots(slots.distance_slots),
    "speed_slots": _slots(slots.speed_slots),
    "distance_var_slots": _slots(slots.distance_var_slots),
    "speed_var_slots": _slots(slots.speed_var_slots),
    "at_home_slots": at_home_slots,
    "slot_vector": slot_vector,
    "slot_vector_var": slot_vector_var,
    "slot_vector_home": slot_vector_home,
    "slot_measures": slot_measures,
}

_SOURCE_SLOT = (NEW_SQL + f""" select service, "user", day, {SOURCE_SQL} as source,
    cast(slot0 as integer) as slot, """)
_SLOT = NEW_SQL + ' select service, "user", day, cast(slot0 as integer) as slot, '

HOME_SQL = SQL + f""", h as (
      select service, "user", day, cast(hour(ts) * 2 + minute(ts) // 30 as integer) as slot,
        {HAVERSINE_SQL} as hv
      from dp where {MOBILITY_SQL} and day < date '{AS_OF}' - 4),
    s as (
      select service, "user", day, slot,
        cast(case when avg(case when {HOME_KM_SQL} <= 0.5 then 1 else 0 end) >= 0.5
          then 1 else 0 end as integer) as value
      from h group by all)"""


def _wide(value: str, default: str) -> str:
    return ", ".join(f"coalesce(max({value}) filter (where slot = {i}), {default}::double) "
                     f"as slot{i + 1}" for i in range(48))


def _long_cte(agg: str) -> str:
    return (NEW_SQL + f""", s as (
        select service, "user", day, {SOURCE_SQL} as source, slot0 as slot,
          round({agg}, 6) as value from new group by all)""")


ORACLES = {
    "distance_slots": _SOURCE_SLOT + "round(sum(distance), 6) as value from new group by all",
    "speed_slots": _SLOT + "round(avg(speed), 6) as value from new group by all",
    "distance_var_slots": _SOURCE_SLOT + "round(var_pop(distance), 6) as value from new group by all",
    "speed_var_slots": _SLOT + "round(var_pop(speed), 6) as value from new group by all",
    "at_home_slots": HOME_SQL + " select * from s",
    "slot_vector": _long_cte("sum(distance)") + f"""
        select service, "user", day, source, 'mean' as type,
          {_wide("case when value > 0 then value end", "-1")} from s
        group by service, "user", day, source""",
    "slot_vector_var": _long_cte("var_pop(distance)") + f"""
        select service, "user", day, source, 'var' as type, {_wide("value", "0")} from s
        group by service, "user", day, source""",
    "slot_vector_home": HOME_SQL + f"""
        select service, "user", day, 'home' as type, {_wide("cast(value as double)", "0")} from s
        group by service, "user", day""",
    "slot_measures": NEW_SQL + f""", h as (select *, {HAVERSINE_SQL} as hv from new)
        select service, "user", day, cast(slot0 as integer) as slot,
          round(avg(speed), 6) as speed_mean, round(var_pop(speed), 6) as speed_var,
          cast(case when avg(case when {HOME_KM_SQL} <= 0.5 then 1 else 0 end) >= 0.5
            then 1 else 0 end as integer) as home from h group by all""",
}
