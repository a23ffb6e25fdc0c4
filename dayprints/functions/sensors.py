"""Columns over sensor fields: sources, wifi, activity, actigraphy, places, nodes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayprints.functions.time import _col

# Fixed values of the indicators.
WEARABLE_SOURCES = ["garmin", "fitbit", "googlefit"]
ACTIVE_NAMES = ["tilting", "walking", "running"]
SOCIAL_PLACE_TYPES = [3, 4, 9, 13, 15, 23, 27, 45, 48]
ACTIGRAPHY_SCALE = 16 * 10 * 9.81


def source_label(source: Column | str) -> Column:
    """A known wearable keeps its name, anything else is the phone app."""
    source = F.lower(F.trim(_col(source)))
    return F.when(source.isin(WEARABLE_SOURCES), source).otherwise(F.lit("app"))


def actigraphy_level(samples: Column | str) -> Column:
    """Mean of the numeric texts in units of g; null for an empty array."""
    samples = _col(samples)
    total = F.aggregate(samples, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))
    return F.when(F.size(samples) > 0, total / F.size(samples) / F.lit(ACTIGRAPHY_SCALE))


def top_activity(activity: Column | str) -> Column:
    """Name of the activity with the highest confidence, ties by name."""
    ranked = F.transform(_col(activity),
                         lambda a: F.struct(a["confidence"].alias("c"), a["name"].alias("n")))
    return F.array_max(ranked)["n"]


def is_active(activity: Column | str) -> Column:
    return F.when(top_activity(activity).isin(ACTIVE_NAMES), 1).otherwise(0)


def wifi_scan(wifis: Column | str) -> Column:
    """``"<hash> -<dBm>"`` texts as array<struct<hash, power_text, power>>."""
    def parse(w: Column) -> Column:
        power = F.element_at(F.split(w, " "), 2)
        return F.struct(F.substring_index(w, " ", 1).alias("hash"), power.alias("power_text"),
                        power.try_cast("int").alias("power"))
    return F.transform(_col(wifis), parse)


def top_wifis(wifis: Column | str, n: int = 5, order: str = "strongest") -> Column:
    """Hashes of the first ``n`` access points of a scan.

    ``strongest`` orders by power, then hash. ``text`` orders (power text, hash)
    as text, as the published vectors do, where -9 sorts after -45.
    """
    if order == "text":
        keyed = F.transform(wifi_scan(wifis), lambda w: F.struct(
            w["power_text"].alias("k"), w["hash"].alias("h")))
    else:
        keyed = F.transform(wifi_scan(wifis), lambda w: F.struct(
            (-w["power"]).alias("k"), w["hash"].alias("h")))
    return F.transform(F.slice(F.array_sort(keyed), 1, n), lambda w: w["h"])


def allowed_places(places: Column | str) -> Column:
    """Social place types of the sample's first place, in their order."""
    types = F.get(_col(places), F.lit(0))["placetype"]
    return F.filter(types, lambda t: t.isin(SOCIAL_PLACE_TYPES))


def first_allowed_place(places: Column | str) -> Column:
    return F.get(allowed_places(places), F.lit(0))


def hop_distance(node: Column | str, other: Column | str) -> Column:
    """0 for the node itself, 1 for a direct neighbour tier, else 2.

    Leaf nodes connect to spine and border ("dr") nodes, border nodes to each other.
    """
    node, other = _col(node), _col(other)
    def between(a: str, b: str) -> Column:
        return ((node.contains(a) & other.contains(b)) | (node.contains(b) & other.contains(a)))
    return (F.when(node == other, 0)
            .when(between("leaf", "spine") | between("leaf", "dr") | between("dr", "dr"), 1)
            .otherwise(2))
