"""Micro-clusters: decayed sums of a group of positions, and their upkeep as tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.operators.ordered import row_numbers
from dayprints.session import cut_lineage

POTENTIAL, OUTLIER = "pMicroCluster", "oMicroCluster"


@dataclass(frozen=True)
class Params:
    """Fixed values of the place clustering; ``clock`` is what ``tp`` counts."""

    lam: float = 0.00001
    eps: float = 0.00047
    beta: float = 0.2
    mu: float = 30.0
    tp: int = 280 * 5
    min_pts: int = 6
    sample_skip: int = 3 * 300
    clock: str = "steps"  # or "seconds"

    @property
    def core_weight(self) -> float:
        return self.beta * self.mu

    @property
    def heaviest(self) -> float:
        """Limit of a weight that gains 1 per sample and decays once per sample."""
        return 1 / (1 - 2 ** -self.lam)


def faded(value: Column, lam: float, steps: Column) -> Column:
    return value * F.pow(F.lit(2.0), steps * -lam)


def centre(ls: str, weight: str = "weight") -> Column:
    return F.col(ls) / F.col(weight)


def radius_of(ls1: str = "LS1", ls2: str = "LS2", ss1: str = "SS1", ss2: str = "SS2",
              weight: str = "weight") -> Column:
    """Largest per-axis deviation of the group."""
    axes = [F.sqrt(F.abs(F.col(ss) / F.col(weight) - F.pow(F.col(ls) / F.col(weight), 2)))
            for ls, ss in ((ls1, ss1), (ls2, ss2))]
    return F.greatest(*axes)


def as_table(df: DataFrame, by: str = "user") -> DataFrame:
    """The stored 18-column form of clusters with sums."""
    text = F.lit("")
    return df.select(
        F.col(by).alias("user"), "creationTimeStamp",
        centre("LS1").alias("longitude"), centre("LS2").alias("latitude"),
        radius_of().alias("radius"), "weight", "LS1", "LS2", "SS1", "SS2", "N",
        F.lit(2).alias("dimensions"), F.lit(0.0).alias("altitude"), text.alias("wifi"),
        text.alias("bluetooth"), text.alias("activities"), text.alias("places"), "type_cluster")


def cluster_summary(df: DataFrame, by: str = "user", lam: float = Params.lam) -> DataFrame:
    """Sums of each (by, label) group; noise (-1) has none.

    ``df`` has by, event_id, ts, t (clock), label, longitude, latitude. The
    newest member counts fully and each earlier one fades by one more step.
    """
    # written once: the numbers need several passes, and ``df`` is often a clustering
    rows = cut_lineage(df.where("label <> -1").select(
        by, "label", "ts", "event_id", "t", "longitude", "latitude"))
    rows = row_numbers(rows, [by, "label"], ["ts", "event_id"], "back", descending=True)
    w = faded(F.lit(1.0), lam, F.col("back") - 1)
    x, y = F.col("longitude"), F.col("latitude")
    return rows.groupBy(by, "label").agg(
        F.count(F.lit(1)).alias("N"), F.sum(w).alias("weight"),
        F.sum(x * w).alias("LS1"), F.sum(y * w).alias("LS2"),
        F.sum(x * x * w).alias("SS1"), F.sum(y * y * w).alias("SS2"),
        F.max("t").alias("creationTimeStamp")).withColumns({
            "longitude": centre("LS1"), "latitude": centre("LS2"), "radius": radius_of()})


def age_limit(t: Column, created: Column, p: Params) -> Column:
    """Weight below which an outlier cluster of this age is dropped."""
    fresh = 2 ** (-p.lam * p.tp) - 1
    return (F.pow(F.lit(2.0), (t - created + p.tp) * -p.lam) - 1) / fresh


def prune(clusters: DataFrame, t: Column, p: Params = Params()) -> DataFrame:
    """Clusters that a check at clock time ``t`` keeps."""
    potential = F.col("type_cluster") == POTENTIAL
    limit = F.when(potential, p.core_weight).otherwise(
        age_limit(t, F.col("creationTimeStamp"), p))
    return clusters.where(F.col("weight") >= limit)


def auto_params(clusters: DataFrame, by: str = "user", lam: float = Params.lam,
                factor: float = 1.2) -> DataFrame:
    """Parameters derived per key: mu from the decay, eps from its first cluster."""
    mu = 1 / (1 - 2 ** -lam)
    return clusters.groupBy(by).agg(
        (F.min_by("radius", "label") * factor).alias("epsilon")).withColumn("mu", F.lit(mu))


def cluster_upsert(stored: DataFrame, updated: DataFrame) -> DataFrame:
    """Stored clusters of (user, type) pairs without an update, plus the updated ones."""
    key = ["user", "type_cluster"]
    kept = stored.join(updated.select(*key).distinct(), on=key, how="left_anti")
    return kept.select(*stored.columns).unionByName(updated.select(*stored.columns))
