"""The clustering job: new positions into each user's saved clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayprints import schemas
from dayprints.operators import dbscan as db
from dayprints.operators import denstream as den
from dayprints.operators import filters, marks
from dayprints.operators import microclusters as mc
from dayprints.session import broadcast_if_small, cut_lineage
from dayprints.sources.tables import read_table, read_table_or_empty, replace_table

DATA_TYPE = "clustering"
KEY = ["service", "user"]
OWNER = "owner"
STATE = f"service string, user string, {den.STATE_DDL}, updated bigint, merged_to date"


def _owned(df: DataFrame) -> DataFrame:
    """Add (service, user) as one value, as the clustering operators take one key."""
    return df.withColumn(OWNER, F.to_json(F.struct(*KEY), {"ignoreNullFields": "false"}))


def updated_clusters(points: DataFrame, stored_marks: DataFrame, saved: DataFrame, as_of: str,
                     p: mc.Params = mc.Params()) -> tuple[DataFrame, DataFrame]:
    """(whole cluster state after the run, last day handled of each (service, user)).

    A (service, user) without a mark starts from density clusters once it has enough
    samples; one with a mark merges its new samples. Samples up to ``merged_to`` are in the
    saved clusters already, also where a run died before it moved the mark.
    """
    rows = filters.no_sentinel(filters.stationary(points)).select(
        *KEY, "event_id", "ts", "day", "longitude", "latitude")
    rows = _owned(marks.incremental(rows, stored_marks, DATA_TYPE, as_of))
    saved = _owned(saved)
    merged_to = saved.groupBy(OWNER).agg(F.max("merged_to").alias("merged_to"))
    rows = rows.join(broadcast_if_small(merged_to), on=OWNER, how="left").where(
        "merged_to is null or day > merged_to").drop("merged_to")
    rows = cut_lineage(rows)
    marked = _owned(stored_marks.where(F.col("data_type") == DATA_TYPE)).select(OWNER)
    known = marked.unionByName(saved.select(OWNER)).distinct()
    new = rows.join(known, on=OWNER, how="left_anti")
    enough = new.groupBy(OWNER).agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= p.sample_skip).select(OWNER)
    starting = cut_lineage(new.join(enough, on=OWNER, how="left_semi"))
    labels = db.dbscan(db.plain_points(starting), db.Euclidean(p.eps), by=OWNER,
                       min_pts=p.min_pts)
    first = den.initial_clusters(
        starting.join(labels.select("event_id", "label"), on="event_id"), OWNER, p)
    merging = rows.join(known, on=OWNER, how="left_semi")
    merged = den.denstream(merging, saved, p, by=OWNER).select(*first.columns)
    # without a mark, samples are kept back until there are enough
    handled = merging.unionByName(starting)
    days = cut_lineage(handled.groupBy(OWNER, *KEY).agg(F.max("day").alias("merged_to")))
    state = (first.unionByName(merged).join(days, on=OWNER)
             .unionByName(den.untouched(saved, days, OWNER)))
    return state.drop(OWNER), days.drop(OWNER)


def run(spark, points: DataFrame, store: dict, as_of: str, p: mc.Params = mc.Params()) -> None:
    """Run the job against stored tables; a run that died anywhere is simply repeated.

    The state tells up to which day it holds samples, so nothing is merged twice, and marks
    follow from it.
    """
    stored_marks = read_table_or_empty(spark, "last_modification", store, schemas.MARKS)
    saved = read_table_or_empty(spark, "cluster_state", store, STATE)
    state, days = updated_clusters(points, stored_marks, saved, as_of, p)
    replace_table(state, "cluster_state", store)
    state = read_table(spark, "cluster_state", store)
    replace_table(den.clusters_out(state), "clusters", store)
    # a user whose clusters were all dropped is in ``days`` only
    handled = state.select(*KEY, "merged_to").unionByName(days).withColumnRenamed(
        "merged_to", "day")
    latest = marks.latest_mark(marks.day_header(handled, DATA_TYPE))
    current = stored_marks.where(F.col("data_type") == DATA_TYPE)
    others = stored_marks.where(F.col("data_type") != DATA_TYPE)
    replace_table(marks.union_marks(marks.marks_merge(current, latest), others),
                  "last_modification", store)
