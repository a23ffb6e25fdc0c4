"""Online clustering as a stream: one state per user, updated sample by sample."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dayprints.functions.time import epoch_seconds
from dayprints.operators.denstream import STATE, STATE_DDL, Clusters
from dayprints.operators.microclusters import Params
from dayprints.streaming import state

OUT_DDL = f"user string, {STATE_DDL}, updated bigint, version bigint"


class PlaceProcessor(StatefulProcessor):
    """Keeps a user's clusters; emits all of them after each micro-batch.

    Samples are merged in (ts, event_id) order within a micro-batch.
    """

    def __init__(self, p: Params):
        self.p = p

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clusters = handle.getListState("clusters", STATE_DDL)
        self.progress = handle.getValueState(
            "progress", "step bigint, t bigint, check_step bigint, version bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        p, places = self.p, Clusters(self.p)
        step, last_t, check_step, version = 0, None, -1, 0
        if self.progress.exists():
            step, last_t, check_step, version = self.progress.get()
            for row in self.clusters.get():
                places.load(row[:8], row[8])
        batch = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        offset = 1 if p.clock == "steps" else 0
        for x, y, seconds in zip(batch["longitude"], batch["latitude"], batch["seconds"]):
            step += 1
            t = step if p.clock == "steps" else int(seconds)
            period = (t - offset) // p.tp
            if last_t is not None and period > (last_t - offset) // p.tp:
                places.prune(step - 1, period * p.tp)
            places.add(float(x), float(y), step, t)
            last_t = t
        if p.clock == "steps" and last_t % p.tp == 0:
            places.prune(step, last_t)
        faded = [self._fade(c, step) for c in places.dump()]
        self.clusters.put([tuple(c) for c in faded])
        self.progress.update((step, last_t, check_step, version + 1))
        # a user without clusters still gets a row, or an older version would count
        none = [[0.0] * 5 + [0, 0, step, ""]]
        out = pd.DataFrame(faded or none, columns=[*STATE, "type_cluster"])
        yield out.assign(user=key[0], updated=last_t, version=version + 1)[
            ["user", *STATE, "type_cluster", "updated", "version"]]

    def _fade(self, c: list, step: int) -> list:
        f = 2.0 ** (-self.p.lam * (step - c[7]))
        return [v * f for v in c[:5]] + [int(c[5]), int(c[6]), step, c[8]]

    def close(self) -> None:
        pass


def denstream_stream(points: DataFrame, p: Params = Params()) -> DataFrame:
    """Stream of cluster states: every micro-batch emits the users it touched.

    The newest ``version`` of a user is the current state. Needs the RocksDB state
    store: spark.sql.streaming.stateStore.providerClass.
    """
    rows = points.select("user", "event_id", "ts", epoch_seconds("ts").alias("seconds"),
                         "longitude", "latitude")
    return rows.groupBy("user").transformWithStateInPandas(
        PlaceProcessor(p), outputStructType=OUT_DDL, outputMode="Update", timeMode="None")


def current_clusters(emitted: DataFrame) -> DataFrame:
    """The newest state of every user out of the emitted rows."""
    newest = emitted.groupBy("user").agg(F.max("version").alias("version"))
    return emitted.join(newest, on=["user", "version"], how="left_semi").where(
        "N > 0").drop("version")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what has arrived, appending every emitted state to a Parquet folder."""
    state.run_available(stream, path, checkpoint)
