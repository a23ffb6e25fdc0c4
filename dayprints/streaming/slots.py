"""Half-hour distance sums as a stream; the watermark is the job's two-day lag."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dayprints.streaming import state

SLOT_MS = 30 * 60 * 1000
CLOSED, LATE = "closed", "late"
OUT_DDL = ("service string, user string, slot_start timestamp, value double, samples bigint, "
           "event_time timestamp")


class SlotProcessor(StatefulProcessor):
    """Open slots of a (service, user) as one state value; a timer at the first end closes them.

    A slot is open until the watermark reaches its end, so the value holds the slots of the lag.
    Rows of a slot that is closed already, and rows without a time, are emitted as late ones.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(
            "open", "starts array<bigint>, sums array<double>, counts array<bigint>")

    def _load(self) -> dict[int, tuple]:
        if not self.open.exists():
            return {}
        starts, sums, counts = self.open.get()
        return dict(zip(starts, zip(sums, counts, strict=True), strict=True))

    def _store(self, slots: dict[int, tuple]) -> None:
        if slots:
            sums, counts = zip(*slots.values(), strict=True)
            self.open.update((list(slots), list(sums), list(counts)))
        else:
            self.open.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        slots, watermark = self._load(), timerValues.getCurrentWatermarkInMs()
        first = min(slots, default=None)
        for batch in rows:
            start = batch["us"] // (1000 * SLOT_MS) * SLOT_MS
            late = batch["us"].isna() | (start + SLOT_MS <= watermark)
            if late.any():
                yield pd.DataFrame({
                    "kind": LATE, "service": key[0], "user": key[1],
                    "slot_start": pd.to_datetime(start[late], unit="ms"),
                    "value": batch["distance"][late].astype(float), "samples": 1,
                    "event_time": pd.to_datetime(batch["us"][late], unit="us")})
            kept = batch[~late].groupby(start[~late].astype("int64"))["distance"]
            for at, total, n in zip(kept.groups, kept.sum(min_count=1), kept.size(), strict=True):
                before, count = slots.get(at, (None, 0))
                total = None if pd.isna(total) else float(total)
                both = before if total is None else total + (before or 0.0)
                slots[at] = both, count + int(n)
        if slots and (first is None or min(slots) < first):
            self.handle.registerTimer(min(slots) + SLOT_MS)
        self._store(slots)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slots, watermark = self._load(), timerValues.getCurrentWatermarkInMs()
        due = sorted(start for start in slots if start + SLOT_MS <= watermark)
        done = [slots.pop(start) for start in due]
        if slots:
            self.handle.registerTimer(min(slots) + SLOT_MS)
        self._store(slots)
        yield pd.DataFrame({
            "kind": CLOSED, "service": key[0], "user": key[1],
            "slot_start": pd.to_datetime(due, unit="ms"), "value": [total for total, _ in done],
            "samples": [n for _, n in done], "event_time": pd.Series([pd.NaT] * len(due))})

    def close(self) -> None:
        pass


def slot_stream(points: DataFrame, lag: str = "2 days", time: str = "event_time") -> DataFrame:
    """Stream of (kind, service, user, slot_start, value, samples, event_time).

    ``closed`` rows are sums per (service, user, half hour), emitted once the watermark has
    passed. Rows later than the lag are not added to a closed slot, as the batch job never returns
    to a day before the mark, but none is lost: each is emitted as a ``late`` row with its own
    distance and time. Closed, late and still open rows add up to all rows, in any order of files.
    """
    # without the time column itself, or Spark would drop late rows before they are seen here
    rows = points.withWatermark(time, lag).select(
        "service", "user", "distance", F.unix_micros(time).alias("us"))
    return rows.groupBy("service", "user").transformWithStateInPandas(
        SlotProcessor(), outputStructType=f"kind string, {OUT_DDL}", outputMode="Update",
        timeMode="EventTime")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what has arrived into a Parquet folder, by batch and kind; then stop."""
    state.run_available(stream, path, checkpoint, "kind")


def emitted(spark, path: str, kind: str) -> DataFrame:
    """The closed slots, or the late rows, that a stream has written so far."""
    rows = spark.read.schema(f"{OUT_DDL}, batch bigint, kind string").parquet(path)
    rows = rows.where(F.col("kind") == kind).drop("batch", "kind")
    return rows.drop("event_time") if kind == CLOSED else rows.drop("samples")
