"""Online micro-clustering of positions per user.

The merge of a sample depends on the clusters left by all samples before it, so
a place is followed in time order. What bounds a task:

* A sample can only join a cluster closer than ``reach`` (an outlier that far
  would widen even the heaviest cluster beyond eps). Positions of a user that
  leave a wider gap are split into regions that evolve independently, each with
  the user's global sample numbers, so the split is exact.
* Rows stream through in Arrow batches in (user, region, time) order; a task
  holds one batch and the clusters of one region, never a user's samples.
* Sample numbers and pruning times come from two-level windows. Decay is applied
  by step difference, and final decay and pruning are column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayprints.functions.time import epoch_seconds
from dayprints.operators.keyed import join_same
from dayprints.operators.microclusters import (OUTLIER, POTENTIAL, Params, age_limit, as_table,
                                               centre, cluster_summary, faded, radius_of)
from dayprints.operators.ordered import previous, ranged, row_numbers, running
from dayprints.session import cut_lineage, measured

STATE = ("weight", "LS1", "LS2", "SS1", "SS2", "N", "creationTimeStamp", "last_step")
STATE_DDL = ("weight double, LS1 double, LS2 double, SS1 double, SS2 double, N bigint, "
             "creationTimeStamp bigint, last_step bigint, type_cluster string")


class Group:
    """Clusters of one kind in the order of their arrival, with a grid over their centres.

    A cluster is [*STATE, centre x, centre y, radius]. The nearest one, by distance to the centre
    less the radius, is sought ring by ring around a sample; the search ends where the largest
    radius so far cannot bring a centre beyond the ring nearer than the best one, or where no
    cluster beyond it could take the sample. The answer is that of a scan of all clusters.
    """

    def __init__(self, p: Params):
        self.p, self.side = p, 2 * p.eps
        self.members: dict[int, list] = {}
        self.cells: dict[tuple[int, int], dict[int, list]] = {}
        self.arrived, self.widest = 0, 0.0
        self.heaviest, self.lightest, self.since = 1.0, 1.0, 0

    def __len__(self) -> int:
        return len(self.members)

    def _cell(self, x: float, y: float) -> tuple[int, int]:
        return math.floor(x / self.side), math.floor(y / self.side)

    def add(self, c: list) -> int:
        number, self.arrived = self.arrived, self.arrived + 1
        if not number:
            self.since = c[7]
        self.put(number, c)
        return number

    def put(self, number: int, c: list) -> None:
        """A cluster at its place in the order, in the place of the one it grew from."""
        old = self.members.get(number)
        cell = self._cell(c[8], c[9])
        if old is not None and (before := self._cell(old[8], old[9])) != cell:
            self._leave(before, number)
        self.members[number] = c
        self.cells.setdefault(cell, {})[number] = c
        self.widest = max(self.widest, c[10])
        self.heaviest = max(self.heaviest, c[0])
        self.lightest = min(self.lightest, c[0])
        self.since = min(self.since, c[7])

    def _leave(self, cell: tuple[int, int], number: int) -> None:
        del self.cells[cell][number]
        if not self.cells[cell]:
            del self.cells[cell]

    def pop(self, number: int) -> list:
        c = self.members.pop(number)
        self._leave(self._cell(c[8], c[9]), number)
        return c

    def _ring(self, i: int, j: int, ring: int):
        if not ring:
            yield i, j
            return
        for k in range(-ring, ring + 1):
            yield i + k, j - ring
            yield i + k, j + ring
        for k in range(1 - ring, ring):
            yield i - ring, j + k
            yield i + ring, j + k

    def nearest(self, x: float, y: float, step: int) -> int | None:
        """The number of the nearest cluster; None if none could take the sample."""
        best, number, seen, ring = math.inf, None, 0, 0
        i, j = self._cell(x, y)
        bound = lambda w: (w + 1) / math.sqrt(w)  # noqa: E731  see farthest_merge
        faintest = self.lightest * 2.0 ** (-self.p.lam * (step - self.since))
        reach = self.p.eps * max(bound(self.heaviest), bound(faintest))
        while seen < len(self.members):
            if 8 * ring > len(self.members):  # fewer clusters than cells to look at
                groups = [self.members]
            else:
                cells = self.cells
                groups = [cells[at] for at in self._ring(i, j, ring) if at in cells]
            for group in groups:
                for k, c in group.items():
                    gap = math.hypot(x - c[8], y - c[9]) - c[10]
                    if gap < best or gap == best and k < number:
                        best, number = gap, k
                seen += len(group)
            beyond = ring * self.side  # clusters not seen are at least this far
            if best < beyond - self.widest or number is None and beyond > reach:
                break
            ring += 1
        return number

    def any_within(self, x: float, y: float) -> bool:
        """Is a centre nearer than two eps, the side of a cell?"""
        i, j = self._cell(x, y)
        return any(math.hypot(x - c[8], y - c[9]) < self.side
                   for a in (i - 1, i, i + 1) for b in (j - 1, j, j + 1)
                   for c in self.cells.get((a, b), {}).values())


class Clusters:
    """The potential and the outlier clusters of one region."""

    def __init__(self, p: Params):
        self.p, self.potential, self.outliers, self.pruned = p, Group(p), Group(p), 0

    def _shape(self, c: list) -> list:
        w = c[0]
        x, y = c[1] / w, c[2] / w
        r = math.sqrt(max(abs(c[3] / w - x * x), abs(c[4] / w - y * y)))
        c[8:] = [x, y, r]
        return c

    def load(self, state: Iterable, kind: str) -> None:
        (self.potential if kind == POTENTIAL else self.outliers).add(self._shape(list(state)))

    def dump(self) -> Iterator[list]:
        for kind, group in ((POTENTIAL, self.potential), (OUTLIER, self.outliers)):
            for number in sorted(group.members):
                yield [*group.members[number][:8], kind]

    def _with(self, c: list, x: float, y: float, step: int) -> list:
        f = 2.0 ** (-self.p.lam * (step - c[7]))
        return self._shape([c[0] * f + 1, c[1] * f + x, c[2] * f + y, c[3] * f + x * x,
                            c[4] * f + y * y, c[5] + 1, c[6], step])

    def _join(self, group: Group, x: float, y: float, step: int) -> int:
        """Add the sample to the nearest cluster if it stays small; its number or -1."""
        number = group.nearest(x, y, step)
        if number is None:
            return -1
        grown = self._with(group.members[number], x, y, step)
        if grown[10] > self.p.eps:
            return -1
        group.put(number, grown)
        return number

    def prune(self, step: int, t: int) -> None:
        """Drop light clusters as of a step; earlier checks are implied by the last."""
        if step <= self.pruned:
            return
        self.pruned = step
        p = self.p
        weight = lambda c: c[0] * 2.0 ** (-p.lam * (step - c[7]))
        fresh = 2.0 ** (-p.lam * p.tp) - 1
        limit = lambda c: (2.0 ** (-p.lam * (t - c[6] + p.tp)) - 1) / fresh
        for group, least in ((self.potential, lambda c: p.core_weight), (self.outliers, limit)):
            for number in [k for k, c in group.members.items() if not weight(c) >= least(c)]:
                group.pop(number)

    def add(self, x: float, y: float, step: int, t: int) -> str:
        """Merge one sample; returns the kind of cluster it went to."""
        if self._join(self.potential, x, y, step) >= 0:
            return POTENTIAL
        number = self._join(self.outliers, x, y, step)
        if number >= 0:
            if self.outliers.members[number][0] > self.p.core_weight:
                self.potential.add(self.outliers.pop(number))
            return OUTLIER
        near = self.potential.any_within(x, y)
        new = self._shape([1.0, x, y, x * x, y * y, 1, t, step])
        (self.potential if near else self.outliers).add(new)
        return POTENTIAL if near else OUTLIER


def farthest_merge(p: Params, samples_between_checks: Column, heaviest: Column) -> Column:
    """Distance beyond which no cluster can take a sample, on any axis.

    A cluster of weight w taking a sample at distance d gets a deviation of at
    least d * sqrt(w) / (w + 1), which must stay within eps. Weights lie between
    what a single sample fades to before the next check and ``heaviest``.
    """
    bound = lambda w: (w + 1) / F.sqrt(w)
    lightest = faded(F.lit(1.0), p.lam, samples_between_checks)
    return F.lit(p.eps) * F.greatest(bound(heaviest), bound(lightest))


def _clocked(samples: DataFrame, saved: DataFrame | None, p: Params, by: str) -> DataFrame:
    """Add step, clock time, and the step and time of the last check before the sample.

    A check happens between two samples when the clock enters a new period.
    """
    order = ["ts", "event_id"]
    rows = row_numbers(ranged(samples, [by], order), [by], order, "step")
    if saved is None:
        rows = rows.withColumn("updated", F.lit(None).cast("bigint"))
    else:
        rows = join_same(rows, saved.groupBy(by).agg(F.max("updated").alias("updated")), [by],
                         "left")
    if p.clock == "steps":
        # checks follow from the step number alone
        base = F.coalesce("updated", F.lit(0))
        rows = rows.withColumn("t", base + F.col("step"))
        entered = F.floor((F.col("t") - 1) / p.tp)
        check = F.when(entered > F.floor((base - F.when(F.col("updated").isNull(), 0).otherwise(1))
                                         / p.tp), entered * p.tp)
        rows = rows.withColumn("check_t", check).withColumn("check_step", F.col("check_t") - base)
    else:
        rows = rows.withColumn("t", epoch_seconds("ts"))
        rows = previous(rows, [by], order, {"before": F.col("t")})
        entered = F.floor(F.col("t") / p.tp)
        check = entered > F.floor(F.coalesce("before", "updated") / p.tp)
        rows = running(rows, [by], order, {
            "check_step": ("max", F.when(check, F.col("step") - 1).cast("bigint")),
            "check_t": ("max", F.when(check, entered * p.tp).cast("bigint"))}).drop("before")
    return rows.drop("updated").fillna(-1, ["check_step", "check_t"])


def _with_side(rows: DataFrame, saved: DataFrame | None, p: Params, by: str) -> DataFrame:
    """Add the width of the empty gap that separates regions of the key.

    A sample adds 1 to a weight at most, so the key's saved weight and its samples
    bound every weight; this is far below the limit for all but the longest keys.
    """
    widest, saved_weight = F.lit(p.eps), F.lit(0.0)
    # in both clocks one row of ``rows`` is a sample or a saved cluster
    if p.clock == "steps":
        n = rows.groupBy(by).agg(F.count(F.lit(1)).alias("samples"))
        busiest = F.lit(p.tp)
    else:
        period = F.floor(F.col("t") / p.tp)
        n = (rows.groupBy(by, period.alias("period")).agg(F.count(F.lit(1)).alias("n"))
             .groupBy(by).agg(F.sum("n").alias("samples"), F.max("n").alias("busiest")))
        busiest = F.col("busiest")
    if saved is not None:
        shape = saved.groupBy(by).agg(F.max(radius_of()).alias("widest"),
                                      F.max("weight").alias("saved_weight"))
        n = join_same(n, shape, [by], "left")
        widest = F.greatest(F.coalesce("widest", widest), widest)
        saved_weight = F.coalesce("saved_weight", saved_weight)
    rows = join_same(rows, measured(n), [by])
    # one sample more than there are, so that the bound is not met exactly
    heaviest = F.least(F.lit(p.heaviest), saved_weight + F.col("samples") + 1)
    side = rows.withColumn("side", farthest_merge(p, busiest, heaviest) + widest)
    return side.drop("busiest", "widest", "samples", "saved_weight")


def _regions(rows: DataFrame, by: str) -> DataFrame:
    """Add strip and region numbers: parts of a key that an empty cell line separates.

    Cuts run between occupied columns of cells, then between the rows of each
    column strip. The windows see occupied cells, not samples.
    """
    rows = rows.withColumns({"cx": F.floor(F.col("x") / F.col("side")),
                             "cy": F.floor(F.col("y") / F.col("side"))})

    def cut(cells: DataFrame, keys: list[str], line: str, name: str) -> DataFrame:
        along = Window.partitionBy(*keys).orderBy(line)
        gap = F.when(F.col(line) - F.lag(line).over(along) > 1, 1).otherwise(0)
        cells = cells.withColumn("__gap", gap)
        # the default frame gives cells of one line the same sum
        return cells.withColumn(name, F.sum("__gap").over(along)).drop("__gap")

    cells = rows.select(by, "cx", "cy").distinct()
    cells = cut(cut(cells, [by], "cx", "strip"), [by, "strip"], "cy", "region")
    return join_same(rows, measured(cells), [by, "cx", "cy"]).drop("cx", "cy", "side")


def load_user_clusters(samples: DataFrame, saved: DataFrame, by: str) -> DataFrame:
    """Samples and saved clusters of the same users in one relation.

    ``seq`` puts a user's clusters (0) before the samples (their step).
    """
    users = samples.select(by).distinct()
    mine = join_same(saved, users, [by]).select(
        by, F.lit(0).cast("bigint").alias("seq"), "creationTimeStamp",
        centre("LS1").alias("x"), centre("LS2").alias("y"),
        "weight", "LS1", "LS2", "SS1", "SS2", "N", "type_cluster")
    return samples.unionByName(mine, allowMissingColumns=True)


def untouched(saved: DataFrame, samples: DataFrame, by: str = "user") -> DataFrame:
    """Saved clusters of users without samples in this run; they stay as they are."""
    return join_same(saved, samples.select(by).distinct(), [by], "left_anti")


_SAVED = ["weight", "LS1", "LS2", "SS1", "SS2", "N", "creationTimeStamp", "type_cluster"]


def _follow(batches: Iterator[pd.DataFrame], by: str, p: Params, out_rows: int = 5000
            ) -> Iterator[pd.DataFrame]:
    """Run every region of a sorted partition through ``Clusters``."""
    columns = [by, *STATE, "type_cluster"]
    key, state, done = None, None, []
    for batch in batches:
        with_saved = "weight" in batch
        if with_saved:
            batch = batch.fillna({"N": 0, "creationTimeStamp": 0, "t": 0, "check_step": -1,
                                  "check_t": 0, "type_cluster": ""})
        wanted = [by, "strip", "region", "seq", "x", "y", "t", "check_step", "check_t"]
        batch[by] = batch[by].astype(object).where(batch[by].notna(), None)  # equal to itself
        lists = [batch[c].tolist() for c in wanted + (_SAVED if with_saved else [])]
        for user, strip, region, seq, x, y, t, check_step, check_t, *loaded in zip(*lists):
            if key != (user, strip, region):
                if key is not None:
                    done.extend([key[0], *c] for c in state.dump())
                key, state = (user, strip, region), Clusters(p)
                if len(done) >= out_rows:
                    yield pd.DataFrame(done, columns=columns)
                    done = []
            if seq == 0:
                w, ls1, ls2, ss1, ss2, n, created, kind = loaded
                state.load((w, ls1, ls2, ss1, ss2, int(n), int(created), 0), kind)
                continue
            if check_step >= 0:
                state.prune(int(check_step), int(check_t))
            state.add(x, y, seq, int(t))
    if key is not None:
        done.extend([key[0], *c] for c in state.dump())
        yield pd.DataFrame(done, columns=columns)


def denstream(samples: DataFrame, saved: DataFrame | None = None, p: Params = Params(),
              by: str = "user") -> DataFrame:
    """Clusters after merging ``samples`` into ``saved``, for the users with samples.

    ``samples`` has by, event_id, ts, longitude, latitude; ``saved`` and the
    result have by, the state columns, type_cluster and ``updated`` (the clock at
    the user's last sample). Samples without a user are those of one user like any other.
    """
    narrow = samples.select(by, "event_id", "ts", "longitude", "latitude")
    rows = cut_lineage(_clocked(narrow, saved, p, by).select(
        by, F.col("step").alias("seq"), "t", F.col("longitude").alias("x"),
        F.col("latitude").alias("y"), "check_step", "check_t"))
    relation = rows if saved is None else load_user_clusters(rows, saved, by)
    relation = _regions(_with_side(relation, saved, p, by), by)
    # a fixed number of partitions: merging is Python work, so small input is spread too
    n = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [by, "strip", "region", "seq"] + ([] if saved is None else ["creationTimeStamp", "LS1"])
    followed = (relation.repartition(n, by, "strip", "region").sortWithinPartitions(*order)
                .mapInPandas(lambda it: _follow(it, by, p), schema=_schema(samples, by)))
    ends = rows.groupBy(by).agg(F.max("seq").alias("steps"), F.max("t").alias("updated"),
                                F.max("check_step").alias("check_step"),
                                F.max("check_t").alias("check_t"))
    return _settled(join_same(followed, ends, [by]), p).select(*followed.columns, "updated")


def _schema(samples: DataFrame, by: str) -> str:
    return f"`{by}` {samples.schema[by].dataType.simpleString()}, {STATE_DDL}"


def _settled(df: DataFrame, p: Params) -> DataFrame:
    """Apply the last checks to untouched clusters, then fade all to the last step."""
    checks = [(F.col("check_step"), F.col("check_t"))]
    if p.clock == "steps":  # the clock may stand exactly on a check
        on_check = F.col("updated") % p.tp == 0
        checks.append((F.when(on_check, F.col("steps")).otherwise(-1), F.col("updated")))
    potential = F.col("type_cluster") == POTENTIAL
    keep = F.lit(True)
    for step, t in checks:
        untouched = step >= F.col("last_step")
        weight = faded(F.col("weight"), p.lam, step - F.col("last_step"))
        limit = F.when(potential, p.core_weight).otherwise(
            age_limit(t, F.col("creationTimeStamp"), p))
        keep = keep & (~untouched | (weight >= limit))
    fade = F.col("steps") - F.col("last_step")
    sums = {c: faded(F.col(c), p.lam, fade) for c in ("weight", "LS1", "LS2", "SS1", "SS2")}
    return df.where(keep).withColumns(sums).withColumn("last_step", F.lit(0).cast("bigint"))


def clusters_out(state: DataFrame, by: str = "user") -> DataFrame:
    """The 18-column table of both kinds of clusters."""
    return as_table(state, by)


def initial_clusters(labelled: DataFrame, by: str = "user", p: Params = Params()) -> DataFrame:
    """First clusters of users without a mark: one potential cluster per label.

    ``labelled`` holds the samples of those users with their density labels; only
    users with at least ``sample_skip`` samples get clusters.
    """
    counts = labelled.groupBy(by).agg(F.count(F.lit(1)).alias("samples")).where(
        F.col("samples") >= p.sample_skip)
    rows = join_same(labelled, measured(counts), [by])
    if p.clock == "steps":
        rows = row_numbers(rows, [by], ["ts", "event_id"], "t")
    else:
        rows = rows.withColumn("t", epoch_seconds("ts"))
    sums = cluster_summary(rows, by, p.lam)
    ends = rows.groupBy(by).agg(F.max("t").alias("updated"))
    return join_same(sums, ends, [by]).select(
        by, *STATE[:-1], F.lit(0).cast("bigint").alias("last_step"),
        F.lit(POTENTIAL).alias("type_cluster"), "updated")
