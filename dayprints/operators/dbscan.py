"""Exact density clustering (DBSCAN) per user without forming all pairs.

Points fall into cells so small that any two points of a cell are neighbours.

* A cell with at least ``min_pts`` points is dense: its points are all core and
  in one cluster, whatever their number. No pairs inside it are looked at.
* Points of other cells (fewer than ``min_pts`` per cell) are sparse. They meet
  other sparse points in an equi-join on cells as wide as the farthest neighbour.
  The members of a dense cell are counted through its boxes: a box within reach
  of the point counts as a whole, one beyond it not at all, and only boxes that
  straddle the point's circle are opened into the finer ones inside.
* Two dense cells are linked when a pair of their points is near. Bounding boxes
  decide most pairs; undecided ones are split into eighths until boxes decide or
  shrink to single positions, so only aggregated boxes are ever compared. Where
  scans count, members with equal scans meet in a join on the scan first; members
  with different ones are left to pairs so close that these can link, of cells
  that are not connected by then.

Clusters are the components of the graph of cells; a cluster is known by its
smallest core id, border points take the smallest cluster they touch, noise is -1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.functions.sensors import top_wifis
from dayprints.operators.components import components
from dayprints.operators.wifi import nearest_scan, scan_hashes
from dayprints.session import cut_lineage

SPLIT = 8
_SURE = 1e-9  # relative slack within which boxes leave the decision to finer boxes


def _gap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(a0 - b1, b0 - a1, F.lit(0.0))


def _span(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(a1 - b0, b1 - a0)


def _norm(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


@dataclass(frozen=True)
class Euclidean:
    """Plain distance of x and y."""

    eps: float

    @property
    def reach(self) -> float:
        """No neighbour is farther than this on an axis."""
        return self.eps

    def divisions(self) -> Column:
        """Cells per ``reach``: a half diagonal of eps keeps cell mates neighbours."""
        return F.lit(2)

    def band(self) -> Column:
        return F.lit(0)

    def factor(self, dz: Column, hamming: Column) -> Column:
        return F.lit(1.0)

    def unknown_hamming(self, vocab: Column) -> Column:
        return F.lit(0.0)

    def hamming(self, a: Column, b: Column, vocab: Column) -> Column:
        return F.lit(0.0)


# Fixed values of the place clustering.
PLACE_KM, ALTITUDE_M, WIFI_SHARE, WEIGHT = 0.3, 10.0, 0.001, 0.25
TOP_WIFIS = 5


@dataclass(frozen=True)
class Multimodal:
    """Distance scaled up by altitude difference and wifi hamming distance.

    geo * (1 + w/alt * (|dz| - alt) + w/share * (hamming - share)), with the
    hamming distance taken over the user's vocabulary. The factor is never below
    1 - 2w, so neighbours lie within eps / (1 - 2w); two scans differ in at most
    ten access points, which bounds it above for cell mates.
    """

    eps: float = PLACE_KM / 6371
    altitude: float = ALTITUDE_M
    share: float = WIFI_SHARE
    weight: float = WEIGHT

    @property
    def reach(self) -> float:
        return self.eps / (1 - 2 * self.weight)

    def _largest_factor(self) -> Column:
        return self.factor(F.lit(2 * self.altitude), self.unknown_hamming(F.col("vocab")))

    def divisions(self) -> Column:
        per_eps = F.lit(math.sqrt(2) * self.reach / self.eps * (1 + 1e-6)) * self._largest_factor()
        return F.ceil(per_eps)

    def band(self) -> Column:
        return F.floor(F.col("z") / (2 * self.altitude))

    def factor(self, dz: Column, hamming: Column) -> Column:
        return (1 + self.weight / self.altitude * (dz - self.altitude)
                + self.weight / self.share * (hamming - self.share))

    def unknown_hamming(self, vocab: Column) -> Column:
        return F.least(F.lit(1.0), F.lit(2.0 * TOP_WIFIS) / vocab)

    def hamming(self, a: Column, b: Column, vocab: Column) -> Column:
        both = F.size(F.array_intersect(a, b))
        return (F.size(a) + F.size(b) - both * 2) / vocab


def _near(metric, a: str, b: str) -> Column:
    """Whether point ``b`` is a neighbour of point ``a`` (struct columns)."""
    p, q = F.col(a), F.col(b)
    h = metric.hamming(p["sig"], q["sig"], p["vocab"])
    d = _norm(p["x"] - q["x"], p["y"] - q["y"])
    return d * metric.factor(F.abs(p["z"] - q["z"]), h) <= metric.eps


def _box_aggregates() -> list[Column]:
    out = [f(c).alias(f"{c}{i}") for c in ("x", "y", "z") for i, f in ((0, F.min), (1, F.max))]
    return [*out, F.min("sig").alias("sig0"), F.max("sig").alias("sig1"),
            F.first("vocab").alias("vocab")]


def _box(name: str) -> Column:
    return F.struct(*[f"{c}{i}" for c in ("x", "y", "z", "sig") for i in (0, 1)],
                    "vocab").alias(name)


def _box_bounds(metric, a: str, b: str) -> tuple[Column, Column]:
    """Smallest and largest possible distance between points of two boxes."""
    p, q = F.col(a), F.col(b)
    args = {c: (p[f"{c}0"], p[f"{c}1"], q[f"{c}0"], q[f"{c}1"]) for c in ("x", "y", "z")}
    known = (p["sig0"] == p["sig1"]) & (q["sig0"] == q["sig1"])
    h = metric.hamming(p["sig0"], q["sig0"], p["vocab"])
    low = _norm(_gap(*args["x"]), _gap(*args["y"])) * metric.factor(
        _gap(*args["z"]), F.when(known, h).otherwise(0.0))
    high = _norm(_span(*args["x"]), _span(*args["y"])) * metric.factor(
        _span(*args["z"]), F.when(known, h).otherwise(metric.unknown_hamming(p["vocab"])))
    single = known
    for c in ("x", "y", "z"):
        single = single & (p[f"{c}0"] == p[f"{c}1"]) & (q[f"{c}0"] == q[f"{c}1"])
    slack = F.when(single, 0.0).otherwise(_SURE)
    return low * (1 - slack), high * (1 + slack)


def _decided(metric, pairs: DataFrame, keep: list[str]) -> DataFrame:
    """Drop pairs of boxes that are too far apart; ``linked`` marks sure neighbours."""
    low, high = _box_bounds(metric, "a", "b")
    return (pairs.withColumns({"__low": low, "__high": high}).where(F.col("__low") <= metric.eps)
            .select(*keep, (F.col("__high") <= metric.eps).alias("linked")))


def _differing(metric, pairs: DataFrame) -> DataFrame:
    """Pairs of boxes that points with different scans may link: one access point at least."""
    p, q = F.col("a"), F.col("b")
    args = {c: (p[f"{c}0"], p[f"{c}1"], q[f"{c}0"], q[f"{c}1"]) for c in ("x", "y", "z")}
    same = ((p["sig0"] == p["sig1"]) & (q["sig0"] == q["sig1"]) & (p["sig0"] == q["sig0"]))
    low = _norm(_gap(*args["x"]), _gap(*args["y"])) * metric.factor(
        _gap(*args["z"]), F.lit(1.0) / p["vocab"])
    return pairs.where(~same & (low * (1 - _SURE) <= metric.eps))


def _unconnected(open_: DataFrame, links: DataFrame) -> DataFrame:
    """Open pairs of cells that the links do not connect, directly or through others."""
    found = components(links)
    for n in ("an", "bn"):
        open_ = open_.join(found.select(F.col("node").alias(n), F.col("component").alias(f"{n}_of")),
                           on=n, how="left")
    of = [F.coalesce(f"{n}_of", n) for n in ("an", "bn")]
    return open_.where(of[0] != of[1]).drop("an_of", "bn_of")


_RING = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
_AHEAD = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]  # one of each two that face each other


def _around(offsets: list[tuple[int, int]] = _RING) -> list[Column]:
    """The wide cells around a wide cell, as exploded columns."""
    near = F.array(*[F.struct((F.col("rx") + i).alias("rx"), (F.col("ry") + j).alias("ry"),
                              F.lit((i, j) != (0, 0)).alias("other_cell")) for i, j in offsets])
    return [F.inline(near)]


class _Grid:
    """Points with their cells, and the steps over them."""

    def __init__(self, df: DataFrame, metric, by: str, id_: str, min_pts: int):
        self.metric, self.min_pts = metric, min_pts
        m = metric.divisions()
        side = F.lit(metric.reach) / m
        pts = df.select(F.col(by).alias("by"), F.col(id_).alias("id"), "x", "y", "z",
                        F.array_sort("sig").alias("sig"), "vocab")  # as a set, in one order
        pts = pts.withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side),
                               "cz": metric.band(), "side": side, "m": m})
        pts = pts.withColumns({"rx": F.floor(F.col("cx") / F.col("m")),
                               "ry": F.floor(F.col("cy") / F.col("m"))}).drop("m")
        cell = ["by", "cx", "cy", "cz"]
        self.cells = cut_lineage(
            pts.groupBy(*cell, "rx", "ry").agg(
                F.count(F.lit(1)).alias("n"), F.min("id").alias("node"), *_box_aggregates())
            .withColumn("dense", F.col("n") >= min_pts))
        # points with the density of their cell, written once for all steps; AQE
        # splits the partitions of hot cells
        self.points = cut_lineage(pts.join(self.cells.select(*cell, "dense", "node"), on=cell))

    def _point(self, name: str) -> Column:
        return F.struct("id", "x", "y", "z", "sig", "vocab").alias(name)

    def sparse_neighbours(self) -> DataFrame:
        """(id, cell of the neighbours, other, n) for every sparse point.

        ``other`` is the neighbour's id in a sparse cell (a bounded number) and
        null for a dense cell, whose members are only counted. Points of two wide
        cells meet once and stand for both.
        """
        sparse = self.points.where(~F.col("dense"))
        left = sparse.select("by", "id", F.col("node").alias("own"), self._point("p"),
                             *_around(_AHEAD))
        right = sparse.select("by", "rx", "ry", "node", self._point("q"))
        pairs = left.join(right, on=["by", "rx", "ry"]).where(_near(self.metric, "p", "q"))

        def way(*columns: str) -> Column:
            names = ("id", "own", "node", "other")
            return F.struct(*[F.col(c).alias(n) for c, n in zip(columns, names)])

        there, back = way("id", "own", "node", "q.id"), way("q.id", "node", "own", "id")
        each = pairs.select(F.inline(F.when(F.col("other_cell"), F.array(there, back))
                                     .otherwise(F.array(there)))).withColumn("n", F.lit(1).cast("bigint"))
        return each.unionByName(self._dense_counts(sparse))

    def _dense_counts(self, sparse: DataFrame) -> DataFrame:
        """(id, own, node, other = null, n): members of dense cells near each sparse point."""
        p = F.col("p")
        spot = F.struct(*[p[c].alias(f"{c}{i}") for c in ("x", "y", "z", "sig") for i in (0, 1)],
                        p["vocab"].alias("vocab")).alias("a")
        keep = ["id", "own", "node", "n", "a"]
        # there are fewer dense cells than points, so these are dealt to the cells around them
        cells = self.cells.where("dense").select("by", "node", "n", _box("b"), *_around())
        points = sparse.select("by", "id", F.col("node").alias("own"), "rx", "ry", self._point("p"))
        pairs = points.select("by", "id", "own", "rx", "ry", spot).join(cells, ["by", "rx", "ry"])
        state = cut_lineage(_decided(self.metric, pairs, keep))
        counted = state.where("linked").select("id", "own", "node", "n")
        open_ = state.where(~F.col("linked")).withColumn("up", F.array().cast("array<bigint>"))
        level = 0
        while not open_.isEmpty():
            level += 1
            boxes = self._boxes(open_.select("node", "up").distinct(), level)
            pairs = open_.select("id", "own", "node", "up", "a").join(
                boxes.select("node", "up", "sub", "n", _box("b")), ["node", "up"])
            state = cut_lineage(_decided(self.metric, pairs, [*keep, "sub"]))
            counted = counted.unionByName(state.where("linked").select("id", "own", "node", "n"))
            open_ = state.where(~F.col("linked")).withColumnRenamed("sub", "up")
        return counted.groupBy("id", "own", "node", F.lit(None).cast("bigint").alias("other")).agg(
            F.sum("n").alias("n"))

    def dense_links(self) -> DataFrame:
        """Pairs of dense cells holding a pair of neighbours, as (a, b) nodes.

        Where scans count, pairs of cells that others connect may be left out.
        """
        scans = isinstance(self.metric, Multimodal)
        pairs = self._cell_pairs(self.cells.where("dense"))
        state = cut_lineage(_decided(self.metric, pairs, ["an", "bn", *(["a", "b"] if scans else [])]))
        links = state.where("linked").select("an", "bn")
        open_ = state.where(~F.col("linked"))
        up = F.array().cast("array<bigint>")
        if scans and not open_.isEmpty():
            links = cut_lineage(links.unionByName(self._same_scan_links(open_)).distinct())
            open_ = _differing(self.metric, open_)
        open_ = open_.select("an", "bn", up.alias("sa"), up.alias("sb"))
        level = 0
        while not open_.isEmpty():
            if scans:
                open_ = cut_lineage(_unconnected(open_, links))
            level += 1
            open_, found = self._split(open_, level, differing=scans)
            links = links.unionByName(found)
        return links

    def _cell_pairs(self, cells: DataFrame, *keys: str) -> DataFrame:
        """Pairs of cells, or of their parts of equal keys, that are not too far by their columns."""
        left = cells.select("by", *keys, F.col("node").alias("an"), _box("a"), *_around())
        right = cells.select("by", *keys, "rx", "ry", F.col("node").alias("bn"), _box("b"))
        return left.join(right, on=["by", "rx", "ry", *keys]).where("an < bn")

    def _same_scan_links(self, open_: DataFrame) -> DataFrame:
        """Pairs of the cells in ``open_`` that neighbours with equal scans link.

        Only what shares a scan is compared, so the work follows the number of points and not
        its square.
        """
        wanted = open_.select(F.col("an").alias("node")).unionByName(
            open_.select(F.col("bn").alias("node"))).distinct()
        parts = cut_lineage(self.points.where("dense").join(wanted, on="node", how="left_semi")
                            .groupBy("by", "rx", "ry", "node", "sig").agg(*_box_aggregates()))
        state = cut_lineage(_decided(self.metric, self._cell_pairs(parts, "sig"),
                                     ["an", "bn", "sig"]))
        links = state.where("linked").select("an", "bn").distinct()
        up = F.array(F.xxhash64("sig"))
        left = (state.where(~F.col("linked")).join(links, on=["an", "bn"], how="left_anti")
                .select("an", "bn", up.alias("sa"), up.alias("sb")))
        level = 0
        while not left.isEmpty():
            level += 1
            left, found = self._split(left, level, scan_from=0)
            links = links.unionByName(found)
        return links

    def _sub_cell(self, level: int, scan_from: int) -> Column:
        """Position inside the cell at a level: SPLIT divisions per level and axis.

        The scan is part of it from the level ``scan_from`` on.
        """
        if not level:
            return F.array(*[F.xxhash64("sig")] if not scan_from else []).cast("array<bigint>")
        parts = float(SPLIT ** level)
        inner = [F.floor((F.col("x") / F.col("side") - F.col("cx")) * parts),
                 F.floor((F.col("y") / F.col("side") - F.col("cy")) * parts)]
        if isinstance(self.metric, Multimodal):
            height = 2 * self.metric.altitude
            inner += [F.floor((F.col("z") / height - F.col("cz")) * parts),
                      F.xxhash64("sig") if level >= scan_from else F.lit(0).cast("bigint")]
        return F.array(*[c.cast("bigint") for c in inner])

    def _boxes(self, wanted: DataFrame, level: int, scan_from: int = 2) -> DataFrame:
        """The boxes of a level, with their numbers of points, inside the wanted (node, up)."""
        rows = self.points.where("dense").withColumns({
            "up": self._sub_cell(level - 1, scan_from), "sub": self._sub_cell(level, scan_from)})
        return cut_lineage(rows.join(wanted, on=["node", "up"], how="left_semi")
                           .groupBy("node", "up", "sub")
                           .agg(F.count(F.lit(1)).alias("n"), *_box_aggregates()))

    def _split(self, open_: DataFrame, level: int, scan_from: int = 2,
               differing: bool = False) -> tuple[DataFrame, DataFrame]:
        """Split the boxes of undecided pairs; returns (still undecided, new links)."""
        wanted = open_.select(F.col("an").alias("node"), F.col("sa").alias("up")).unionByName(
            open_.select(F.col("bn").alias("node"), F.col("sb").alias("up"))).distinct()
        boxes = self._boxes(wanted, level, scan_from)
        side = lambda n, s, name: boxes.select(
            F.col("node").alias(n), F.col("up").alias(s), F.col("sub").alias(f"{s}2"),
            _box(name))
        pairs = (open_.join(side("an", "sa", "a"), on=["an", "sa"])
                 .join(side("bn", "sb", "b"), on=["bn", "sb"]))
        if differing:
            pairs = _differing(self.metric, pairs)
        state = cut_lineage(_decided(self.metric, pairs, ["an", "bn", "sa2", "sb2"]))
        found = state.where("linked").select("an", "bn").distinct()
        left = (state.where(~F.col("linked")).join(found, on=["an", "bn"], how="left_anti")
                .select("an", "bn", F.col("sa2").alias("sa"), F.col("sb2").alias("sb")))
        return left, found


def core_points(df: DataFrame, metric, by: str = "user", id_: str = "event_id",
                min_pts: int = 6) -> DataFrame:
    """(by, id, core): whether a point has ``min_pts`` neighbours, itself included."""
    grid = _Grid(df, metric, by, id_, min_pts)
    count = grid.sparse_neighbours().groupBy("id").agg(F.sum("n").alias("n"))
    core = F.when(F.col("dense") | (F.col("n") >= min_pts), 1).otherwise(0)
    return grid.points.join(count, on="id", how="left").select(
        F.col("by").alias(by), F.col("id").alias(id_), core.alias("core"))


def dbscan(df: DataFrame, metric, by: str = "user", id_: str = "event_id",
           min_pts: int = 6) -> DataFrame:
    """(by, id, label) for points with columns x, y, z, sig and vocab."""
    grid = _Grid(df, metric, by, id_, min_pts)
    near = cut_lineage(grid.sparse_neighbours())
    core = cut_lineage(near.groupBy("id", "own").agg(F.sum("n").alias("n"))
                       .where(F.col("n") >= min_pts).select("id", "own"))

    # neighbours that are core: dense cells as a whole, sparse points by their id
    in_dense = near.where("other is null").select("id", "own", "node")
    in_sparse = near.where("other is not null").join(
        core.select(F.col("id").alias("other")), on="other", how="left_semi").select(
        "id", "own", "node")
    touching = cut_lineage(in_dense.unionByName(in_sparse).distinct())
    links = (touching.join(core.select("id"), on="id", how="left_semi")
             .select(F.col("own").alias("an"), F.col("node").alias("bn"))
             .unionByName(grid.dense_links()))
    found = components(links)

    # cell node -> smallest core id of its cluster
    first_core = core.groupBy(F.col("own").alias("node")).agg(F.min("id").alias("low"))
    core_cells = first_core.unionByName(
        grid.cells.where("dense").select("node", F.col("node").alias("low")))
    placed = core_cells.join(found, on="node", how="left").withColumn(
        "component", F.coalesce("component", "node"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("label"))
    labels = cut_lineage(placed.join(lowest, on="component").select("node", "label"))

    # a sparse point is near its own cell's core points, so one minimum serves
    # core and border points alike
    sparse = touching.join(labels, on="node").groupBy("id").agg(F.min("label").alias("sparse_label"))
    out = grid.points.join(labels.withColumnRenamed("label", "cell_label"), on="node", how="left")
    out = out.join(sparse, on="id", how="left")
    label = F.when(F.col("dense"), F.col("cell_label")).otherwise(F.col("sparse_label"))
    return out.select(F.col("by").alias(by), F.col("id").alias(id_),
                      F.coalesce(label, F.lit(-1)).alias("label"))


def plain_points(df: DataFrame, x: str = "longitude", y: str = "latitude") -> DataFrame:
    """Give points the columns that ``dbscan`` reads."""
    return df.withColumns({"x": F.col(x), "y": F.col(y), "z": F.lit(0.0),
                           "sig": F.array().cast("array<string>"), "vocab": F.lit(1)})


def place_points(positions: DataFrame, scans: DataFrame, by: str) -> DataFrame:
    """Positions with altitude and the nearest wifi scan, as ``Multimodal`` reads them.

    A position without a scan within a minute has an empty set; the hamming
    distance is over the number of distinct access points of the key's scans.
    """
    top = top_wifis("wifis", TOP_WIFIS)
    near = nearest_scan(positions, scans, [by], F.struct(F.array_sort(top).alias("hashes")))
    vocab = (scan_hashes(scans, [by], TOP_WIFIS).groupBy(by)
             .agg(F.count_distinct("hash").alias("vocab")))
    sig = F.coalesce("scan.payload.hashes", F.array().cast("array<string>"))
    return (near.withColumns({"x": F.col("longitude"), "y": F.col("latitude"),
                              "z": F.col("altitude"), "sig": sig})
            .join(vocab, on=by, how="left").fillna(1, ["vocab"]))
