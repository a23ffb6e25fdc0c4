"""Density clustering against brute force over all pairs."""

import numpy as np
import pytest

from dayprints.operators import dbscan as db
from dayprints.operators import silhouette
from dayprints.operators.components import components


def brute_labels(near, ids, min_pts):
    """Labels from a boolean neighbour matrix: smallest core id, -1 for noise."""
    core = near.sum(axis=1) >= min_pts
    label = np.where(core, ids, np.iinfo("int64").max)
    while True:
        spread = np.where(near & core[None, :], label[None, :], np.iinfo("int64").max).min(axis=1)
        following = np.where(core, np.minimum(label, spread), label)
        if (following == label).all():
            break
        label = following
    border = np.where(near & core[None, :], label[None, :], np.iinfo("int64").max).min(axis=1)
    out = np.where(core, label, border)
    return np.where(out == np.iinfo("int64").max, -1, out)


def euclid(xy, eps):
    d = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(axis=2))
    return d <= eps


def run(spark, users, eps=1.0, min_pts=6, parts=3):
    rows, truth = [], {}
    for u, xy in users.items():
        ids = np.arange(len(xy)) + 100_000 * (1 + list(users).index(u))
        rows += [(u, int(i), float(x), float(y)) for i, (x, y) in zip(ids, xy)]
        truth.update(zip(ids.tolist(), brute_labels(euclid(xy, eps), ids, min_pts).tolist()))
    df = spark.createDataFrame(rows, "user string, event_id bigint, longitude double, latitude double")
    points = db.plain_points(df.repartition(parts))
    got = db.dbscan(points, db.Euclidean(eps), min_pts=min_pts).collect()
    return {r["event_id"]: r["label"] for r in got}, truth, points


def test_random_densities_and_partitions(spark):
    rng = np.random.default_rng(1)
    users = {
        "spread": rng.uniform(0, 25, (400, 2)),
        "hot": rng.normal(0, 0.4, (600, 2)),
        "mixed": np.vstack([rng.normal(0, .3, (150, 2)), rng.normal(3, .5, (150, 2)),
                            rng.uniform(-5, 8, (100, 2))]),
        "noise": rng.uniform(0, 200, (50, 2)),
        "chain": np.column_stack([np.arange(0, 120, 0.3), np.zeros(400)]),
        "one": np.zeros((1, 2)),
        "same": np.full((40, 2), 7.25),
    }
    first, truth, points = run(spark, users)
    assert first == truth
    second, _, _ = run(spark, users, parts=8)
    assert second == truth
    core = {r["event_id"]: r["core"] for r in db.core_points(points, db.Euclidean(1.0)).collect()}
    for i, u in enumerate(users):
        want = euclid(users[u], 1.0).sum(axis=1) >= 6
        assert [core[100_000 * (1 + i) + j] for j in range(len(want))] == want.astype(int).tolist()


def test_dense_cells_close_to_eps(spark):
    """Dense neighbouring cells whose boxes do not decide: refined down to points."""
    rng = np.random.default_rng(2)
    def arcs(gap):
        # two groups on arcs that bulge towards each other: many pairs just around eps
        y = np.append(rng.uniform(0.01, 0.49, 60), 0.25)
        bulge = 1e-3 * (y - 0.25) ** 2
        return np.vstack([np.column_stack([0.45 - bulge, y]),
                          np.column_stack([0.45 + gap + bulge, y])])
    users = {"apart": arcs(1.0000001), "touch": arcs(1.0), "near": arcs(0.9999999)}
    got, truth, _ = run(spark, users)
    assert got == truth
    labels = {u: {truth[k] for k in truth if k // 100_000 == 1 + i}
              for i, u in enumerate(users)}
    assert (len(labels["apart"]), len(labels["near"])) == (2, 1)


def test_border_point_takes_the_smallest_cluster(spark):
    left = [(-0.9 + dx, 0) for dx in np.linspace(-0.5, 0, 6)]
    right = [(0.9 + dx, 0) for dx in np.linspace(0, 0.5, 6)]
    got, truth, _ = run(spark, {"u": np.array(right + left + [(0.0, 0.0)])})
    assert got == truth
    assert got[100_012] == 100_000


def test_empty(spark):
    none = spark.createDataFrame([], "user string, event_id bigint, longitude double, latitude double")
    assert db.dbscan(db.plain_points(none), db.Euclidean(1.0)).count() == 0


def test_multimodal_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    metric = db.Multimodal(eps=1.0)
    rows, truth = [], {}
    for u, (n, vocab, scale) in {"few": (250, 30, 0.4), "many": (300, 5000, 1.5),
                                 "hot": (300, 5000, 0.02)}.items():
        ids = np.arange(n) + 10_000 * (1 + len(truth))
        xy = rng.normal(0, scale, (n, 2)) * rng.choice([0.05, 1.0], (n, 1))
        xy += rng.choice([0, 20, 40], (n, 1))
        z = rng.choice([600.0, 604.0, 640.0], n)
        kinds = [[], ["a", "b"], ["a", "b", "c"], ["d", "e", "f", "g", "h"]]
        sig = [kinds[k] for k in rng.integers(0, 4, n)]
        ham = np.array([[len(set(a) ^ set(b)) / vocab for b in sig] for a in sig])
        geo = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(axis=2))
        dist = geo * (1 + .025 * (np.abs(z[:, None] - z[None, :]) - 10) + 250 * (ham - .001))
        truth.update(zip(ids.tolist(), brute_labels(dist <= 1.0, ids, 6).tolist()))
        rows += [(u, int(i), float(x), float(y), float(h), s, vocab)
                 for i, (x, y), h, s in zip(ids, xy, z, sig)]
    df = spark.createDataFrame(rows, "user string, event_id bigint, x double, y double, z double, "
                                     "sig array<string>, vocab bigint")
    got = {r["event_id"]: r["label"] for r in db.dbscan(df, metric).collect()}
    assert got == truth
    assert len(set(truth.values())) > 5


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(200)]                      # chain
    edges += [(1000, i) for i in range(1001, 1300)]               # star
    edges += [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]  # cycle
    edges += [(3001, 3000), (3000, 3001), (3000, 3000)]
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)},
                   **{i: 2000 for i in range(2000, 2050)}, 3000: 3000, 3001: 3000}


@pytest.mark.parametrize("block", [16, 1024])
def test_silhouette_blocks(spark, block):
    # equal positions occur: rounded coordinates
    rng = np.random.default_rng(6)
    xy, label = rng.normal(0, 1, (90, 2)).round(0), rng.integers(-1, 3, 90)
    label[0] = 9
    d = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(axis=2))
    want = []
    for i in range(90):
        mine = label == label[i]
        a = d[i][mine].sum() / max(mine.sum() - 1, 1)
        b = min(d[i][label == other].mean() for other in set(label) - {label[i]})
        want.append(0.0 if mine.sum() == 1 else (b - a) / max(a, b))
    rows = [("u", i, float(x), float(y), int(k)) for i, ((x, y), k) in enumerate(zip(xy, label))]
    df = spark.createDataFrame(rows, "user string, event_id bigint, longitude double, "
                                     "latitude double, label bigint")
    got = silhouette.silhouette(df, "user", block=block).first()["silhouette"]
    assert got == pytest.approx(np.mean(want))


def test_sparse_points_open_few_boxes_of_a_crowded_cell(spark, monkeypatch):
    """100,000 points in a cell and 200 scattered ones: far fewer rows than pairs."""
    rng = np.random.default_rng(3)
    crowd = rng.uniform(0.02, 0.48, (100_000, 2))
    # scattered over the cells around, few in each of them, most of them close to eps
    cells = [(i, j) for i in range(-3, 4) for j in range(-3, 4) if (i, j) != (0, 0)]
    spread = np.array([(i / 2 + a, j / 2 + b) for i, j in cells
                       for a, b in rng.uniform(0.02, 0.48, (5, 2))])[:200]
    rows = [("u", i, float(x), float(y)) for i, (x, y) in enumerate(np.vstack([crowd, spread]))]
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame(
        rows, columns=["user", "event_id", "longitude", "latitude"])).repartition(4)
    compared = []

    def counting(metric, pairs, keep, decide=db._decided):
        if "a" in keep:
            compared.append(pairs.count())
        return decide(metric, pairs, keep)

    monkeypatch.setattr(db, "_decided", counting)
    got = db.core_points(db.plain_points(df), db.Euclidean(1.0), min_pts=6).collect()
    core = {r["event_id"]: r["core"] for r in got}
    near = np.sqrt(((spread[:, None, :] - crowd[None]) ** 2).sum(axis=2)) <= 1.0
    among = np.sqrt(((spread[:, None, :] - spread[None]) ** 2).sum(axis=2)) <= 1.0
    want = (near.sum(axis=1) + among.sum(axis=1)) >= 6
    assert [core[100_000 + i] for i in range(200)] == want.astype(int).tolist()
    assert all(core[i] == 1 for i in range(100_000))
    assert sum(compared) < 1_000_000  # all pairs would be 20 million
    print("pairs of points and boxes:", compared)


def test_squared_silhouette_equals_all_pairs(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for user, n in (("u", 120), (None, 60)):
        xy, label = rng.normal(0, 1, (n, 2)), rng.integers(-1, 3, n)
        label[0] = 9
        d = ((xy[:, None, :] - xy[None, :, :]) ** 2).sum(axis=2)
        each = []
        for i in range(n):
            mine = label == label[i]
            a = d[i][mine].sum() / max(mine.sum() - 1, 1)
            b = min(d[i][label == k].mean() for k in set(label) - {label[i]})
            each.append(0.0 if mine.sum() == 1 else (b - a) / max(a, b))
        want[user] = np.mean(each)
        rows += [(user, float(x), float(y), int(k)) for (x, y), k in zip(xy, label)]
    rows += [("one label", 1.0, 2.0, 3), ("one label", 1.5, 2.0, 3), ("u", None, 1.0, 1)]
    df = spark.createDataFrame(rows, "user string, longitude double, latitude double, label int")
    got = {r["user"]: r["silhouette"] for r in silhouette.silhouette_squared(df, "user").collect()}
    assert got == pytest.approx(want)


def test_crowded_cells_of_many_scans_are_not_compared_scan_by_scan(spark, monkeypatch):
    """Two cells with 400 scans each, one linked by a common scan, one by closeness."""
    metric = db.Multimodal(eps=1.0)
    pairs = [[f"h{i:02d}", f"h{j:02d}"] for i in range(40) for j in range(i)]
    cells = [(0.0, pairs[:400]), (0.5, pairs[300:301] * 3 + pairs[400:700]),
             (-0.5, pairs[380:760]), (0.05, pairs[700:720]), (-0.05, [[]] * 8),
             (0.9, pairs[760:])]
    x, sig = (list(v) for v in zip(*[(x, s[::-1]) for x, group in cells for s in group]))
    ids = np.arange(len(x)) + 10
    ham = np.array([[len(set(a) ^ set(b)) / 40 for b in sig] for a in sig])
    apart = np.abs(np.array(x)[:, None] - np.array(x)[None, :])
    truth = brute_labels(apart * (1 + .025 * -10 + 250 * (ham - .001)) <= 1.0, ids, 6)
    df = spark.createDataFrame(
        [("u", int(i), float(v), 0.0, 600.0, s, 40) for i, v, s in zip(ids, x, sig)],
        "user string, event_id bigint, x double, y double, z double, sig array<string>, "
        "vocab bigint").repartition(3)
    compared = []

    def counting(metric, pairs, keep, decide=db._decided):
        compared.append(pairs.count())
        return decide(metric, pairs, keep)

    monkeypatch.setattr(db, "_decided", counting)
    got = {r["event_id"]: r["label"] for r in db.dbscan(df, metric).collect()}
    assert got == dict(zip(ids.tolist(), truth.tolist()))
    assert len(set(got.values())) == 2
    assert sum(compared) < 20_000  # the scans of the first three cells make 360,000 pairs


def test_sparse_points_of_two_cells_meet_once(spark):
    """Every near pair stands in both directions, without a grouping of the pairs."""
    rng = np.random.default_rng(9)
    xy = np.vstack([rng.uniform(-6, 6, (300, 2)), rng.normal(0, 0.3, (100, 2))])
    df = spark.createDataFrame([("u", i, float(x), float(y)) for i, (x, y) in enumerate(xy)],
                               "user string, event_id bigint, longitude double, latitude double")
    grid = db._Grid(db.plain_points(df), db.Euclidean(1.0), "user", "event_id", 6)
    found = grid.sparse_neighbours()
    sparse = sorted(r["id"] for r in grid.points.where("not dense").collect())
    near = euclid(xy, 1.0)
    want = sorted((i, j) for i in sparse for j in sparse if near[i, j])
    rows = found.where("other is not null").collect()
    assert sorted((r["id"], r["other"]) for r in rows) == want and len(want) > 500
    node = {r["id"]: r["node"] for r in grid.points.collect()}
    assert all((r["own"], r["node"], r["n"]) == (node[r["id"]], node[r["other"]], 1) for r in rows)
    members = {n: [i for i in node if node[i] == n] for n in set(node.values())}
    for r in found.where("other is null").collect():
        assert r["n"] == near[r["id"], members[r["node"]]].sum()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1  # the counts of dense cells only
