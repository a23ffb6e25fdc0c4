"""Online clustering against a direct simulation that decays every cluster per sample."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayprints.operators import denstream as den
from dayprints.operators import microclusters as mc

SAMPLES = "user string, event_id bigint, ts timestamp_ntz, longitude double, latitude double"
START = dt.datetime(2024, 1, 1)


class Direct:
    """One user's clusters; sums are faded at every single sample."""

    def __init__(self, p):
        self.p, self.groups, self.step, self.last = p, {"p": [], "o": []}, 0, None
        self.factor = 2 ** -p.lam

    @staticmethod
    def shape(c):
        mean = c["ls"] / c["w"]
        return mean, np.sqrt(np.abs(c["ss"] / c["w"] - mean ** 2)).max()

    def grown(self, c, v):
        return {**c, "w": c["w"] * self.factor + 1, "ls": c["ls"] * self.factor + v,
                "ss": c["ss"] * self.factor + v * v, "n": c["n"] + 1}

    def nearest(self, kind, v):
        def gap(c):
            mean, r = self.shape(c)
            return math.hypot(*(v - mean)) - r
        return min(self.groups[kind], key=gap) if self.groups[kind] else None

    def check(self, t):
        p = self.p
        self.groups["p"] = [c for c in self.groups["p"] if c["w"] >= p.beta * p.mu]
        limit = lambda c: ((2 ** (-p.lam * (t - c["t0"] + p.tp)) - 1)
                           / (2 ** (-p.lam * p.tp) - 1))
        self.groups["o"] = [c for c in self.groups["o"] if c["w"] >= limit(c)]

    def add(self, v, seconds):
        self.step += 1
        t = self.step if self.p.clock == "steps" else seconds
        if self.p.clock == "seconds" and self.last is not None and t // self.p.tp > self.last // self.p.tp:
            self.check(t // self.p.tp * self.p.tp)
        self.last = t
        target = None
        for kind in ("p", "o"):
            c = self.nearest(kind, v)
            if c is not None:
                bigger = self.grown(c, v)
                if self.shape(bigger)[1] <= self.p.eps:
                    self.groups[kind][[x is c for x in self.groups[kind]].index(True)] = bigger
                    if kind == "o" and bigger["w"] > self.p.beta * self.p.mu:
                        self.groups["o"] = [x for x in self.groups["o"] if x is not bigger]
                        self.groups["p"].append(bigger)
                    target = bigger
                    break
        if target is None:
            target = {"w": 1.0, "ls": v.copy(), "ss": v * v, "n": 1, "t0": t}
            close = any(math.hypot(*(v - self.shape(c)[0])) < 2 * self.p.eps for c in self.groups["p"])
            self.groups["p" if close else "o"].append(target)
        for group in self.groups.values():
            for c in group:
                if c is not target:
                    for key in ("w", "ls", "ss"):
                        c[key] = c[key] * self.factor
        if self.p.clock == "steps" and t % self.p.tp == 0:
            self.check(t)

    def result(self):
        return sorted((kind, c["n"], int(c["t0"]), round(c["w"], 6), round(c["ls"][0], 6),
                       round(c["ss"][1], 6)) for kind in "po" for c in self.groups[kind])


def tracks(seed=0, n=500):
    """Users moving between places; one of them has most of the samples and far places."""
    rng = np.random.default_rng(seed)
    out = {}
    for user, count, centres in (
            ("hot", n * 3, [(0, 0), (0.003, 0.001), (30, 10), (30, -40), (30.001, 10.002)]),
            ("near", n, [(0, 0), (0.0008, 0.0003), (0.002, 0)]),
            ("few", 3, [(5, 5)])):
        place = np.array(centres)[rng.integers(0, len(centres), count)]
        jitter = rng.normal(0, rng.choice([0.0001, 0.0004], (count, 1)), (count, 2))
        far = (rng.random((count, 1)) < 0.03) * rng.normal(0, 0.05, (count, 2))
        seconds = np.cumsum(rng.integers(1, 900, count))
        out[user] = (place + jitter + far, seconds)
    return out


def frame(table, data, shuffle=0):
    rows, i = [], 0
    for user, (xy, seconds) in data.items():
        for (x, y), s in zip(xy, seconds):
            rows.append((user, i, str(START + dt.timedelta(seconds=int(s))), float(x), float(y)))
            i += 1
    if shuffle:
        rows = [rows[j] for j in np.random.default_rng(shuffle).permutation(len(rows))]
    return table(rows, SAMPLES)


def direct(data, p):
    out = {}
    epoch = int((START - dt.datetime(1970, 1, 1)).total_seconds())
    for user, (xy, seconds) in data.items():
        one = Direct(p)
        for v, s in zip(xy, seconds):
            one.add(np.array(v, dtype=float), int(s) + epoch)
        out[user] = one.result()
    return out


def collected(df):
    out = {}
    for r in df.collect():
        kind = "p" if r["type_cluster"] == mc.POTENTIAL else "o"
        out.setdefault(r["user"], []).append(
            (kind, r["N"], r["creationTimeStamp"], round(r["weight"], 6), round(r["LS1"], 6),
             round(r["SS2"], 6)))
    return {u: sorted(v) for u, v in out.items()}


CASES = [mc.Params(), mc.Params(tp=60), mc.Params(tp=7, lam=0.01),
         mc.Params(clock="seconds"), mc.Params(clock="seconds", tp=20000, lam=0.001)]


def assert_same(got, want):
    assert got.keys() == {u for u in want if want[u]}
    for user in got:
        assert len(got[user]) == len(want[user])
        for a, b in zip(got[user], want[user]):
            assert a[:3] == b[:3]
            assert a[3:] == pytest.approx(b[3:], abs=2e-6)


@pytest.mark.parametrize("p", CASES, ids=str)
def test_equals_direct_simulation(table, p):
    data = tracks()
    assert_same(collected(den.denstream(frame(table, data, shuffle=3), None, p)), direct(data, p))


@pytest.mark.parametrize("p", CASES[1:4], ids=str)
def test_two_batches_equal_one(spark, table, p):
    data = tracks(seed=9, n=200)
    df = frame(table, data, shuffle=1).cache()
    cut = F.lit(str(START + dt.timedelta(seconds=40000))).cast("timestamp_ntz")
    saved = den.denstream(df.where(F.col("ts") < cut), None, p)
    saved = spark.createDataFrame(saved.collect(), saved.schema)
    both = den.denstream(df.where(F.col("ts") >= cut), saved, p)
    kept = saved.join(both.select("user").distinct(), on="user", how="left_anti")
    assert_same(collected(both.unionByName(kept)), direct(data, p))


@pytest.mark.parametrize("p", [mc.Params(tp=60), mc.Params(clock="seconds", tp=20000)], ids=str)
def test_samples_without_a_user_are_one_user(spark, table, p):
    data = {None if user == "near" else user: v for user, v in tracks(n=60).items()}
    df = frame(table, data, shuffle=2).cache()
    assert_same(collected(den.denstream(df, None, p)), direct(data, p))
    cut = F.lit(str(START + dt.timedelta(seconds=15000))).cast("timestamp_ntz")
    saved = den.denstream(df.where(F.col("ts") < cut), None, p)
    saved = spark.createDataFrame(saved.collect(), saved.schema)
    later = df.where(F.col("ts") >= cut)
    both = den.denstream(later, saved, p).unionByName(den.untouched(saved, later))
    assert_same(collected(both), direct(data, p))


class Scan(den.Group):
    """The nearest cluster by looking at all of them."""

    looked = 0

    def nearest(self, x, y, step):
        if not self.members:
            return None
        return min(self.members, key=lambda k: (math.hypot(
            x - self.members[k][8], y - self.members[k][9]) - self.members[k][10], k))


@pytest.mark.parametrize("p", [mc.Params(tp=10**9), mc.Params(tp=50, lam=0.01),
                               mc.Params(tp=400, lam=0.2)], ids=str)
def test_the_grid_finds_what_a_scan_finds(p):
    rng = np.random.default_rng(11)
    one, other = den.Clusters(p), den.Clusters(p)
    other.potential, other.outliers = Scan(p), Scan(p)
    # crowded and scattered places, some samples just around the border of a cluster
    centres = rng.uniform(0, 0.05, (40, 2))
    for step in range(1, 4001):
        x, y = centres[rng.integers(40)] + rng.normal(0, rng.choice([1e-4, 6e-4, 5e-3]), 2)
        if step % p.tp == 0:
            one.prune(step - 1, step), other.prune(step - 1, step)
        assert one.add(x, y, step, step) == other.add(x, y, step, step)
    assert list(one.dump()) == list(other.dump())


def test_time_per_sample_does_not_grow_with_the_clusters(monkeypatch):
    """Distances measured per sample, with 200 and with 20,000 clusters around."""
    rng = np.random.default_rng(4)
    measured = {}
    for n in (200, 20_000):
        clusters, side = den.Clusters(mc.Params()), 0.01 * math.sqrt(n)
        for x, y in rng.uniform(0, side, (n, 2)):
            clusters.load([1.0, x, y, x * x, y * y, 1, 0, 0], mc.OUTLIER)
        calls = [0]

        def counted(*args, calls=calls):
            calls[0] += 1
            return math.hypot(*args)

        monkeypatch.setattr(den, "math", type("M", (), {**vars(math), "hypot": counted}))
        for i, (x, y) in enumerate(rng.uniform(0, side, (500, 2))):
            clusters.add(x, y, i + 1, i + 1)
        monkeypatch.undo()
        measured[n] = calls[0] / 500
    print("distances per sample:", measured)
    assert measured[20_000] < 2 * measured[200] + 5 and measured[20_000] < 50


def test_far_places_are_separate_regions(table):
    rows = frame(table, tracks()).select("user", F.col("longitude").alias("x"),
                                         F.col("latitude").alias("y"))
    sided = den._with_side(rows, None, mc.Params(), "user")
    regions = den._regions(sided, "user").select("user", "strip", "region").distinct()
    assert regions.where("user = 'hot'").count() >= 3


@pytest.mark.parametrize("samples,clusters", [(899, 0), (900, 1), (901, 1)])
def test_first_clusters_need_enough_samples(spark, table, samples, clusters):
    rows = [("u", i, str(START + dt.timedelta(minutes=i)), 1.0 + 1e-5 * (i % 7), 2.0)
            for i in range(samples)]
    labelled = table(rows, SAMPLES).withColumn("label", F.lit(0))
    got = den.initial_clusters(labelled).collect()
    assert len(got) == clusters
    if clusters:
        assert got[0]["N"] == samples and got[0]["updated"] == samples
        fade = 2.0 ** -1e-5
        assert got[0]["weight"] == pytest.approx((1 - fade ** samples) / (1 - fade))


def test_prune_and_upsert(spark):
    ddl = "user string, type_cluster string, weight double, creationTimeStamp bigint"
    rows = [("u", mc.POTENTIAL, 5.9, 0), ("u", mc.POTENTIAL, 6.0, 0), ("u", mc.OUTLIER, 0.99, 100),
            ("u", mc.OUTLIER, 1.0, 100), ("v", mc.OUTLIER, 3.0, 0)]
    df = spark.createDataFrame(rows, ddl)
    kept = mc.prune(df, F.lit(100)).collect()
    assert sorted(r["weight"] for r in kept) == [1.0, 3.0, 6.0]
    updated = spark.createDataFrame([("u", mc.POTENTIAL, 9.0, 1)], ddl)
    out = mc.cluster_upsert(df, updated).collect()
    assert sorted((r["user"], r["weight"]) for r in out) == [
        ("u", 0.99), ("u", 1.0), ("u", 9.0), ("v", 3.0)]


def test_summary_reads_its_rows_once(spark):
    """What comes out of a clustering is not made again for every pass of the row numbers."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = spark.range(500).select(
        F.lit("u").alias("user"), F.col("id").alias("event_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.col("id").alias("t"),
        (F.col("id") % 3 - 1).alias("label"), F.col("id").cast("double").alias("longitude"),
        F.lit(1.0).alias("latitude"))
    got = mc.cluster_summary(rows.mapInPandas(counted, rows.schema)).collect()
    assert {r["label"]: (r["N"], r["creationTimeStamp"]) for r in got} == {0: (167, 499), 1: (166, 497)}
    assert read.value == 500
