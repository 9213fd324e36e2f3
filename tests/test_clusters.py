"""Density, Ward and silhouette against plain pairwise versions; partial autocorrelation against its definition."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tillwise.operators import clusters, density, forecast, hierarchy


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(rows)], "id long, x array<double>")


def plain_dbscan(rows, eps, least):
    """(core flags, component of core rows, clusters in reach of other rows)."""
    def within(a, b):
        return sum((p - q) * (p - q) for p, q in zip(a, b)) <= eps * eps

    near = [[j for j in range(len(rows)) if within(rows[i], rows[j])] for i in range(len(rows))]
    core = [len(n) >= least for n in near]
    part = [None] * len(rows)
    for i in range(len(rows)):
        if core[i] and part[i] is None:
            todo = [i]
            part[i] = i
            while todo:
                for j in near[todo.pop()]:
                    if core[j] and part[j] is None:
                        part[j] = i
                        todo.append(j)
    return core, part, [{part[j] for j in n if core[j]} for n in near]


def assert_dbscan(rows, got, eps, least):
    core, part, reach = plain_dbscan(rows, eps, least)
    names = {}
    for i in range(len(rows)):
        if core[i]:
            assert got[i] >= 0
            assert names.setdefault(part[i], got[i]) == got[i]
    assert len(set(names.values())) == len(names)
    for i in range(len(rows)):
        if not core[i]:
            assert got[i] == min((names[p] for p in reach[i]), default=-1)
    return core, names


def test_density_equals_pairwise(spark):
    rng = random.Random(2)
    blobs = [[c + rng.gauss(0, 0.5) for c in rng.choice([(-4, 0), (4, 0), (0, 5)])] for _ in range(250)]
    rows = blobs + [blobs[0]] * 30 + [[round(v) for v in r] for r in blobs[:40]]  # copies, and rows at exact distances
    chain = range(len(rows), len(rows) + 70)
    rows += [(0.45 * i, 100.0) for i in range(70)]
    apart = len(rows)  # two sheets of dense cells, just out of reach
    rows += [(200 + i / 40, y) for y in (0.0, 1.0001) for i in range(60)]
    tied = len(rows)  # the same with one row within eps of both
    rows += [(300 + i / 40, y) for y in (0.0, 1.0001) for i in range(60)] + [(301.0, 1.0)]
    odd = spark.createDataFrame([(-1, None), (-2, [1.0]), (-3, [float("nan"), 0.0]), (-4, [None, 0.0]), (-5, [float("inf"), 0.0])],
                                "id long, x array<double>")
    got = {r["id"]: r["cluster"] for r in density.density(frame(spark, rows).unionByName(odd), "id", "x", 1.0, 5).collect()}
    core, names = assert_dbscan(rows, got, 1.0, 5)
    assert 0 < sum(core) < len(rows) and len(names) > 4
    assert len({got[i] for i in chain}) == 1 and got[apart] != got[apart + 60] and got[tied] == got[tied + 60]
    assert {got[i] for i in range(-5, 0)} == {-1} and len(got) == len(rows) + 5


def test_density_in_four_dimensions_and_empty(spark):
    rng = random.Random(9)
    rows = [[c + rng.gauss(0, 0.45) for c in rng.choice([(-2, 0, 1, 0), (2, 0, 0, 1)])] for _ in range(200)]
    got = {r["id"]: r["cluster"] for r in density.density(frame(spark, rows), "id", "x", 1.0, 10).collect()}
    core, _ = assert_dbscan(rows, got, 1.0, 10)
    assert 0 < sum(core) < len(rows)
    assert density.density(frame(spark, rows).limit(0), "id").count() == 0


def test_density_far_from_zero(spark):
    """Cells so far out that neighbouring numbers are one double are paired once."""
    got = density.density(frame(spark, [[1e17]] * 10 + [[-1e17]] * 50), "id", "x", 1.0, 50).collect()
    assert sorted(r["cluster"] for r in got) == [-1] * 10 + [0] * 50


def test_density_broadcasts_no_pairs(spark):
    plan = density.density(frame(spark, [[0.1 * i, 0.0] for i in range(30)]), "id", min_points=3)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan  # whatever the estimated size


def plain_ward(rows, k):
    groups = [[i] for i in range(len(rows))]
    x = np.array(rows, float)
    heights = []
    while len(groups) > 1:
        def cost(a, b):
            d = x[a].mean(axis=0) - x[b].mean(axis=0)
            return len(a) * len(b) / (len(a) + len(b)) * float(d @ d)

        if len(groups) == k:
            cut = [tuple(sorted(g)) for g in groups]
        a, b = min(itertools.combinations(range(len(groups)), 2), key=lambda p: cost(groups[p[0]], groups[p[1]]))
        heights.append(math.sqrt(2 * cost(groups[a], groups[b])))
        groups[a] = groups[a] + groups.pop(b)
    return sorted(cut), heights


def test_ward_equals_pairwise(spark):
    rng = random.Random(3)
    rows = [[rng.gauss(c, 1) for c in rng.choice([(0, 0, 0), (4, 0, 1), (0, 5, 5)])] for _ in range(60)]
    cut, heights = plain_ward(rows, 4)
    got = {}
    for r in hierarchy.ward(frame(spark, rows), 4).collect():
        got.setdefault(r["cluster"], []).append(r["id"])
    assert sorted(tuple(sorted(v)) for v in got.values()) == cut
    assert [len(got[c]) for c in range(4)] == sorted((len(v) for v in got.values()), reverse=True)
    assert [r["height"] for r in hierarchy.ward_heights(frame(spark, rows)).orderBy("step").collect()] == pytest.approx(heights, abs=1e-5)


def test_ward_copies_bounded_summaries_and_small_tables(spark):
    rng = random.Random(4)
    centres = [(0, 0), (30, 0), (0, 30)]
    rows = [[rng.gauss(c, 1) for c in centres[i % 3]] for i in range(600)] + [[0.0, 0.0]] * 300
    got = {r["id"]: r["cluster"] for r in hierarchy.ward(frame(spark, rows), 3, limit=40).collect()}
    assert len(got) == 900  # no row is lost by summaries
    assert all(got[i] == got[i % 3] for i in range(600)) and len(set(got.values())) == 3 and got[700] == got[0] == 0
    assert hierarchy.ward_heights(frame(spark, rows), limit=40).count() < 40
    same = hierarchy.ward(frame(spark, [[1.0, 2.0]] * 5), 3).collect()
    assert [r["cluster"] for r in same] == [0] * 5
    assert hierarchy.ward(frame(spark, rows).limit(0), 3).count() == 0


def test_silhouette_equals_pairwise(spark):
    rng = random.Random(6)
    rows = [([rng.gauss(3 * (i % 3), 1.5) for _ in range(3)], i % 3) for i in range(90)] + [([50.0, 50.0, 50.0], 7), ([0.0, 0.0, 0.0], -1)]
    df = spark.createDataFrame([(i, x, c) for i, (x, c) in enumerate(rows)], "id long, x array<double>, cluster int")
    kept = [(i, x, c) for i, (x, c) in enumerate(rows) if c >= 0]

    def score(i, x, c):
        by = {}
        for j, y, o in kept:
            if j != i:
                by.setdefault(o, []).append(math.dist(x, y))
        if c not in by:
            return 0.0
        a, b = sum(by[c]) / len(by[c]), min(sum(v) / len(v) for o, v in by.items() if o != c)
        return (b - a) / max(a, b)

    for every in (1, 7):
        asked = [score(*r) for r in kept if r[0] % every == 0]
        for block in (16, 512):
            assert clusters.silhouette(df, "id", every=every, block=block).first()[0] == pytest.approx(sum(asked) / len(asked), abs=1e-4)
    assert clusters.silhouette(df.where("cluster = 1"), "id", every=1).first()[0] == 0.0
    assert clusters.silhouette(df.limit(0), "id").first()[0] is None


def test_silhouettes_share_one_set_of_distances(spark):
    rng = random.Random(8)
    rows = [[rng.gauss(6 * (i % 4), 1.0) for _ in range(3)] for i in range(120)] + [[0.0, 0.0, 0.0]] * 9
    f = frame(spark, rows).select(F.col("id").alias("user_id"), array_to_vector("x").alias("features"))
    got = clusters.silhouettes(f, (3, 4), every=1).collect()
    for r in got:
        labelled = KMeans(k=r["k"], seed=42, predictionCol="cluster").fit(f).transform(f)
        points = labelled.select("user_id", "cluster", vector_to_array("features").alias("x"))
        assert r["silhouette"] == clusters.silhouette(points, "user_id", every=1, block=8).first()[0]
    assert [r["k"] for r in got] == [3, 4] and got[1]["silhouette"] > 0.7


def test_distances_of_near_far_and_odd_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 4)) * 1e4
    q = np.concatenate([x[:5], x[5:10] + 1e-7, rng.normal(size=(5, 4))])
    want = np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    assert np.allclose(clusters._distances(q, x), want, rtol=1e-9, atol=0)
    q[0, 0], x[3, 1] = np.nan, np.inf
    want = np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    assert np.allclose(clusters._distances(q, x), want, equal_nan=True)


def test_partial_autocorrelation_is_the_last_coefficient(spark):
    r = [0.8, 0.5, 0.1, -0.2]
    got = spark.createDataFrame([(r,)], "r array<double>").select(forecast.partial_autocorrelation("r")).first()[0]
    full = [1.0] + r
    want = [np.linalg.solve([[full[abs(i - j)] for j in range(k)] for i in range(k)], r[:k])[-1] for k in range(1, 5)]
    assert got == pytest.approx(want)
    odd = spark.createDataFrame([([],), ([1.0, 0.5],)], "r array<double>").select(forecast.partial_autocorrelation("r")).collect()
    assert odd[0][0] == [] and odd[1][0] == [1.0, 0.0]


def plain_silhouette(rows):
    """Mean over (x, cluster) rows, noise left out."""
    kept, out = [r for r in rows if r[1] >= 0], []
    for i, (x, c) in enumerate(kept):
        by = {}
        for j, (y, o) in enumerate(kept):
            if j != i:
                by.setdefault(o, []).append(math.dist(x, y))
        a, b = (sum(v) / len(v) if v else None for v in (by.get(c, []), min((v for o, v in by.items() if o != c), key=lambda v: sum(v) / len(v), default=[])))
        out.append(0.0 if a is None or b is None or max(a, b) == 0 else (b - a) / max(a, b))
    return sum(out) / len(out)


def test_silhouettes_measure_every_row(spark):
    """No id is divisible by 50; equal rows count as often as they come, also in different clusters."""
    rng = random.Random(5)
    rows = [[rng.gauss(2 * (i % 3), 1.0) for _ in range(2)] for i in range(40)] + [[0.5, 0.5]] * 7
    f = spark.createDataFrame([(50 * i + 1, x) for i, x in enumerate(rows)], "user_id long, x array<double>").withColumn("features", array_to_vector("x"))
    got = clusters.silhouettes(f.select("user_id", "features"), (3,)).first()
    labelled = KMeans(k=3, seed=42).fit(f).transform(f).collect()
    assert got["silhouette"] == pytest.approx(plain_silhouette([(r["x"], r["prediction"]) for r in labelled]), abs=1e-4)
    mixed = [(50 * i + 1, x, i % 3 - (i % 7 == 0)) for i, x in enumerate(rows)]
    df = spark.createDataFrame(mixed, "id long, x array<double>, cluster int")
    for block in (5, 1000):
        assert clusters.silhouette(df, "id", block=block).first()[0] == pytest.approx(plain_silhouette([r[1:] for r in mixed]), abs=1e-4)


def test_compared_methods_measure_every_row(spark):
    rng = random.Random(7)
    rows = [(50 * i + 3, rng.gauss(8 * (i % 2), 1.0), rng.gauss(0, 1.0)) for i in range(60)] + [(50 * i + 3, 40.0, 9.0) for i in range(60, 64)]
    wide = spark.createDataFrame(rows, "user_id long, a double, b double").persist()
    got = {r["method"]: r for r in clusters.compare(wide, ("a", "b"), k=3, eps=0.5, min_points=4).collect()}
    f = clusters.vectors(wide, ("a", "b"), ("user_id",)).withColumn("x", vector_to_array("features"))
    found = {"kmeans": KMeans(k=3, seed=42, predictionCol="cluster").fit(f).transform(f), "hierarchical": hierarchy.ward(f, 3),
             "dbscan": f.join(density.density(f, "user_id", "x", 0.5, 4), "user_id")}
    assert got["dbscan"]["clusters"] >= 2
    for name, df in found.items():
        assert got[name]["silhouette"] == pytest.approx(plain_silhouette([(r["x"], r["cluster"]) for r in df.collect()]), abs=1e-4)
