import math
import random

import pytest
from pyspark.sql import functions as F

from rodado.functions import geo
from rodado.operators import nearby, skew, spatial
from rodado.operators.graph import _metres


def frame(spark, pts, names):
    return spark.createDataFrame(pts, f"{names[0]} bigint, {names[1]} double, {names[2]} double")


@pytest.mark.parametrize("seed,box,radius", [(1, (-71.1, -71.0, -36.6, -36.5), 250.0), (2, (-180, 180, -90, 90), 900_000.0), (3, (179.99, 180.0, -1, 1), 5000.0), (4, (-180, 180, 89.95, 90), 2000.0), (5, (-180, 180, -90, -89.9), 9000.0)])
def test_within_against_brute_force(spark, seed, box, radius):
    rnd = random.Random(seed)
    x0, x1, y0, y1 = box
    make = lambda n: [(i, rnd.choice([1, -1]) * rnd.uniform(x0, x1) if x0 == 179.99 else rnd.uniform(x0, x1), rnd.uniform(y0, y1)) for i in range(n)]
    a = make(150) + [(900, 180.0, 0.0), (901, -180.0, 0.0), (902, 0.0, 90.0), (903, 5.0, -90.0)]
    b = make(80) + [(800, -180.0, 0.0001), (801, 77.0, 90.0), (802, 0.0, -90.0)]
    got = nearby.within(frame(spark, a, ("p", "lng", "lat")), frame(spark, b, ("c", "x", "y")), radius, ["p"], centre_xy=("x", "y"), distance="m")
    got = {(r["p"], r["c"]) for r in got.collect()}
    want = {(p, c) for p, x, y in a for c, u, v in b if _metres(x, y, u, v) <= radius}
    assert got == want


def test_bad_coordinates_and_crowds(spark, monkeypatch):
    bad = [(1, None, 1.0), (2, 1.0, None), (3, float("nan"), 1.0), (4, 181.0, 1.0), (5, 1.0, -90.5), (6, 1.0, 1.0)]
    p = frame(spark, bad + [(100 + i, 1.0, 1.0) for i in range(300)], ("p", "lng", "lat"))
    c = frame(spark, [(1, 1.0, 1.0), (2, None, None), (3, 1.0, float("nan"))], ("c", "x", "y"))
    monkeypatch.setattr(skew, "SALT_ROWS", 50)
    hot = skew.hot_keys(p.withColumn("k", F.lit(1)), ["k"], ["id"], rows=50)
    assert hot.first()["_salts"] == 7
    got = skew.salted_join(p.withColumn("k", F.lit(1)), c.withColumn("k", F.lit(1)), ["k"], ["p"], rows=50)
    assert got.count() == p.count() * 3
    assert nearby.within(p, c, 100.0, ["p"], centre_xy=("x", "y")).count() == 301
    assert nearby.within(p.limit(0), c, 100.0, ["p"], centre_xy=("x", "y")).count() == 0
    assert nearby.within(p, c.limit(0), 100.0, ["p"], centre_xy=("x", "y")).count() == 0


def test_paths_near_places(spark):
    d = 1 / 111_194.93
    places = spark.createDataFrame([(1, 0.0, 0.0, "a"), (1, 0.0, 0.0, "b"), (2, 0.0, 0.01, "a"), (None, 0.0, 0.0, "a"), (3, None, 0.0, "a")], "place_id bigint, lng double, lat double, path_id string")
    paths = spark.createDataFrame(
        [(10, [[0.0, 249.9 * d], [0.0, 249.9 * d]], 1), (11, [[0.0, 250.5 * d]], 1), (12, None, 1), (13, [], 1), (14, [[0.0], [0.0, 0.0, 0.0], None, [None, 0.0]], 1), (None, [[0.0, 0.0]], 1), (10, [[0.0, 249.9 * d]], 2)],
        "path_id bigint, anchors array<array<double>>, lat int",
    )
    assert [tuple(r) for r in nearby.paths_near_places(places, paths).collect()] == [(1, 10)]


def test_regions(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 0.5), (3, None, 0.5), (4, 0.2, 0.9)], "p bigint, lng double, lat double")
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    reg = spark.createDataFrame([(7, ring), (8, ring[:2]), (9, None)], "r bigint, ring array<struct<lng:double,lat:double>>")
    got = nearby.regions_of_points(pts.withColumn("lat", F.col("lat") - 0.1), reg, ["p"], "ring")
    assert {(r["p"], r["r"]) for r in got.collect()} == {(1, 7)}


def test_nearest_and_shapes(spark):
    rnd = random.Random(9)
    a = [(i, rnd.uniform(-71.2, -71.0), rnd.uniform(-36.6, -36.4)) for i in range(40)] + [(99, 100.0, 40.0)]
    b = [(i, rnd.uniform(-71.2, -71.0), rnd.uniform(-36.6, -36.4)) for i in range(25)]
    p, t = frame(spark, a, ("p", "lng", "lat")), frame(spark, b, ("t", "_x", "_y"))
    got = {r["p"]: r["t"] for r in spatial.nearest(p, t, "p", "t", 1, 500.0).collect()}
    assert got == {i: min(b, key=lambda q: (_metres(x, y, q[1], q[2]), q[0]))[0] for i, x, y in a}
    near = {i for i, x, y in a if any(_metres(x, y, u, v) <= 2000 for _, u, v in b)}
    assert {r["p"] for r in spatial.semi(p, t, 2000.0, ["p"], ("_x", "_y")).collect()} == near
    assert {r["p"] for r in spatial.anti(p, t, 2000.0, ["p"], ("_x", "_y")).collect()} == {i for i, _, _ in a} - near


def test_geometry(spark):
    df = spark.createDataFrame([(-71.0, -36.0, -70.99, -36.01)], "a double, b double, c double, d double")
    r = df.select(geo.haversine("a", "b", "c", "d").alias("m"), geo.bearing("a", "b", "c", "d").alias("t"), geo.compass(geo.bearing("a", "b", "c", "d")).alias("w"), geo.angle_between(F.lit(350), F.lit(20)).alias("g"), geo.cell(F.lit(-70.65), 0.005).alias("k"), geo.half_up(F.lit(-2.5)).alias("h")).first()
    assert math.isclose(r["m"], _metres(-71.0, -36.0, -70.99, -36.01), rel_tol=1e-9) and r["w"] == "SE" and r["g"] == 30 and r["k"] == math.floor(-70.65 / 0.005) and r["h"] == -2
    x, y = (df.select(v.alias("v")).first()["v"] for v in geo.destination("a", "b", 90.0, 1000.0))
    assert math.isclose(_metres(-71.0, -36.0, x, y), 1000, rel_tol=1e-6)


def test_cover_of_a_ring():
    """Every place in the ring is in a cell, whole cells hold no other place, and a large ring has no more cells than a small one."""
    rnd = random.Random(3)
    for size in (0.001, 1.0, 60.0):
        k = [2 * math.pi * i / 14 for i in range(14)]
        xs = [10 + size * (1 if i % 2 else 0.5) * math.cos(a) for i, a in enumerate(k)]
        ys = [20 + size * (1 if i % 2 else 0.5) * math.sin(a) for i, a in enumerate(k)]
        cells = nearby.cover_ring(xs, ys)
        assert 10 < len(cells) < 500
        for _ in range(400):
            px, py = 10 + rnd.uniform(-1.1, 1.1) * size, 20 + rnd.uniform(-1.1, 1.1) * size
            inside = sum((a > py) != (b > py) and px < (d - c) * (py - a) / (b - a) + c for a, b, c, d in zip(ys, ys[1:] + ys[:1], xs, xs[1:] + xs[:1])) % 2 == 1
            met = [w for lv, lo, hi, w in cells if lo <= nearby._interleaved(int((px + 180) / 360 * 2**lv), int((py + 90) / 180 * 2**lv)) <= hi]
            assert len(met) <= 1 and (not inside or met) and (inside or not any(met))
    assert nearby.cover_ring([1.0, 2.0], [1.0, 2.0]) == [] and nearby.cover_ring([1.0, float("nan"), 2.0], [1.0, 2.0, 3.0]) == []
