import math

import pytest
from pyspark.sql import functions as F

from rodado.operators import tracks as T
from rodado.operators.graph import _metres

DEG = 1 / 111_194.93


def track(spark, pts, key=1):
    return spark.createDataFrame([(key, i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "track bigint, ord bigint, lng double, lat double")


def line(n, step_m, start=(0.0, 0.0)):
    return [(start[0] + i * step_m * DEG, start[1]) for i in range(n)]


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_straight_line(spark):
    t = track(spark, line(21, 50.0))
    e = one(T.ends(t))
    assert e["points"] == 21 and math.isclose(e["length_m"], 1000, rel_tol=1e-4)
    assert one(T.jumps(t))["worst_m"] == 50 and one(T.density(t))["points_per_km"] == 21
    i = one(T.interpolated(t))
    assert i["runs"] == 1 and i["real_pct"] == 5
    assert one(T.smoothness(t))["smoothness"] == 100
    assert one(T.shape(t))["shape"] == "→E →E"


def test_out_and_back(spark):
    go = line(61, 100.0)
    t = track(spark, go + go[::-1][1:20])
    s = one(T.smoothness(t))
    assert s["sharp_turns"] == 1 and s["walkbacks"] > 10
    assert one(T.retracing(t))["retraced"] > 0.1
    r = one(T.rideability(t))
    assert r["rideability"] < 80 and r["wasted_m"] == 1900


def test_circle_is_a_rideable_loop(spark):
    pts = [(0.02 * math.cos(a), 0.02 * math.sin(a)) for a in [2 * math.pi * k / 80 for k in range(81)]]
    t = track(spark, pts)
    assert one(T.rideability(t))["rideability"] >= 98
    assert one(T.walkbacks_loop(t))["walkbacks"] == 0
    tags = spark.createDataFrame([(1, ["loop"])], "track bigint, tags array<string>")
    c = one(T.loop_closure(t, tags))
    assert c["closure_m"] == 0 and c["closed"]


@pytest.mark.parametrize("pts", [[(0, 0)], [(0, 0), (0, 0)], [(0, 0), (0.001, 0)]])
def test_tiny_tracks(spark, pts):
    t = track(spark, pts)
    for f in (T.ends, T.jumps, T.density, T.smoothness, T.interpolated, T.retracing):
        one(f(t))
    assert one(T.rideability(t))["rideability"] == 100
    assert T.shape(t).count() == (len(pts) > 1)


def test_empty_and_dirty(spark):
    t = track(spark, [(0, 0)]).limit(0)
    for f in (T.ends, T.jumps, T.density, T.smoothness, T.interpolated, T.rideability, T.shape, T.retracing, T.sample_every):
        assert f(t).count() == 0
    bad = spark.createDataFrame([(1, 0, None, 0.0), (None, 1, 0.0, 0.0), (1, 2, 400.0, 0.0), (1, 3, 0.0, 0.0)], "track bigint, ord bigint, lng double, lat double")
    assert T.clean(bad).count() == 1


def test_resample_and_point_at(spark):
    t = track(spark, line(5, 130.0))
    r = [(x["at_m"], x["lng"]) for x in T.resample(t, 100.0).orderBy("at_m").collect()]
    assert [a for a, _ in r] == [0, 100, 200, 300, 400, 500] and all(math.isclose(x / DEG, a, abs_tol=0.1) for a, x in r)
    w = spark.createDataFrame([(1, -5.0), (1, 0.0), (1, 260.0), (1, 999.0)], "track bigint, at_m double")
    got = {x["at_m"]: x["lng"] / DEG for x in T.point_at(t, w).collect()}
    assert math.isclose(got[260.0], 260, abs_tol=0.1) and math.isclose(got[999.0], 520, abs_tol=0.1) and abs(got[-5.0]) < 0.1 and abs(got[0.0]) < 0.1


def test_sample_every_advances_once_a_vertex(spark):
    t = track(spark, [(k * DEG, 0) for k in (0, 900, 3500, 3600, 3700)])
    assert [r["ord"] for r in T.sample_every(t, 1000.0).orderBy("ord").collect()] == [0, 2, 3, 4]


def test_densify_and_elevation(spark):
    d = T.densify(track(spark, [(0, 0), (200 * DEG, 0), (250 * DEG, 0)])).orderBy("ord", "sub").collect()
    assert len(d) in (6, 7) and all(_metres(a["lng"], a["lat"], b["lng"], b["lat"]) <= 51 for a, b in zip(d, d[1:]))
    t = track(spark, line(5, 100.0)).withColumn("ele", F.when(F.col("ord") == 1, 10.0).when(F.col("ord") == 3, 30.0))
    assert [round(r["ele"], 3) for r in T.fill_elevation(t).orderBy("ord").collect()] == [10, 10, 20, 30, 30]


def test_runs_and_breaks(spark):
    t = track(spark, [(0, 0), (DEG * 10, 0), (DEG * 5000, 0), (DEG * 5010, 0)])
    assert [r["part"] for r in T.breaks(t, 200.0).orderBy("ord").collect()] == [1, 1, 2, 2]
    assert one(T.longest_run(t, "track", "ord", F.col("ord") > 0))["run"] == 3
    assert one(T.longest_run(t, "track", "ord", F.lit(None).cast("boolean")))["run"] == 0
    k = T.islands(t.withColumn("k", F.when(F.col("ord") < 2, 1)), "track", "ord", "k").orderBy("ord").collect()
    assert [r["island"] for r in k] == [1, 1, 2, 2]


def test_gap_penalty(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 100.0), (1, 600.0), (1, 1500.0), (2, 90_000.0), (3, None)], "k bigint, g double")
    r = {x["k"]: x for x in T.gap_totals(df, "k", "g").collect()}
    assert r[1]["gaps"] == 3 and math.isclose(r[1]["penalty"], 0.05 + 0.6 + 2.1) and r[2]["penalty"] == 8 and r[3]["penalty"] == 0
