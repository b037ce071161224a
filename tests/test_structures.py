import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from rodado.operators import corridors, graph, greedy, lines, search, zones
from rodado.operators.graph import _metres
from rodado.operators.lines import Line


def union_find(n, edges):
    p = list(range(n))

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(n)}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    n = 150
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(n), rnd.randrange(n)) for _ in range(40)] + [(100, k) for k in range(101, 120)]
    e = spark.createDataFrame(edges + edges[:5], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in graph.components(spark.range(n), e).collect()}
    assert got == union_find(n, edges)


def test_components_without_edges(spark):
    e = spark.createDataFrame([], "a bigint, b bigint")
    assert {(r["id"], r["component"]) for r in graph.components(spark.range(3), e).collect()} == {(0, 0), (1, 1), (2, 2)}
    assert graph.components(spark.range(0), e).count() == 0


def test_flood_fill(spark):
    c = spark.createDataFrame([(0, 0), (1, 1), (1, 2), (5, 5), (-3, 7), (-2, 6), (0, 0)], "gx bigint, gy bigint")
    got = {}
    for r in graph.flood_fill(c).collect():
        got.setdefault(r["component"], set()).add((r["gx"], r["gy"]))
    assert sorted(map(sorted, got.values())) == [[(-3, 7), (-2, 6)], [(0, 0), (1, 1), (1, 2)], [(5, 5)]]


def test_paths(spark):
    edges = [(1, 2, 1.0, 1.0), (2, 3, 1.0, 1.0), (1, 3, 5.0, 5.0), (3, 4, 1.0, 1.0), (9, 9, 1.0, 1.0)]
    e = spark.createDataFrame(edges, "a bigint, b bigint, cost double, length double")
    req = spark.createDataFrame([(1, 4), (4, 1), (1, 1), (7, 8)], "src bigint, dst bigint")
    got = {(r["src"], r["dst"]): (r["cost"], r["path"]) for r in graph.paths(req, e).collect()}
    assert got == {(1, 4): (3.0, [1, 2, 3, 4]), (1, 1): (0.0, [1])}
    assert graph.paths(req, e, most=2.0).count() == 1
    at = spark.createDataFrame([(i, i * 1e-5, 0.0) for i in range(1, 5)], "id bigint, lng double, lat double")
    star = {(r["src"], r["dst"]): r["length"] for r in graph.paths(req, e, at, "a_star").collect()}
    assert star[(1, 4)] >= 3.0 and (4, 1) not in star
    with pytest.raises(ValueError):
        graph.collect_graph(e, most=2)


def test_cycles(spark):
    e = [(a, b, 1.0) for a, b in itertools.combinations(range(5), 2)]
    df = spark.createDataFrame(e, "a bigint, b bigint, length double")
    assert graph.triangles(df, 3, 3).count() == math.comb(5, 3) and graph.triangles(df, 4, 9).count() == 0
    assert graph.rectangles(df, 4, 4).count() == math.comb(5, 4)


def first_set(keys, conflicts, rank):
    kept = []
    for k in sorted(keys, key=lambda k: (rank[k], k)):
        if not any((k, o) in conflicts or (o, k) in conflicts for o in kept):
            kept.append(k)
    return set(kept)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_keep_best_is_the_greedy_choice(spark, seed):
    rnd = random.Random(seed)
    n = 60
    conflicts = {(rnd.randrange(n), rnd.randrange(n)) for _ in range(90)}
    conflicts = {(a, b) for a, b in conflicts if a != b}
    rank = {i: rnd.randrange(8) for i in range(n)}
    rows = spark.createDataFrame([(i, rank[i]) for i in range(n)], "id bigint, score bigint")
    e = spark.createDataFrame(sorted(conflicts), "a bigint, b bigint")
    got = {r["id"] for r in greedy.keep_best(rows, e, "id", F.col("score")).collect()}
    assert got == first_set(range(n), conflicts, rank)
    assert greedy.keep_best(rows, e.limit(0), "id", F.col("score")).count() == n


def test_clusters_and_sets(spark):
    m = 1 / 111_194.93
    pts = spark.createDataFrame([(1, 0.0, 0.0, 5), (2, 300 * m, 0.0, 9), (3, 600 * m, 0.0, 1), (4, 5000 * m, 0.0, 1)], "id bigint, lng double, lat double, s int")
    got = {r["id"]: r["centre"] for r in greedy.cluster(pts, "id", 500.0, -F.col("s")).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 4}
    rows = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["z"]), (4, None)], "id bigint, items array<string>")
    assert [tuple(r) for r in greedy.set_conflicts(rows, "id", "items", 0.6).collect()] == [(1, 2)]


def test_select_diverse(spark):
    rows = spark.createDataFrame([(i, "x", 100 - i, "a" if i < 6 else "b", ["p"] if i % 2 else ["q"]) for i in range(12)], "id bigint, g string, score bigint, kind string, tags array<string>")
    near = spark.createDataFrame([(0, 1)], "a bigint, b bigint")
    got = [r["id"] for r in greedy.select_diverse(rows, near, "id", "g", "score", {"kind": 3, "tags": 4}, 5).orderBy("place").collect()]
    assert got == [0, 2, 3, 6, 7]
    assert greedy.select_diverse(rows.limit(0), near, "id", "g", "score", {"kind": 3}, 5).count() == 0


def test_keep_best_of_a_long_chain(spark):
    """Each row outranks the next: rounds alone would take half as many as there are rows."""
    n = 300
    rows, e = spark.range(n), spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert [r["id"] for r in greedy.keep_best(rows, e, "id", F.col("id")).orderBy("id").collect()] == list(range(0, n, 2))
    # a component too large for one task goes on in rounds and comes out the same
    small = spark.range(16)
    got = greedy.keep_best(small, e.where("b < 16"), "id", F.col("id"), rounds=2, task_edges=3)
    assert sorted(r["id"] for r in got.collect()) == list(range(0, 16, 2))


def test_components_of_a_long_path(spark):
    n = 100_000
    mixed = F.pmod(F.col("id") * 48_271, F.lit(n))  # neighbours have numbers far apart
    nodes = spark.range(n).select(mixed.alias("id"))
    e = spark.range(n - 1).select(mixed.alias("a"), F.pmod((F.col("id") + 1) * 48_271, F.lit(n)).alias("b"))
    got = graph.components(nodes, e).agg(F.min("component"), F.max("component"), F.count("*")).first()
    assert tuple(got) == (0, 0, n)


def test_continuations(spark):
    m = 1 / 111_194.93
    cols = "seg_id bigint, normal_name string, length_m double, lng0 double, lat0 double, lng1 double, lat1 double"
    line = lambda i, name, a, b: (i, name, abs(b[1] - a[1]) / m + abs(b[0] - a[0]) / m, *a, *b)
    rows = [
        line(1, "A", (0.0, 0.0), (0.0, 500 * m)), line(2, "A", (0.0, 600 * m), (0.0, 1200 * m)),  # one flows into the other
        line(3, "A", (50 * m, 0.0), (50 * m, 520 * m)),  # beside the first: both start there and end there
        line(4, "B", (0.0, 0.0), (300 * m, 0.0)), line(5, "B", (0.0, 50 * m), (0.0, 900 * m)),  # only start together
        line(6, "A", (0.0, 1700 * m), (150 * m, 1700 * m)),  # ends and starts near none
        line(7, "", (0.0, 500 * m), (0.0, 700 * m)), line(8, "C", (0.0, 0.0), (0.0, 400 * m)), line(9, "C", (60 * m, 390 * m), (60 * m, 10 * m)),  # there and back
    ]
    df = spark.createDataFrame(rows, cols)
    assert sorted(tuple(r) for r in corridors.continuations(df).collect()) == [(1, 2), (2, 3)]


def straight(n=6):
    return [Line(i, [(-70.6 + .005 * (i + k / 4), -33.4) for k in range(5)]) for i in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_order_doesnt_depend_on_the_input(seed):
    rnd = random.Random(seed)
    ls = [x if rnd.random() < 0.5 else Line(x.id, x.points[::-1]) for x in straight()]
    rnd.shuffle(ls)
    out = lines.order_lines(ls)
    assert [x.id for x in out] == list(range(6)) and lines.count_turns(out) == 0
    assert all(a.end == b.start for a, b in zip(out, out[1:])) and out[0].start[0] < out[-1].end[0]


def test_order_of_shapes():
    arc = [Line(i, [(-70.6 + .02 * math.sin(a), -33.4 + .02 * math.cos(a)) for a in [math.pi / 2 * (i + k / 4) / 6 for k in range(5)]]) for i in range(6)]
    assert lines.count_turns(lines.order_lines(arc[::-1])) == 0
    down = [Line(i, [(-70.6, -33.4 + .005 * (i + k / 4)) for k in range(5)]) for i in range(4)]
    assert [x.id for x in lines.order_lines(down)] == [3, 2, 1, 0]
    twin = straight() + [Line(50, [(-70.6 + .005 * k, -33.4003) for k in range(3)])]
    assert 50 in [x.id for x in lines.order_lines(twin)] and 0 not in [x.id for x in lines.order_lines(twin)]
    assert lines.order_lines([]) == [] and lines.order_lines([Line(1, [(0.0, 0.0)])]) == []
    closed = Line(2, [(0.0, 0.0), (0.01, 0.0), (0.0, 0.0)])
    assert lines.order_lines([closed]) == []


def test_linear_reference():
    ls = straight()
    pts, cum, spans = lines.measure(ls)
    s, d = lines.project(pts, cum, (-70.59, -33.401))
    assert abs(s - cum[-1] / 3) < 1 and abs(d - 111.2) < 1
    part = lines.cut(ls, cum[-1] / 3 + 5, cum[-1] * 0.9)
    assert [x.id for x in part] == [2, 3, 4, 5] and abs(sum(x.length for x in part) - (cum[-1] * (0.9 - 1 / 3) - 5)) < 1
    assert [x.id for x in lines.cut(ls, cum[-1] * 0.9, cum[-1] / 3 + 5)] == [5, 4, 3, 2]
    # a stretch that is short against its line stays if it is all there is
    assert [(x.id, round(x.length)) for x in lines.cut(ls, 5.0, 35.0)] == [(0, 30)]
    cross = [Line(9, [(-70.59 + .0001, -33.41), (-70.59 + .0001, -33.39)])]
    p2, c2, _ = lines.measure(cross)
    kind, a, b, gap = lines.junctions(pts, cum, p2, c2)[0]
    assert kind == "cross" and gap == 0 and abs(a - cum[-1] / 3) < 20
    out = lines.chain([(-70.6, -33.4), ls, cross, (-70.59, -33.389)])
    assert [x.id for x in out[0]] == [0, 1, 9]
    assert lines.chain([]) == []


def test_plan_and_axes():
    paths = {1: [(0.0, 0.0), (0.05, 0.0)], 2: [(0.05, 0.0), (0.1, 0.0)], 3: [(0.0, 1.0), (0.1, 1.0)]}
    got = lines.plan((0.0, 0.0), (0.1, 0.0), paths, lambda p, at, goal: -min(_metres(*q, *at) for q in p))
    assert got == [1, 2]
    assert [i for i, _ in lines.axis_order([((0, 0), (0, .01)), ((0, .03), (0, .02)), ((0, .011), (0, .019))])] in ([0, 2, 1], [1, 2, 0])
    assert lines.axis_order([]) == []


def test_ordered_paths(spark):
    rows = [(1, x.id, x.points, None) for x in straight()] + [(2, 7, None, True), (3, 8, [(0.0, 0.0), (0.01, 0.0)], True)]
    df = spark.createDataFrame(rows, "path bigint, way_id bigint, points array<struct<lng:double,lat:double>>, oneway boolean")
    got = lines.ordered_paths(df, "path").collect()
    assert [r["way_id"] for r in sorted(got, key=lambda r: (r["path"], r["ord"]))] == [0, 1, 2, 3, 4, 5, 8]


def test_merge_axes():
    ax = lambda i, name, a, b: dict(id=i, name=name, start=a, end=b, length_m=_metres(*a, *b), names={name})
    got = corridors.merge_axes([ax(1, "A", (-.02, 0), (.02, 0)), ax(2, "", (.0205, 0), (.025, 0)), ax(3, "B", (.0255, 0), (.05, 0)), ax(4, "A", (.02, .002), (.02, .03))])
    assert sorted(got) == [[1, 2], [3], [4]]


def row_of(n, m=1 / 111_195, axis=lambda i: 0, step=1000):
    """n segments of a kilometre in a row to the east, linked both ways; those of one axis for nothing."""
    seg = [(i, axis(i), float(step), i * step * m, 0.0, (i + 1) * step * m, 0.0) for i in range(n)]
    edges = [(a, b, 0.0 if axis(a) == axis(b) else 100.0, float(step)) for i in range(n - 1) for a, b in ((i, i + 1), (i + 1, i))]
    return edges, seg


def test_one_way_search():
    m = 1 / 111_195
    edges, seg = row_of(12)
    g = search.Network(edges, seg, [(7, 0.0, 0.0), (8, 4000 * m, 100 * m), (9, 11_500 * m, 0.0)])
    found = search.one_way(g, 0, (0.0, 0.0), 7)
    assert found and all(p == list(range(len(p))) for _, p, _, _ in found)
    # an end is the nearest anchor within 2 km, another than the start, over 1.5 km from it
    assert {e for e, *_ in found} == {8, 9} and all(abs(len(p) * 1000 - 4000) < 2001 for e, p, _, _ in found if e == 8)
    assert len({int((a + b) // 3000) for _, _, a, b in found}) == 3
    assert search.one_way(g, 99, (0.0, 0.0), 7) == []
    # a sharp turn to another axis isn't taken
    back = search.Network([(0, 1, 10.0, 1000.0)], [(0, 0, 1000.0, 0.0, 0.0, 1000 * m, 0.0), (1, 1, 3000.0, 990 * m, 10 * m, -2000 * m, 20 * m)], [(5, -2000 * m, 0.0)])
    assert search.one_way(back, 0, (900 * m, 0.0), 4) == []
    assert [e for e, *_ in search.one_way(search.Network(edges, seg, [(3, 3000 * m, 0.0)]), 0, (0.0, 0.0), 3)] == []
    assert search.rides_well(search._Path([], frozenset(), 595.0, 405.0, 0.0)) and not search.rides_well(search._Path([], frozenset(), 594.0, 406.0, 0.0))


def test_loop_search():
    m, n = 1 / 111_195, 24
    at = [(2000 * m * math.cos(2 * math.pi * k / n), 2000 * m * math.sin(2 * math.pi * k / n)) for k in range(n)]
    seg = [(k, k // 12, 523.0, *at[k], *at[(k + 1) % n]) for k in range(n)]
    edges = [(k, (k + 1) % n, 0.0 if k // 12 == (k + 1) % n // 12 else 30.0, 523.0) for k in range(n)]
    g = search.Network(edges, seg)
    for radius in search.RADII:
        found = search.loops(g, 0, at[0], radius)
        assert found and all(p[0] == 0 and len(p) >= 6 and len({k // 12 for k in p}) == 2 for p, _, _ in found)
    # a loop over one corridor is none
    assert search.loops(search.Network(edges, [(s, 0, *r) for s, _, *r in seg]), 0, at[0], 2000.0) == []


def test_zones(spark):
    pts = [("cafe", 0.0001 * i, 0.0) for i in range(20)] + [("pub", 0.0001 * i, 0.0) for i in range(5)] + [("pub", 1.0, 1.0)]
    df = spark.createDataFrame(pts, "kind string, lng double, lat double")
    z = zones.lively(df).collect()
    assert len(z) == 1 and z[0]["kind"] == "cafe" and z[0]["points"] == 25 and math.isclose(z[0]["magnetism"], 6 + 25 / 30)
    b = zones.boosted(zones.lively(df), "zone", [(spark.createDataFrame([(0.001, 0.0)], "_x double, _y double"), 500.0, 1.0)])
    assert math.isclose(b.first()["magnetism"], 7 + 25 / 30)
