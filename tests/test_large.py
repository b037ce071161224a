"""What larger tables need: plans and results that hold when a table doesn't fit one process."""

import random
import re

import pytest

from rodado.operators import collections as R
from rodado.operators import corridors, graph, lines, nearby, search, spatial, zones
from rodado.plans import generate, score_routes, templates


def final_plan(df):
    """The plan that ran, as adaptive execution left it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_zone_cells_are_not_sent_out(spark):
    places = spark.createDataFrame([(i, i / 1000, 0.0) for i in range(20)], "z bigint, lng double, lat double").dropDuplicates(["z"])
    points = spark.createDataFrame([(7, 0.0005, 0.0), (8, 5.0, 5.0)], "t bigint, lng double, lat double")
    cells = zones.buffered(places, "z", 200.0)
    got = zones.zones_along(points, cells, "t", "z")
    assert "BroadcastHashJoin" not in final_plan(got)
    assert {tuple(r) for r in got.collect()} == {(7, r["z"]) for r in cells.where("gx = 0 and gy = 0").collect()} != set()


def test_windows_of_names_are_not_sent_out(spark):
    names = spark.createDataFrame([("Ruta Río Norte",), ("ruta rio norte",), ("Ñu",), ("b",), (None,)], "n string")
    items = spark.createDataFrame([(5, "rio"), (2, "La Ruta Rio Norte Larga"), (3, "RIO"), (8, "el nu"), (9, "abc")], "k bigint, t string")
    got = R.first_name_match(names, "n", items, "t", "k")
    assert not re.search(r"BroadcastHashJoin \[_w", final_plan(got))
    assert {r["n"]: r["k"] for r in got.collect()} == {"Ruta Río Norte": 2, "ruta rio norte": 2, "Ñu": 8, "b": 9}


def test_names_of_crowded_spots(spark, monkeypatch):
    rnd = random.Random(3)
    spots = [(x / 100, y / 100) for x in range(4) for y in range(3)]
    pl = [(rnd.choice("abcdefghijklmnop") * rnd.randint(1, 3), *rnd.choice(spots)) for _ in range(300)] + [(None, 0.0, 0.0), ("far", 9.0, 9.0), ("off", None, 1.0)]
    pts = [(t, i, *rnd.choice(spots)) for t in range(30) for i in range(rnd.randint(1, 6))] + [(99, 0, 5.0, 5.0)]
    places = spark.createDataFrame(pl, "name string, _x double, _y double")
    samples = spark.createDataFrame(pts, "track bigint, ord bigint, lng double, lat double")
    want = {t: len({n for n, x, y in pl if n and (x, y) in {p[2:] for p in pts if p[0] == t}}) for t in range(30)}
    rows = []
    monkeypatch.setattr(score_routes, "within", lambda p, c, *a, **k: rows.append(c.count()) or nearby.within(p, c, *a, **k))
    assert {r["track"]: r["pois"] for r in score_routes._near_names(samples, places, 500.0).collect()} == want
    assert rows == [len({p[1:] for p in pl if p[0] and p[1] is not None}) + 1]  # spots meet the samples, not names; one has no place
    sets = spark.createDataFrame([([1, 2],), ([2],), ([1, 2, 3],)], "_spots array<bigint>")
    at = spark.createDataFrame([(1, 7), (1, 8), (2, 8), (2, 9), (3, 9)], "_spot bigint, _name bigint")
    assert {tuple(r["_spots"]): r["pois"] for r in score_routes._names_of(sets, at, 2).collect()} == {(1, 2): 3, (2,): 2, (1, 2, 3): 3}


def test_paths_component_by_component(spark, monkeypatch):
    rnd = random.Random(5)
    far = 2**61
    blocks = [[(far + k * 100 + i, far + k * 100 + rnd.randrange(8)) for i in range(8) for _ in range(2)] for k in range(12)]
    e = [(a, b, float(rnd.randint(1, 9)), 1.0) for g in blocks for a, b in g if a != b]
    req = [(a, b) for g in blocks for a, b in rnd.sample([(x, y) for x, _ in g for _, y in g], 9)] + [(far, far + 100), (5, 5), (5, 6)]
    g = graph.Graph(e)
    want = [(a, b, *r) for a, b in req if (r := g.dijkstra(a, [b]).get(b))]
    monkeypatch.setattr(graph, "GRAPH_EDGES", 30)  # the whole graph has more, no component has
    monkeypatch.setattr(graph, "TASK_STARTS", 2)
    edges = spark.createDataFrame(e, "a bigint, b bigint, cost double, length double")
    got = graph.paths(spark.createDataFrame(req, "src bigint, dst bigint"), edges).collect()
    assert sorted((r["src"], r["dst"], r["cost"], r["length"], r["path"]) for r in got) == sorted(want)
    monkeypatch.setattr(graph, "GRAPH_EDGES", 5)
    with pytest.raises(ValueError, match="component"):
        graph.paths(spark.createDataFrame(req, "src bigint, dst bigint"), edges)


def test_windows_of_fuzzy_names_are_not_sent_out(spark):
    a = spark.createDataFrame([(1, "Parque Central"), (2, "x")], "i bigint, n string")
    b = spark.createDataFrame([(7, "El Parque Central"), (8, "parque central"), (9, "otro")], "j bigint, m string")
    got = R.fuzzy_names(a, "n", b, "m")
    assert not re.search(r"BroadcastHashJoin \[_w", final_plan(got))
    assert {(r["i"], r["j"]) for r in got.collect()} == {(1, 7), (1, 8)}


def test_corridors_are_rows_not_groups(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.randrange(12) if i < 60 else i, *(rnd.uniform(0, 0.01) for _ in range(4))) for i in range(90)]
    df = spark.createDataFrame(rows, "seg_id bigint, axis bigint, lng0 double, lat0 double, lng1 double, lat1 double")
    got = corridors.chained(df, "axis")
    assert "FlatMapGroups" not in final_plan(got)
    want = set()
    for axis in {r[1] for r in rows}:
        o = lines.order_lines([lines.Line(i, [(a, b), (c, d)]) for i, x, a, b, c, d in rows if x == axis], every=True)
        want |= {(axis, k, x.id, x.turned, graph._metres(*o[k - 1].end, *x.start) if k else 0.0) for k, x in enumerate(o)}
    assert {tuple(r) for r in got.collect()} == want and len(want) == 90


def test_searches_component_by_component(spark, monkeypatch):
    m = 1 / 111_195
    seg, edges, at = [], [], []
    for k in range(6):  # rows of ten segments, two of a corridor, far from one another
        x0, y0 = k * 0.5, k * 0.3
        seg += [(k * 10 + i, k * 10 + i // 2 * 2, 1000.0, x0 + i * 1000 * m, y0, x0 + (i + 1) * 1000 * m, y0) for i in range(10)]
        edges += [(k * 10 + i, k * 10 + j, 5.0 * (i // 2 != j // 2), 1000.0) for i in range(10) for j in (i - 1, i + 1) if 0 <= j < 10]
        at += [(100 + k * 3 + i, x0 + x * m, y0 + 90 * m) for i, x in enumerate((100, 4100, 9300))]
    starts = [(p, x, y, s) for p, x, y in at for s in range((p - 100) // 3 * 10, (p - 100) // 3 * 10 + 10, 3)]
    monkeypatch.setattr(graph, "GRAPH_EDGES", 25)  # the whole has 108 edges, a component 18
    monkeypatch.setattr(search, "GRAPH_EDGES", 25)
    monkeypatch.setattr(search, "TASK_SEARCHES", 5)
    frames = [spark.createDataFrame(*x) for x in (
        (starts, "place_id bigint, lng double, lat double, seg_id bigint"), (seg, "seg_id bigint, axis bigint, length_m double, lng0 double, lat0 double, lng1 double, lat1 double"),
        (edges, "a bigint, b bigint, cost double, length double"), (at, "place_id bigint, lng double, lat double"))]
    g = search.Network(edges, seg, at)
    want = {(p, e, s, *r[0], *r[1:]) for p, x, y, s in starts for e, *r in search.one_way(g, s, (x, y), p, search.rides_well)}
    got = search.search_routes(*frames).collect()
    assert {(r["start"], r["end"], r["seg_id"], *r["path"], r["on_m"], r["gap_m"]) for r in got} == want and len(got) == len(want) > 20
    around = sorted((p, p, s, *r) for p, x, y, s in starts for d in search.RADII for r in search.loops(g, s, (x, y), d, search.rides_well))
    assert sorted((r["start"], r["end"], r["seg_id"], r["path"], r["on_m"], r["gap_m"]) for r in search.search_routes(*frames, "loops").collect()) == around
    monkeypatch.setattr(graph, "GRAPH_EDGES", 9)
    with pytest.raises(ValueError, match="component"):
        search.search_routes(*frames)


def test_gaps_over_roads_component_by_component(spark, monkeypatch):
    rnd = random.Random(11)
    m = 1 / 111_195
    ways = []
    for k in range(8):  # crooked roads with branches, far from one another
        x0 = k * 0.1
        ways += [(k * 10 + j, [{"lng": x0 + i * 100 * m, "lat": (j * 150 + rnd.choice((0, 30))) * m} for i in range(12)], rnd.choice(("residential", "cycleway"))) for j in range(2)]
        ways += [(k * 10 + 5, [ways[-2][1][4], ways[-1][1][4]], "path")]
    df = spark.createDataFrame(ways, "way_id bigint, points array<struct<lng:double,lat:double>>, highway string")
    nodes, edges = graph.road_graph(df)
    pt = lambda x, y: {"lng": x, "lat": y * m}
    routes = [(k, "one-way", [(None, [[pt(k % 8 * 0.1 + rnd.uniform(-50, 1200) * m, rnd.uniform(-60, 210)) for _ in range(2)] for _ in range(4)])]) for k in range(24)] + [(99, "loop", None)]
    r = spark.createDataFrame(routes, "route bigint, kind string, axes array<struct<turned:boolean,segs:array<array<struct<lng:double,lat:double>>>>>")
    whole = generate.Roads([tuple(e) for e in edges.select("a", "b", "cost", "length").collect()], [(n["id"], (n["lng"], n["lat"])) for n in nodes.collect()])
    want = {(t, i, *p) for t, k, axes in routes for i, p in enumerate(generate.ride([(u, [[(p["lng"], p["lat"]) for p in s] for s in segs]) for u, segs in axes or ()], k == "loop", whole))}
    straight = sum(len(generate.ride([(u, [[(p["lng"], p["lat"]) for p in s] for s in segs]) for u, segs in axes or ()], k == "loop")) for _, k, axes in routes)
    assert len(want) > straight  # some gaps go by roads
    monkeypatch.setattr(graph, "GRAPH_EDGES", 60)  # the whole has over 300 edges, a component about 46
    monkeypatch.setattr(graph.collect_graph, "__defaults__", (None, 60))
    assert edges.count() > 300
    for roads in ((nodes, edges), (nodes, edges, graph.road_components(df))):
        assert {tuple(x) for x in generate.tracks_of(r, roads).collect()} == want


def test_distances_to_a_goal_are_told_once(spark, monkeypatch):
    rnd = random.Random(2)
    at = {i: (rnd.uniform(0, 0.02), rnd.uniform(0, 0.02)) for i in range(40)}
    e = [(a, b, rnd.uniform(0, 300), rnd.uniform(0, 900)) for a in at for b in rnd.sample(range(40), 4) if a != b]
    told = []
    metres = graph._metres
    monkeypatch.setattr(graph, "_metres", lambda *p: told.append(p) or metres(*p))
    g = graph.Graph(e, at.items())
    got = {(a, 7): g.a_star(a, 7) for a in at}
    assert len(told) <= len(at)
    fresh = {(a, 7): graph.Graph(e, at.items()).a_star(a, 7) for a in at}
    assert got == fresh and g.a_star(3, 9) == graph.Graph(e, at.items()).a_star(3, 9) and sum(x is not None for x in got.values()) > 30


def test_templates_component_by_component(spark, monkeypatch):
    rnd = random.Random(13)
    m = 1 / 111_195
    seg, edges = [], []
    for k in range(6):  # rows of ten segments, corridors of two or three, far from one another; the last two rows share a name
        x0, y0, at = k * 0.5, k * 0.3, k * 10
        axis = [at + (0, 0, 2, 2, 2, 5, 6, 6, 8, 8)[i] for i in range(10)]
        seg += [(at + i, axis[i], f"Calle {'ABCDEE'[k]}{axis[i] % 10}", 1000.0, x0 + i * 1000 * m, y0, x0 + (i + 1) * 1000 * m, y0) for i in range(10)]
        edges += [(at + i, at + j, 5.0, 1000.0) for i in range(10) for j in (i - 1, i + 1) if 0 <= j < 10 and (i, j) != (4, 5)]
    found = [(900 + i, f"Plaza {'XYZ'[i % 3]}", rnd.randrange(6) * 0.5 + rnd.uniform(0, 0.09), rnd.randrange(6) * 0.3) for i in range(20)]
    names = [None, "nowhere", "plaza x", "Plaza Y", "PLAZA Z", *(f"calle {a}{i}" for a in "abcde" for i in (0, 2, 5, 6, 8))]
    stops = []
    for r in range(150):
        for o in range(rnd.randint(1, 6)):
            x = rnd.randrange(6)
            stops.append((r, o, rnd.choice(names), *rnd.choice(((None, None), (x * 0.5 + rnd.uniform(0, 0.09), x * 0.3), (999.0, 0.0), (100.0, -60.0)))))
    frames = [spark.createDataFrame(*f) for f in (
        (stops, "route bigint, ord int, name string, lng double, lat double"), (seg, "seg_id bigint, axis bigint, axis_name string, length_m double, lng0 double, lat0 double, lng1 double, lat1 double"),
        (edges, "a bigint, b bigint, cost double, length double"), (found, "place_id bigint, name string, lng double, lat double"))]
    # what one process finds that holds the whole network
    g = search.Network(edges, [(s, a, *r) for s, a, _, *r in seg])
    members, named = {}, {}
    for s, a, n, _, x0, y0, x1, y1 in seg:
        members.setdefault(a, []).append(s)
        named.setdefault((a, n.lower()), []).append(((x0 + x1) / 2, (y0 + y1) / 2))
    near = lambda x, y: min(seg, key=lambda s: (graph._metres(x, y, *g.at[s[0]]), s[0]))[0] if abs(x) <= 180 else None
    want, several = {}, 0
    for r in range(150):
        options = []
        for _, _, name, x, y in sorted(s for s in stops if s[0] == r):
            o = [("axis", a, sum(p[0] for p in v) / len(v), sum(p[1] for p in v) / len(v), None) for (a, n), v in named.items() if name and n == name.lower()]
            o += [("poi", i, u, v, near(u, v)) for i, n, u, v in found if name and n.lower() == name.lower()]
            o = sorted(o) or ([("place", None, x, y, near(x, y))] if x is not None else [])
            options.append([dict(zip(("kind", "id", "lng", "lat", "seg_id"), m)) for m in o])
        chosen = templates.coherent(options, g, members)
        if sum(c is not None for c in chosen) > 1 and (path := templates.path_of(chosen, g, members)):
            want[r] = path, sum(c is not None for c in chosen)
            several += len({s // 10 for s in path}) > 1
    assert several > 20 and len(want) > several
    monkeypatch.setattr(graph, "GRAPH_EDGES", 25)  # the whole has 102 edges, a component 17
    monkeypatch.setattr(graph.collect_graph, "__defaults__", (None, 25))
    monkeypatch.setattr(templates, "TASK_TEMPLATES", 7, raising=False)
    monkeypatch.setattr(templates, "TASK_STOPS", 40, raising=False)
    got = templates.template_paths(*frames).collect()
    assert {r["route"]: (r["path"], r["stops"]) for r in got} == want and len(got) == len(want)
    monkeypatch.setattr(graph, "GRAPH_EDGES", 9)
    with pytest.raises(ValueError, match="component"):
        templates.template_paths(*frames)


def test_nearest_of_far_points(spark):
    rnd = random.Random(4)
    targets = [(i, *rnd.choice(((-72.0, -36.0), (179.5, 60.0), (-179.9, 60.0), (10.0, 89.0)))) for i in range(120)]
    targets = [(i, x + rnd.uniform(0, 0.4), y + rnd.uniform(0, 0.4)) for i, x, y in targets] + [(500, -72.0, -36.0), (400, -72.0, -36.0), (501, None, None)]
    points = [(k, rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for k in range(60)] + [(90, -72.0, -36.0), (91, 0.0, 90.0), (92, 400.0, 0.0), (93, None, 0.0)]
    p = spark.createDataFrame(points, "k bigint, lng double, lat double")
    t = spark.createDataFrame(targets, "t bigint, _x double, _y double")
    got = {tuple(r) for r in spatial.nearest_far(p, t, "k", "t").collect()}
    assert {r[0]: r[1] for r in got}[90] == 400 and len(got) == 62
    assert got == {(r["k"], r["t"], r["metres"]) for r in spatial.nearest(p, t, "k", "t", 1, 250.0).collect()}


def test_nearest_one_as_nearest(spark):
    rnd = random.Random(6)
    spots = [(rnd.uniform(-0.02, 0.02), rnd.uniform(-0.02, 0.02)) for _ in range(60)]
    p = spark.createDataFrame([(i, *rnd.choice(spots)) for i in range(80)] + [(90, 0.5, 0.5), (91, None, 0.0), (92, 0.02, 0.04)], "k bigint, lng double, lat double")
    t = spark.createDataFrame([(i, *rnd.choice(spots)) for i in range(50)], "t bigint, _x double, _y double")
    got = {tuple(r) for r in spatial.nearest_one(p, t, "k", "t", (400.0, 3200.0)).collect()}
    want = {(r["k"], r["t"], r["metres"]) for r in spatial.nearest(p, t, "k", "t", 1, 400.0, 3200.0).collect()}
    assert got == want and len(got) == 81 and len({m > 400 for _, _, m in got}) == 2


def test_names_that_begin_alike(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(2, 5)))
    text = lambda: " ".join(["Avenida", *(word() for _ in range(rnd.randint(1, 3)))])
    a, b = [(i, text()) for i in range(150)] + [(200, ""), (201, None)], [(i, text()) for i in range(150)] + [(300, ""), (301, "Avenida"), (302, None)]
    a += [(400 + i, n[3:]) for i, n in b[:40]]
    fits = lambda x, y: x == y or any(len(p) >= 8 and len(p) < len(q) and len(p) / len(q) >= 0.5 and p in q for p, q in ((x, y), (y, x)))
    want = sorted((i, j) for i, x in a for j, y in b if x is not None and y is not None and fits(x.lower().strip(), y.lower().strip()))
    got = R.fuzzy_names(spark.createDataFrame(a, "i bigint, x string"), "x", spark.createDataFrame(b, "j bigint, y string"), "y")
    assert sorted((r["i"], r["j"]) for r in got.collect()) == want and len(want) > 200
