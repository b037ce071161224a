"""Tracks, pages, names, upserts and templates on hand-made rows."""

from pyspark.sql import functions as F

from rodado.operators import collections as R
from rodado.operators import lines, zones
from rodado.operators.graph import _metres
from rodado.operators.search import Network
from rodado.plans import generate, templates
from rodado.sinks import files as K

M = 1 / 111_195


def line(*xs, y=0.0):
    return [(x * M, y * M) for x in xs]


def test_ride_turns_fills_and_closes():
    # the second segment is drawn the other way, 30 m on; the third lies 300 m on and is reached straight
    out = generate.ride([(None, [line(0, 100), line(230, 130)]), (None, [line(530, 630)])])
    assert out == line(0, 100) + line(130, 230) + line(230, 530) + line(530, 630)
    # an axis is entered by its nearer end, or as it is told
    far = [line(900, 800), line(800, 700)]
    assert generate.ride([(None, [line(0, 690)]), (None, far)])[-1] == line(900)[0]
    assert generate.ride([(True, far)]) == line(800, 700) + line(700, 800) + line(800, 900)
    ring = [line(0, 1000), [(1000 * M, 0.0), (1000 * M, 1000 * M)], [(1000 * M, 1000 * M), (0.0, 900 * M)]]
    assert generate.ride([(False, ring)], loop=True)[-1] == (0.0, 0.0) and generate.ride([(False, ring)])[-1] == (0.0, 900 * M)
    assert generate.ride([(False, [line(0, 5000)])], loop=True)[-1] == line(5000)[0]
    assert generate.ride([]) == [] and generate.ride([(None, [])]) == []


def test_gaps_go_by_roads_and_legs():
    way = line(0, 100, 200, 300, 400, y=20)
    edges = [(a, b, 1.5 * 100, 100.0) for k in range(4) for a, b in ((k, k + 1), (k + 1, k))]
    roads = generate.Roads(edges, list(enumerate(way)))
    gap = [(False, [line(-100, 0), line(400, 500)])]
    assert generate.ride(gap, roads=roads) == line(-100, 0) + way[1:-1] + line(400, 500)
    # too far out of the way: the road costs more than it may
    dear = generate.Roads([(a, b, c, 500.0) for a, b, c, _ in edges], list(enumerate(way)))
    assert generate.ride(gap, roads=dear) == line(-100, 0) + line(0, 400) + line(400, 500)
    legs = {generate.leg_key(line(0)[0], line(400)[0]): line(150, 250, y=5)}
    assert generate.ride(gap, legs=legs) == line(-100, 0) + line(150, 250, y=5) + line(400, 500)
    assert roads.node((1.0, 1.0)) is None and roads.way(line(0)[0], (1.0, 1.0), 100.0) is None


def test_tracks_of(spark):
    pt = lambda ps: [{"lng": float(a), "lat": float(b)} for a, b in ps]
    rows = [(1, "one-way", [(None, [pt(line(0, 100)), pt(line(200, 100))])]), (2, "loop", []), (3, "one-way", None)]
    df = spark.createDataFrame(rows, "route bigint, kind string, axes array<struct<turned:boolean,segs:array<array<struct<lng:double,lat:double>>>>>")
    got = generate.tracks_of(df, legs=spark.createDataFrame([], "key string, points array<struct<lng:double,lat:double>>")).orderBy("ord").collect()
    assert [(r["track"], round(r["lng"] / M)) for r in got] == [(1, 0), (1, 100), (1, 100), (1, 200)]


def test_pages_are_kept_and_renewed(spark):
    s = "id bigint, name string, distance_km double, variants array<struct<name:string,gpx:string,distance_km:double>>, body string, updated_at date"
    old = spark.createDataFrame([(1, "a", 1.0, [("a", "x.gpx", 1.0), ("b", "y.gpx", 9.0)], "written by hand", None), (2, "b", 2.0, [], "https://youtu.be/1\n\n  https://www.youtube.com/2\n", None), (3, "c", 3.0, None, None, None)], s)
    new = spark.createDataFrame([(1, "A", 7.0, ["v"]), (2, "B", 8.0, ["v", "w", "v"]), (4, "D", 5.0, None)], "id bigint, name string, distance_km double, videos array<string>")
    got = {r["id"]: r for r in R.page_upsert(old, new, "id", F.lit("2026-01-02").cast("date")).collect()}
    assert got[1]["name"] == "a" and got[1]["distance_km"] == 7 and got[1]["body"] == "written by hand" and [v["distance_km"] for v in got[1]["variants"]] == [7, 9]
    assert got[2]["body"] == "v\nw" and got[2]["variants"] == [] and str(got[2]["updated_at"]) == "2026-01-02"
    assert got[3]["distance_km"] == 3 and got[3]["updated_at"] is None and got[4]["variants"][0]["gpx"] == "main.gpx" and got[4]["body"] == ""
    texts = {"": True, None: True, " \n": True, "https://youtu.be/x": True, "text\nhttps://youtu.be/x": False, "https://youtu.be/x\ntext": False, "https://vimeo.com/1": False}
    df = spark.createDataFrame([(k,) for k in texts], "b string")
    assert {r["b"]: r["o"] for r in df.select("b", R.only_videos(F.col("b")).alias("o")).collect()} == texts


def test_full_page(spark):
    s = ("route bigint, name string, kind string, total_m double, infra_pct double, start_name string, end_name string, tags array<string>, runs array<struct<name:string,comunas:array<string>,length_m:double,tipos:array<string>,"
         "places:array<string>,widths:array<int>,conditions:array<string>>>, gaps array<struct<from:string,to:string,metres:double>>, videos array<string>")
    runs = [("EJE UNO", ["centro", "norte"], 4000.0, ["bi"], ["parque", "calzada"], [150, 0, 200], ["Buena", "nan", "mala"]), (None, [], 500.0, None, None, None, None)]
    df = spark.createDataFrame([(1, 'Ruta "A"', "one-way", 5200.0, 87.0, "P", "Q", ["x", "y"], runs, [("EJE UNO", "", 700.0), ("a", "b", 20.0)], ["u", "u", " "]), (2, "B", "loop", 1000.0, 95.0, "P", "P", None, runs[1:], None, None)], s)
    got = {r["route"]: r["page"] for r in K.full_page(df, F.lit("2026-01-02")).collect()}
    assert got[1] == """---
name: "Ruta \\"A\\""
status: published
distance_km: 5.2
tags:
  - x
  - y
created_at: "2026-01-02"
updated_at: "2026-01-02"
variants:
  - name: "Ruta \\"A\\""
    gpx: main.gpx
    distance_km: 5.2
---

5,2 kilómetros por Centro y Norte, desde P hasta Q. El 87% del recorrido tiene ciclovía.

### Tramos

**Eje Uno** (Centro y Norte) — 4,0 km, bi, en parque y calzada, 150–200 cm de ancho.
Evaluación: de "mala" a "buena".

**Sin Nombre** — 0,5 km.

### Tramos sin infraestructura

Entre **Eje Uno** y **Siguiente Tramo** — 700 m sin infraestructura ciclista.

Videos a nivel de calle de cada tramo:

u
"""
    assert "Un circuito de 1,0 kilómetros por , saliendo desde P. Prácticamente todo" in got[2]


def test_curated(spark):
    s = "route bigint, name string, kind string, start_name string, end_name string, start_points int, end_points int, total_m double, infra_pct double, condition double, videos bigint, park double, comunas array<string>, gap_max_m double"
    row = lambda i, name, kind, a, b, pts, c: (i, name, kind, a, b, pts, pts, 8000.0, 90.0, 5.0, 0, 0.0, c, 0.0)
    rows = [row(1, "De A a B", "one-way", "A", "B", 9, ["x"]), row(2, "De A a B 2", "one-way", "B", "A", 8, ["y"]), row(3, "De B a A", "one-way", "B", "A", 7, ["y"]), row(4, "Circuito C", "loop", "C", "C", 6, ["x"]), row(5, "Ruta D", "one-way", "D", "E", 5, ["x"])]
    rows += [row(10 + i, f"M{'abcdefghij'[i]}", "mountain", f"s{i}", f"t{i}", 4, [f"z{i}"]) for i in range(10)]
    cells = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (5, 0, 0), (5, 9, 9), (4, 0, 1)], "route bigint, gx bigint, gy bigint")
    got = [r["route"] for r in R.curated(spark.createDataFrame(rows, s), cells).orderBy("place").collect()]
    # 2 has the base name of 1, 3 its pair of anchors, 4 the ground of 1; 5 shares half of its ground, not more; eight mountains
    assert got == [1, 5, *range(10, 18)]
    stats = R.curation_stats(spark.createDataFrame([(3000.0, 80.0, ["a"]), (7000.0, 71.0, ["a", "b"]), (12000.0, 90.0, [])], "total_m double, infra_pct double, comunas array<string>")).first()
    assert tuple(stats) == (3, 1, 1, 1, 2, 80)


def test_names(spark):
    names = spark.createDataFrame([("Río",), ("la  RIO norte",), ("x",), ("",), (None,), ("q",)], "n string")
    items = spark.createDataFrame([(5, "rio"), (2, "El Rio Norte"), (1, "Rio Norte"), (9, "axe"), (7, "xx"), (3, None)], "k bigint, t string")
    got = {r["n"]: r["k"] for r in R.first_name_match(names, "n", items, "t", "k").collect()}
    assert got == {"Río": 5, "la  RIO norte": 1, "x": 7}
    seg = spark.createDataFrame([(1, "g", "Calle", "a", 5.0), (2, "g", "Ñandú", "b", 9.0), (3, "g", "Otra", "c", 9.0), (4, "h", "Sola", "b", 1.0)], "k bigint, g string, nombre string, comuna string, length_m double")
    assert {r["g"]: r["slug"] for r in R.corridor_slugs(seg, "g", "k").collect()} == {"g": "nandu-a-y-mas", "h": "sola-b"}
    votes = spark.createDataFrame([("a", True), ("a", False), ("b", False), ("b", None), ("b", True)], "g string, v boolean")
    assert {r["g"]: r["yes"] for r in R.majority(votes, "g", F.col("v")).collect()} == {"a": True, "b": False}
    kept = R.replaced(items.select("k", "t"), spark.createDataFrame([(5, "new"), (8, "new")], "k bigint, t string"), "k", F.col("k") >= 5)
    assert sorted(tuple(r) for r in kept.collect()) == [(5, "rio"), (7, "xx"), (8, "new"), (9, "axe")]


def test_template_matches_are_coherent(spark):
    seg = [(i, 0 if i < 4 else 1, 1000.0, *line(i * 1000)[0], *line((i + 1) * 1000)[0]) for i in range(8)]
    edges = [(a, b, 0.0, 1000.0) for i in range(7) for a, b in ((i, i + 1), (i + 1, i))]
    g = Network(edges, seg)
    members = {0: [0, 1, 2, 3], 1: [4, 5, 6, 7]}
    at = lambda kind, id_, x, s=None: {"kind": kind, "id": id_, "name": "n", "lng": x * M, "lat": 0.0, "seg_id": s}
    near, far = at("poi", 1, 7500, 7), at("poi", 2, 90_000, 7)
    chosen = templates.coherent([[at("poi", 9, 500, 0)], [far, near], []], g, members)
    assert [m and m["id"] for m in chosen] == [9, 1, None]
    assert templates.path_of(chosen, g, members) == list(range(8))
    axis = templates.coherent([[near], [at("axis", 0, 2000), at("poi", 3, 4600, 4)]], g, members)
    # an axis is worth 5 km: it wins though a place of its name lies nearer; it is entered at its west end
    assert axis[1]["kind"] == "axis" and templates.path_of(axis, g, members) == [7, 6, 5, 4, 3, 2, 1, 0, 1, 2, 3]
    stops = spark.createDataFrame([(1, 0, "Park A", None, None), (1, 1, None, *line(7400)[0]), (2, 0, "nowhere", None, None)], "route bigint, ord int, name string, lng double, lat double")
    s = spark.createDataFrame([(i, a, "Largo", *r) for i, a, *r in seg], "seg_id bigint, axis bigint, axis_name string, length_m double, lng0 double, lat0 double, lng1 double, lat1 double")
    e = spark.createDataFrame(edges, "a bigint, b bigint, cost double, length double")
    found = spark.createDataFrame([(4, "park a", 400 * M, 0.0)], "place_id bigint, name string, lng double, lat double")
    assert [(r["route"], r["path"], r["stops"]) for r in templates.template_paths(stops, s, e, found).collect()] == [(1, list(range(8)), 2)]
    assert _metres(0, 0, 0, 0) == 0


def test_jumps_and_backtracks():
    at = lambda i, path, a, b: lines.Line(i, line(a, b), path=path)
    part = [at(1, 0, 0, 500), at(2, 0, 450, 900), at(3, 0, 300, 700), at(4, 1, 600, 1400), at(1, 1, 0, 500), at(5, 1, 1400, 2000)]
    # 3 begins 600 m behind on its own path and 1 was ridden before; 4 is of another path
    assert [x.id for x in lines.without_backtracks(part)] == [1, 2, 4, 5]
    assert lines.without_backtracks([at(1, 0, 0, 50), at(2, 0, 40, 60)]) != [] and lines.without_backtracks([]) == []
    far = [at(1, 0, 0, 500), at(2, 0, 2000, 2500), at(3, 1, 3400, 4000), at(4, 2, 5100, 6000)]
    assert [[x.id for x in p] for p in lines.split_jumps(far)] == [[1, 2, 3], [4]]


def test_areas_as_zones(spark):
    ring = [(0.0, 0.0), (0.01, 0.0), (0.01, 0.01), (0.0, 0.01)]
    rows = [("a", 0.005, 0.005, 1200.0, ring), ("b", 1.0, 0.0, 600.0, None), ("c", 2.0, 0.0, 400.0, ring), ("d", 3.0, 0.0, None, ring[:2]), ("e", None, None, 700.0, None)]
    df = spark.createDataFrame(rows, "k string, lng double, lat double, extent_m double, ring array<struct<lng:double,lat:double>>")
    got = {r["k"]: (r["cells"], r["magnetism"]) for r in zones.areas(df, "k").collect()}
    assert got["a"] == (100, 9.0) and set(got) == {"a", "b", "d"} and got["b"][1] == 8.0 and got["d"][1] == 7.0 and min(got["b"][0], got["d"][0]) > 10
