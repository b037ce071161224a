"""Queries over the whole of their tables, on small tables and against brute force."""

import datetime as dt
import itertools
import math
import random
import re
import unicodedata

import pytest

import __spark_entry__ as entry
from rodado.functions import geo, rules
from rodado.operators import corridors, graph
from rodado.operators.graph import _metres
from rodado.operators.lines import turn_between
from rodado.plans import suggest


@pytest.fixture
def root(spark, tmp_path):
    """Writes tables given as (name, rows, schema) into a folder that queries read."""

    def put(*tables):
        for name, rows, schema in tables:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return put


def run(spark, name, d):
    return entry.queries()[name](spark, d).collect()


NAMES = [
    "Ciclovía Ñuñoa", "Ａｖｅｎｉｄａ Ｓｕｒ", "Calle​Sur", "Ciclovía  Norte", "Αθήνα", "Ώρα", "Москва й", "Ő Ǎ ṩ", "Paseo – «Río»", "n° 3º", "﻿Calle Uno", "Av.　Dos Tres ",
    "Ꭺ Ꮇ", "ае", "", "ﬁn", "ẞ ß",
]


def test_names_of_any_script(spark, root):
    d = root(("catastro", [(n,) for n in [*NAMES, None, NAMES[0]]], "nombre string"))
    space = r"[\s\x1c-\x1f\x85\xa0﻿]+"
    bare = lambda t: "".join(c for c in unicodedata.normalize("NFD", t) if not "̀" <= c <= "ͯ")
    tidy = lambda t: re.sub(space, " ", t).strip(" ")
    kinds = r"^(AV\.|AVENIDA|CALLE|PASEO|CICLOVIA|CICLOBANDA|SENDERO) +"
    normal = {n: tidy(re.sub(kinds, "", tidy(bare(n.upper())))) for n in NAMES}
    assert {r["nombre"]: r["normal_name"] for r in run(spark, "q_normal_name", d)} == normal
    slug = {n: (re.sub("^-|-$", "", re.sub("[^a-z0-9]+", "-", bare(n.lower()))), tidy(bare(n.lower()))) for n in NAMES}
    assert {r["nombre"]: (r["slug"], r["loose"]) for r in run(spark, "q_slug", d)} == slug


def test_short_steps_count(spark, root):
    at = dt.datetime(2026, 1, 1)
    d = root(("events", [(i, 1 if i < 30 else 2, at + dt.timedelta(minutes=i)) for i in range(31)], "event_id bigint, user_id bigint, ts timestamp"))
    # the walk of the view
    p, x, y = [], 0, 0
    for i in range(30):
        far = 20 if i % 41 == 0 else 1
        x, y = x + (i * 7919 % 401 - 200) * far, y + (i * 104729 % 401 - 200) * far
        p.append((-75.7 + x / 1e5, 45.4 + y / 1e5))
    assert any(_metres(*a, *b) < 150 for a, b in zip(p, p[1:]))
    b = [math.degrees(math.atan2(c - a, e - f)) for (a, f), (c, e) in zip(p, p[1:])]
    turns = [i + 3 for i, (u, v) in enumerate(zip(b, b[1:])) if turn_between(u, v) > 120]
    got = {r["track"]: (r["reversals"], r["first"]) for r in run(spark, "q_reversals", d)}
    assert got[1] == (len(turns), turns[0])
    assert sorted((r["ord"], r["gap_m"]) for r in run(spark, "q_teleport", d) if r["track"] == 1) == [(i, 0) for i in range(2, 30)]
    assert {r["track"] for r in run(spark, "q_valid_trace", d)} == {1, 1_000_001}


W = "way_id bigint, geometry array<struct<lon:double,lat:double>>"


def test_paths_of_any_cost(spark, root):
    # a row of ways with gaps of about 150 m, each link 190, and a way beside that shortens it
    m = 1 / 111_195
    ends = [(0, 100), (250, 350), (500, 600), (750, 850), (1000, 1100), (420, 430)]
    d = root(("ways", [(i + 1, [(a * m, 0.0), (b * m, 0.0)]) for i, (a, b) in enumerate(ends)], W))
    gap = lambda p, q: min(abs(x - y) for x in p for y in q)
    n = range(len(ends))
    best = {(i, j): 0 if i == j else gap(ends[i], ends[j]) + 40 if gap(ends[i], ends[j]) <= 200 else math.inf for i in n for j in n}
    for k in n:
        best |= {(i, j): min(best[i, j], best[i, k] + best[k, j]) for i in n for j in n}
    got = {(r["src"], r["dst"]): r["cost"] for r in run(spark, "q_shortest", d)}
    assert max(got.values()) > 300 and all(abs(c - best[i - 1, j - 1]) < 1 for (i, j), c in got.items())
    # the operator has no bound either
    e = spark.createDataFrame([(i, j, float(best[i, j]), float(best[i, j])) for i in n for j in n if i != j and gap(ends[i], ends[j]) <= 200], "a int, b int, cost double, length double")
    req = spark.createDataFrame([(i, j) for i in n for j in n if i != j], "src int, dst int")
    far = {(r["src"], r["dst"]): r["cost"] for r in graph.paths(req, e).collect()}
    assert far == {k: pytest.approx(best[k]) for k in best if k[0] != k[1]} and max(far.values()) > 600


def test_suggestions_count_places_and_conditions(spark):
    m = 1 / 111_195
    rows = [(k, "A", 1000.0, None, "both", k * 1000 * m, 0.0, (k + 1) * 1000 * m, 0.0, 6.0 + k % 2) for k in range(8)]
    seg = spark.createDataFrame(rows, "seg_id bigint, normal_name string, length_m double, emplazamiento string, bike_direction string, lng0 double, lat0 double, lng1 double, lat1 double, condition double")
    kind = max(rules.ANCHOR_POINTS, key=rules.ANCHOR_POINTS.get)
    sights = spark.createDataFrame([(1, "a", kind, 0.0, 0.0), (2, "b", kind, 8000 * m, 0.0), (3, "c", "other", 4000 * m, 100 * m), (4, "d", "toilets", 0.0, 0.0)], "place_id bigint, name string, category string, lng double, lat double")
    r = suggest.suggest(seg, sights).collect()
    # all candidates ride the one corridor, so one is left: from one end to the other
    assert len(r) == 1 and {r[0]["start"], r[0]["end"]} == {1, 2} and r[0]["segments"] == 8 and r[0]["kind"] == "one-way"
    x = r[0]
    assert x["start_points"] == x["end_points"] == rules.ANCHOR_POINTS[kind] + 2 and x["pois"] == 1 and x["places"] == ["c"] and x["condition"] == 6.5
    assert x["name"] in ("De a a b", "De b a a") and x["infra_pct"] == 100 and x["gap_m"] == 0
    # 100/10 + 6.5 + 24/4 + 3 for 8 km of one corridor + 1 for 8 km + 2 for no detour + 1.5 for one kind of place
    assert x["score"] == 30.0
    plain = suggest.suggest(seg.drop("condition"), sights).first()
    assert plain["score"] == 23.5 and suggest.suggest(seg, sights.limit(0)).count() == 0


def test_gates(spark):
    """Two corridors 4 km apart, and one that runs back over itself: neither is a route; without gates both are."""
    m = 1 / 111_195
    line = lambda i, axis, x0, x1, y=0.0: (i, axis, f"n{axis}", float(abs(x1 - x0)), None, x0 * m, y * m, x1 * m, y * m, None, None, None)
    seg = spark.createDataFrame([line(1, 1, 0, 3000), line(2, 2, 7000, 9900), line(3, 3, 3000, 0, 60.0)], "seg_id bigint, axis bigint, axis_name string, length_m double, emplazamiento string, lng0 double, lat0 double, lng1 double, lat1 double, condition double, comuna string, video string")
    found = spark.createDataFrame([(1, "a", "park", 0.0, 0.0, 0.0, 9), (2, "b", "park", 9000 * m, 0.0, 0.0, 9)], "place_id bigint, name string, category string, lng double, lat double, infra_m double, score int")
    c = spark.createDataFrame([(10, 1, 2, [1, 2]), (11, 1, 2, [1, 3]), (12, 1, 2, [1])], "route bigint, start bigint, end bigint, path array<bigint>")
    assert [r["route"] for r in suggest.assembled(c, seg, found).collect()] == [12]
    every = {r["route"]: r for r in suggest.assembled(c, seg, found, gates=False).collect()}
    assert set(every) == {10, 11, 12} and abs(every[10]["gap_max_m"] - 4000) < 1 and every[10]["runs"] == 2
    assert every[10]["infra_pct"] == 60 and every[12]["detour"] == 1


def test_zone_graph_and_routes(spark):
    m = 1 / 111_195
    rows = [(k, k // 4, f"n{k // 4}", 1000.0, None, k * 1000 * m, 0.0, (k + 1) * 1000 * m, 0.0, None, None, None) for k in range(8)]
    seg = spark.createDataFrame(rows, "seg_id bigint, axis bigint, axis_name string, length_m double, emplazamiento string, lng0 double, lat0 double, lng1 double, lat1 double, condition double, comuna string, video string")
    edges = spark.createDataFrame([(a, b, 0.0 if a // 4 == b // 4 else 50.0, 1000.0) for k in range(7) for a, b in ((k, k + 1), (k + 1, k))], "a bigint, b bigint, cost double, length double")
    zones = spark.createDataFrame([(1, 500 * m, 0.0), (2, 3500 * m, 0.0), (3, 7500 * m, 10 * m), (4, 30_000 * m, 0.0)], "zone bigint, clng double, clat double")
    cells = zones.select("zone", geo.cell("clng", 0.002).alias("gx"), geo.cell("clat", 0.002).alias("gy"))
    e = {(r["a"], r["b"]): r for r in suggest.zone_graph(zones, cells, seg, edges).collect()}
    assert set(e) == {(1, 2), (1, 3), (2, 3)}
    assert e[1, 3]["path"] == list(range(8)) and e[1, 3]["along"] == [2] and e[1, 3]["length_m"] == 7050 and abs(e[1, 3]["infra_fraction"] - 6 / 7) < 1e-9
    found = spark.createDataFrame([(7, "a", 500 * m, 0.0, 9), (8, "b", 7400 * m, 0.0, 8), (9, "c", 7500 * m, 0.0, 4)], "place_id bigint, name string, lng double, lat double, score int")
    got = suggest.zone_routes(zones, suggest.zone_graph(zones, cells, seg, edges), found).collect()
    assert [(r["source"], r["start"], r["end"], r["zones"]) for r in got] == [("one-way", 7, 8, [1, 2, 3])]


def test_every_segment_is_chained(spark, root):
    # a road, a carriageway beside it, a short piece and a closed one, all of one name, and a short road by itself
    m = 1 / 111_195
    at = lambda *p: [(x * m, y * m) for x, y in p]
    ways = [(1, at((0, 0), (1000, 0))), (2, at((1000, 10), (10, 10))), (3, at((1000, 0), (1020, 0))), (4, at((1020, 0), (1060, 40), (1020, 0)))]
    ways = [(i, p, {"name": "Doble", "highway": "cycleway"}) for i, p in ways] + [(5, at((9000, 0), (9020, 0)), {"highway": "cycleway"})]
    d = root(("ways", ways, W + ", tags map<string,string>"))
    assert sorted(r["seg_id"] for r in run(spark, "q_chained", d)) == [1, 2, 3, 4, 5]
    assert {r["a"] for r in run(spark, "q_segment_edges", d)} == {1, 2, 3, 4}


def test_groups_of_axes_change_no_merge(spark):
    rnd = random.Random(7)
    m = 1 / 111_195
    rows = []
    for i in range(120):
        x, y, n = rnd.uniform(0, 9000) * m, rnd.uniform(0, 600) * m, rnd.choice([300, 900, 1500])
        rows.append((i, rnd.choice(["A", "B", "", ""]), float(n), x, y, x + n * m, y + rnd.uniform(-60, 60) * m))
    df = spark.createDataFrame(rows, "axis bigint, name string, length_m double, lng0 double, lat0 double, lng1 double, lat1 double")
    whole = corridors.merge_axes([dict(id=i, name=n, start=(a, b), end=(c, e), length_m=ln, names={n}) for i, n, ln, a, b, c, e in rows])
    got = {}
    for r in corridors.merged_axes(df.join(corridors.mergeable(df), "axis"), "group").collect():
        got.setdefault(r["corridor"], []).append(r["axis"])
    assert sorted(map(sorted, got.values())) == sorted(whole) and len(whole) < 115


def test_axes_merge_and_places_conflict_across_cells(spark, root):
    # a road that goes on under no name on the other side of a cell's edge, and two places on both sides
    m = 1 / 111_195
    at = lambda *p: [(x * m, 0.01) for x in p]
    edge = 0.05 / m
    ways = [(1, at(edge - 2000, edge - 900), {"name": "A", "highway": "cycleway"}), (2, at(edge - 900, edge - 50), {"name": "A", "highway": "cycleway"}), (3, at(edge + 50, edge + 600), {"highway": "cycleway"})]
    day = dt.datetime(2026, 1, 1)
    pl = [(1, "p", "cafe", 0.01, 0.05 - 100 * m, day), (2, "q", "bar", 0.01, 0.05 + 100 * m, day), (3, "r", "bar", 0.01, 0.09, day)]
    d = root(("ways", ways, W + ", tags map<string,string>"), ("places", pl, "place_id bigint, name string, category string, lat double, lng double, loaded_at timestamp"))
    assert len({r["corridor"] for r in run(spark, "q_merged_axes", d)}) == 1
    assert {r["place_id"] for r in run(spark, "q_select_diverse", d)} in ({1, 3}, {2, 3})


def test_loops_over_lively_zones(spark, root):
    m = 1 / 111_195
    day = dt.datetime(2026, 1, 1)
    spots = [(10, 10), (5000, 200), (9000, 4000), (300, 8000), (4000, 7000), (30000, 10)]
    at = [((x // 556 + 0.5) * 0.005, (y // 556 + 0.5) * 0.005) for x, y in spots]
    pl = [(i * 10 + k, "n", "cafe", y, x, day) for i, (x, y) in enumerate(at) for k in range(4)] + [(900, "n", "viewpoint", 0.2, 0.2, day)]
    d = root(("places", pl, "place_id bigint, name string, category string, lat double, lng double, loaded_at timestamp"))
    far = lambda a, b: _metres(*at[a], *at[b])
    ok = lambda *p: all(far(a, b) <= 10_000 for a, b in p)
    n = range(len(at))
    pairs = [p for p in itertools.combinations(n, 2) if ok(p)]
    assert len(run(spark, "q_zone_pairs", d)) == len(pairs) == 10

    def area(a, b, c):
        (ax, ay), (bx, by), (cx, cy) = at[a], at[b], at[c]
        return abs((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))

    three = [t for t in itertools.combinations(n, 3) if ok(*itertools.combinations(t, 2)) and 5000 <= far(t[0], t[1]) + far(t[1], t[2]) + far(t[0], t[2]) <= 35_000 and area(*t) >= 0.001]
    assert len(run(spark, "q_triangles", d)) == len(three) > 0

    def spread(t):
        mx, my = (sum(at[i][k] for i in t) / 4 for k in (0, 1))
        return len({(at[i][0] >= mx, at[i][1] >= my) for i in t}) >= 3

    four = [t for t in itertools.combinations(n, 4) if ok(*zip(t, t[1:] + t[:1])) and 10_000 <= sum(far(x, y) for x, y in zip(t, t[1:] + t[:1])) <= 50_000 and spread(t)]
    assert len(run(spark, "q_rectangles", d)) == len(four) > 0
