import datetime

import numpy as np

from rodado.llm import linkage as L
from rodado.llm.names import town_key, with_name_words

DEG = 1 / 111_194.93
CAT = "feature_id bigint, nombre string, comuna string, geometry struct<type:string,coordinates:array<array<array<double>>>>, loaded_at date, words int"
WAY = "way_id bigint, geometry array<struct<lon:double,lat:double>>, tags map<string,string>, town int"


def feature(i, name, x, y, length=400.0, comuna="sur", extra=(), lines=1):
    pts = [[float(x + k * length / 4 * DEG / np.cos(np.radians(y))), y, *extra] for k in range(5)]
    return (i, name, comuna, ("MultiLineString", [pts] * lines if lines == 1 else [pts[:3], pts[2:]]), datetime.date(2020, 1, 1), 0)


def way(i, name, x, y, length=400.0, tags=None, off=0.0, turn=False):
    pts = [(float(x + k * length / 3 * DEG / np.cos(np.radians(y))), y + off * DEG) for k in range(4)]
    return (i, pts[::-1] if turn else pts, {"highway": "cycleway", **({"name": name} if name else {}), **(tags or {})}, 0)


def world():
    cat, ways = [], []
    for i in range(60):
        x, y = -71.0 + (i % 10) * 0.03, -36.0 + (i // 10) * 0.03
        cat.append(feature(i, f"Calle Aria {i} Norte", x, y, lines=1 + i % 2))
        ways.append(way(1000 + i, f"aria {i} norte", x, y, off=3.0 + i % 5, turn=i % 2 == 0))
        ways.append(way(2000 + i, f"Otra Cosa {i}", x, y, off=28.0))  # beside it
        ways.append(way(3000 + i, f"aria {i} norte", x + 0.0046, y, off=3.0))  # goes on
        ways.append(way(4000 + i, f"aria {i} norte", x, y, off=6.0, tags={"highway": "secondary"}))  # no cycling
    return cat, ways


def test_links(spark):
    cat, ways = world()
    odd = [(900, None, None, None, None, None), (901, "x", None, ("MultiLineString", [[[None, 1.0], [5.0], []], None]), None, None), (None, "y", "z", cat[0][3], None, None)]
    c = spark.createDataFrame([*cat, *cat[:7], *odd, feature(800, None, -70.0, -35.0, comuna=None, extra=(12.5,))], CAT)
    w = spark.createDataFrame([*ways, *ways[:9], (9000, None, None, None), (9001, [], {}, None), (9002, [(None, 1.0)], {"highway": "cycleway"}, None), way(9100, None, -70.0, -35.0, off=2.0)], WAY)
    got = {(r["feature_id"], r["way_id"]) for r in L.same_facilities(c, w).collect()}
    assert got == {(i, 1000 + i) for i in range(60)} | {(800, 9100)}
    links = {(r["feature_id"], r["way_id"]): r["confidence"] for r in L.link(c, w).collect()}
    assert len(links) == len(set(links)) and all(0 <= v <= 1 for v in links.values())
    assert links[(3, 2003)] < 0.1 < 0.9 < links[(3, 1003)]


def test_empty(spark):
    c, w = spark.createDataFrame([], CAT), spark.createDataFrame([], WAY)
    assert L.same_facilities(c, w).collect() == []
    cat, ways = world()
    assert L.same_facilities(spark.createDataFrame(cat[:3], CAT), w).collect() == []


def test_run_along_against_brute_force():
    rnd = np.random.default_rng(1)
    f, w = [], []
    for _ in range(30):
        p = np.cumsum(rnd.normal(0, 3e-4, (6, 2)), 0) + [-71, -36]
        q = p + rnd.normal(0, 1e-4, 2)
        seg = lambda a: np.hstack([(u := np.round(a * L.UNITS).astype(np.int32))[:-1], np.diff(u, axis=0)]).ravel()
        f.append(seg(p))
        w.append(seg(q))
    reach = np.where(np.arange(30) % 2, L.REACH_M, L.NEAR_M)
    whole = L.run_along(f, w, reach)
    for i in range(30):
        one = L.run_along(f[i : i + 1], w[i : i + 1], reach[i : i + 1])
        assert np.allclose([x[i] for x in whole], [x[0] for x in one], equal_nan=True)


def test_work_in_small_parts(monkeypatch):
    p = np.round(np.array([[-71, -36, -0.003, 0], [-71.003, -36, -0.002, -0.001]]) * L.UNITS).astype(np.int32).ravel()
    far = np.full(2, L.REACH_M)
    a = L.run_along([p, p], [p, p], far)
    monkeypatch.setattr(L, "WORK", 1)
    assert all(np.allclose(x, y) for x, y in zip(a, L.run_along([p, p], [p, p], far)))
    assert np.allclose(a[0], 1) and np.allclose(a[1], 0)


def test_blocking_misses_no_near_pair(spark):
    """Pairs of lines in any direction: the first pass finds those that run alike within its reach, the second those of
    one name in the wider one."""
    rnd = np.random.default_rng(5)
    m = 1 / 111_195
    cat, ways = [], []
    for i in range(60):
        x, y, a, off = -71 + i * 0.05, -36.0, rnd.uniform(0, 2 * np.pi), (25.0, 40.0)[i % 2]
        east = m / np.cos(np.radians(y))
        at = lambda s, o: [float(x + (s * np.cos(a) - o * np.sin(a)) * east), float(y + (s * np.sin(a) + o * np.cos(a)) * m)]  # noqa: E731,B023
        named = "Calle Larga" if i % 4 == 1 else None
        cat.append((i, named, None, ("MultiLineString", [[at(0, 0), at(300, 0)]])))
        ways.append((i, [tuple(at(280, off)), tuple(at(10, off))], {"highway": "cycleway", **({"name": "Larga"} if named else {})}))
    c = spark.createDataFrame(cat, "feature_id bigint, nombre string, comuna string, geometry struct<type:string,coordinates:array<array<array<double>>>>")
    w = spark.createDataFrame(ways, "way_id bigint, geometry array<struct<lon:double,lat:double>>, tags map<string,string>")
    f, v = L.survey_lines(c), L.way_lines(w)
    got = {r["feature_id"]: r["share"] for r in L.compare(L.candidate_pairs(f, v), f, v).where("feature_id = way_id").collect()}
    assert {i for i, s in got.items() if s and s > 0.9} == {i for i in range(60) if i % 2 == 0 or i % 4 == 1}


def test_estimates_converge():
    patterns = [((1, 1, 1, 1, 1), 500), ((4, 2, 5, 8, 1), 500), ((0, 0, 1, 1, 1), 50), ((4, 1, 1, 6, 2), 60)]
    post, share, m, u = L.expectation_maximisation(patterns, [0.9, 0.1, 0.9, 0.1])
    assert post[0] > 0.99 and post[1] < 0.01 and post[2] > 0.9 and post[3] < 0.2 and 0.4 < share < 0.6
    assert L.expectation_maximisation([], [])[0] == []


def test_names(spark):
    rows = [("CICLOVÍA AV. GRAL. PÉREZ - TRAMO Nº 2",), ("Pérez, General",), ("Сiclovíа Gеneral Pérez",), ("S/N",), ("Sin nombre",), (None,), ("",), ("Calle",)]
    got = [r["w"] for r in with_name_words(spark.createDataFrame(rows, "n string"), "n", "w").collect()]
    assert got == [["general", "perez"], ["perez", "general"], ["general", "perez"], None, None, None, None, None]
    t = spark.createDataFrame([("Comuna de El Litoral",), (" el litoral ",)], "c string")
    assert {r[0] for r in t.select(town_key(t["c"])).collect()} == {"el litoral"}
