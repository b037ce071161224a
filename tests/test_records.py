import datetime as dt

from pyspark.sql import functions as F

from rodado.functions import rules
from rodado.functions import text as X
from rodado.operators import calendar as C
from rodado.operators import collections as R
from rodado.plans import facts

D = dt.date


def test_comfort(spark):
    cases = [
        ({"highway": "cycleway"}, 5), ({"highway": "tertiary", "cycleway:right": "track"}, 5), ({"highway": "path", "bicycle": "designated"}, 4), ({"highway": "path"}, 3),
        ({"highway": "footway", "bicycle": "yes"}, 3), ({"highway": "footway"}, 0), ({"highway": "residential", "cycleway": "lane"}, 2), ({"highway": "primary", "cycleway": "lane"}, 1),
        ({"highway": "primary"}, 0), ({}, 0), (None, 0), ({"highway": "residential", "cycleway": ""}, 0),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, tags map<string,string>")
    assert [r["c"] for r in df.orderBy("i").select(rules.comfort(F.col("tags")).alias("c")).collect()] == [c for _, c in cases]
    s = df.where("i = 8").select(rules.comfort(F.col("tags"), F.lit("parque")).alias("a"), rules.comfort(F.col("tags"), F.lit("otro")).alias("b")).first()
    assert (s["a"], s["b"]) == (5, 0)


def test_roads_only_without_anything_else(spark):
    df = spark.createDataFrame([(1, "a", "road"), (2, "a", "cycleway"), (3, "b", "road"), (4, "b", None), (5, "c", "lane")], "id int, g string, way_class string")
    assert sorted(r["id"] for r in R.cycling_ways(df, "g").collect()) == [2, 3, 5]


def test_texts(spark):
    df = spark.createDataFrame([("Ciclovía  Avenida Ñuñoa",), (None,), ("",), ("PASEO del Río-2",)], "n string")
    r = df.select(X.normal_name(F.col("n")).alias("a"), X.slug(F.col("n")).alias("b")).collect()
    assert [tuple(x) for x in r] == [("AVENIDA NUNOA", "ciclovia-avenida-nunoa"), ("", None), ("", ""), ("DEL RIO-2", "paseo-del-rio-2")]
    m = lambda a, b: df.limit(1).select(X.names_match(F.lit(a), F.lit(b)).alias("m")).first()["m"]
    assert m("Costanera Sur", "Ciclovía Costanera Sur") and m("PARQUE  Balmacéda", "parque balmaceda")
    assert not m("Nacional", "Librería Nacional") and not m("Sur", "Costanera Sur") and not m("Parque Norte", "Parque Sur")
    f = df.limit(1).select(X.fill_template("{a} de {b}{c}", {"a": F.lit(3), "b": F.lit("x"), "c": F.lit(None).cast("string")}).alias("t"), X.yaml_text(F.lit('a "b"\n')).alias("y"), X.spoken_list(F.array(F.lit("A"), F.lit("B"), F.lit("C"))).alias("l")).first()
    assert f["t"] == "3 de x" and f["y"] == '"a \\"b\\"\\n"' and f["l"] == "A, B y C"


def test_fuzzy_names_find_what_all_pairs_would(spark):
    names = ["Costanera Sur", "Ciclovía Costanera Sur", "Parque Balmaceda", "Gran Parque Balmaceda Norte", "Sur", "Costanera", None, "", "Parque balmacéda"]
    a = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, a string")
    b = a.withColumnsRenamed({"i": "j", "a": "b"})
    got = {(r["i"], r["j"]) for r in R.fuzzy_names(a, "a", b, "b").collect()}
    want = {(r["i"], r["j"]) for r in a.crossJoin(b).where(X.names_match(F.col("a"), F.col("b"))).collect()}
    assert got == want


def test_keys(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, body string, n int")
    new = spark.createDataFrame([(2, "x", 20), (3, "c", 30)], "k int, body string, n int")
    assert sorted(map(tuple, R.upsert(old, new, "k", ["n"]).collect())) == [(1, "a", 1), (2, "b", 20), (3, "c", 30)]
    add = new.unionAll(spark.createDataFrame([(3, "d", 5)], new.schema))
    assert sorted(map(tuple, R.insert_missing(old, add, "k", F.col("n")).collect())) == [(1, "a", 1), (2, "b", 2), (3, "d", 5)]
    s = R.numbered_slugs(spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "i int, name string"), "name", F.col("i"))
    assert {r["i"]: r["slug"] for r in s.collect()} == {1: "a-b", 2: "a-b-2", 3: "c"}
    m = R.most_frequent(spark.createDataFrame([("g", "x", 1), ("g", "y", 2), ("g", None, 3), ("h", None, 4)], "g string, v string, o int"), "g", "v", F.col("o"))
    assert [tuple(r) for r in m.collect()] == [("g", "x")]
    c = R.cascade(spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int"), "k", [("p", old, "body"), ("q", new, "body")])
    assert {r["k"]: (r["source"], r["target"]) for r in c.collect()} == {1: ("p", "a"), 2: ("p", "b"), 3: ("q", "c"), None: (None, None)}


def test_series(spark):
    rows = [
        (1, "weekly", "Thursday", D(2026, 5, 5), D(2026, 5, 28), [D(2026, 5, 14)]), (2, "biweekly", "monday", D(2026, 5, 4), D(2026, 6, 1), None), (3, "monthly", "monday", D(2026, 5, 4), D(2026, 6, 1), None),
        (4, "weekly", "noday", D(2026, 5, 4), D(2026, 6, 1), None), (5, "weekly", "monday", D(2026, 6, 4), D(2026, 6, 1), None), (6, "weekly", "monday", None, D(2026, 6, 1), None), (7, "weekly", None, D(2026, 5, 4), D(2026, 6, 1), None),
    ]
    s = spark.createDataFrame(rows, "series_id int, recurrence string, recurrence_day string, season_start date, season_end date, skip_dates array<date>")
    got = {}
    for r in C.recurrences(s).collect():
        got.setdefault(r["series_id"], []).append(r["date"].day)
    assert {k: sorted(v) for k, v in got.items()} == {1: [7, 21, 28], 2: [1, 4, 18]}
    o = spark.createDataFrame([(1, D(2026, 5, 7), None, "there"), (1, D(2026, 5, 21), True, None), (1, D(2030, 1, 1), None, "x")], "series_id int, date date, cancelled boolean, location string")
    base = s.select("series_id", F.lit("here").alias("location"))
    got = {(r["date"].day, r["location"], r["cancelled"]) for r in C.with_overrides(C.recurrences(s.where("series_id = 1")), o, base, ["location"]).collect()}
    assert got == {(7, "there", False), (21, "here", True), (28, "here", False)}


def test_results(spark):
    df = spark.createDataFrame([(1, "g", "10:30"), (2, "g", "09:15"), (3, "g", "DNS"), (4, "g", "25:00"), (5, "g", None), (6, "g", "09:15")], "i int, g string, t string").withColumn("lim", F.lit(1200))
    assert {r["i"]: r["place"] for r in C.ranked_results(df, "g", "t", "lim").collect()} == {1: 3, 2: 1, 3: None, 4: None, 5: None, 6: 1}


def test_facts(spark):
    t = {
        "places": spark.createDataFrame([(1, "p", "cafe", 0.0, 0.0), (2, "q", None, None, 0.0)], "place_id bigint, name string, category string, lng double, lat double"),
        "routes": spark.createDataFrame([("a", "A", 10.0), ("b", "B", 30.5), ("c", "C", None)], "slug string, name string, distance_km double"),
        "tracks": spark.createDataFrame([("a", 0.001, 0.0), ("b", 1.0, 1.0)], "track string, lng double, lat double"),
        "events": spark.createDataFrame([(D(2026, 1, 1),), (D(2025, 1, 1),), (None,)], "start_date date"),
    }
    run = lambda spec: [r["text"] for r in facts.fact(spec, t, F.lit("2026-06-01").cast("date")).collect()]
    assert run({"template": "{count} cafes", "query": {"type": "places", "filter": {"category": "cafe"}}}) == ["1 cafes"]
    assert run({"template": "{count} pubs", "query": {"type": "places", "filter": {"category": "pub"}}}) == []
    assert run({"template": "{name} {distance_km}", "query": {"type": "routes", "sort": "distance_km", "direction": "desc", "fields": ["name", "distance_km"]}}) == ["B 30.5"]
    assert run({"template": "{count}", "query": {"type": "routes_near_places", "filter": {"category": "cafe"}}}) == ["1"]
    assert run({"template": "{track} {count}", "query": {"type": "route_place_density", "filter": {"category": "cafe"}}}) == ["a 1"]
    assert run({"template": "{count}", "query": {"type": "events", "filter": {"year": "current"}}}) == ["1"]
    assert run({"template": "{total_km}", "query": {"type": "aggregate"}}) == ["40.5"] and run({"text": "hi"}) == ["hi"]
    for bad in ({"type": "nothing"}, {"type": "routes", "sort": "name", "order": "up"}):
        try:
            facts.compile_query(bad, t)
            raise AssertionError
        except ValueError:
            pass


def test_segments(spark):
    g = "struct<type:string,coordinates:array<array<array<double>>>>"
    rows = [(1, " Calle X ", "SUR ", 0.5, "Uni", "Parque", 0, "Buena", 0.0, None, "", ("MultiLineString", [[[0.0, 0.0], [0.001, 0.0, 5.0]], None, [[0.002, 0.0], [None, 1.0], [0.003, 0.0]]])), (2, None, None, None, None, None, None, None, None, True, None, None), (1, None, None, None, None, None, None, None, None, None, None, None)]
    c = spark.createDataFrame(rows, f"feature_id bigint, nombre string, comuna string, km double, tipo string, emplazamiento string, ancho_cm int, clasificacion string, score double, invalida boolean, video string, geometry {g}")
    s = {r["feature_id"]: r for r in R.survey_segments(c.limit(2)).collect()}
    assert s[1]["points"] == 4 and abs(s[1]["length_m"] - 222.39) < 0.1 and s[1]["score"] is None and s[1]["ancho_cm"] is None and s[1]["normal_name"] == "X"
    assert s[2]["nombre"] == "unnamed-2" and s[2]["comuna"] == "unknown" and s[2]["points"] == 0 and s[2]["lng0"] is None and s[2]["invalida"]
    assert R.corridors(R.survey_segments(c.limit(0)), "comuna").count() == 0
