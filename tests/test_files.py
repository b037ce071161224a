import json
import random

from pyspark.sql import functions as F

from rodado.sinks import files as K
from rodado.sources import files as S


def test_front_matter(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\nname: Café\nstart_time: 17:30\ndate: 2026-05-07\nlit: yes\nn: 3\ntags: [a, b]\n---\nBody\n---\nmore", "utf-8")
    (tmp_path / "b.md").write_text("no front matter", "utf-8")
    (tmp_path / "c.md").write_text("---\n: [bad\n---\nx", "utf-8")
    (tmp_path / "d.md").write_text("", "utf-8")
    files = S.text_files(spark, str(tmp_path), "*.md")
    rows = {r["path"][-4:]: r for r in S.front_matter(files).collect()}
    assert json.loads(rows["a.md"]["fields"]) == {"name": "Café", "start_time": "17:30", "date": "2026-05-07", "lit": "yes", "n": 3, "tags": ["a", "b"]}
    assert rows["a.md"]["body"] == "Body\n---\nmore" and rows["b.md"]["fields"] is None and rows["b.md"]["body"] == "no front matter" and rows["c.md"]["fields"] is None
    typed = S.records(files, "name string, n int, tags array<string>, gone string").collect()
    assert [(r["name"], r["n"], r["tags"], r["gone"]) for r in typed] == [("Café", 3, ["a", "b"], None)]


def test_registry_and_settings(spark, tmp_path):
    (tmp_path / "r.yml").write_text("bike_paths:\n- name: A\n  anchors: [[1.0, 2.0]]\n- name: B\n", "utf-8")
    files = S.text_files(spark, str(tmp_path), "*.yml")
    assert [(r["ord"], r["name"], r["anchors"]) for r in S.yaml_list(files, "bike_paths", "name string, anchors array<array<double>>").orderBy("ord").collect()] == [(0, "A", [[1.0, 2.0]]), (1, "B", None)]
    assert S.settings(files, {"zoom": "12"}).first()["zoom"] == "12"


def test_gpx(spark):
    pts = spark.createDataFrame([(1, 0, -71.1234567, -36.5, 10.0, 1), (1, 1, -71.2, -36.6, None, 1), (1, 2, -71.3, -36.7, None, 2), (2, 0, 0.0, 0.0, None, 1)], "k bigint, ord int, lng double, lat double, ele double, part int")
    g = K.gpx_text(pts, "k")
    text = {r["k"]: r["gpx"] for r in g.collect()}
    assert text[1].count("<trkseg>") == 2 and text[1].count("<trkpt") == 3
    back = [(r["k"], r["ord"], r["lng"], r["lat"], r["ele"]) for r in S.gpx_points(g, "gpx", "k").orderBy("k", "ord").collect()]
    assert back == [(1, 0, -71.1234567, -36.5, 10.0), (1, 1, -71.2, -36.6, None), (1, 2, -71.3, -36.7, None), (2, 0, 0.0, 0.0, None)]
    odd = spark.createDataFrame([("a", '<trkpt lon="1.5" lat="2.5"/><trkpt lat="x" lon="1"/><trkpt lat="95" lon="1"/>'), ("b", "version https://git-lfs"), ("c", None)], "path string, text string")
    assert [tuple(r) for r in S.gpx_points(odd).collect()] == [("a", 0, 1.5, 2.5, None)]


def test_polyline(spark):
    assert S.decode_polyline("_p~iF~ps|U_ulLnnqC_mqNvxq`@") == [(-120.2, 38.5), (-120.95, 40.7), (-126.453, 43.252)]
    rnd = random.Random(1)
    pts = [(round(rnd.uniform(-180, 180), 5), round(rnd.uniform(-90, 90), 5)) for _ in range(200)]
    assert S.decode_polyline(S.encode_polyline(pts)) == pts and S.decode_polyline(None) == S.decode_polyline("") == []
    df = spark.createDataFrame([(1, S.encode_polyline(pts[:3])), (2, None)], "k bigint, p string")
    assert [(r["lng"], r["lat"]) for r in S.polylines(df, "k", "p").orderBy("ord").collect()] == pts[:3]


def test_geojson(spark, tmp_path):
    f = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"nombre": "A", "x": 1}, "geometry": {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}},
        {"type": "Feature", "properties": {"nombre": "B"}, "geometry": {"type": "MultiLineString", "coordinates": [[[1, 2], [3, 4]], [[5, 6]]]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}
    (tmp_path / "f.json").write_text(json.dumps(f))
    r = S.geojson_features(spark, str(tmp_path / "f.json"), "nombre string").collect()
    assert [(x["nombre"], x["geometry"]["coordinates"]) for x in r] == [("A", [[[1.0, 2.0], [3.0, 4.0]]]), ("B", [[[1.0, 2.0], [3.0, 4.0]], [[5.0, 6.0]]]), (None, None)]
    (tmp_path / "p.json").write_text("[[1, 2], [3, 4]]")
    assert [tuple(x) for x in S.point_list(spark, str(tmp_path / "p.json")).collect()] == [(0, 1.0, 2.0), (1, 3.0, 4.0)]


def test_pages_and_drawing(spark, tmp_path):
    r = spark.createDataFrame([(1, 'La "R"', 12.5, ["a", None, "a", "b"], None), (2, None, None, None, "t")], "route_id bigint, name string, distance_km double, tags array<string>, tagline string")
    p = {x["route_id"]: x["page"] for x in K.route_page(r).collect()}
    assert p[1] == '---\nname: "La \\"R\\""\ndistance_km: 12.5\n---\n\nRecorrido de 12,5 km.\n\nEtiquetas: a y b.\n' and p[2].startswith('---\nname: ""\ntagline: "t"\n---')
    pts = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 1.0, 1.0), (2, 0, 1.0, 0.0), (2, 1, 1.0, 1.0)], "track bigint, ord int, lng double, lat double")
    assert [x["line"] for x in K.draw(pts, 3, 2).orderBy("row").collect()] == ["  *", "a b"]
    K.write_texts(K.route_page(r), str(tmp_path / "out"), "page", "route_id")
    assert spark.read.text(str(tmp_path / "out")).count() > 0
    assert json.loads(K.nested(r).first()["document"])["name"] == 'La "R"'


def test_sample_rows(spark):
    df = spark.range(1000).repartition(7).withColumn("_i", F.lit("clash")).drop("_i")
    got = sorted(r["id"] for r in K.sample_rows(df, 10, F.col("id")).collect())
    assert got == list(range(0, 1000, 100)) and K.sample_rows(df.limit(0), 5, F.col("id")).count() == 0
    assert K.sample_rows(df.where("id < 3"), 10, F.col("id")).count() == 3
