from rodado.operators import lines
from rodado.plans import generate

M = 1 / 111_194.93


def test_connectors(spark):
    gaps = spark.createDataFrame([(1, 0.0, 0.0, -400 * M, 0.0, 400 * M, 0.0)], "gap bigint, px double, py double, ax double, ay double, bx double, by double")
    rows = []
    for path, y, length in ((7, 50.0, 800.0), (8, 10.0, 2000.0), (9, 120.0, 800.0), (10, 900.0, 800.0)):
        rows += [(path, x * M, y * M, length, 0.0, y * M) for x in (-400, -200, 0, 200, 400)]
    rows += [(11, x * M, 1.0 * M, 700.0, 395 * M, 0.0) for x in (-400, 0, 400)]  # its middle lies by a neighbour
    paths = spark.createDataFrame(rows, "path bigint, _x double, _y double, length_m double, mx double, my double")
    got = generate.connectors(gaps, paths).collect()
    assert [(r["gap"], r["path"]) for r in got] == [(1, 7)] and abs(got[0]["total_m"] - 150) < 1
    assert generate.connectors(gaps.limit(0), paths).count() == 0


def test_generated_routes(spark):
    pts = [[(-70.6 + .005 * (i + k / 4), -33.4) for k in range(5)] for i in range(4)]
    pieces = spark.createDataFrame([(5, i, p, False) for i, p in enumerate(pts)], "path bigint, way_id bigint, points array<struct<lng:double,lat:double>>, oneway boolean")
    paths = generate.path_pieces(pieces, lines.ordered_paths(pieces, "path"), "path")
    stops = [(1, 0, None, -70.6, -33.401), (1, 1, 5, None, None), (1, 2, None, -70.585, -33.401), (2, 0, None, None, None), (3, 0, 77, None, None)]
    df = spark.createDataFrame(stops, "route bigint, ord int, path bigint, lng double, lat double")
    got = generate.generated_routes(df, paths).orderBy("ord").collect()
    assert {r["route"] for r in got} == {1} and list(dict.fromkeys(r["way_id"] for r in got)) == [0, 1, 2] and {r["part"] for r in got} == {1}
    assert [r["ord"] for r in got] == list(range(len(got))) and abs(got[-1]["lng"] + 70.585) < 1e-6
    assert generate.generated_routes(df.limit(0), paths).count() == 0
