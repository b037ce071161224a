"""Routes that share a path: what the path tells is told once."""

import pytest

from rodado.plans import suggest

M = 1 / 111_195
SEGMENTS = "seg_id bigint, axis bigint, axis_name string, length_m double, emplazamiento string, lng0 double, lat0 double, lng1 double, lat1 double, condition double, comuna string, video string"


@pytest.fixture
def town(spark):
    seg = spark.createDataFrame([(k, k // 2, f"n{k // 2}", 1000.0, None, k * 1000 * M, 0.0, (k + 1) * 1000 * M, 0.0, float(k), None, None) for k in range(4)], SEGMENTS)
    found = spark.createDataFrame([(1, "a", "park", 0.0, 0.0, 0.0, 9), (2, "b", "park", 4000 * M, 0.0, 0.0, 8), (3, "c", "cafe", 100 * M, 0.0, 0.0, 7)], "place_id bigint, name string, category string, lng double, lat double, infra_m double, score int")
    return seg, found


def test_candidates_of_one_path_are_assembled_once(spark, town, monkeypatch):
    seen = []
    own = suggest.chain_runs
    monkeypatch.setattr(suggest, "chain_runs", lambda routes, segments: seen.append(routes.count()) or own(routes, segments))
    # two from different anchors, one from an anchor back to itself: a loop of the same path
    c = spark.createDataFrame([(10, 1, 2, [0, 1, 2, 3]), (11, 3, 2, [0, 1, 2, 3]), (12, 1, 1, [0, 1, 2, 3])], "route bigint, start bigint, end bigint, path array<bigint>")
    got = {r["route"]: r for r in suggest.assembled(c, *town, gates=False).collect()}
    assert seen == [1]
    assert {k: (r["kind"], r["start_points"], r["pois"], r["places"]) for k, r in got.items()} == {10: ("one-way", 9, 1, ["c"]), 11: ("one-way", 7, 1, ["a"]), 12: ("loop", 9, 2, ["b", "c"])}
    assert all(r["segments"] == 4 and r["runs"] == 2 and r["condition"] == 1.5 and r["aspect"] == 99 for r in got.values())
    assert {r["route"] for r in suggest.assembled(c, *town).collect()} == {10, 11, 12}
