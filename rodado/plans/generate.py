"""From stops (places and registered paths) to tracks, one route a group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import lines
from ..operators.graph import _metres


def path_pieces(pieces: DataFrame, ordered: DataFrame, by: str) -> DataFrame:
    """(by, pieces array<struct<ord,way_id,turned,points>>): each path's pieces in riding order, from lines.ordered_paths."""
    j = ordered.join(pieces.select(by, "way_id", "points"), [by, "way_id"])
    return j.groupBy(by).agg(F.sort_array(F.collect_list(F.struct("ord", "way_id", "turned", "points"))).alias("pieces"))


def generated_routes(stops: DataFrame, paths: DataFrame, between: int = 3) -> DataFrame:
    """(route, part, ord, way_id, turned, lng, lat): the points of each route in riding order.

    stops: (route, ord, path, lng, lat): a path where ``path`` is known, else a place; stops with neither are left out.
    paths: (path, pieces) of :func:`path_pieces`. Two places side by side are joined over up to ``between`` of the
    route's own paths, chosen by comfort of approach: the path that comes nearest to the way.
    """
    kind = stops.schema["route"].dataType.simpleString()
    src = stops.join(paths, "path", "left").select("route", "ord", "lng", "lat", "path", "pieces")

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("ord")
        known, stops_, ids = {}, [], []
        for r in pdf.to_dict("records"):
            if r["pieces"] is not None and len(r["pieces"]):
                ls = [lines.Line(int(p["way_id"]), [(q["lng"], q["lat"]) for q in p["points"]], False, bool(p["turned"])) for p in r["pieces"] if len(p["points"]) > 1]
                known[int(r["path"])] = ls
                stops_.append(ls)
                ids.append(int(r["path"]))
            elif pd.notna(r["lng"]) and pd.notna(r["lat"]):
                stops_.append((r["lng"], r["lat"]))
                ids.append(None)
        full, used = [], {i for i in ids if i is not None}
        for k, s in enumerate(stops_):
            if k and isinstance(s, tuple) and isinstance(stops_[k - 1], tuple):
                free = {i: [p for x in ls for p in x.ridden] for i, ls in known.items() if i not in used}
                full += [known[i] for i in lines.plan(stops_[k - 1], s, free, lambda pts, at, goal: -min(_metres(*p, *at) + _metres(*p, *goal) for p in pts), between)]
            full.append(s)
        out = []
        for n, part in enumerate(lines.chain(full), 1):
            for x in part:
                out += [(pdf["route"].iloc[0], n, len(out) + i, x.id, x.turned, *p) for i, p in enumerate(x.ridden)]
        return pd.DataFrame(out, columns=["route", "part", "ord", "way_id", "turned", "lng", "lat"])

    return src.groupBy("route").applyInPandas(run, f"route {kind}, part int, ord bigint, way_id bigint, turned boolean, lng double, lat double")


def connectors(gaps: DataFrame, paths: DataFrame, near_m: float = 500.0, longest_m: float = 1500.0, apart_m: float = 100.0) -> DataFrame:
    """(gap, path, total_m): for each gap the path that links a place with its two neighbours best.

    gaps: (gap, px, py, ax, ay, bx, by): the place and the nearest points of its neighbours. paths: (path, _x, _y,
    length_m, mx, my): points, length and middle. A path qualifies if it is short, comes near to all three, and its
    middle isn't by either neighbour; the least sum of distances wins, then the smaller path.
    """
    from ..functions import geo
    from ..operators.nearby import within

    pts = paths.select("path", "_x", "_y").distinct()
    out = None
    for x, y in (("px", "py"), ("ax", "ay"), ("bx", "by")):
        d = within(gaps.select("gap", F.col(x).alias("lng"), F.col(y).alias("lat")).distinct(), pts, near_m, ["gap"], centre_xy=("_x", "_y"), distance="_d")
        d = d.groupBy("gap", "path").agg(F.min("_d").alias(f"_{x}"))
        out = d if out is None else out.join(d, ["gap", "path"])
    one = paths.groupBy("path").agg(F.max("length_m").alias("_len"), F.min("mx").alias("_mx"), F.min("my").alias("_my")).where(F.col("_len") <= longest_m)
    j = out.join(one, "path").join(gaps.select("gap", "ax", "ay", "bx", "by"), "gap")
    j = j.where((geo.haversine("_mx", "_my", "ax", "ay") > apart_m) & (geo.haversine("_mx", "_my", "bx", "by") > apart_m))
    j = j.withColumn("_sum", F.col("_px") + F.col("_ax") + F.col("_bx"))
    return j.groupBy("gap").agg(F.min(F.struct("_sum", "path")).alias("_b")).select("gap", F.col("_b.path").alias("path"), F.col("_b._sum").alias("total_m"))


class Roads:
    """A road graph in memory, with its nodes in a grid, to fill gaps with."""

    CELL, NEAR_M = 0.002, 200.0

    def __init__(self, edges, nodes):
        from ..operators.graph import Graph

        self.graph, self.at, self.grid = Graph(edges), dict(nodes), {}
        for i, (x, y) in self.at.items():
            self.grid.setdefault((int(x // self.CELL), int(y // self.CELL)), []).append(i)

    def node(self, p):
        """The nearest node within NEAR_M, the smaller one on ties; None if there is none."""
        gx, gy = int(p[0] // self.CELL), int(p[1] // self.CELL)
        wide = 1 + int(1 / max(0.05, math.cos(math.radians(p[1]))))
        near = [(_metres(*p, *self.at[i]), i) for a in range(gx - wide, gx + wide + 1) for b in (gy - 1, gy, gy + 1) for i in self.grid.get((a, b), ())]
        d, i = min(near, default=(math.inf, None))
        return i if d <= self.NEAR_M else None

    def way(self, p, q, most_m: float):
        """(metres, points) of the cheapest way between two places that costs at most 3 x ``most_m``, None without one."""
        a, b = self.node(p), self.node(q)
        if a is None or b is None:
            return None
        found = self.graph.dijkstra(a, [b], 3 * most_m).get(b)
        return found and (found[1], [self.at[n] for n in found[2]])


#: Gaps in metres that are filled, looked for on roads, and that a loop is closed over.
FILL_M, ROAD_M, CLOSE_M = 50.0, 100.0, (50.0, 2000.0)


def ride(axes: list[tuple[bool | None, list[list[tuple[float, float]]]]], loop: bool = False, roads: Roads | None = None, legs: dict | None = None) -> list[tuple[float, float]]:
    """The points of one track over axes of segments, each segment turned to begin near where the last one ended.

    axes: (turned, segments): true or false if the sense of the axis is known, None to enter it by the nearer end. Gaps
    over 50 m are filled: by roads if that isn't far out of the way, else by a known leg (:func:`leg_key`), else straight.
    A loop is closed over 50 m to 2 km.
    """
    out: list[tuple[float, float]] = []
    for turned, segs in axes:
        segs = [s for s in segs if s]
        if not segs:
            continue
        if turned is None:
            turned = bool(out) and len(segs) > 1 and _metres(*out[-1], *segs[-1][-1]) < _metres(*out[-1], *segs[0][0])
        for s in segs[::-1] if turned else segs:
            if out and len(s) > 1 and _metres(*out[-1], *s[-1]) < _metres(*out[-1], *s[0]):
                s = s[::-1]
            gap = _metres(*out[-1], *s[0]) if out else 0.0
            if gap > FILL_M:
                out += _fill(out[-1], s[0], gap, roads, legs or {})
            out += s
    if loop and len(out) > 2 and CLOSE_M[0] < _metres(*out[0], *out[-1]) < CLOSE_M[1]:
        out.append(out[0])
    return out


def _fill(a, b, gap: float, roads: Roads | None, legs: dict) -> list:
    if roads is not None and gap > ROAD_M:
        way = roads.way(a, b, gap * (5 if gap < 500 else 3))
        if way and len(way[1]) > 2 and way[0] < gap * (3.5 if gap < 500 else 2.5 if gap < 1000 else 2.0):
            return way[1][1:-1]
    if gap > 200 and (leg := legs.get(leg_key(a, b))):
        return list(leg)
    return [a, b]


def leg_key(a: tuple[float, float], b: tuple[float, float]) -> str:
    """Key of a leg between two places, to five decimals (about a metre)."""
    return "_".join(f"{v:.5f}" for v in (*a, *b))


class Asked:
    """Roads that only note what ways :func:`ride` asks for: that depends on the segments, not on how gaps are filled."""

    def __init__(self):
        self.legs: list = []

    def way(self, p, q, most_m: float):
        self.legs.append((*p, *q, 3 * most_m))


class Found:
    """Roads that know the ways asked for: (metres, points) by the two places."""

    def __init__(self, ways: dict):
        self.ways = ways

    def way(self, p, q, most_m: float):
        return self.ways.get((*p, *q))


def _axes(axes) -> list:
    return [(a["turned"], [[(p["lng"], p["lat"]) for p in s or ()] for s in a["segs"] or ()]) for a in axes or ()]


def road_ways(routes: DataFrame, roads: tuple[DataFrame, ...]) -> DataFrame:
    """(route, ways array<struct<ax,ay,bx,by,length,points>>): the ways over roads that the gaps of routes ask for, as from
    :meth:`Roads.way`, searched component by component. roads: nodes and edges, and the nodes' components if known."""
    from ..operators import graph
    from ..operators.nearby import within
    from ..session import stage

    kind = routes.schema["route"].dataType.simpleString()
    nodes, edges, *known = roads

    def ask(batches):
        import pyarrow as pa

        for b in batches:
            own, legs = [], []
            for i, (k, axes) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                a = Asked()
                ride(_axes(axes), k == "loop", a)
                own += [i] * len(a.legs)
                legs += a.legs
            cols = list(zip(*legs)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(own, pa.int64())), *(pa.array(v, pa.float64()) for v in cols)], ["route", "ax", "ay", "bx", "by", "most"])

    asked = stage(routes.select("route", "kind", "axes").mapInArrow(ask, f"route {kind}, ax double, ay double, bx double, by double, most double").distinct(), "asked")
    nodes = stage(nodes, "nodes")
    ends = asked.select(F.explode(F.array(*(F.struct(F.col(f"{k}x").alias("_x"), F.col(f"{k}y").alias("_y")) for k in "ab"))).alias("_e")).select("_e.*").distinct()
    near = within(nodes, ends, Roads.NEAR_M, ["id"], centre_xy=("_x", "_y"), distance="_d").groupBy("_x", "_y").agg(F.min(F.struct("_d", "id"))["id"].alias("_n"))
    near = stage(near, "near")
    side = lambda k, n: near.select(F.col("_x").alias(f"{k}x"), F.col("_y").alias(f"{k}y"), F.col("_n").alias(n))
    legs = stage(asked.join(side("a", "src"), ["ax", "ay"]).join(side("b", "dst"), ["bx", "by"]).where("src <> dst"), "legs")
    req = legs.groupBy("src", "dst").agg(F.max("most").alias("most"))
    p = stage(graph.paths(req, edges, known=known[0] if known else None), "ways")
    n = p.select("src", "dst", F.posexplode("path").alias("_i", "id")).join(nodes, "id").groupBy("src", "dst").agg(F.sort_array(F.collect_list(F.struct("_i", "lng", "lat"))).alias("_p"))
    n = n.select("src", "dst", F.transform("_p", lambda v: F.struct(v["lng"].alias("lng"), v["lat"].alias("lat"))).alias("points"))
    w = legs.join(p.select("src", "dst", "cost", "length"), ["src", "dst"]).where("cost <= most").join(n, ["src", "dst"])
    return w.groupBy("route").agg(F.collect_list(F.struct("ax", "ay", "bx", "by", "length", "points")).alias("ways"))


def tracks_of(routes: DataFrame, roads: tuple[DataFrame, ...] | None = None, legs: DataFrame | None = None, most_legs: int = 200_000) -> DataFrame:
    """(track, ord, lng, lat) of routes (route, kind, axes array<struct<turned boolean, segs array<array<struct<lng,lat>>>>>).

    roads: nodes and edges as from graph.road_graph, and the components of the nodes if known (graph.road_components); no
    task holds more of them than some components (:func:`road_ways`). legs: (key, points array<struct<lng,lat>>), ways known
    from elsewhere, which go to every task after a check of their number.
    """
    known = [(r["key"], [(p["lng"], p["lat"]) for p in r["points"]]) for r in legs.limit(most_legs + 1).collect()] if legs is not None else []
    if len(known) > most_legs:
        raise ValueError(f"more than {most_legs} legs; cut the region")
    box = routes.sparkSession.sparkContext.broadcast(dict(known))
    kind = routes.schema["route"].dataType.simpleString()
    src = routes.select("route", "kind", "axes")
    if filled := bool(roads):
        src = src.join(road_ways(src, roads), "route", "left")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            own, at, xs, ys = [], [], [], []
            for i, (k, axes, ways) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist() if filled else [None] * b.num_rows)):
                found = {(w["ax"], w["ay"], w["bx"], w["by"]): (w["length"], [(p["lng"], p["lat"]) for p in w["points"]]) for w in ways or ()}
                line = ride(_axes(axes), k == "loop", Found(found) if found else None, box.value)
                own += [i] * len(line)
                at += range(len(line))
                xs += [p[0] for p in line]
                ys += [p[1] for p in line]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(own, pa.int64())), pa.array(at, pa.int64()), pa.array(xs, pa.float64()), pa.array(ys, pa.float64())], ["track", "ord", "lng", "lat"])

    return src.mapInArrow(run, f"track {kind}, ord bigint, lng double, lat double")


def path_ways(paths: DataFrame, ways: DataFrame, pad: float = 0.02, park_pad: float = 0.001, snap_m: float = 50.0) -> DataFrame:
    """(path_id, way_id): the ways of each registered path, by the first of three means that it has: its listed ways; ways of
    its listed names in the box around its anchors, widened by ``pad`` degrees; ways of its own name there.

    Of these only cycling ways stay (collections.cycling_ways). If only parks are left, the cycle ways that come within
    ``snap_m`` of a corner of them stand in for them, where there are any.
    paths: (path_id, name, osm_names, osm_way_ids, anchors); ways: (way_id, name, tags, points array<struct<lng,lat>>).
    """
    from ..functions import geo, rules
    from ..operators import collections, nearby

    c = F.col
    w = ways.where(F.size("points") >= 2)
    good = F.filter(F.coalesce("anchors", F.array().cast("array<array<double>>")), lambda a: (F.size(a) == 2) & geo.on_earth(F.try_element_at(a, F.lit(1)), F.try_element_at(a, F.lit(2))))
    p = paths.withColumn("_a", F.transform(good, lambda a: F.struct(a[0].alias("x"), a[1].alias("y"))))
    some = lambda k: F.coalesce(F.size(k) > 0, F.lit(False))
    boxed = F.size("_a") >= 2
    listed = p.where(some("osm_way_ids")).select("path_id", F.explode("osm_way_ids").alias("way_id")).join(w.select("way_id"), "way_id").select("path_id", "way_id")
    named = p.where(~some("osm_way_ids") & boxed)
    names = F.when(some("osm_names"), c("osm_names")).otherwise(F.array("name"))
    edge = lambda f, k: f(F.transform("_a", lambda a: a[k]))
    box = [(edge(F.array_min, "x") - pad).alias("_x0"), (edge(F.array_max, "x") + pad).alias("_x1"), (edge(F.array_min, "y") - pad).alias("_y0"), (edge(F.array_max, "y") + pad).alias("_y1")]
    named = named.select("path_id", F.explode(names).alias("name"), *box).join(w.select("way_id", "name", "points"), "name")
    named = named.where(F.exists("points", lambda v: v["lng"].between(c("_x0"), c("_x1")) & v["lat"].between(c("_y0"), c("_y1")))).select("path_id", "way_id")
    every = listed.unionAll(named).distinct().join(w.select("way_id", rules.way_class(c("tags")).alias("way_class"), F.coalesce(rules.tag(c("tags"), "leisure") == "park", F.lit(False)).alias("_park"), "points"), "way_id")
    kept = collections.cycling_ways(every.select("path_id", "way_id", "way_class"), "path_id").select("path_id", "way_id")
    kept = kept.join(every.select("path_id", "way_id", "_park", "points"), ["path_id", "way_id"])
    parks = kept.groupBy("path_id").agg(F.min("_park").alias("_only")).where("_only").select("path_id")
    corners = kept.join(parks, "path_id").select("path_id", F.explode("points").alias("_p")).select("path_id", c("_p.lng").alias("_x"), c("_p.lat").alias("_y")).distinct()
    t = c("tags")
    cycle = w.where((rules.tag(t, "highway") == "cycleway") | ((rules.tag(t, "highway") == "path") & rules.tag(t, "bicycle").rlike("designated|yes")))
    vertices = cycle.select("way_id", F.posexplode("points").alias("_i", "_p")).select("way_id", "_i", "_p.*")
    snapped = nearby.within(vertices, corners, snap_m, ["way_id", "_i"], centre_xy=("_x", "_y"), distance="_d").where(c("_d") < snap_m).select("path_id", "way_id").distinct()
    plain = kept.join(snapped.select("path_id").distinct(), "path_id", "left_anti").select("path_id", "way_id")
    return plain.unionByName(snapped)
