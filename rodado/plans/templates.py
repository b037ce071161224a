"""Paths over the segment graph from templates: lists of names and places that a curator wants a route to pass."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import collections, graph, search, spatial
from ..operators.graph import _metres
from ..session import stage

#: What a match is worth by its kind, in metres of nearness, and the least letters of an axis' name.
WORTH = {"axis": 5000.0, "zone": 2000.0, "poi": 0.0, "place": 0.0}
AXIS_LETTERS = 3
#: Metres around a place that its nearest segment is looked for first.
NEAR_M = (1000.0, 8000.0)
#: Stops, and templates of one name or component, that a task handles at about.
TASK_STOPS, TASK_TEMPLATES = 20_000, 5_000


def meanings(names: DataFrame, segments: DataFrame, found: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """(_n, kind, name, id, lng, lat): everything that each name (_n, _stop) can mean: every axis, zone and anchor whose name
    matches it (collections.fuzzy_names).

    segments: (seg_id, axis, axis_name, ends); found: anchors (place_id, name, lng, lat); zones: (zone, name, clng, clat).
    An axis has its middle.
    """
    c = F.col
    mid = segments.select("axis", "axis_name", ((c("lng0") + c("lng1")) / 2).alias("x"), ((c("lat0") + c("lat1")) / 2).alias("y"))
    axes = mid.where(F.length("axis_name") >= AXIS_LETTERS).groupBy("axis").agg(F.first("axis_name").alias("name"), F.avg("x").alias("lng"), F.avg("y").alias("lat"))
    sides = [("axis", axes.select(c("axis").cast("bigint").alias("id"), "name", "lng", "lat")), ("poi", found.where("name is not null").select(c("place_id").cast("bigint").alias("id"), "name", "lng", "lat"))]
    if zones is not None:
        sides.append(("zone", zones.where("name is not null").select(c("zone").cast("bigint").alias("id"), "name", c("clng").alias("lng"), c("clat").alias("lat"))))
    out = None
    for kind, side in sides:
        m = collections.fuzzy_names(names, "_stop", side, "name").select("_n", F.lit(kind).alias("kind"), "name", "id", "lng", "lat")
        out = m if out is None else out.unionAll(m)
    return out


def coherent(options: list[list[dict]], g: search.Network, members: dict) -> list[dict | None]:
    """One match for each stop: those with one are settled; the others take, in order, the one nearest to the middle of the
    settled ones and, counted twice, to settled neighbours; kinds are worth metres. An axis is where its nearest piece is."""
    chosen: list[dict | None] = [o[0] if len(o) == 1 else None for o in options]
    settled = [m for m in chosen if m]
    middle = settled and (sum(m["lng"] for m in settled) / len(settled), sum(m["lat"] for m in settled) / len(settled))

    def far(m: dict, x: float, y: float) -> float:
        if m["kind"] != "axis":
            return _metres(m["lng"], m["lat"], x, y)
        return min((min(_metres(*p, x, y) for p in (g.at[s], *g.ends[s])) for s in members.get(m["id"], ())), default=_metres(m["lng"], m["lat"], x, y))

    for i, o in enumerate(options):
        if chosen[i] is None and o:
            def cost(m: dict, i: int = i) -> float:
                beside = [chosen[k] for k in (i - 1, i + 1) if 0 <= k < len(chosen) and chosen[k]]
                return (far(m, *middle) if middle else 0.0) + sum(2 * far(m, n["lng"], n["lat"]) for n in beside) - WORTH[m["kind"]]

            chosen[i] = min(o, key=lambda m: (cost(m), m["kind"], m["id"] or 0))
    return chosen


def choices(stops: DataFrame, segments: DataFrame, found: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """(route, ord, kind, id, lng, lat, stops): the coherent match of each stop of the templates (route, ord, name, lng, lat)
    that have at least two, and how many the template has. A stop that matches none means its place, if it has one.

    A name is looked up once, whatever the stops that have it. A task holds the stops of some templates, what their names
    can mean, and the segments of those axes; templates that share their first name meet in one.
    """
    c = F.col
    none = lambda t: F.lit(None).cast(t)
    s = stops.select("route", "ord", c("name").alias("_stop"), "lng", "lat")
    names = stage(s.where("_stop is not null").select("_stop").distinct().withColumn("_n", F.monotonically_increasing_id()), "names")
    m = stage(meanings(names, segments, found, zones), "meanings")
    s = s.where("_stop is not null").join(names, "_stop").select("route", "ord", "_n", "lng", "lat").unionAll(s.where("_stop is null").select("route", "ord", none("bigint"), "lng", "lat"))
    s = stage(s, "stops")
    parts = max(int(stops.sparkSession.conf.get("spark.sql.shuffle.partitions")), s.count() // TASK_STOPS)
    first = s.groupBy("route").agg(F.coalesce(F.min("_n"), F.xxhash64("route")).alias("_k"))
    hot = first.groupBy("_k").agg(F.ceil(F.count("*") / TASK_TEMPLATES).cast("int").alias("_salts")).where("_salts > 1")
    part = F.pmod(F.xxhash64("_k", F.pmod(F.xxhash64("route"), F.coalesce("_salts", F.lit(1)))), F.lit(parts))
    s = stage(s.join(first.join(hot, "_k", "left").select("route", part.alias("_part")), "route"), "stops")
    o = stage(s.where("_n is not null").select("_part", "_n").distinct().join(m, "_n"), "options")
    seg = segments.select("seg_id", c("axis").cast("bigint").alias("id"), "lng0", "lat0", "lng1", "lat1").dropDuplicates(["seg_id"])
    seg = o.where("kind = 'axis'").select("_part", "id").distinct().join(seg, "id")
    cols = ["_part", "_n", "kind", "id", "name", "x", "y", "x1", "y1", "seg_id"]
    rows = o.select("_part", "_n", "kind", "id", "name", "lng", "lat", none("double"), none("double"), none(segments.schema["seg_id"].dataType)).toDF(*cols)
    rows = rows.unionAll(seg.select("_part", none("bigint"), none("string"), "id", none("string"), "lng0", "lat0", "lng1", "lat1", "seg_id").toDF(*cols))
    kind, ords = (stops.schema[k].dataType.simpleString() for k in ("route", "ord"))

    def run(left, right):
        import pyarrow as pa

        options, members, segs, by = {}, {}, [], {}
        for n, k, i, name, x, y, x1, y1, seg_id in zip(*(right.column(k).to_pylist() for k in cols[1:])):
            if k is None:
                segs.append((seg_id, i, 0.0, x, y, x1, y1))
                members.setdefault(i, []).append(seg_id)
            else:
                options.setdefault(n, []).append({"kind": k, "id": i, "name": name, "lng": x, "lat": y})
        order = lambda m: (m["kind"], m["id"] is not None, m["id"] or 0, m["name"], m["lng"], m["lat"])
        for v in options.values():
            v.sort(key=order)
        g = search.Network((), segs)
        for route, at, n, x, y in zip(*(left.column(k).to_pylist() for k in ("route", "ord", "_n", "lng", "lat"))):
            by.setdefault(route, {}).setdefault(at, []).append((n, x, y))
        out = []
        for route, at in by.items():
            o = []
            for k in sorted(at):
                v = options.get(at[k][0][0], []) if len(at[k]) == 1 else sorted((m for n, _, _ in at[k] for m in options.get(n, ())), key=order)
                o.append(v or sorted(({"kind": "place", "id": None, "name": "", "lng": x, "lat": y} for _, x, y in at[k] if x is not None and y is not None), key=order))
            chosen = coherent(o, g, members)
            if (n := sum(x is not None for x in chosen)) > 1:
                out += [(route, k, m["kind"], m["id"], m["lng"], m["lat"], n) for k, m in zip(sorted(at), chosen) if m]
        own, at = left.schema.field("route").type, left.schema.field("ord").type
        cols_ = list(zip(*out)) or [()] * 7
        return pa.table([pa.array(v, t) for v, t in zip(cols_, (own, at, pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.int32()))], ["route", "ord", "kind", "id", "lng", "lat", "stops"])

    return s.groupBy("_part").cogroup(rows.groupBy("_part")).applyInArrow(run, f"route {kind}, ord {ords}, kind string, id bigint, lng double, lat double, stops int")


def _through(chosen: list[dict | None], g: search.Network, members: dict, turned: bool = False) -> list:
    path: list = []
    for m in chosen:
        if m is None:
            continue
        segs = sorted(members.get(m["id"], ()), key=lambda s: (g.at[s][0], s)) if m["kind"] == "axis" else []
        entry = segs[0] if segs else m["seg_id"]
        if entry is None:
            continue
        if path and path[-1] != entry and (way := g.a_star(path[-1], entry)):
            path += way[2][1:]
        if path and segs:
            x, y = g.ends[path[-1]][1]
            if _metres(x, y, *g.at[segs[-1]]) < _metres(x, y, *g.at[segs[0]]):
                segs = segs[::-1]
        elif turned:
            segs = segs[::-1]
        for s in segs or ([] if path else [entry]):
            if not path or path[-1] != s:
                path.append(s)
    return path


def path_of(chosen: list[dict | None], g: search.Network, members: dict) -> list:
    """Segments through the chosen matches: an axis whole, from the end that is nearer, and ways between what follows."""
    path = _through(chosen, g, members)
    return path if len(path) > 1 else []


def pieces(chosen: DataFrame, segments: DataFrame, known: DataFrame) -> DataFrame:
    """(route, piece, ord, kind, id, seg_id, component, stops): what the paths of templates go through, in pieces of one
    component each. chosen: as from :func:`choices`; known: the components of the segments (id, component).

    seg_id is the segment nearest to what isn't an axis. There is no way into another component: an axis of one begins the next
    piece, and what isn't an axis is passed over.
    """
    c = F.col
    comp = known.withColumnRenamed("id", "seg_id")
    axes = segments.groupBy(c("axis").cast("bigint").alias("id")).agg(F.min("seg_id").alias("seg_id")).join(comp, "seg_id").select("id", "component")
    mids = segments.select("seg_id", ((c("lng0") + c("lng1")) / 2).alias("_x"), ((c("lat0") + c("lat1")) / 2).alias("_y"))
    at = stage(chosen.where("kind <> 'axis'").select("lng", "lat").distinct().withColumn("_k", F.xxhash64("lng", "lat")), "places")
    near = spatial.nearest_one(at, mids, "_k", "seg_id", NEAR_M).select("_k", "seg_id")
    near = near.unionAll(spatial.nearest_far(at.join(near, "_k", "left_anti"), mids, "_k", "seg_id").select("_k", "seg_id"))
    near = near.join(at, "_k").drop("_k").join(comp, "seg_id")
    p = chosen.where("kind = 'axis'").join(axes, "id").select("route", "ord", "kind", "id", F.lit(None).cast(segments.schema["seg_id"].dataType).alias("seg_id"), "component", "stops")
    p = p.unionAll(chosen.where("kind <> 'axis'").join(near, ["lng", "lat"]).select("route", "ord", "kind", "id", "seg_id", "component", "stops"))
    w = Window.partitionBy("route").orderBy("ord")
    p = p.withColumn("_first", F.row_number().over(w) == 1)
    p = p.withColumn("_in", F.last(F.when(c("_first") | (c("kind") == "axis"), c("component")), True).over(w))
    p = p.withColumn("_new", F.coalesce(c("_in") != F.lag("_in").over(w), F.lit(False)).cast("int"))
    return p.withColumn("piece", F.sum("_new").over(w).cast("int")).where("component = _in").select("route", "piece", "ord", "kind", "id", "seg_id", "component", "stops")


def template_paths(stops: DataFrame, segments: DataFrame, edges: DataFrame, found: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """(route, path, stops): the path of each template with at least two stops that mean something, and how many do.

    stops: (route, ord, name, lng, lat); edges: (a, b, cost, length); the others as for :func:`meanings`. No way leaves a
    component of edges and corridors: a task holds the segments and edges of some components and the pieces of templates in
    them. A component of more than GRAPH_EDGES edges is an error.
    """
    c = F.col
    chosen = stage(choices(stops, segments, found, zones), "chosen")
    seg = segments.select("seg_id", "axis", "length_m", "lng0", "lat0", "lng1", "lat1").dropDuplicates(["seg_id"])
    comp = search.connected(seg, edges)
    p = stage(pieces(chosen, seg, comp), "pieces")
    n = p.select("route", "piece", "component").distinct().groupBy("component").agg(F.count("*").alias("_n"))
    parts = int(stops.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = stage(n.select("component", F.ceil(c("_n") / TASK_TEMPLATES).cast("int").alias("_salts")), "asked")
    at = comp.join(asked, "component")
    e = stage(edges.select("a", "b", "cost", "length").join(at.withColumnRenamed("id", "a"), "a"), "edges")
    size = e.groupBy("component").agg(F.count("*").alias("_n")).agg(F.max("_n").alias("most"), F.sum("_n").alias("all")).first()
    if (size["most"] or 0) > graph.GRAPH_EDGES:
        raise ValueError(f"{size['most']} edges in one component; cut the region")
    parts = max(parts, (size["all"] or 0) // graph.TASK_EDGES)
    to = F.pmod(F.xxhash64("component") + c("_salt"), F.lit(parts)).alias("_part")
    # a part that gets a component for two of its shares holds it once
    shares = asked.select("component", F.explode(F.sequence(F.lit(0), c("_salts") - 1)).alias("_salt")).select("component", to).distinct()
    p = p.join(asked, "component").withColumn("_salt", F.pmod(F.xxhash64("route"), c("_salts"))).select(to, "route", "piece", "ord", "kind", "id", "seg_id", "stops")
    none = lambda t: F.lit(None).cast(t)
    node, ax = (seg.schema[k].dataType for k in ("seg_id", "axis"))
    cols = ["_part", "a", "b", "axis", "x", "y", "lng0", "lat0", "lng1", "lat1"]
    rows = e.join(shares, "component").select("_part", "a", "b", none(ax), "cost", "length", *[none("double")] * 4).toDF(*cols)
    rows = rows.unionAll(seg.join(at.withColumnRenamed("id", "seg_id"), "seg_id").join(shares, "component").select("_part", "seg_id", none(node), "axis", "length_m", none("double"), "lng0", "lat0", "lng1", "lat1").toDF(*cols))
    kind = stops.schema["route"].dataType.simpleString()

    def run(left, right):
        import pyarrow as pa

        net, segs, members, by = [], [], {}, {}
        for a, b, axis, x, y, *ends in zip(*(right.column(k).to_pylist() for k in cols[1:])):
            if b is not None:
                net.append((a, b, x, y))
            else:
                segs.append((a, axis, x, *ends))
                members.setdefault(axis, []).append(a)
        g = search.Network(net, segs)
        for route, piece, k, what, i, s, n in sorted(zip(*(left.column(k).to_pylist() for k in ("route", "piece", "ord", "kind", "id", "seg_id", "stops"))), key=lambda r: r[:3]):
            by.setdefault((route, piece, n), []).append({"kind": what, "id": i, "seg_id": s})
        out = []
        for (route, piece, n), chosen in by.items():
            path, back, tips = _through(chosen, g, members), None, None
            if piece:  # begins with an axis, in a sense that depends on the piece before
                back = _through(chosen, g, members, True)
                own = sorted(members[chosen[0]["id"]], key=lambda s: (g.at[s][0], s))
                tips = [*g.at[own[0]], *g.at[own[-1]], *g.ends[back[-1]][1]]
            out.append((route, piece, n, path, back, [*g.ends[path[-1]][1], *(tips or ())]))
        own, ids = left.schema.field("route").type, pa.list_(pa.int64())
        cells = list(zip(*out)) or [()] * 6
        return pa.table([pa.array(v, t) for v, t in zip(cells, (own, pa.int32(), pa.int32(), ids, ids, pa.list_(pa.float64())))], ["route", "piece", "stops", "path", "back", "tips"])

    done = p.groupBy("_part").cogroup(rows.groupBy("_part")).applyInArrow(run, f"route {kind}, piece int, stops int, path array<bigint>, back array<bigint>, tips array<double>")
    whole = done.groupBy("route").agg(F.sort_array(F.collect_list(F.struct("piece", "path", "back", "tips"))).alias("_p"), F.first("stops").alias("stops"))

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            own, paths = [], []
            for i, rows in enumerate(b.column(1).to_pylist()):
                path = _joined([(r["path"], r["back"], r["tips"]) for r in rows])
                if len(path) > 1:
                    own.append(i)
                    paths.append(path)
            at = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array(paths, pa.list_(pa.int64())), b.column(2).take(at)], ["route", "path", "stops"])

    return whole.select("route", "_p", "stops").mapInArrow(join, f"route {kind}, path array<bigint>, stops int")


def _joined(parts: list[tuple]) -> list:
    """The path of pieces (path, path if its first axis is turned, tips): an axis is entered at the end that is nearer. tips:
    where the path ends, and for all pieces but the first the first axis' two ends and where the turned path ends."""
    path: list = []
    for straight, back, tips in parts:
        turn = path and _metres(*end, *tips[4:6]) < _metres(*end, *tips[2:4])
        path, end = path + (back if turn else straight), tips[6:8] if turn else tips[:2]
    return path
