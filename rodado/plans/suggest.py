"""From segments and places to routes: corridors, graph, anchors, searches, zones, assembly, scores, selection.

A candidate is (route, start, end, path): two anchors and the segments between them, in riding order. Assembly groups a
path into runs of one corridor, puts the runs into an order of small gaps, drops what no one would ride, and scores the
rest. Routes are bounded (searches stop at 120 segments), so what is done route by route is done in a row or a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, rules
from ..operators import corridors, graph, greedy, lines, nearby, search, spatial, tracks
from ..session import drop, stage

#: Points an anchor has at least to start or end a route, metres of a gap that no route may have.
LEAST_POINTS, GAP_M = 5, 3000.0


def anchors(places: DataFrame, segments: DataFrame, most_m: float = 3000.0) -> DataFrame:
    """(place_id, name, category, lng, lat, infra_m, score): places near a segment's end or middle, utilities left out.

    The score is the category's, 2 more under 200 m from a segment, 1 more under 800 m; of places of one name within
    200 m the best stays.
    """
    tips = segments.select(F.explode(F.array(
        F.struct(F.col("lng0").alias("_x"), F.col("lat0").alias("_y")), F.struct(F.col("lng1").alias("_x"), F.col("lat1").alias("_y")),
        F.struct(((F.col("lng0") + F.col("lng1")) / 2).alias("_x"), ((F.col("lat0") + F.col("lat1")) / 2).alias("_y")),
    )).alias("_t")).select("_t.*").distinct()
    p = places.where(~F.coalesce(F.col("category").isin(*rules.UTILITY_PLACES), F.lit(False)) & geo.on_earth("lng", "lat"))
    near = spatial.nearest_one(p, tips.withColumn("_id", F.xxhash64("_x", "_y")), "place_id", "_id", (most_m / spatial.GROWTH, most_m))
    a = p.join(near.select("place_id", F.col("metres").alias("infra_m")), "place_id")
    bonus = F.when(F.col("infra_m") < 200, 2).when(F.col("infra_m") < 800, 1).otherwise(0)
    a = stage(a.select("place_id", "name", "category", "lng", "lat", "infra_m", (rules.anchor_points(F.col("category")) + bonus).alias("score")), "anchors")
    return greedy.without_repeats(a.where("name is not null"), "place_id", "name", 200.0, -F.col("score"))


def chain_runs(routes: DataFrame, segments: DataFrame) -> DataFrame:
    """(route, run, axis, name, length_m, lng0, lat0, lng1, lat1, segs array of (ord, seg_id), park_m, oasis_m, road_m, comunas):
    consecutive segments of one corridor are a run, summed anew over the segments it has.

    routes: (route, path). segments also have axis, axis_name and comuna.
    """
    r = routes.select("route", F.posexplode("path").alias("ord", "seg_id")).join(segments, "seg_id")
    r = tracks.islands(r, "route", "ord", "axis")
    placed = lambda *v: F.sum(F.when(F.col("emplazamiento").isin(*v), F.col("length_m")).otherwise(0.0))
    return r.groupBy("route", F.col("island").alias("run")).agg(
        F.first("axis").alias("axis"), F.first("axis_name").alias("name"), F.sum("length_m").alias("length_m"),
        *(F.min_by(c, "ord").alias(c) for c in ("lng0", "lat0")), *(F.max_by(c, "ord").alias(c) for c in ("lng1", "lat1")),
        F.sort_array(F.collect_list(F.struct("ord", "seg_id"))).alias("segs"), placed("parque").alias("park_m"), placed(*rules.GREEN_PLACEMENT).alias("oasis_m"), placed("calzada").alias("road_m"),
        F.array_sort(F.collect_set("comuna")).alias("comunas"), F.count("video").alias("videos"),
    )


def ordered_runs(runs: DataFrame, kinds: DataFrame) -> DataFrame:
    """(route, run, place, turned): the runs of each route in an order of small gaps (:func:`lines.axis_order`)."""
    kind = runs.schema["route"].dataType.simpleString()

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for route, rows, loop in zip(pdf["route"], pdf["_r"], pdf["loop"]):
                ends = [((r["lng0"], r["lat0"]), (r["lng1"], r["lat1"])) for r in rows]
                out += [(route, rows[i]["run"], k, t) for k, (i, t) in enumerate(lines.axis_order(ends, bool(loop)))]
            yield pd.DataFrame(out, columns=["route", "run", "place", "turned"])

    # a route has few runs: a row each, as groups cost far more
    src = runs.groupBy("route").agg(F.sort_array(F.collect_list(F.struct("run", "lng0", "lat0", "lng1", "lat1"))).alias("_r"))
    src = src.join(kinds.select("route", (F.col("kind") == "loop").alias("loop")), "route").repartition(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return src.select("route", "_r", "loop").mapInPandas(run, f"route {kind}, run bigint, place int, turned boolean")


def kind_of(trail: Column, park: Column, same: Column, runs: Column) -> Column:
    """'mountain' for mostly park or a trail's name, 'loop' for one anchor or two under 500 m apart and at least two runs,
    else 'one-way'."""
    return F.when(trail | (park > 0.5), "mountain").when(same & (runs >= 2), "loop").otherwise("one-way")


def loop_shapes(points: DataFrame, totals: DataFrame, runs: DataFrame) -> DataFrame:
    """(route, aspect, efficiency, paperclip, hub, oval) of the shapes of routes.

    points: (route, ord, lng, lat) of all vertices; totals: (route, total_m); runs: (route, place, lng0, lat0, lng1, lat1).
    aspect: longer by shorter side of the box; efficiency: metres by those around the box; paperclip: more than 0.4 of
    about 20 samples of the first half near the second one; hub: ends of runs that meet again. Routes of fewer than four
    points, or less than 100 m wide or high, have aspect 99, efficiency 0, and nothing else.
    """
    p = points.groupBy("route").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("ord", "lng", "lat"))), lambda v: F.struct(v["lng"].alias("x"), v["lat"].alias("y"))).alias("_p"),
        F.min("lng").alias("_x0"), F.max("lng").alias("_x1"), F.min("lat").alias("_y0"), F.max("lat").alias("_y1"),
    ).join(totals.select("route", "total_m"), "route")
    c = F.col
    midx, midy = (c("_x0") + c("_x1")) / 2, (c("_y0") + c("_y1")) / 2
    p = p.withColumns({"_w": geo.haversine("_x0", midy, "_x1", midy), "_h": geo.haversine(midx, "_y0", midx, "_y1"), "_half": F.floor(F.size("_p") / 2).cast("int")})
    p = p.withColumns({"_flat": (F.size("_p") < 4) | (c("_w") < 100) | (c("_h") < 100), "_step": F.greatest(F.floor(c("_half") / 20), F.lit(1)).cast("int"), "_near": F.least(300 + c("total_m") / 20, F.lit(1500.0))})
    every = lambda a: F.filter(a, lambda _, i: i % c("_step") == 0)
    p = p.withColumns({"_a": every(F.slice("_p", 1, c("_half"))), "_b": every(F.slice("_p", c("_half") + 1, F.size("_p")))})
    hits = F.size(F.filter("_a", lambda a: F.exists("_b", lambda b: geo.haversine(a["x"], a["y"], b["x"], b["y"]) < c("_near"))))
    p = p.withColumn("paperclip", ~c("_flat") & (hits / F.greatest(F.size("_a"), F.lit(1)) > 0.4))
    tips = runs.select("route", F.explode(F.array(*(F.struct((F.col("place") * 2 + k).alias("i"), F.col(f"lng{k}").alias("x"), F.col(f"lat{k}").alias("y")) for k in (0, 1)))).alias("_t")).groupBy("route").agg(F.sort_array(F.collect_list("_t")).alias("_t"))
    met = F.aggregate("_t", F.lit(0), lambda s, a: s + F.size(F.filter("_t", lambda b: (b["i"] >= a["i"] + 3) & (geo.haversine(a["x"], a["y"], b["x"], b["y"]) < 200))))
    tips = tips.select("route", F.when(F.size("_t") >= 6, met).otherwise(0).alias("_met"))
    p = p.join(tips, "route", "left")
    aspect = F.when(c("_flat"), 99.0).otherwise(F.greatest("_w", "_h") / F.least("_w", "_h"))
    efficiency = F.when(c("_flat"), 0.0).otherwise(c("total_m") / (2 * (c("_w") + c("_h"))))
    p = p.withColumns({"aspect": aspect, "efficiency": efficiency})
    p = p.withColumn("hub", ~c("_flat") & ((F.coalesce("_met", F.lit(0)) >= 2) | ((F.coalesce("_met", F.lit(0)) >= 1) & (c("efficiency") < 0.5))))
    return p.select("route", "aspect", "efficiency", "paperclip", "hub", (~c("_flat") & (c("aspect") < 2.5) & (c("efficiency") > 0.55) & ~c("paperclip") & ~c("hub")).alias("oval"))


def candidate_score() -> Column:
    """The weighted sum of a candidate to one decimal, from the columns of :func:`assembled`."""
    c = F.col
    km = c("total_m") / 1000
    signature = F.when(c("longest_m") > 5000, 3.0).when(c("longest_m") > 3000, 1.5).otherwise(0.0)
    distance = F.when(km < 4, -2.0).when(km < 5, 0.0).when(km <= 15, 1.0).when(km <= 40, 2.0).otherwise(0.0)
    loop, around = c("kind") == "loop", F.when(c("efficiency") > 0.7, 2.0).when(c("efficiency") > 0.5, 1.0).otherwise(0.0)
    coherence = F.when(loop, around).when(c("detour") < 1.5, 2.0).when(c("detour") < 2, 1.0).when(c("detour") < 2.5, 0.0).otherwise(-1.0)
    kind = F.when(loop, F.when(c("oval"), 5.0).otherwise(2.0)).when(c("kind") == "mountain", 3.0).otherwise(0.0)
    pois = F.when(c("infra_pct") >= 70, F.least(c("pois") * 1.5, F.lit(6.0))).otherwise(0.0)
    s = (
        c("infra_pct") / 10 + F.least(c("condition"), F.lit(10.0)) + (c("start_points") + c("end_points")) / 4 + signature + distance + kind + coherence
        + F.least(c("park") * 8, F.lit(4.0)) + c("oasis") * 5 - c("roadway") * 5 + pois - c("penalty")
    )
    return geo.half_up(s, 1)


def route_name() -> Column:
    """'Sendero X', 'Circuito X' by the longest run with a name, else the start's; 'De A a B' for one-way routes."""
    named = F.when(F.col("longest_name") != "", F.initcap(F.lower("longest_name")))
    known = F.coalesce(named, F.col("start_name"))
    return F.when(F.col("kind") == "mountain", F.concat(F.lit("Sendero "), known)).when(F.col("kind") == "loop", F.concat(F.lit("Circuito "), known)).otherwise(F.concat(F.lit("De "), "start_name", F.lit(" a "), "end_name"))


def assembled(candidates: DataFrame, segments: DataFrame, found: DataFrame, points: DataFrame | None = None, gates: bool = True) -> DataFrame:
    """One row a candidate that can be ridden: kind, name, metres, gaps, shares, shape, anchors' points, places, score.

    candidates: (route, start, end, path); segments: (seg_id, axis, axis_name, length_m, ends, emplazamiento, condition,
    comuna); found: anchors as from :func:`anchors`; points: (seg_id, ord, lng, lat), the vertices of the segments, else
    their ends. Gates: no gap over 3 km, loops also none at their close; no teleport and little retracing in the trace;
    60 % on segments. Without ``gates`` all stay.
    """
    return _shaped(*_scored(candidates, segments, found, points, gates)).drop("_ride")


def _scored(candidates: DataFrame, segments: DataFrame, found: DataFrame, points: DataFrame | None, gates: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows of :func:`assembled` with _ride, but with the shapes of loops alone, as no other score depends on them; and
    what tells the others': (ride, place, ends) of runs, (ride, ord, seg_id, turned) of segments, vertices of segments.

    Many candidates differ only in their anchors. What depends on the path alone is told once a path, and what also depends
    on being a loop once a ride: a path as a loop or not.
    """
    c = F.col
    cand = candidates.select("route", "start", "end", F.xxhash64("path").alias("_line"))
    runs = stage(chain_runs(candidates.select(F.xxhash64("path").alias("route"), "path").dropDuplicates(["route"]), segments).withColumnRenamed("route", "_line"), "runs")
    a = found.select("place_id", "name", "lng", "lat", "score")
    side = lambda k: a.select(F.col("place_id").alias(k), F.col("name").alias(f"{k}_name"), F.col("lng").alias(f"_{k}x"), F.col("lat").alias(f"_{k}y"), F.col("score").alias(f"{k}_points"))
    trail = F.coalesce(F.lower("name").rlike("|".join(rules.TRAIL_WORDS)), F.lit(False))
    g = runs.groupBy("_line").agg(F.sum("length_m").alias("on_m"), F.max(trail).alias("_trail"), F.count("*").alias("runs"), *(F.sum(k).alias(k) for k in ("park_m", "oasis_m", "road_m", "videos")),
                                  F.max("length_m").alias("longest_m"), F.max_by("name", F.struct("length_m", (-c("run")).alias("r"))).alias("longest_name"), F.array_distinct(F.flatten(F.collect_list("comunas"))).alias("comunas"))
    share = lambda k: F.coalesce(c(k) / F.nullif(c("on_m"), F.lit(0.0)), F.lit(0.0))
    g = g.withColumns({"park": share("park_m"), "oasis": share("oasis_m"), "roadway": share("road_m")})
    same = (c("start_name") == c("end_name")) | (geo.haversine("_startx", "_starty", "_endx", "_endy") < 500)
    m = cand.join(side("start"), "start").join(side("end"), "end").join(g, "_line")
    m = m.withColumn("kind", kind_of(c("_trail"), c("park"), same, c("runs"))).withColumn("_ride", F.xxhash64("_line", c("kind") == "loop"))
    m = stage(m.drop("_trail", "park_m", "oasis_m", "road_m", "_startx", "_starty", "_endx", "_endy"), "kinds")
    rides = m.select("_line", c("_ride").alias("route"), "kind", "runs", "on_m").dropDuplicates(["route"])
    own = runs.join(rides.select("_line", "route"), "_line").drop("_line")
    o = stage(own.join(ordered_runs(own, rides), ["route", "run"]).drop("axis", "name", "park_m", "oasis_m", "road_m", "comunas", "videos"), "ordered")
    drop(runs)
    w = Window.partitionBy("route").orderBy("place")
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    flip = {k: F.when(c("turned"), c(f"{k[:3]}{1 - int(k[3])}")).otherwise(c(k)) for k in ("lng0", "lat0", "lng1", "lat1")}
    q = o.drop("segs").withColumns({f"p{k}": F.lag(k).over(w) for k in flip} | {f"f{k}": F.first(k).over(full) for k in flip} | {f"t{k}": v for k, v in flip.items()})
    q = q.withColumns({"_gap": spatial.min_end_gap("p", ""), "_close": spatial.min_end_gap("", "f")})
    gap = F.when(c("_gap") > 10, c("_gap"))
    gaps = q.groupBy("route").agg(
        F.coalesce(F.sum(gap), F.lit(0.0)).alias("gap_m"), F.coalesce(F.max(gap), F.lit(0.0)).alias("gap_max_m"), F.least(F.coalesce(F.sum(tracks.gap_penalty(gap)), F.lit(0.0)), F.lit(8.0)).alias("penalty"),
        F.max_by("_close", "place").alias("close_m"), F.min_by(F.struct("tlng0", "tlat0"), "place").alias("_s"), F.max_by(F.struct("tlng1", "tlat1"), "place").alias("_e"),
    )
    r = rides.drop("_line").join(gaps, "route").withColumn("total_m", c("on_m") + c("gap_m"))
    r = r.withColumn("infra_pct", F.when(c("total_m") > 0, geo.half_up(c("on_m") / c("total_m") * 100)).otherwise(0.0))
    crow = geo.haversine("_s.tlng0", "_s.tlat0", "_e.tlng1", "_e.tlat1")
    r = r.withColumn("detour", F.when(c("runs") == 1, 1.0).when(crow < 100, c("total_m") / 1000).otherwise(c("total_m") / crow)).drop("_s", "_e", "runs", "on_m")
    if gates:
        r = r.where((c("gap_max_m") <= GAP_M) & (c("infra_pct") >= 60) & ((c("kind") != "loop") | (c("close_m") <= GAP_M)))
    r = told = stage(r.withColumn("_loop", c("kind") == "loop").drop("kind"), "rides")
    if points is None:
        points = segments.select("seg_id", F.explode(F.array(*(F.struct(F.lit(k).alias("ord"), c(f"lng{k}").alias("lng"), c(f"lat{k}").alias("lat")) for k in (0, 1)))).alias("_p")).select("seg_id", "_p.*")
    # the segments in riding order, each turned as its run is
    drawn = points.select(c("seg_id").alias("_id")).distinct().withColumn("_drawn", F.lit(True))
    sides = segments.select(c("seg_id").alias("_id"), "lng0", "lat0", "lng1", "lat1", "condition").join(drawn, "_id", "left")
    rid = o.join(r.select("route"), "route", "left_semi").select("route", "place", "turned", F.explode("segs").alias("_g")).join(sides, c("_g.seg_id") == c("_id"))
    rid = rid.withColumn("_o", F.row_number().over(Window.partitionBy("route").orderBy("place", F.when(c("turned"), -c("_g.ord")).otherwise(c("_g.ord")))))
    rid = stage(rid.select("route", c("_o").alias("ord"), c("_id").alias("seg_id"), "turned", "lng0", "lat0", "lng1", "lat1", "condition", "_drawn"), "ridden")
    if gates:
        trace = tracks.valid_trace(rid.select(c("route").alias("track"), "ord", *(v.alias(k) for k, v in flip.items())), gap_m=GAP_M)
        r = r.join(trace.where("valid").select(c("track").alias("route")), "route", "left_semi")
    known = rid.groupBy("route").agg(F.coalesce(geo.half_up(F.avg("condition"), 1), F.lit(0.0)).alias("condition"), F.count("*").alias("segments"), F.max("_drawn").alias("_drawn"))
    r = stage(r.join(known.where("_drawn").drop("_drawn"), "route"), "rides")
    drop(told)
    shapes = loop_shapes(_vertices(rid.join(r.where("_loop").select("route"), "route", "left_semi"), points), r, o)
    r = r.join(shapes, "route", "left").withColumnRenamed("route", "_ride").drop("_loop")
    m = m.join(r, "_ride").drop("_line")
    m = m.join(along(candidates, segments, found, m), "route", "left").withColumn("pois", F.coalesce("pois", F.lit(0)))
    return m.withColumn("name", route_name()).withColumn("score", candidate_score()), o, rid, points


def _vertices(ridden: DataFrame, points: DataFrame) -> DataFrame:
    """(route, ord, lng, lat) of all vertices of the segments (route, ord, seg_id, turned) in riding order."""
    v = ridden.select("route", F.col("ord").alias("_so"), "seg_id", "turned").join(points, "seg_id")
    return v.select("route", F.struct("_so", F.when(F.col("turned"), -F.col("ord")).otherwise(F.col("ord")).alias("o")).alias("ord"), "lng", "lat")


def _shaped(routes: DataFrame, runs: DataFrame, ridden: DataFrame, points: DataFrame) -> DataFrame:
    """Adds the shapes that routes of :func:`_scored` lack."""
    cols = ("aspect", "efficiency", "paperclip", "hub", "oval")
    lack = routes.where("aspect is null").select(F.col("_ride").alias("route"), "total_m").dropDuplicates(["route"])
    of = lambda df: df.join(lack.select("route"), "route", "left_semi")
    s = loop_shapes(_vertices(of(ridden), points), lack, of(runs)).withColumnsRenamed({"route": "_ride"} | {k: f"_{k}" for k in cols})
    return routes.join(s, "_ride", "left").withColumns({k: F.coalesce(k, f"_{k}") for k in cols}).drop(*(f"_{k}" for k in cols))


def along(routes: DataFrame, segments: DataFrame, found: DataFrame, ends_: DataFrame, way_m: float = 300.0, most: int = 10) -> DataFrame:
    """(route, pois, places): kinds of the anchors by the way, and the first ``most`` of them by their number; anchors of
    the name of the route's start or end don't count."""
    tips = segments.select("seg_id", F.explode(F.array(
        F.struct(F.col("lng0").alias("lng"), F.col("lat0").alias("lat")), F.struct(F.col("lng1").alias("lng"), F.col("lat1").alias("lat")),
        F.struct(((F.col("lng0") + F.col("lng1")) / 2).alias("lng"), ((F.col("lat0") + F.col("lat1")) / 2).alias("lat")),
    )).alias("_t")).select("seg_id", "_t.*").distinct()
    a = found.select("place_id", "name", "category", F.col("lng").alias("_x"), F.col("lat").alias("_y"))
    by = nearby.within(tips, a, way_m, ["seg_id"], centre_xy=("_x", "_y"), distance="_d").where(F.col("_d") < way_m).select("seg_id", "place_id", "name", "category").distinct()
    # what is by the way depends on the path alone, and many routes share one
    own = routes.join(ends_.select("route", "start_name", "end_name"), "route").withColumn("_line", F.xxhash64("path"))
    line = own.select("_line", "path").dropDuplicates(["_line"]).select("_line", F.explode("path").alias("seg_id")).join(by, "seg_id")
    line = line.groupBy("_line").agg(F.sort_array(F.collect_set(F.struct("place_id", "name", "category"))).alias("_p"))
    rows = own.select("route", "_line", "start_name", "end_name").join(line, "_line")
    rows = rows.withColumn("_p", F.filter("_p", lambda p: (p["name"] != F.col("start_name")) & (p["name"] != F.col("end_name")))).where(F.size("_p") > 0)
    kinds = F.array_distinct(F.transform("_p", lambda p: F.coalesce(p["category"], F.lit(""))))
    return rows.select("route", F.size(kinds).cast("long").alias("pois"), F.transform(F.slice("_p", 1, most), lambda p: p["name"]).alias("places"))


def axis_anchors(found: DataFrame, segments: DataFrame, most_m: float = 3000.0) -> DataFrame:
    """(axis, place_id, score, place): the anchors within ``most_m`` of a segment's end of each axis, the best first."""
    tips = segments.select("axis", F.explode(F.array(*(F.struct(F.col(f"lng{k}").alias("lng"), F.col(f"lat{k}").alias("lat")) for k in (0, 1)))).alias("_t")).select("axis", "_t.*").distinct()
    a = found.select("place_id", "score", F.col("lng").alias("_x"), F.col("lat").alias("_y"))
    j = nearby.within(tips, a, most_m, ["axis"], centre_xy=("_x", "_y")).select("axis", "place_id", "score").distinct()
    return j.withColumn("place", F.row_number().over(Window.partitionBy("axis").orderBy(F.col("score").desc(), "place_id")))


def out_and_back(found: DataFrame, segments: DataFrame, members: DataFrame, least_m: float = 2000.0) -> DataFrame:
    """(start, end, path): each axis of ``least_m`` and more from its best anchor to the next, or back to the only one."""
    two = axis_anchors(found, segments).where("place <= 2").groupBy("axis").agg(F.min_by("place_id", "place").alias("start"), F.max_by("place_id", "place").alias("end"))
    long = segments.groupBy("axis").agg(F.sum("length_m").alias("_m")).where(F.col("_m") >= least_m)
    path = members.groupBy("axis").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "seg_id"))), lambda s: s["seg_id"]).alias("path"))
    return two.join(long, "axis").join(path, "axis").select("start", "end", "path")


def zone_graph(zones: DataFrame, cells: DataFrame, segments: DataFrame, edges: DataFrame, crow_m: float = 10_000.0, most_m: float = 15_000.0, known: DataFrame | None = None) -> DataFrame:
    """(a, b, length_m, infra_fraction, path, along) with a < b: the way over segments between the zones near each other,
    the share of its hops that cost nothing, and the zones it passes through.

    zones: (zone, clng, clat, ...); cells: (zone, gx, gy) of the cells of the zones. The way back is the reversed one.
    known: the components of the segments (id, component), where they are known already.
    """
    mids = segments.select(F.col("seg_id").alias("id"), ((F.col("lng0") + F.col("lng1")) / 2).alias("lng"), ((F.col("lat0") + F.col("lat1")) / 2).alias("lat"))
    z = zones.select("zone", F.col("clng").alias("lng"), F.col("clat").alias("lat"))
    pairs = stage(spatial.pairs_within(z, "zone", crow_m).select("a", "b"), "pairs")
    # a zone without another one near it, however far from all segments, needs none
    z = z.join(pairs.select(F.explode(F.array("a", "b")).alias("zone")).distinct(), "zone", "left_semi")
    near = spatial.nearest(z, mids.select("id", F.col("lng").alias("_x"), F.col("lat").alias("_y")), "zone", "id", 1, 1000.0).select("zone", "id")
    pairs = pairs.join(near.select(F.col("zone").alias("a"), F.col("id").alias("src")), "a").join(near.select(F.col("zone").alias("b"), F.col("id").alias("dst")), "b")
    pairs = stage(pairs, "pairs")
    p = stage(graph.paths(pairs.select("src", "dst").distinct(), edges, mids, "a_star", most_m, known), "ways")
    hops = p.select("src", "dst", F.explode(F.arrays_zip(F.slice("path", 1, F.size("path") - 1).alias("a"), F.slice("path", 2, F.size("path")).alias("b"))).alias("_h")).select("src", "dst", "_h.a", "_h.b")
    free = hops.join(edges.select("a", "b", "cost"), ["a", "b"]).groupBy("src", "dst").agg(F.avg((F.col("cost") == 0).cast("double")).alias("_free"))
    e = pairs.join(p, ["src", "dst"]).join(free, ["src", "dst"], "left")
    at = mids.select(F.col("id").alias("_s"), geo.cell("lng", 0.002).alias("gx"), geo.cell("lat", 0.002).alias("gy")).join(cells.select("zone", "gx", "gy").distinct(), ["gx", "gy"]).select("_s", "zone")
    by = e.select("a", "b", F.explode("path").alias("_s")).join(at, "_s").where("zone <> a and zone <> b").groupBy("a", "b").agg(F.array_sort(F.collect_set("zone")).alias("along"))
    e = e.join(by, ["a", "b"], "left")
    return e.select("a", "b", F.col("length").alias("length_m"), F.coalesce("_free", F.lit(1.0)).alias("infra_fraction"), "path", F.coalesce("along", F.array().cast(f"array<{zones.schema['zone'].dataType.simpleString()}>")).alias("along"))


def zone_routes(zones: DataFrame, ways: DataFrame, found: DataFrame) -> DataFrame:
    """(source, start, end, path, zones): candidates between two zones of 3 to 30 km, and loops over three zones of 5 to
    35 km and over four of 10 to 50 km, from the best anchors within 2 km of the zones.

    ways: as from :func:`zone_graph`. Loops over three zones aren't tiny or flat; those over four lie in three quadrants.
    """
    z = zones.select("zone", F.col("clng").alias("lng"), F.col("clat").alias("lat"))
    best = spatial.best_within(z, found.where(F.col("score") >= LEAST_POINTS).select("place_id", "score", F.col("lng").alias("_x"), F.col("lat").alias("_y")), 2000.0, "zone", "place_id", "score")
    best = stage(best.select("zone", "place_id"), "best")
    side = lambda k, c: best.select(F.col("zone").alias(k), F.col("place_id").alias(c))
    at = lambda k: z.select(F.col("zone").alias(k), F.col("lng").alias(f"_x{k}"), F.col("lat").alias(f"_y{k}"))
    e = ways.select("a", "b", F.col("length_m").alias("length"))
    p = lambda x, y, c: ways.select(F.col("a").alias(x), F.col("b").alias(y), F.col("path").alias(c))
    one = ways.where(F.col("length_m").between(3000, 30_000)).join(side("a", "start"), "a").join(side("b", "end"), "b")
    one = one.select(F.lit("one-way").alias("source"), "start", "end", "path", F.concat(F.array("a"), "along", F.array("b")).alias("zones"))
    t = graph.triangles(e, 5000.0, 35_000.0)
    for k in "abc":
        t = t.join(at(k), k)
    t = t.where(~graph.collinear(*(F.col(f"_{v}{k}") for k in "abc" for v in "xy"))).join(p("a", "b", "_1"), ["a", "b"]).join(p("b", "c", "_2"), ["b", "c"]).join(p("a", "c", "_3"), ["a", "c"]).join(side("a", "start"), "a")
    t = t.select(F.lit("triangle").alias("source"), "start", F.col("start").alias("end"), F.concat("_1", "_2", F.reverse("_3")).alias("path"), F.array("a", "b", "c").alias("zones"))
    r = graph.rectangles(e, 10_000.0, 50_000.0)
    for k in "abcd":
        r = r.join(at(k), k)
    r = r.where(graph.quadrants([F.col(f"_x{k}") for k in "abcd"], [F.col(f"_y{k}") for k in "abcd"]) >= 3)
    r = r.join(p("a", "b", "_1"), ["a", "b"]).join(p("b", "c", "_2"), ["b", "c"]).join(p("c", "d", "_3"), ["c", "d"]).join(p("a", "d", "_4"), ["a", "d"]).join(side("a", "start"), "a")
    r = r.select(F.lit("rectangle").alias("source"), "start", F.col("start").alias("end"), F.concat("_1", "_2", "_3", F.reverse("_4")).alias("path"), F.array("a", "b", "c", "d").alias("zones"))
    return stage(one, "routes").unionByName(stage(t, "routes")).unionByName(stage(r, "routes"))


def network(segments: DataFrame, gap_m: float = 500.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(segments with axis and axis_name, members, edges): corridors of the segments, their chains, and the segment graph."""
    s = segments
    for c, kind in (("condition", "double"), ("comuna", "string"), ("nombre", "string"), ("video", "string")):
        s = s if c in s.columns else s.withColumn(c, F.lit(None).cast(kind))
    s = stage(s.where("lng0 is not null and lng1 is not null"), "segments")
    axes = stage(corridors.axes_of(s), "axes")
    s = s.join(axes, "seg_id")
    named = s.groupBy("axis").agg(F.coalesce(F.max(F.coalesce(F.nullif("nombre", F.lit("")), "normal_name")), F.lit("")).alias("axis_name"))
    s = stage(s.join(named, "axis"), "segments")
    members = stage(corridors.chained(s, "axis"), "members")
    return s, members, stage(corridors.segment_edges(members, s, gap_m), "edges")


def starts_of(found: DataFrame, segments: DataFrame, within_m: float, k: int, least: int = 1) -> DataFrame:
    """(place_id, lng, lat, seg_id): each anchor with its k nearest segments, if it has ``least`` segments so near."""
    tips = segments.select("seg_id", F.explode(F.array(
        F.struct(F.col("lng0").alias("_x"), F.col("lat0").alias("_y")), F.struct(F.col("lng1").alias("_x"), F.col("lat1").alias("_y")),
        F.struct(((F.col("lng0") + F.col("lng1")) / 2).alias("_x"), ((F.col("lat0") + F.col("lat1")) / 2).alias("_y")),
    )).alias("_t")).select("seg_id", "_t.*").distinct()
    near = spatial.top_within(found.select("place_id", "lng", "lat"), tips, within_m, "place_id", "seg_id", max(k, least))
    full = near.where(F.col("place") >= least).select("place_id").distinct()
    return near.where(F.col("place") <= k).join(full, "place_id", "left_semi").join(found.select("place_id", "lng", "lat"), "place_id").select("place_id", "lng", "lat", "seg_id")


def candidates_of(found: DataFrame, segments: DataFrame, members: DataFrame, edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(route, source, start, end, path) of the searches from the anchors of LEAST_POINTS and more, and along single axes."""
    good = stage(found.where(F.col("score") >= LEAST_POINTS), "good")
    known = search.connected(segments, edges) if known is None else known
    # each part for itself: one plan of all would take much of the driver's memory
    one = search.search_routes(starts_of(good, segments, 2000.0, 3), segments, edges, good, known=known).select(F.lit("one-way").alias("source"), "start", "end", "path")
    around = search.search_routes(starts_of(good, segments, 1500.0, 2, search.LOOP_SEGMENTS), segments, edges, good, "loops", known=known).select(F.lit("loop").alias("source"), "start", "end", "path")
    one, around = stage(one, "routes"), stage(around, "routes")
    back = out_and_back(good, segments, members).select(F.lit("axis").alias("source"), "start", "end", "path")
    return numbered(one.unionAll(around).unionAll(back))


def numbered(candidates: DataFrame) -> DataFrame:
    """Adds route, a number told from the anchors and the path; candidates given twice come out once."""
    return candidates.withColumn("route", F.xxhash64("start", "end", "path")).dropDuplicates(["route"])


def kept(routes: DataFrame, candidates: DataFrame, segments: DataFrame, share: float = 0.6) -> DataFrame:
    """Routes best first, without those that share more than ``share`` of their corridors with a better one; length adds up
    to 5 points, so that a corridor's whole isn't ousted by its parts."""
    axes = candidates.join(routes.select("route"), "route", "left_semi").select("route", F.explode("path").alias("seg_id")).join(segments.select("seg_id", "axis"), "seg_id").groupBy("route").agg(F.collect_set("axis").alias("_axes"))
    rank = -(F.col("score") + F.least(F.col("total_m") / 2000, F.lit(5.0)))
    # of routes over the same corridors only the best can stay: the others needn't meet anything else
    best = routes.join(axes, "route").groupBy(F.array_sort("_axes").alias("_axes")).agg(F.min_by("route", F.struct(rank.alias("r"), F.col("route").alias("k"))).alias("route"))
    r = stage(routes.join(best, "route"), "best")
    return greedy.keep_best(r, greedy.set_conflicts(r, "route", "_axes", share), "route", rank, rounds=2).drop("_axes")


def survey_matches(ways: DataFrame, surveys: DataFrame, near_m: float = 80.0, share: float = 0.4) -> DataFrame:
    """(seg_id, feature_id): for each way the first surveyed feature that more than ``share`` of the way's samples lie near a
    sample of. ways: (seg_id, points, length_m); surveys: (feature_id, points, length_m); points array<struct<lng,lat>>.

    About five samples a line (:func:`geo.sampled`). Lines whose vertex means are farther apart than both lengths don't match.
    """
    side = lambda df, key, x, y: df.where(F.size("points") > 0).select(key, F.col("length_m").alias(f"_l{key}"), geo.centroid(F.col("points")).alias(f"_c{key}"), F.posexplode(geo.sampled(F.col("points"))).alias(f"_i{key}", "_p")).select(key, f"_l{key}", f"_c{key}", f"_i{key}", F.col("_p.lng").alias(x), F.col("_p.lat").alias(y))
    w, v = side(ways, "seg_id", "lng", "lat"), side(surveys, "feature_id", "_x", "_y")
    n = ways.where(F.size("points") > 0).select("seg_id", F.size(geo.sampled(F.col("points"))).alias("_n"))
    j = nearby.within(w, v, near_m, ["seg_id", "_iseg_id"], centre_xy=("_x", "_y"), distance="_d").where(F.col("_d") < near_m)
    j = j.where(geo.haversine("_cseg_id.lng", "_cseg_id.lat", "_cfeature_id.lng", "_cfeature_id.lat") <= F.col("_lseg_id") + F.col("_lfeature_id"))
    hit = j.groupBy("seg_id", "feature_id").agg(F.count_distinct("_iseg_id").alias("_hit")).join(n, "seg_id").where(F.col("_hit") > share * F.col("_n"))
    return hit.groupBy("seg_id").agg(F.min("feature_id").alias("feature_id"))


def surveyed(segments: DataFrame, surveys: DataFrame, matches: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Segments with what their surveyed feature knows, else their own: ``columns`` maps a survey's column to the segment's."""
    s = surveys.select("feature_id", *(F.col(k).alias(f"_s_{v}") for k, v in columns.items()))
    j = segments.join(matches.join(s, "feature_id"), "seg_id", "left")
    own = lambda v: F.col(v) if v in segments.columns else F.lit(None)
    return j.withColumns({v: F.coalesce(f"_s_{v}", own(v)) for v in columns.values()}).drop(*(f"_s_{v}" for v in columns.values()))


def suggest(segments: DataFrame, places: DataFrame, gap_m: float = 500.0, zones: tuple[DataFrame, DataFrame] | None = None, points: DataFrame | None = None) -> DataFrame:
    """Routes between anchors, similar ones reduced to the best: all columns of :func:`assembled`, source, path, and zones.

    segments: (seg_id, normal_name, length_m, emplazamiento, bike_direction, lng0, lat0, lng1, lat1), with condition, comuna
    and nombre where known. places: (place_id, name, category, lng, lat). zones: (zone, clng, clat, ...) and their cells
    (zone, gx, gy), if routes between zones are wanted, too.
    """
    s, members, edges = network(segments, gap_m)
    found = stage(anchors(places, s), "anchors")
    known = search.connected(s, edges)
    c = candidates_of(found, s, members, edges, known)
    if zones is not None:
        z, cells = zones
        c = c.drop("route").unionByName(zone_routes(z, zone_graph(z, cells, s, edges, known=known), found).drop("zones"))
        c = numbered(c)
    c = stage(c, "candidates")
    return chosen(c, s, found, points)


def chosen(candidates: DataFrame, segments: DataFrame, found: DataFrame, points: DataFrame | None = None) -> DataFrame:
    """The candidates (route, source, start, end, path) that can be ridden, assembled, and reduced to the best by
    :func:`kept`."""
    m, runs, ridden, points = _scored(candidates, segments, found, points)
    r = stage(m.join(candidates.select("route", "source", "path"), "route"), "routes")
    best = stage(kept(r, candidates, segments), "kept")
    return _shaped(best, runs, ridden, points).drop("_ride")
