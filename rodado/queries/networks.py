"""Queries on corridors, ordering, zones, searches, greedy selections and whole pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, rules
from ..operators import collections as R
from ..operators import corridors, greedy, lines, search, spatial, zones
from ..operators import tracks as T
from ..plans import generate, score_routes, suggest
from ..sinks import files
from ..session import stage, table
from ._sql import TRACKS, hav
from .files import _WV
from .records import _LEN, _PREFIX, _SP, _T, _WAYS
from .spatial import _PL
from .views import event_tracks, located, places

QUERIES, SQL = {}, {}


def _add(name, make, sql=None):
    QUERIES[name] = make
    if sql:
        SQL[name] = sql


def segments(s, d):
    w = R.way_segments(table(s, d, "ways"))
    return w.where("lng0 is not null").select(F.col("way_id").alias("seg_id"), "nombre", "normal_name", "length_m", "emplazamiento", "bike_direction", "surface", "lit", "tipo", "ancho_cm", "lng0", "lat0", "lng1", "lat1")


def way_lines(s, d):
    """(seg_id, points, length_m) of the ways."""
    w = table(s, d, "ways").where("way_id is not null").dropDuplicates(["way_id"])
    pts = F.transform(F.filter("geometry", lambda p: geo.on_earth(p["lon"], p["lat"])), lambda p: F.struct(p["lon"].alias("lng"), p["lat"].alias("lat")))
    w = w.select(F.col("way_id").alias("seg_id"), F.coalesce(pts, F.array().cast("array<struct<lng:double,lat:double>>")).alias("points"))
    return w.withColumn("length_m", geo.line_length(F.col("points")))


def survey_lines(s, d):
    """(feature_id, points, length_m, what the survey knows) of the valid surveyed features."""
    c = table(s, d, "catastro")
    pts = F.filter(F.transform(F.flatten(F.filter("geometry.coordinates", lambda x: x.isNotNull())), lambda p: F.struct(F.try_element_at(p, F.lit(1)).alias("lng"), F.try_element_at(p, F.lit(2)).alias("lat"))), lambda p: geo.on_earth(p["lng"], p["lat"]))
    p = c.where("feature_id is not null").dropDuplicates(["feature_id"]).select("feature_id", F.coalesce(pts, F.array().cast("array<struct<lng:double,lat:double>>")).alias("points"))
    return R.survey_segments(c).where("not invalida").drop("points").join(p, "feature_id")


#: What a surveyed feature tells of a segment: its columns and the segment's.
KNOWN = {"emplazamiento": "emplazamiento", "clasificacion": "clasificacion", "score": "condition", "ancho_cm": "ancho_cm", "video": "video", "tipo": "tipo", "comuna": "comuna"}


def surveyed_segments(s, d):
    v = stage(survey_lines(s, d), "surveys")
    return suggest.surveyed(segments(s, d), v, suggest.survey_matches(way_lines(s, d), v), KNOWN)


#: Kinds of anchors that the terms of places.category mean.
KINDS = {
    "parkland": "park", "coffee house": "cafe", "bicycle workshop": "bicycle", "viewpoint": "viewpoint", "sandy shore": "beach", "campground": "camp_site", "public toilet": "toilets",
    "footbridge": "bridge", "gelato bar": "ice_cream", "brewpub": "pub", "museum": "museum", "train station": "station", "ferry dock": "ferry_terminal", "car parking": "parking",
    "bike hire": "bicycle_rental", "street market": "marketplace", "botanical garden": "garden", "water reservoir": "water", "picnic area": "square",
}


def sights(s, d):
    """Places with the kind of anchor that their category is."""
    kind = F.create_map(*(F.lit(x) for kv in KINDS.items() for x in kv))
    p = located(places(s, d)).select("place_id", "name", F.lower(F.trim("category")).alias("_c"), "lng", "lat")
    return p.select("place_id", "name", F.coalesce(F.try_element_at(kind, F.col("_c")), F.col("_c")).alias("category"), "lng", "lat")


def _pieces(s, d):
    w = table(s, d, "ways").where("way_id is not null").dropDuplicates(["way_id"])
    pts = F.transform(F.filter("geometry", lambda p: geo.on_earth(p["lon"], p["lat"])), lambda p: F.struct(p["lon"].alias("lng"), p["lat"].alias("lat")))
    w = w.select("way_id", pts.alias("points"), (rules.tag(F.col("tags"), "oneway") == "yes").alias("oneway"))
    b = table(s, d, "bikepaths").where("path_id is not null").select("path_id", F.explode("osm_way_ids").alias("way_id")).distinct()
    return b.join(w, "way_id")


_NAME = _SP.format("regexp_replace(" + _SP.format("strip_accents(upper(" + "coalesce(" + _T("name", "name:es") + ",'')" + "))") + ", '^(" + _PREFIX + ") +', '')")
_SEGS = f"""{_WAYS}, sg0 AS (SELECT way_id AS id, {_NAME} AS name, list_filter(geometry, lambda p: p.lat BETWEEN -90 AND 90 AND p.lon BETWEEN -180 AND 180) AS p FROM w), sg AS (SELECT id, name, {_LEN} AS len, p[1].lon AS x0, p[1].lat AS y0, p[-1].lon AS x1, p[-1].lat AS y1 FROM sg0 WHERE len(p)>0)"""
_NEAR = lambda i, j: f"{hav(f'a.x{i}', f'a.y{i}', f'b.x{j}', f'b.y{j}')}<{{}}200"
_CONT = f"""ct AS (SELECT a.id AS a, b.id AS b FROM sg a JOIN sg b ON a.name=b.name AND a.name<>'' AND a.id<b.id WHERE ({_NEAR(1, 0).format('=')} OR {_NEAR(0, 1).format('=')})
AND NOT ((({_NEAR(0, 0).format('')} AND {_NEAR(1, 1).format('')}) OR ({_NEAR(0, 1).format('')} AND {_NEAR(1, 0).format('')})) AND a.len>200 AND b.len>200))"""
_AXES = f"{_SEGS}, {_CONT}, e AS (SELECT a AS u, b AS v FROM ct UNION ALL SELECT b, a FROM ct), r(u, c) AS (SELECT id, id FROM sg UNION SELECT e.v, r.c FROM r JOIN e ON e.u=r.u WHERE r.c<e.v), ax AS (SELECT u AS id, min(c) AS axis FROM r GROUP BY u)"
_add("q_axes", lambda s, d: corridors.axes_of(segments(s, d)).groupBy("axis").agg(F.count("*").alias("segments")), f"WITH RECURSIVE {_AXES} SELECT axis, count(*) AS segments FROM ax GROUP BY 1")
_add("q_chained", lambda s, d: corridors.chained(segments(s, d).join(corridors.axes_of(segments(s, d)), "seg_id"), "axis").withColumn("gap_m", F.round("gap_m", 2)))


def _merged(s, d):
    seg = stage(segments(s, d).join(corridors.axes_of(segments(s, d)), "seg_id"), "segments")
    a = seg.groupBy("axis").agg(F.max("nombre").alias("name"), F.sum("length_m").alias("length_m"))
    a = stage(a.join(corridors.axis_ends(corridors.chained(seg, "axis"), seg), "axis"), "axes")
    return corridors.merged_axes(a.join(corridors.mergeable(a), "axis"), "group").select("axis", "corridor")


_add("q_merged_axes", _merged)
_add("q_ordered_paths", lambda s, d: lines.ordered_paths(_pieces(s, d), "path_id"))


def _graph(s, d):
    """The segments and the edges between them; the names are made plain once."""
    seg = stage(segments(s, d).select("seg_id", "normal_name", "length_m", "bike_direction", "lng0", "lat0", "lng1", "lat1"), "segments")
    axes = stage(corridors.axes_of(seg), "axes")
    members = stage(corridors.chained(seg.join(axes, "seg_id"), "axis"), "members")
    return seg, corridors.segment_edges(members, seg, 300.0)


def _mid(seg):
    return seg.select(F.col("seg_id").alias("id"), ((F.col("lng0") + F.col("lng1")) / 2).alias("lng"), ((F.col("lat0") + F.col("lat1")) / 2).alias("lat"))


_add("q_segment_edges", lambda s, d: _graph(s, d)[1].select("a", "b", F.round("cost", 2).alias("cost")))


def _searched(s, d, how):
    seg, members, edges = suggest.network(segments(s, d), 300.0)
    good = stage(suggest.anchors(sights(s, d), seg).where(F.col("score") >= suggest.LEAST_POINTS), "good")
    at = suggest.starts_of(good, seg, 2000.0, 3) if how == "one_way" else suggest.starts_of(good, seg, 1500.0, 2, search.LOOP_SEGMENTS)
    return search.search_routes(at, seg, edges, good, how).select("start", "end", "seg_id", F.round("on_m", 1).alias("on_m"), F.round("gap_m", 1).alias("gap_m"), F.size("path").alias("segments"))


_add("q_one_way_search", lambda s, d: _searched(s, d, "one_way"))
_add("q_loop_search", lambda s, d: _searched(s, d, "loops"))


def _a_star(s, d):
    from ..operators import graph

    seg, e = _graph(s, d)
    e = stage(e, "edges")
    req = e.where("a < b").select(F.col("a").alias("src"), F.col("b").alias("m")).join(e.where("a < b").select(F.col("a").alias("m"), F.col("b").alias("dst")), "m").select("src", "dst").distinct()
    return graph.paths(req, e, _mid(seg), "a_star", 15_000.0).select("src", "dst", F.round("length", 2).alias("length"), F.size("path").alias("hops"))


_add("q_a_star", _a_star)
_add("q_anchors", lambda s, d: suggest.anchors(sights(s, d), segments(s, d)).select("place_id", "score", F.round("infra_m", 2).alias("infra_m")))


def _pl(s, d):
    return located(places(s, d)).select("place_id", "category", "name", "lng", "lat")


_RANK = lambda: F.pmod(F.col("place_id") * 7919, F.lit(10007))
_add("q_keep_best", lambda s, d: greedy.keep_best(_pl(s, d), spatial.pairs_within(_pl(s, d), "place_id", 300.0), "place_id", _RANK()).select("place_id"))
_add("q_cluster", lambda s, d: greedy.cluster_report(_pl(s, d), greedy.cluster(_pl(s, d), "place_id", 500.0, _RANK()), "place_id", "category"))
_add("q_without_repeats", lambda s, d: greedy.without_repeats(_pl(s, d).where("name is not null"), "place_id", "name", 2000.0, F.col("place_id")).select("place_id"))


def _diverse(s, d):
    area = F.concat_ws(",", geo.cell("lng", 0.05), geo.cell("lat", 0.05))
    p = _pl(s, d).where("category is not null").withColumn("area", area).withColumn("score", _RANK())
    return greedy.select_diverse(p, spatial.pairs_within(p, "place_id", 500.0), "place_id", "area", "score", {"category": 5}, 60)


_add("q_select_diverse", _diverse)
_add("q_line_overlap", lambda s, d: greedy.overlapping(T.resample(_ways(s, d), 50.0).select(F.col("track").alias("line"), F.col("at_m").cast("long").alias("ord"), "lng", "lat"), 30.0, 0.5),
     f"""WITH {_WV}, a AS (SELECT *, lag(lng) OVER w AS px, lag(lat) OVER w AS py FROM wv WINDOW w AS (PARTITION BY track ORDER BY ord)), b AS (SELECT *, {hav('px', 'py', 'lng', 'lat')} AS step FROM a), c AS (SELECT *, sum(step) OVER (PARTITION BY track ORDER BY ord ROWS UNBOUNDED PRECEDING) AS cum FROM b),
k AS (SELECT *, cum-step AS start, unnest(range(ceil((cum-step)/50.0)::BIGINT, floor(cum/50.0)::BIGINT+1)) AS k FROM c WHERE step>0), s AS (SELECT track, k, px+(lng-px)*(k*50.0::DOUBLE-start)/step AS x, py+(lat-py)*(k*50.0::DOUBLE-start)/step AS y FROM k WHERE k*50.0<cum),
n AS (SELECT track, count(*) AS n FROM s GROUP BY 1), h AS (SELECT a.track AS a, b.track AS b, count(DISTINCT a.k) AS h FROM s a JOIN s b ON a.track<>b.track AND abs(a.y-b.y)<0.0003 WHERE {hav('a.x', 'a.y', 'b.x', 'b.y')}<=30 GROUP BY 1,2)
SELECT DISTINCT least(a,b) AS a, greatest(a,b) AS b FROM h JOIN n ON n.track=h.a WHERE h/n>=0.5""")


def _ways(s, d):
    from .views import way_points

    return way_points(s, d)


_add("q_zones", lambda s, d: zones.strongest(zones.boosted(zones.lively(_pl(s, d).select(F.coalesce("category", F.lit("other")).alias("kind"), "lng", "lat"), 3), "zone", [(_pl(s, d).where("category = 'train station'").select(F.col("lng").alias("_x"), F.col("lat").alias("_y")), 500.0, 1.0)]), "zone").select("points", "cells", "kind", F.round("magnetism", 4).alias("magnetism")))
_DISC = lambda src, key, m: f"""dc AS (SELECT {key} AS key, lng, lat, ceil({m}/{geo.DEGREE_M}/0.001::DOUBLE)::INT AS ny, ceil({m}/{geo.DEGREE_M}/greatest(cos(radians(lat)),0.01)/0.001::DOUBLE)::INT AS nx FROM {src}), di AS (SELECT *, unnest(range(-nx,nx+1)) AS i FROM dc), dj AS (SELECT *, unnest(range(-ny,ny+1)) AS j FROM di),
dd AS (SELECT DISTINCT key, floor((lng+i*0.001::DOUBLE)/0.001::DOUBLE)::BIGINT AS gx, floor((lat+j*0.001::DOUBLE)/0.001::DOUBLE)::BIGINT AS gy FROM dj WHERE {hav('lng', 'lat', 'lng+i*0.001::DOUBLE', 'lat+j*0.001::DOUBLE')}<={m})"""  # noqa: E731
_add("q_waterside", lambda s, d: zones.waterside(_ways(s, d), "track").select("track", "cells", "magnetism"), f"WITH {_WV}, {_DISC('wv', 'track', 150.0)} SELECT key AS track, count(*) AS cells, 9.0::DOUBLE AS magnetism FROM dd GROUP BY 1")
_add("q_repelling", lambda s, d: zones.repelling(_ways(s, d)).groupBy("zone").agg(F.count("*").alias("cells")).select("cells"))
_add("q_zones_along", lambda s, d: zones.zones_along(_ways(s, d), zones.buffered(_pl(s, d), "place_id", 200.0), "track", "place_id"),
     f"WITH {_WV}, {_PL}, {_DISC('p', 'place_id', 200.0)} SELECT DISTINCT track, key AS place_id FROM wv JOIN dd ON floor(lng/0.001::DOUBLE)=gx AND floor(lat/0.001::DOUBLE)=gy")
_add("q_buffer_cells", lambda s, d: spatial.disc_cells(_pl(s, d), "lng", "lat", 300.0, 0.001).groupBy("gx", "gy").agg(F.count_distinct("place_id").alias("places")),
     f"WITH {_PL}, {_DISC('p', 'place_id', 300.0)} SELECT gx, gy, count(*) AS places FROM dd GROUP BY 1,2")
_add("q_top80", lambda s, d: greedy.top_groups(_pl(s, d).groupBy(geo.cell("lng", 0.005).alias("gx"), geo.cell("lat", 0.005).alias("gy")).agg(F.count("*").alias("n")), 80, F.col("n").desc(), F.col("gx"), F.col("gy")),
     f"WITH {_PL} SELECT floor(lng/0.005::DOUBLE)::BIGINT AS gx, floor(lat/0.005::DOUBLE)::BIGINT AS gy, count(*) AS n FROM p GROUP BY 1,2 ORDER BY n DESC, gx, gy LIMIT 80")


def _zones(s, d):
    """The strongest lively zones and their cells."""
    pts = _pl(s, d).select(F.coalesce("category", F.lit("other")).alias("kind"), "lng", "lat")
    z = stage(zones.strongest(zones.lively(pts, 3), "zone"), "zones")
    return z, stage(zones.lively_cells(pts, 3).join(z.select("zone"), "zone"), "cells")


def suggested(s, d):
    pts = way_lines(s, d).select("seg_id", F.posexplode("points").alias("ord", "_p")).select("seg_id", "ord", "_p.*")
    return suggest.suggest(surveyed_segments(s, d), sights(s, d), zones=_zones(s, d), points=pts)


_add("q_suggest", lambda s, d: suggested(s, d).select("route", "source", "kind", "name", F.round("total_m", 1).alias("total_m"), "infra_pct", "segments", "runs", F.round("condition", 1).alias("condition"), "pois", "score"))


def _zone_graph(s, d):
    seg, _, edges = suggest.network(segments(s, d), 300.0)
    z, cells = _zones(s, d)
    return suggest.zone_graph(z, cells, seg, edges)


_add("q_zone_graph", lambda s, d: _zone_graph(s, d).select("a", "b", F.round("length_m", 1).alias("length_m"), F.round("infra_fraction", 4).alias("infra_fraction"), F.size("path").alias("segments"), F.size("along").alias("along")))


def _zone_routes(s, d):
    seg, _, edges = suggest.network(segments(s, d), 300.0)
    z, cells = _zones(s, d)
    found = stage(suggest.anchors(sights(s, d), seg), "anchors")
    return suggest.zone_routes(z, suggest.zone_graph(z, cells, seg, edges), found)


_add("q_zone_routes", lambda s, d: _zone_routes(s, d).select("source", "start", "end", F.size("path").alias("segments"), F.array_join(F.col("zones").cast("array<string>"), ",").alias("zones")))


def _axis_anchors(s, d):
    seg, _, _ = suggest.network(segments(s, d), 300.0)
    return suggest.axis_anchors(suggest.anchors(sights(s, d), seg).where(F.col("score") >= suggest.LEAST_POINTS), seg).where("place <= 5")


_add("q_axis_anchors", _axis_anchors)
def _generated(s, d):
    """Each registered path as a route over its ways, from its first anchor to its last one if it has two different ones."""
    pieces = stage(_pieces(s, d), "pieces")
    paths = generate.path_pieces(pieces, lines.ordered_paths(pieces, "path_id"), "path_id").withColumnRenamed("path_id", "path")
    good = F.filter("anchors", lambda a: (F.size(a) == 2) & geo.on_earth(a[0], a[1]))
    b = table(s, d, "bikepaths").where("path_id is not null").dropDuplicates(["path_id"]).select("path_id", F.coalesce(good, F.array().cast("array<array<double>>")).alias("a"))
    none = F.lit(None).cast("double")
    place = lambda k, a: F.struct(F.lit(k).alias("ord"), F.lit(None).cast("bigint").alias("path"), F.try_element_at(a, F.lit(1)).alias("lng"), F.try_element_at(a, F.lit(2)).alias("lat"))
    whole = F.array(F.struct(F.lit(1).alias("ord"), F.col("path_id").alias("path"), none.alias("lng"), none.alias("lat")))
    first, last = F.try_element_at("a", F.lit(1)), F.try_element_at("a", F.lit(-1))
    stops = F.when((F.size("a") > 1) & (first != last), F.concat(F.array(place(0, first)), whole, F.array(place(2, last)))).otherwise(whole)
    return generate.generated_routes(b.select(F.col("path_id").alias("route"), F.explode(stops).alias("_s")).select("route", "_s.*"), paths)


_add("q_generated_routes", lambda s, d: _generated(s, d).groupBy("route").agg(F.count("*").alias("points"), F.max("part").alias("parts")))

# --- the flagship: score cards of tracks -----------------------------------------------------------------------


def _ground(s, d):
    """Points of three kinds around the tracks, told from the orders' keys."""
    o = table(s, d, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    return o.select(F.element_at(F.array(F.lit("bike"), F.lit("car"), F.lit("green")), (k % 3 + 1).cast("int")).alias("ground"), (F.lit(-75.7) + ((k * 7919) % 20001 - 10000) / 1e5).alias("_x"), (F.lit(45.4) + ((k * 104729) % 20001 - 10000) / 1e5).alias("_y"))


def cards(s, d):
    p = event_tracks(s, d)
    pois = located(places(s, d)).where("name is not null").select("name", (F.lit(-75.7) + (F.col("place_id") % 400 - 200) / 1e3).alias("_x"), (F.lit(45.4) + ((F.col("place_id") * 7) % 400 - 200) / 1e3).alias("_y"))
    tags = p.select("track").distinct().select("track", F.when(F.col("track") % 2 == 0, F.array(F.lit("loop"))).otherwise(F.array(F.lit("flat"))).alias("tags"))
    return score_routes.score_cards(p, pois, _ground(s, d), tags)


_GR = "gr AS (SELECT ['bike','car','green'][(o_orderkey%3)::INT+1] AS ground, -75.7+((o_orderkey*7919)%20001-10000)/1e5 AS x, 45.4+((o_orderkey*104729)%20001-10000)/1e5 AS y FROM orders)"
_GD = hav("lng", "lat", "x", "y")
#: The samples of long tracks: every n-th point.
_SA = "sa AS (SELECT track, ord, lng, lat FROM (SELECT *, row_number() OVER (PARTITION BY track ORDER BY ord)-1 AS i, count(*) OVER (PARTITION BY track) AS n FROM tr) WHERE i % greatest(n//200,1) = 0)"
_add("q_ground_shares", lambda s, d: score_routes.ground_shares(event_tracks(s, d), _ground(s, d)),
     f"""WITH {TRACKS}, {_GR}, {_SA}, h AS (SELECT track, ord, max(CASE WHEN ground='bike' AND {_GD}<50 THEN 1 ELSE 0 END) AS b, max(CASE WHEN ground='car' AND {_GD}<50 THEN 1 ELSE 0 END) AS c, max(CASE WHEN ground='green' AND {_GD}<200 THEN 1 ELSE 0 END) AS g FROM sa JOIN gr ON abs(lat-y)<0.002 AND abs(lng-x)<0.004 GROUP BY 1,2)
SELECT sa.track, floor(sum(coalesce(b,0))/count(*)*100+0.5)::BIGINT AS bike_pct, floor(sum(coalesce(c,0))/count(*)*100+0.5)::BIGINT AS car_pct, floor(sum(coalesce(g,0))/count(*)*100+0.5)::BIGINT AS green_pct FROM sa LEFT JOIN h ON h.track=sa.track AND h.ord=sa.ord GROUP BY 1""")


def _cards_sql():
    """The parts of the other twins, joined as the plan joins them: ca has every column of a card."""
    from . import tracks as Q

    base = Q._SMOOTH + Q._INTER + Q._RIDE + Q._SHAPE
    jumps = ", ju AS (SELECT track, count(*) FILTER (step_m>500) AS j5, count(*) FILTER (step_m>1000) AS j1 FROM st GROUP BY track)"
    dens = ", de AS (SELECT track, (CASE WHEN length_m>0 THEN floor(n/(length_m/1000)+0.5) ELSE 0 END)::BIGINT AS ppk FROM en WHERE n>=2)"
    own = _PL.replace("p AS", "pq AS", 1)
    pois = f""", {own}, pp AS (SELECT name, -75.7+(place_id%400-200)/1e3 AS x, 45.4+(place_id*7%400-200)/1e3 AS y FROM pq WHERE name IS NOT NULL), ph AS (SELECT track, count(DISTINCT name) AS k FROM sa JOIN pp ON abs(lat-y)<0.005 AND {_GD}<500 GROUP BY 1),
po AS (SELECT en.track, CASE WHEN length_m>0 THEN floor(coalesce(k,0)/(length_m/1000)*100+0.5)/10 ELSE 0 END AS per FROM en LEFT JOIN ph USING (track))"""
    gs = SQL["q_ground_shares"].split(_SA)[1].replace("\nSELECT sa.track", ", gs AS (SELECT sa.track", 1) + ")"
    loop = f", cl AS (SELECT track, floor({hav('lng0','lat0','lng1','lat1')}+0.5)::BIGINT AS closure_m, floor({hav('lng0','lat0','lng1','lat1')}+0.5)<500 AS closed FROM en WHERE track%2=0)"
    score = ("smoothness*0.25::DOUBLE-walkbacks*5+real_pct*0.2::DOUBLE+least(per*3,15.0::DOUBLE)-j1*10-(j5-j1)*5+least(ppk/5,10.0::DOUBLE)+(CASE WHEN closed IS NULL THEN 0 WHEN closed THEN 5 ELSE -10 END)"
             "+(rideability-50)*0.6::DOUBLE+(bike_pct*0.15::DOUBLE-car_pct*0.1::DOUBLE+green_pct*0.1::DOUBLE)")
    said = ["CASE WHEN walkbacks>0 THEN walkbacks || ' walkbacks' END", "CASE WHEN j1>0 THEN j1 || ' jumps >1km' END", "CASE WHEN runs>3 THEN runs || ' interpolated gaps' END", "CASE WHEN bike_pct<30 THEN 'only ' || bike_pct || '% on bike path' END",
            "CASE WHEN car_pct>50 THEN car_pct || '% near car traffic' END", "CASE WHEN NOT closed THEN 'loop not closed (' || closure_m || 'm gap)' END", "CASE WHEN rideability<50 THEN 'low rideability ' || rideability || '%' END", "CASE WHEN ppk<20 THEN 'sparse (' || ppk || ' pts/km)' END"]
    issues = f"array_to_string(list_filter([{', '.join(said)}], lambda x: x IS NOT NULL), '; ')"
    return f"WITH {TRACKS}, {_SA}{base}{jumps}{dens}{pois}, {_GR}{gs}{loop}, ca AS (SELECT *, floor(({score})*10.0::DOUBLE+0.5::DOUBLE)/10.0::DOUBLE AS composite, {issues} AS issues FROM sm JOIN ip USING (track) JOIN ri USING (track) JOIN ju USING (track) JOIN de USING (track) JOIN po USING (track) JOIN gs USING (track) JOIN sp USING (track) LEFT JOIN cl USING (track))"


_CARDS = _cards_sql()
_add("q_score_cards", lambda s, d: cards(s, d).select("track", "smoothness", "walkbacks", "real_pct", "rideability", "composite"), _CARDS + " SELECT track, smoothness, walkbacks, real_pct, rideability, composite FROM ca")
_add("q_card_issues", lambda s, d: cards(s, d).select("track", "shape", F.array_join("issues", "; ").alias("issues")), _CARDS + " SELECT track, shape, issues FROM ca")
_add("q_card_summary", lambda s, d: score_routes.summary(cards(s, d)), _CARDS + " SELECT count(*) AS tracks, floor(avg(composite)*100+0.5)/100 AS mean, min(composite) AS low, max(composite) AS high, count(*) FILTER (composite>=50) AS good, count(*) FILTER (issues<>'') AS with_issues, sum(j1)::BIGINT AS jumps FROM ca")
_add("q_report", lambda s, d: files.report_lines(cards(s, d)), _CARDS + " SELECT printf('%6.1f  %s  %s  %s', composite, track::VARCHAR, shape, issues) AS line FROM ca")
_add("q_tag_audit", lambda s, d: score_routes.ground_shares(event_tracks(s, d), _ground(s, d)).select("track", F.when((F.col("green_pct") >= 50) & (F.col("track") % 2 == 0), "MISSING").when((F.col("green_pct") < 50) & (F.col("track") % 2 == 1), "EXTRA").alias("audit")).where("audit is not null"),
     f"SELECT * FROM (SELECT track, CASE WHEN green_pct>=50 AND track%2=0 THEN 'MISSING' WHEN green_pct<50 AND track%2=1 THEN 'EXTRA' END AS audit FROM ({SQL['q_ground_shares']})) WHERE audit IS NOT NULL")
