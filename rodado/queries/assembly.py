"""Queries on what routes are made of and made into: ways of paths, runs, shapes, tracks, pages, names, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, rules, scores
from ..operators import collections as R
from ..operators import graph, greedy, lines, spatial
from ..operators import tracks as T
from ..plans import generate, suggest, templates
from ..sinks import files as K
from ..session import stage, table
from ._sql import TRACKS, hav
from .files import _WV
from .networks import KNOWN, _pieces, segments, sights, survey_lines, surveyed_segments, way_lines
from .records import _CLASS, _LEN, _NAMED, _SEG, _SP, _T, _WAYS, _named_routes, _named_ways
from .spatial import _PL
from .views import event_tracks, places, routes

QUERIES, SQL = {}, {}
_RT = "r AS (SELECT DISTINCT ON (route_id) * FROM routes)"


def _add(name, make, sql=None):
    QUERIES[name] = make
    if sql:
        SQL[name] = sql


# --- roads and ways of paths -------------------------------------------------------------------------------------


def _roads(s, d):
    w = table(s, d, "ways").where("way_id is not null").dropDuplicates(["way_id"]).select(F.col("way_id").alias("seg_id"), rules.tag(F.col("tags"), "highway").alias("highway"))
    return graph.road_graph(way_lines(s, d).join(w, "seg_id").select(F.col("seg_id").alias("way_id"), "points", "highway"))


_KEY = lambda x, y: f"(floor({x}/1e-4::DOUBLE+0.5)::BIGINT*4294967296+floor({y}/1e-4::DOUBLE+0.5)::BIGINT+2147483648)"
_ROADS = f"""{_WAYS}, wk AS (SELECT way_id AS track, (CASE coalesce({_T('highway')},'residential') {' '.join(f"WHEN '{k}' THEN {v}" for k, v in rules.ROAD_WEIGHTS.items())} ELSE 2.0 END)::DOUBLE AS wt FROM w),
rv AS (SELECT track, row_number() OVER o AS i, lng, lat, lead(lng) OVER o AS x, lead(lat) OVER o AS y FROM wv WINDOW o AS (PARTITION BY track ORDER BY ord)), re AS (SELECT {_KEY('lng', 'lat')} AS a, {_KEY('x', 'y')} AS b, {hav('lng', 'lat', 'x', 'y')} AS m, wt FROM rv JOIN wk USING (track) WHERE x IS NOT NULL)"""
_WVW = _WV.split(", ", 1)[0] and _WV[_WV.index("wu AS"):]
_add("q_road_edges", lambda s, d: _roads(s, d)[1].select("a", "b", F.round("cost", 3).alias("cost")),
     "WITH " + _ROADS.replace("wk AS", _WVW + ", wk AS", 1) + " SELECT a, b, round(min(m*wt),3) AS cost FROM (SELECT a, b, m, wt FROM re UNION ALL SELECT b, a, m, wt FROM re) WHERE a<>b GROUP BY 1,2")
_add("q_road_nodes", lambda s, d: _roads(s, d)[0].select("id", F.round("lng", 7).alias("lng"), F.round("lat", 7).alias("lat")),
     f"WITH {_WV} SELECT {_KEY('lng', 'lat')} AS id, round(arg_min(lng, (track, ord)),7) AS lng, round(arg_min(lat, (track, ord)),7) AS lat FROM wv GROUP BY 1")


def _paths(s, d):
    return table(s, d, "bikepaths").where("path_id is not null").dropDuplicates(["path_id"])


def _path_ways(s, d):
    w = table(s, d, "ways").where("way_id is not null").dropDuplicates(["way_id"]).select(F.col("way_id").alias("seg_id"), rules.tag(F.col("tags"), "name").alias("name"), "tags")
    w = stage(way_lines(s, d).join(w, "seg_id").select(F.col("seg_id").alias("way_id"), "name", "tags", "points"), "ways")
    p = _paths(s, d).select("path_id", "name", "osm_names", "osm_way_ids", "anchors")
    # the registry by its ways, and once more as if only the names were known
    return generate.path_ways(p.unionByName(p.withColumn("path_id", -F.col("path_id")).withColumn("osm_way_ids", F.lit(None).cast("array<bigint>"))), w)


_PTS = "list_filter(geometry, lambda p: p.lat BETWEEN -90 AND 90 AND p.lon BETWEEN -180 AND 180)"
_add("q_path_ways", _path_ways, f"""WITH {_WAYS}, k AS (SELECT way_id, {_T('name')} AS name, {_CLASS} AS cls, coalesce({_T('leisure')}='park',false) AS park, ({_T('highway')}='cycleway' OR ({_T('highway')}='path' AND regexp_matches({_T('bicycle')},'designated|yes'))) AS cyc, {_PTS} AS p FROM w), kk AS (SELECT * FROM k WHERE len(p)>=2),
b AS (SELECT DISTINCT ON (path_id) path_id, name, osm_names, osm_way_ids, list_filter(coalesce(anchors,[]), lambda a: len(a)=2 AND a[2] BETWEEN -90 AND 90 AND a[1] BETWEEN -180 AND 180) AS a FROM bikepaths WHERE path_id IS NOT NULL),
bb AS (SELECT * FROM b UNION ALL SELECT -path_id, name, osm_names, NULL, a FROM b),
l AS (SELECT DISTINCT path_id, way_id FROM (SELECT path_id, unnest(osm_way_ids) AS way_id FROM bb WHERE len(osm_way_ids)>0) JOIN kk USING (way_id)),
nb AS (SELECT path_id, unnest(CASE WHEN len(osm_names)>0 THEN osm_names ELSE [name] END) AS name, list_min(list_transform(a, lambda x: x[1]))-0.02::DOUBLE AS x0, list_max(list_transform(a, lambda x: x[1]))+0.02::DOUBLE AS x1, list_min(list_transform(a, lambda x: x[2]))-0.02::DOUBLE AS y0, list_max(list_transform(a, lambda x: x[2]))+0.02::DOUBLE AS y1 FROM bb WHERE coalesce(len(osm_way_ids),0)=0 AND len(a)>=2),
nm AS (SELECT DISTINCT path_id, way_id FROM (SELECT path_id, way_id, x0, x1, y0, y1, unnest(p) AS v FROM nb JOIN kk USING (name)) WHERE v.lon BETWEEN x0 AND x1 AND v.lat BETWEEN y0 AND y1),
ev AS (SELECT path_id, way_id, cls, park, p FROM (SELECT * FROM l UNION SELECT * FROM nm) JOIN kk USING (way_id)), g AS (SELECT *, bool_or(cls IN ('cycleway','lane')) OVER (PARTITION BY path_id) AS better FROM ev WHERE cls IS NOT NULL), kept AS (SELECT * FROM g WHERE cls<>'road' OR NOT better),
op AS (SELECT path_id FROM kept GROUP BY 1 HAVING bool_and(park)), co AS (SELECT DISTINCT path_id, v.lon AS x, v.lat AS y FROM (SELECT path_id, unnest(p) AS v FROM kept JOIN op USING (path_id))), cv AS (SELECT way_id, v.lon AS lng, v.lat AS lat FROM (SELECT way_id, unnest(p) AS v FROM kk WHERE cyc)),
sn AS (SELECT DISTINCT path_id, way_id FROM cv JOIN co ON abs(lat-y)<0.0006 WHERE {hav('lng', 'lat', 'x', 'y')}<50)
SELECT path_id, way_id FROM kept WHERE path_id NOT IN (SELECT path_id FROM sn) UNION ALL SELECT path_id, way_id FROM sn""")


def _ridden(s, d):
    """Each registered path in riding order as one axis, ridden with its gaps filled over the roads, and densified."""
    pieces = stage(_pieces(s, d), "pieces")
    p = generate.path_pieces(pieces, lines.ordered_paths(pieces, "path_id"), "path_id")
    segs = F.transform("pieces", lambda x: F.when(x["turned"], F.reverse(x["points"])).otherwise(x["points"]))
    r = p.select(F.col("path_id").alias("route"), F.lit("one-way").alias("kind"), F.array(F.struct(F.lit(False).alias("turned"), segs.alias("segs"))).alias("axes"))
    r = stage(r, "paths")
    ways = way_lines(s, d).select(F.col("seg_id").alias("way_id"), "points")
    return T.densify(stage(generate.tracks_of(r, (*_roads(s, d), graph.road_components(ways))), "tracks"))


_add("q_ridden_tracks", lambda s, d: _ridden(s, d).groupBy("track").agg(F.count("*").alias("points"), F.count_if(F.col("sub") > 0).alias("added")))

# --- runs and shapes ---------------------------------------------------------------------------------------------


def _runs(s, d):
    """The listed ways of each registered path, in the order of the list, as runs of one name."""
    seg = segments(s, d).withColumns({"axis": F.col("nombre"), "axis_name": F.col("nombre"), "comuna": F.lit(None).cast("string"), "video": F.lit(None).cast("string")})
    r = _paths(s, d).select(F.col("path_id").alias("route"), F.col("osm_way_ids").alias("path")).where("path is not null")
    return suggest.chain_runs(r, seg)


_add("q_axis_runs", lambda s, d: _runs(s, d).select("route", F.col("run").cast("bigint").alias("run"), "axis", F.round("length_m", 3).alias("length_m"), F.size("segs").alias("segments"), F.round("park_m", 3).alias("park_m"), "lng0", "lat1"),
     f"""WITH {_WAYS}, k AS (SELECT way_id, coalesce({_T('name', 'name:es')},'') AS axis, CASE WHEN coalesce({_T('highway')} IN ('path','footway') AND ({_T('leisure')}='park' OR {_T('landuse')}='recreation_ground' OR {_T('route')}='mtb' OR {_T('sac_scale')} IS NOT NULL),false) OR regexp_matches(lower(coalesce({_T('name', 'name:es')},'')),'parque|sendero') THEN 'parque' END AS pl, {_PTS} AS p FROM w), kk AS (SELECT *, {_LEN} AS len FROM k WHERE len(p)>0),
b AS (SELECT DISTINCT ON (path_id) path_id, osm_way_ids FROM bikepaths WHERE path_id IS NOT NULL), u AS (SELECT path_id AS route, unnest(osm_way_ids) AS way_id, generate_subscripts(osm_way_ids,1) AS ord FROM b), j AS (SELECT * FROM u JOIN kk USING (way_id)),
c AS (SELECT *, CASE WHEN axis IS DISTINCT FROM lag(axis) OVER o OR row_number() OVER o=1 THEN 1 ELSE 0 END AS ch FROM j WINDOW o AS (PARTITION BY route ORDER BY ord)), i AS (SELECT *, sum(ch) OVER (PARTITION BY route ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM c)
SELECT route, run, any_value(axis) AS axis, round(sum(len),3) AS length_m, count(*)::INT AS segments, round(sum(CASE WHEN pl='parque' THEN len ELSE 0 END),3) AS park_m, arg_min(p[1].lon, ord) AS lng0, arg_max(p[-1].lat, ord) AS lat1 FROM i GROUP BY 1,2""")


def _shapes(s, d):
    """The shapes of the walks, with every ten points as a run."""
    p = event_tracks(s, d).withColumnRenamed("track", "route")
    total = T.ends(event_tracks(s, d)).select(F.col("track").alias("route"), F.col("length_m").alias("total_m"))
    tens = p.groupBy("route", F.floor((F.col("ord") - 1) / 10).alias("place")).agg(*(F.min_by(c, "ord").alias(f"{c}0") for c in ("lng", "lat")), *(F.max_by(c, "ord").alias(f"{c}1") for c in ("lng", "lat")))
    return suggest.loop_shapes(p, total, tens)


_add("q_loop_shape", lambda s, d: _shapes(s, d).select("route", F.round("aspect", 4).alias("aspect"), F.round("efficiency", 4).alias("efficiency"), "paperclip", "hub", "oval"),
     f"""WITH {TRACKS}, bx AS (SELECT track, count(*) AS n, min(lng) AS x0, max(lng) AS x1, min(lat) AS y0, max(lat) AS y1 FROM tr GROUP BY 1), wh AS (SELECT *, {hav('x0', '(y0+y1)/2', 'x1', '(y0+y1)/2')} AS w, {hav('(x0+x1)/2', 'y0', '(x0+x1)/2', 'y1')} AS h FROM bx),
fl AS (SELECT wh.*, length_m AS t, wh.n<4 OR w<100 OR h<100 AS flat, wh.n//2 AS half FROM wh JOIN en USING (track)), st2 AS (SELECT *, greatest(half//20,1) AS step, least(300+t/20,1500) AS near FROM fl),
sa AS (SELECT tr.track, ord, lng, lat FROM tr JOIN st2 USING (track) WHERE ord<=half AND (ord-1)%step=0), sb AS (SELECT tr.track, lng, lat FROM tr JOIN st2 USING (track) WHERE ord>half AND (ord-1-half)%step=0),
hi AS (SELECT a.track, count(DISTINCT a.ord) AS k FROM sa a JOIN sb b ON a.track=b.track JOIN st2 ON st2.track=a.track WHERE {hav('a.lng', 'a.lat', 'b.lng', 'b.lat')}<near GROUP BY 1), na AS (SELECT track, count(*) AS k FROM sa GROUP BY 1),
te AS (SELECT track, (ord-1)//10 AS place, arg_min(lng,ord) AS x0, arg_min(lat,ord) AS y0, arg_max(lng,ord) AS x1, arg_max(lat,ord) AS y1 FROM tr GROUP BY 1,2), ti AS (SELECT track, place*2 AS i, x0 AS x, y0 AS y FROM te UNION ALL SELECT track, place*2+1, x1, y1 FROM te), tn AS (SELECT track, count(*) AS n FROM ti GROUP BY 1),
hb AS (SELECT a.track, count(*) AS m FROM ti a JOIN ti b ON a.track=b.track AND b.i>=a.i+3 JOIN tn ON tn.track=a.track WHERE tn.n>=6 AND {hav('a.x', 'a.y', 'b.x', 'b.y')}<200 GROUP BY 1),
z AS (SELECT st2.track, flat, CASE WHEN flat THEN 99.0 ELSE greatest(w,h)/least(w,h) END AS aspect, CASE WHEN flat THEN 0.0 ELSE t/(2*(w+h)) END AS eff, NOT flat AND coalesce(hi.k,0)/greatest(coalesce(na.k,0),1)>0.4 AS clip, coalesce(m,0) AS m FROM st2 LEFT JOIN hi ON hi.track=st2.track LEFT JOIN na ON na.track=st2.track LEFT JOIN hb ON hb.track=st2.track),
y AS (SELECT *, NOT flat AND (m>=2 OR (m>=1 AND eff<0.5)) AS hub FROM z) SELECT track AS route, round(aspect,4) AS aspect, round(eff,4) AS efficiency, clip AS paperclip, hub, NOT flat AND aspect<2.5 AND eff>0.55 AND NOT clip AND NOT hub AS oval FROM y""")

# --- surveys of segments ------------------------------------------------------------------------------------------


def _matches(s, d):
    return suggest.survey_matches(way_lines(s, d), survey_lines(s, d))


_SMP = lambda c: f"CASE WHEN len({c})<=5 THEN {c} ELSE list_filter({c}, lambda x, i: (i-1)%greatest(len({c})//5,1)=0) END"
_SURVEY = f"""{_WAYS}, wl0 AS (SELECT way_id AS id, {_PTS} AS p FROM w), wl AS (SELECT id, p, {_LEN} AS len, list_avg(list_transform(p, lambda x: x.lon)) AS cx, list_avg(list_transform(p, lambda x: x.lat)) AS cy FROM wl0 WHERE len(p)>0),
sc0 AS (SELECT DISTINCT ON (feature_id) feature_id AS id, list_filter(geometry.coordinates, lambda l: l IS NOT NULL) AS ls FROM catastro WHERE feature_id IS NOT NULL AND NOT coalesce(invalida,false)), good AS (SELECT id, list_transform(ls, lambda l: list_transform(list_filter(l, lambda p: p[2] BETWEEN -90 AND 90 AND p[1] BETWEEN -180 AND 180), lambda p: {{'lon': p[1], 'lat': p[2]}})) AS ls FROM sc0),
sl AS (SELECT id, flatten(ls) AS p, coalesce(list_sum(list_transform(ls, lambda p: {_LEN})),0) AS slen FROM good), sm AS (SELECT id, p, list_avg(list_transform(p, lambda x: x.lon)) AS cx, list_avg(list_transform(p, lambda x: x.lat)) AS cy, {_LEN} AS len FROM sl WHERE len(p)>0),
wa AS (SELECT id, len, cx, cy, unnest({_SMP('p')}) AS v, generate_subscripts({_SMP('p')},1) AS i FROM wl), sb AS (SELECT id, len, cx, cy, unnest({_SMP('p')}) AS v FROM sm), n AS (SELECT id, count(*) AS n FROM wa GROUP BY 1),
h AS (SELECT a.id AS seg_id, b.id AS feature_id, count(DISTINCT a.i) AS k FROM wa a JOIN sb b ON abs(a.v.lat-b.v.lat)<0.0008 WHERE {hav('a.v.lon', 'a.v.lat', 'b.v.lon', 'b.v.lat')}<80 AND {hav('a.cx', 'a.cy', 'b.cx', 'b.cy')}<=a.len+b.len GROUP BY 1,2),
mt AS (SELECT seg_id, min(feature_id) AS feature_id FROM h JOIN n ON n.id=h.seg_id WHERE k>0.4*n GROUP BY 1)"""
_add("q_survey_match", _matches, f"WITH {_SURVEY} SELECT seg_id, feature_id FROM mt")


def _surveyed_comfort(s, d):
    """Comfort of the ways, by the surveyed placement where there is one."""
    w = table(s, d, "ways").where("way_id is not null").dropDuplicates(["way_id"]).select(F.col("way_id").alias("seg_id"), "tags")
    v = survey_lines(s, d).select("feature_id", F.col("emplazamiento").alias("_e"))
    j = w.join(_matches(s, d).join(v, "feature_id"), "seg_id", "left")
    return j.select(F.col("seg_id").alias("way_id"), rules.comfort(F.col("tags"), F.col("_e")).alias("comfort"))


from .records import _COMFORT  # noqa: E402

_add("q_comfort_surveyed", _surveyed_comfort, f"WITH {_SURVEY}, pl AS (SELECT seg_id, lower(nullif(trim(emplazamiento),'')) AS e FROM mt JOIN (SELECT DISTINCT ON (feature_id) * FROM catastro) USING (feature_id)) SELECT way_id, coalesce(CASE e {' '.join(f'''WHEN '{k}' THEN {v}''' for k, v in rules.SURVEYED_COMFORT.items())} END, {_COMFORT}) AS comfort FROM w LEFT JOIN pl ON seg_id=way_id")

# --- names, majorities, summaries ----------------------------------------------------------------------------------
_add("q_majority", lambda s, d: R.majority(segments(s, d).where("normal_name <> ''").withColumn("_n", R.runs_north("lng0", "lat0", "lng1", "lat1")), "nombre", F.col("_n")).select("nombre", F.when(F.col("yes"), "north-south").otherwise("east-west").alias("bearing")),
     f"WITH {_NAMED}, o AS (SELECT nombre, abs(p[-1].lat-p[1].lat)>=abs(p[-1].lon-p[1].lon)*cos(radians((p[1].lat+p[-1].lat)/2)) AS n FROM ns WHERE len(p)>0 AND {{}}<>'') SELECT nombre, CASE WHEN count(*) FILTER (n)*2>=count(*) THEN 'north-south' ELSE 'east-west' END AS bearing FROM o GROUP BY 1".format(_SP.format("regexp_replace(" + _SP.format("strip_accents(upper(nombre))") + ", '^(AV\\.|AVENIDA|CALLE|PASEO|CICLOVIA|CICLOVÍA|CICLOBANDA|SENDERO) +', '')")))
_SURV = lambda s, d: R.survey_segments(table(s, d, "catastro")).where("not invalida")
_SLUG = lambda c: f"regexp_replace(regexp_replace(strip_accents(lower({c})),'[^a-z0-9]+','-','g'),'^-|-$','','g')"
_add("q_corridor_slug", lambda s, d: R.corridor_slugs(_SURV(s, d).withColumn("length_m", F.col("km")), "tipo", "feature_id").where("tipo is not null"),
     _SEG.replace("SELECT feature_id, lower(", "SELECT feature_id, coalesce(nullif(trim(nombre),''), 'unnamed-' || feature_id) AS nombre, lower(") + f", g AS (SELECT tipo, arg_max(nombre, (km, -feature_id)) AS n, list_sort(list(DISTINCT comuna)) AS t FROM s WHERE NOT invalida AND tipo IS NOT NULL GROUP BY 1) SELECT tipo, {_SLUG('''n || '-' || CASE WHEN len(t)<=2 THEN array_to_string(t,'-') ELSE t[1] || '-y-mas' END''')} AS slug FROM g")
_LOOSE = lambda c: _SP.format(f"strip_accents(lower({c}))")
_add("q_first_name", lambda s, d: R.first_name_match(routes(s, d).where("name is not null"), "name", _paths(s, d).where("name is not null").select("path_id", F.col("name").alias("pn")), "pn", "path_id"),
     f"WITH {_RT}, a AS (SELECT DISTINCT name, {_LOOSE('name')} AS x FROM r WHERE name IS NOT NULL), b AS (SELECT DISTINCT path_id, {_LOOSE('name')} AS y FROM bikepaths WHERE path_id IS NOT NULL AND name IS NOT NULL), m AS (SELECT name, path_id, CASE WHEN x=y THEN 0 ELSE 1 END AS k FROM a JOIN b ON x<>'' AND y<>'' AND (x=y OR contains(x,y) OR contains(y,x))) SELECT name, arg_min(path_id, (k, path_id)) AS path_id FROM m GROUP BY 1")
_add("q_proposal_summary", lambda s, d: R.proposal_summary(segments(s, d), "nombre", places(s, d), routes(s, d)),
     f"WITH {_WAYS}, {_RT}, k AS (SELECT coalesce({_T('name', 'name:es')},'') AS n, {_PTS} AS p FROM w), l AS (SELECT n, {_LEN} AS len FROM k WHERE len(p)>0) SELECT count(*) AS segments, count(DISTINCT n) AS axes, floor(sum(len)/1000*10+0.5)/10 AS infra_km, (SELECT count(DISTINCT place_id) + count(DISTINCT 1) FILTER (place_id IS NULL) FROM places) AS anchors, (SELECT count(*) FROM r) AS routes FROM l")


def _named(s, d):
    return _named_routes(s, d).join(_named_ways(s, d).groupBy("nombre").agg(F.sum("length_m").alias("total_m"), F.array_sort(F.collect_set(F.nullif("comuna", F.lit("")))).alias("comunas")), "nombre")


_add("q_curation_stats", lambda s, d: R.curation_stats(_named(s, d)),
     f"WITH {_NAMED}, g AS (SELECT nombre, sum(length_m) AS t, coalesce(floor(sum(CASE WHEN comfort>0 THEN length_m ELSE 0 END)/nullif(sum(length_m),0)*100+0.5),0) AS pct FROM ns GROUP BY 1) SELECT count(*) AS routes, count(*) FILTER (t<5000) AS short, count(*) FILTER (t>=5000 AND t<10000) AS medium, count(*) FILTER (t>=10000) AS long, (SELECT count(DISTINCT comuna) FROM ns WHERE comuna<>'') AS comunas, floor(avg(pct)+0.5)::BIGINT AS infra_pct FROM g")

# --- pages ---------------------------------------------------------------------------------------------------------


def _upserted(s, d):
    """Published routes as pages that are there; every route with variants as a new run over the sum of their lengths."""
    r = routes(s, d)
    body = F.when(F.col("homepage_featured"), F.concat(F.lit("https://youtu.be/"), F.col("route_id"), F.lit("\n\n"))).otherwise(F.coalesce("tagline", F.lit("")))
    old = r.where("status = 'published'").select("route_id", "name", "distance_km", "variants", body.alias("body"), "updated_at")
    total = F.aggregate("variants", F.lit(0.0), lambda a, v: a + F.coalesce(v["distance_km"], F.lit(0.0)))
    new = r.where("size(variants) > 0").select("route_id", "name", F.round(total, 1).alias("distance_km"), F.array(F.concat(F.lit("https://youtu.be/v"), F.col("route_id")), F.concat(F.lit("https://youtu.be/v"), F.col("route_id"))).alias("videos"))
    return R.page_upsert(old, new, "route_id", F.lit("2026-01-01").cast("date"))


_add("q_page_upsert", lambda s, d: _upserted(s, d).select("route_id", "name", "distance_km", F.size("variants").alias("variants"), F.try_element_at("variants", F.lit(1))["distance_km"].alias("first_km"), "body", F.col("updated_at").cast("string").alias("updated_at")),
     f"""WITH {_RT}, o AS (SELECT route_id, name, distance_km, variants, CASE WHEN coalesce(homepage_featured,false) THEN 'https://youtu.be/' || route_id || chr(10) || chr(10) ELSE coalesce(tagline,'') END AS body, updated_at FROM r WHERE status='published'),
n AS (SELECT route_id, name, round(coalesce(list_sum(list_transform(variants, lambda v: coalesce(v.distance_km,0))),0),1) AS km, 'https://youtu.be/v' || route_id AS v FROM r WHERE len(variants)>0)
SELECT coalesce(o.route_id,n.route_id) AS route_id, CASE WHEN o.route_id IS NULL THEN n.name ELSE o.name END AS name, CASE WHEN n.route_id IS NULL THEN distance_km ELSE km END AS distance_km, CASE WHEN o.route_id IS NULL THEN 1 ELSE len(variants) END::INT AS variants,
CASE WHEN n.route_id IS NULL THEN variants[1].distance_km WHEN o.route_id IS NULL OR len(variants)>0 THEN km END AS first_km, CASE WHEN n.route_id IS NOT NULL AND (o.route_id IS NULL OR trim(body)='' OR starts_with(body,'https://youtu.be/')) THEN v ELSE body END AS body,
CASE WHEN n.route_id IS NULL THEN updated_at::VARCHAR ELSE '2026-01-01' END AS updated_at FROM o FULL JOIN n ON n.route_id=o.route_id""")
_add("q_replace_routes", lambda s, d: R.replaced(routes(s, d).select("route_id", "name", "status"), routes(s, d).where("distance_km is not null").select("route_id", F.lit("new").alias("name"), "status"), "route_id", F.col("status") == "published"),
     f"WITH {_RT} SELECT route_id, name, status FROM r WHERE status='published' UNION ALL SELECT route_id, 'new', status FROM r WHERE distance_km IS NOT NULL AND NOT coalesce(status='published',false)")


def _pages(s, d):
    """Ways of one name as routes with whole pages: a run for each town, their gaps what has no cycling comfort."""
    w = _named_ways(s, d)
    runs = w.groupBy("nombre", "comuna").agg(
        F.sum("length_m").alias("length_m"), F.array_sort(F.collect_set("tipo")).alias("tipos"), F.array_sort(F.collect_set("emplazamiento")).alias("places"),
        F.array_sort(F.collect_list("ancho_cm")).alias("widths"), F.array_sort(F.collect_set("surface")).alias("conditions"))
    runs = runs.groupBy("nombre").agg(F.sort_array(F.collect_list(F.struct(F.concat_ws(" ", "nombre", "comuna").alias("name"), F.array("comuna").alias("comunas"), "length_m", "tipos", "places", "widths", "conditions"))).alias("runs"))
    gaps = w.where("comfort = 0").groupBy("nombre").agg(F.sort_array(F.collect_list(F.struct(F.col("length_m").alias("metres"), F.col("nombre").alias("from"), F.col("comuna").alias("to")))).alias("gaps"))
    tags = R.corridor_tags(w, "nombre", _named_routes(s, d), "way_id")
    r = _named(s, d).join(runs, "nombre").join(gaps, "nombre", "left").join(tags, "nombre")
    return K.full_page(r.select(F.col("nombre").alias("route"), F.col("nombre").alias("name"), "kind", "total_m", "infra_pct", F.lit(None).cast("string").alias("start_name"), F.lit(None).cast("string").alias("end_name"), "tags", "runs", "gaps", F.array().cast("array<string>").alias("videos")), F.lit("2026-01-01"))


_add("q_full_pages", lambda s, d: _pages(s, d).select("route", F.length("page").alias("chars"), F.sha2("page", 256).alias("digest")))

# --- tracks near a line or place ------------------------------------------------------------------------------------


def _corridor(s, d):
    """The walks that come within 300 m of the first one's points, by how many they cover."""
    p = event_tracks(s, d)
    ref = p.where(F.col("track") == p.agg(F.min("track")).first()[0]).select("ord", F.col("lng").alias("_x"), F.col("lat").alias("_y"))
    return spatial.find_corridor(p, ref, 300.0)


_add("q_find_corridor", _corridor, f"""WITH {TRACKS}, f AS (SELECT ord, lng AS x, lat AS y FROM tr WHERE track=(SELECT min(track) FROM tr)), sa AS (SELECT track, lng, lat FROM (SELECT *, row_number() OVER (PARTITION BY track ORDER BY ord)-1 AS i, count(*) OVER (PARTITION BY track) AS n FROM tr) WHERE i % greatest(n//500,1) = 0),
h AS (SELECT track, count(DISTINCT ord) AS near FROM sa JOIN f ON {hav('lng', 'lat', 'x', 'y')}<=300 GROUP BY 1) SELECT track, near, (SELECT count(*) FROM f) AS total, floor(near/(SELECT count(*) FROM f)*100+0.5)::BIGINT AS pct FROM h ORDER BY near DESC, track LIMIT 25""")
_add("q_tracks_near", lambda s, d: spatial.tracks_near(event_tracks(s, d), -75.7, 45.4, 2000.0),
     f"WITH {TRACKS}, sa AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track ORDER BY ord)-1 AS i, count(*) OVER (PARTITION BY track) AS n FROM tr) WHERE i % greatest(n//500,1) = 0) SELECT track, floor(min({hav('lng', 'lat', '-75.7', '45.4')})+0.5)::BIGINT AS metres, any_value(n) AS points FROM sa GROUP BY 1 HAVING min({hav('lng', 'lat', '-75.7', '45.4')})<=2000 ORDER BY min({hav('lng', 'lat', '-75.7', '45.4')}), track LIMIT 25")


def _templates(s, d):
    """The waypoints of the routes as templates, over the network of the ways and the anchors by it."""
    seg, _, edges = suggest.network(segments(s, d), 300.0)
    found = stage(suggest.anchors(sights(s, d), seg), "anchors")
    w = routes(s, d).select(F.col("route_id").alias("route"), F.posexplode("waypoints").alias("ord", "_w")).select("route", "ord", "_w.name", F.when(geo.on_earth("_w.lng", "_w.lat"), F.col("_w.lng")).alias("lng"), F.when(geo.on_earth("_w.lng", "_w.lat"), F.col("_w.lat")).alias("lat"))
    return templates.template_paths(w, seg, edges, found)


_add("q_template_paths", lambda s, d: _templates(s, d).select("route", F.size("path").alias("segments"), "stops"))
