"""Queries on records, names, rules, calendars and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, rules
from ..functions import text as X
from ..operators import calendar as C
from ..operators import collections as R
from ..plans import facts
from ..session import table
from .views import located, places, routes

QUERIES, SQL = {}, {}


def _add(name, make, sql=None):
    QUERIES[name] = make
    if sql:
        SQL[name] = sql


# --- names and texts -------------------------------------------------------------------------------------------
_UN = "strip_accents({})"
_SP = "trim(regexp_replace({}, '[\\s\\x1c-\\x1f\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}\\x{{feff}}]+', ' ', 'g'))"
_NAMES = "SELECT DISTINCT nombre FROM catastro WHERE nombre IS NOT NULL"
_PREFIX = X.KIND_PREFIX.replace("'", "''")


def _names(s, d):
    return table(s, d, "catastro").select("nombre").where("nombre is not null").distinct()


_add("q_normal_name", lambda s, d: _names(s, d).select("nombre", X.normal_name(F.col("nombre")).alias("normal_name")),
     f"SELECT nombre, {_SP.format('regexp_replace(' + _SP.format('strip_accents(upper(nombre))') + chr(44) + chr(39) + '^(' + _PREFIX + ') +' + chr(39) + ', ' + chr(39) * 2 + ')')} AS normal_name FROM ({_NAMES})")
_add("q_slug", lambda s, d: _names(s, d).select("nombre", X.slug(F.col("nombre")).alias("slug"), X.loose_name(F.col("nombre")).alias("loose")),
     f"SELECT nombre, regexp_replace(regexp_replace(strip_accents(lower(nombre)), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, {_SP.format('strip_accents(lower(nombre))')} AS loose FROM ({_NAMES})")
_add("q_texts", lambda s, d: table(s, d, "customer").select(
        "c_custkey", X.distance_text(F.col("c_acctbal")).alias("dist"), X.decimal_comma(F.round(F.col("c_acctbal"), 1), 1).alias("comma"),
        X.yaml_text(F.col("c_name")).alias("yaml"), X.xml_text(F.concat(F.lit("<a&b>"), "c_mktsegment")).alias("xml"), X.base_name(F.concat("c_mktsegment", F.lit(" 2"))).alias("base"),
        X.spoken_list(F.array("c_mktsegment", F.lit("B"), F.lit("C"))).alias("list"), X.title_of_slug(F.lit("los-morros-norte")).alias("title")),
     f"""SELECT c_custkey, CASE WHEN c_acctbal<1000 THEN floor(c_acctbal+0.5)::BIGINT || ' m' ELSE format('{{:.1f}}', floor(c_acctbal/100+0.5)/10) || ' km' END AS dist, replace(format('{{:.1f}}', round(c_acctbal,1)),'.',',') AS comma,
'"' || c_name || '"' AS yaml, '&lt;a&amp;b&gt;' || c_mktsegment AS xml, c_mktsegment AS base, c_mktsegment || ', B y C' AS list, 'Los Morros Norte' AS title FROM customer""")
_add("q_name_quality", lambda s, d: places(s, d).where("name is not null").select("place_id", X.name_quality(F.col("name"), F.coalesce("organizer", "name")).alias("points")),
     "WITH p AS (SELECT DISTINCT place_id, name AS a, coalesce(organizer,name) AS b FROM places WHERE name IS NOT NULL) SELECT place_id, greatest(" + "+".join(
         f"(CASE WHEN regexp_matches(lower({c}),'{w}') THEN {n} ELSE 0 END)" for c in ("a", "b") for n, w in X.NAME_POINTS) + "-(CASE WHEN a=b THEN 6 ELSE 0 END),0) AS points FROM p")
_add("q_place_kind", lambda s, d: places(s, d).where("name is not null").select("place_id", rules.place_kind(F.col("name"), F.col("category")).alias("kind"), rules.anchor_points(F.col("category")).alias("points")),
     "SELECT DISTINCT place_id, CASE " + " ".join(f"WHEN regexp_matches(lower(name),'{w}') THEN '{k}'" for w, k in rules.KIND_BY_WORD) + " ELSE CASE category " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rules.KIND_BY_TYPE.items()) + " ELSE 'park' END END AS kind, CASE category "
     + " ".join(f"WHEN '{a}' THEN {b}" for a, b in rules.ANCHOR_POINTS.items()) + " ELSE 1 END AS points FROM places WHERE name IS NOT NULL")

# --- ways and surveyed stretches -------------------------------------------------------------------------------
_T = lambda *ks: "coalesce(" + ",".join(f"nullif(tags['{k}'],'')" for k in ks) + ")"
_CW = _T("cycleway", "cycleway:left", "cycleway:right", "cycleway:both")
_WAYS = "w AS (SELECT DISTINCT ON (way_id) way_id, tags, geometry FROM ways WHERE way_id IS NOT NULL)"
_COMFORT = f"""CASE WHEN {_T('highway')}='cycleway' THEN 5 WHEN {_CW} IN ('track','separate') THEN 5 WHEN {_T('highway')}='path' AND {_T('bicycle')} IN ('designated','yes') THEN 4
WHEN {_T('highway')}='footway' AND {_T('bicycle')}='yes' THEN 3 WHEN {_T('highway')}='path' THEN 3 WHEN {_T('highway')} IN ('residential','living_street') AND {_CW} IS NOT NULL THEN 2 WHEN {_CW} IN ('lane','shared_lane') THEN 1 ELSE 0 END"""
_CLASS = f"""CASE WHEN {_T('highway')}='cycleway' THEN 'cycleway' WHEN {_T('highway')} IN ('path','footway') AND {_T('bicycle')} IN ('designated','yes') THEN 'cycleway' WHEN {_T('leisure')}='park' OR {_T('highway')} IN ('path','pedestrian') THEN 'cycleway'
WHEN {_CW} IS NOT NULL THEN 'lane' WHEN {_T('highway')} IN ('primary','secondary','tertiary','residential','living_street') THEN 'road' WHEN {_T('bicycle')} IN ('designated','yes') THEN 'cycleway' END"""


def _ways(s, d):
    return table(s, d, "ways").where("way_id is not null").dropDuplicates(["way_id"])


_add("q_comfort", lambda s, d: _ways(s, d).select("way_id", rules.comfort(F.col("tags")).alias("comfort"), rules.way_class(F.col("tags")).alias("way_class"), rules.ground_class(F.col("tags")).alias("ground"), rules.road_weight(rules.tag(F.col("tags"), "highway")).alias("weight")),
     f"""WITH {_WAYS} SELECT way_id, {_COMFORT} AS comfort, {_CLASS} AS way_class, CASE WHEN coalesce({_T('highway')}='cycleway',false) OR {_T('cycleway')} IS NOT NULL OR coalesce({_T('bicycle')}='designated',false) THEN 'bike' WHEN {_T('highway')} IN ('primary','secondary','trunk','motorway') THEN 'car'
WHEN {_T('leisure')} IS NOT NULL OR {_T('natural')}='water' OR {_T('waterway')} IS NOT NULL THEN 'green' END AS ground, (CASE coalesce({_T('highway')},'residential') """ + " ".join(f"WHEN '{k}' THEN {v}" for k, v in rules.ROAD_WEIGHTS.items()) + " ELSE 2.0 END)::DOUBLE AS weight FROM w")
_NUM = "try_cast(nullif(regexp_extract({}, '^\\s*([+-]?(?:\\d+\\.?\\d*|\\.\\d+))', 1),'') AS DOUBLE)"
_add("q_way_segments", lambda s, d: R.way_segments(table(s, d, "ways")).select("way_id", "nombre", "tipo", "emplazamiento", "ancho_cm", "surface", "lit", "maxspeed", "segregated", "bike_direction", F.round("length_m", 3).alias("length_m"), "lng0", "lat0", "lng1", "lat1"),
     f"""WITH {_WAYS}, g AS (SELECT *, list_filter(geometry, lambda p: p.lat BETWEEN -90 AND 90 AND p.lon BETWEEN -180 AND 180) AS p, coalesce({_T('name', 'name:es')},'') AS nm FROM w)
SELECT way_id, nm AS nombre, {_T('cycleway', 'highway')} AS tipo, CASE WHEN coalesce({_T('highway')} IN ('path','footway') AND ({_T('leisure')}='park' OR {_T('landuse')}='recreation_ground' OR {_T('route')}='mtb' OR {_T('sac_scale')} IS NOT NULL),false) OR regexp_matches(lower(nm),'parque|sendero') THEN 'parque' END AS emplazamiento,
floor({_NUM.format(_T('width'))}*100+0.5)::INT AS ancho_cm, {_T('surface')} AS surface, coalesce({_T('lit')}='yes',false) AS lit, {_NUM.format(_T('maxspeed'))}::INT AS maxspeed, coalesce({_T('segregated')}='yes',false) AS segregated,
CASE WHEN coalesce({_T('oneway:bicycle')}='yes',false) OR (coalesce({_T('oneway')}='yes',false) AND NOT coalesce({_T('oneway:bicycle')}='no',false)) THEN 'forward' WHEN {_T('oneway:bicycle')}='-1' THEN 'reverse' ELSE 'both' END AS bike_direction,
round(coalesce(list_sum(list_transform(range(1, len(p)), lambda i: 2*6371000.0*asin(sqrt(least(1.0, pow(sin(radians(p[i+1].lat-p[i].lat)/2),2)+cos(radians(p[i].lat))*cos(radians(p[i+1].lat))*pow(sin(radians(p[i+1].lon-p[i].lon)/2),2)))))),0),3) AS length_m,
p[1].lon AS lng0, p[1].lat AS lat0, p[-1].lon AS lng1, p[-1].lat AS lat1 FROM g""")
_add("q_survey_segments", lambda s, d: R.survey_segments(table(s, d, "catastro")).select("feature_id", "comuna", "km", "tipo", "emplazamiento", "ancho_cm", "clasificacion", "score", "invalida", "video", "points", "lng0", "lat0", "lng1", "lat1", F.round("clng", 4).alias("clng"), F.round("clat", 4).alias("clat")),
     """WITH c AS (SELECT DISTINCT ON (feature_id) * FROM catastro WHERE feature_id IS NOT NULL), g AS (SELECT *, coalesce(list_filter(flatten(list_filter(geometry.coordinates, lambda l: l IS NOT NULL)), lambda p: p[2] BETWEEN -90 AND 90 AND p[1] BETWEEN -180 AND 180),[]) AS p FROM c)
SELECT feature_id, lower(coalesce(nullif(trim(comuna),''),'unknown')) AS comuna, coalesce(km,0) AS km, lower(nullif(trim(tipo),'')) AS tipo, lower(nullif(trim(emplazamiento),'')) AS emplazamiento, nullif(ancho_cm,0) AS ancho_cm, lower(nullif(trim(clasificacion),'')) AS clasificacion, nullif(score,0) AS score,
coalesce(invalida,false) AS invalida, nullif(trim(video),'') AS video, len(p) AS points, p[1][1] AS lng0, p[1][2] AS lat0, p[-1][1] AS lng1, p[-1][2] AS lat1, round(list_avg(list_transform(p, lambda x: x[1])),4) AS clng, round(list_avg(list_transform(p, lambda x: x[2])),4) AS clat FROM g""")
_SEG = """WITH c AS (SELECT DISTINCT ON (feature_id) * FROM catastro WHERE feature_id IS NOT NULL), s AS (SELECT feature_id, lower(coalesce(nullif(trim(comuna),''),'unknown')) AS comuna, coalesce(km,0) AS km, lower(nullif(trim(tipo),'')) AS tipo,
lower(nullif(trim(emplazamiento),'')) AS emplazamiento, nullif(ancho_cm,0) AS ancho_cm, lower(nullif(trim(clasificacion),'')) AS clasificacion, nullif(score,0) AS score, coalesce(invalida,false) AS invalida, nullif(trim(video),'') AS video FROM c)"""


def _seg(s, d):
    return R.survey_segments(table(s, d, "catastro")).where("not invalida")


_RANK = "CASE clasificacion WHEN 'buena' THEN 0 WHEN 'regular' THEN 1 WHEN 'mala' THEN 2 WHEN 'muy mala' THEN 3 END"
_add("q_rollup_corridor", lambda s, d: R.corridors(_seg(s, d).withColumn("length_m", F.col("km")), "comuna").select("comuna", "segments", F.round("length_m", 6).alias("km"), F.round("mean_score", 6).alias("mean_score"), "best", "worst", F.array_join("videos", " ").alias("videos"), F.round("green_share", 6).alias("green_share"), F.round("mean_width_cm", 6).alias("mean_width_cm")),
     _SEG + f""", r AS (SELECT *, {_RANK} AS k FROM s WHERE NOT invalida) SELECT comuna, count(*) AS segments, round(sum(km),6) AS km, round(avg(score),6) AS mean_score, coalesce(['buena','regular','mala','muy mala'][min(k)+1], arg_max(clasificacion, feature_id)) AS best,
coalesce(arg_min(clasificacion, feature_id) FILTER (clasificacion IS NOT NULL AND k IS NULL), ['buena','regular','mala','muy mala'][max(k)+1]) AS worst, coalesce((SELECT string_agg(video, ' ' ORDER BY o, video) FROM (SELECT video, min(feature_id) AS o FROM r q WHERE q.comuna=r.comuna AND video IS NOT NULL GROUP BY 1)),'') AS videos,
round(coalesce(sum(km) FILTER (emplazamiento IN ('parque','mediana','bandejón')),0)/nullif(sum(km),0),6) AS green_share, round(avg(ancho_cm) FILTER (ancho_cm>0),6) AS mean_width_cm FROM r GROUP BY comuna""")


def _named_ways(s, d):
    """Ways with a name, their town, and whether they have any cycling comfort."""
    w = R.way_segments(table(s, d, "ways")).join(_ways(s, d).select("way_id", F.coalesce(rules.tag(F.col("tags"), "is_in:city"), F.lit("")).alias("comuna")), "way_id")
    return w.where("nombre <> ''")


def _named_routes(s, d):
    """The ways of each name as one route: what has no cycling comfort is its gaps."""
    on, off = F.when(F.col("comfort") > 0, F.col("length_m")).otherwise(0.0), F.when(F.col("comfort") == 0, F.col("length_m")).otherwise(0.0)
    trail = F.max(F.lower("nombre").rlike("|".join(rules.TRAIL_WORDS)))
    g = _named_ways(s, d).groupBy("nombre").agg(F.sum(on).alias("_on"), F.sum("length_m").alias("_all"), F.max(off).alias("gap_max_m"), trail.alias("_trail"))
    return g.select("nombre", F.when(F.col("_trail"), "mountain").otherwise("one-way").alias("kind"), F.coalesce(geo.half_up(F.col("_on") / F.nullif(F.col("_all"), F.lit(0.0)) * 100), F.lit(0.0)).alias("infra_pct"), "gap_max_m")


_LEN = "coalesce(list_sum(list_transform(range(1, len(p)), lambda i: 2*6371000.0*asin(sqrt(least(1.0, pow(sin(radians(p[i+1].lat-p[i].lat)/2),2)+cos(radians(p[i].lat))*cos(radians(p[i+1].lat))*pow(sin(radians(p[i+1].lon-p[i].lon)/2),2)))))),0)"
_NAMED = f"""{_WAYS}, nw AS (SELECT way_id, coalesce({_T('name', 'name:es')},'') AS nombre, {_T('cycleway', 'highway')} AS tipo, {_T('surface')} AS surface, coalesce({_T('lit')}='yes',false) AS lit, floor({_NUM.format(_T('width'))}*100+0.5)::INT AS ancho_cm, coalesce({_T('is_in:city')},'') AS comuna, {_COMFORT} AS comfort,
CASE WHEN coalesce({_T('highway')} IN ('path','footway') AND ({_T('leisure')}='park' OR {_T('landuse')}='recreation_ground' OR {_T('route')}='mtb' OR {_T('sac_scale')} IS NOT NULL),false) OR regexp_matches(lower(coalesce({_T('name', 'name:es')},'')),'parque|sendero') THEN 'parque' END AS emplazamiento,
list_filter(geometry, lambda p: p.lat BETWEEN -90 AND 90 AND p.lon BETWEEN -180 AND 180) AS p FROM w), ns AS (SELECT *, {_LEN} AS length_m FROM nw WHERE nombre<>'')"""
_add("q_corridor_tags", lambda s, d: R.corridor_tags(_named_ways(s, d), "nombre", _named_routes(s, d), "way_id").select("nombre", F.array_join("tags", "|").alias("tags")),
     f"""WITH {_NAMED}, rt AS (SELECT nombre, coalesce(floor(sum(CASE WHEN comfort>0 THEN length_m ELSE 0 END)/nullif(sum(length_m),0)*100+0.5),0) AS pct, max(CASE WHEN comfort=0 THEN length_m ELSE 0 END) AS gap, bool_or(regexp_matches(lower(nombre),'cerro|sendero|mtb|trail|mahuida|manquehue')) AS trail,
bool_or(tipo='unidireccional') AS one, bool_or(emplazamiento='parque') AS park, bool_or(emplazamiento='mediana') AS median, coalesce(avg(ancho_cm) FILTER (ancho_cm>0),0) AS wide, count(*) FILTER (lit) > count(*)*0.7 AS lit, list(DISTINCT comuna) FILTER (comuna<>'') AS towns FROM ns GROUP BY nombre),
sc AS (SELECT nombre, surface, count(*) AS n, min(way_id) AS o FROM ns WHERE surface IS NOT NULL GROUP BY 1,2), sf AS (SELECT nombre, surface FROM (SELECT *, row_number() OVER (PARTITION BY nombre ORDER BY n DESC, o) AS k FROM sc) WHERE k=1)
SELECT rt.nombre, array_to_string(list_sort(list_distinct(list_concat(list_filter(['bike path', CASE WHEN one THEN 'protected lane' END, CASE WHEN park THEN 'park path' END, CASE WHEN median THEN 'median lane' END, CASE WHEN surface IN ('gravel','unpaved','dirt') THEN 'gravel' END, CASE WHEN surface IN ('cobblestone','sett') THEN 'cobblestone' END,
CASE WHEN lit THEN 'lit' END, CASE WHEN trail THEN 'mountain' END, 'flat', CASE WHEN pct>80 AND gap<300 AND wide>=150 THEN 'easy' END, CASE WHEN pct>80 AND gap<300 AND wide>=150 THEN 'family friendly' END, CASE WHEN pct<50 OR gap>1000 THEN 'hard' END], lambda x: x IS NOT NULL), coalesce(towns,[])))),'|') AS tags FROM rt LEFT JOIN sf USING (nombre)""")
_add("q_mode_placement", lambda s, d: R.most_frequent(_seg(s, d), "comuna", "emplazamiento", F.col("feature_id")),
     _SEG + ", n AS (SELECT comuna, emplazamiento, count(*) AS n, min(feature_id) AS o FROM s WHERE NOT invalida AND emplazamiento IS NOT NULL GROUP BY 1,2) SELECT comuna, emplazamiento FROM (SELECT *, row_number() OVER (PARTITION BY comuna ORDER BY n DESC, o) AS k FROM n) WHERE k=1")
_add("q_cycling_ways", lambda s, d: R.cycling_ways(_ways(s, d).select("way_id", F.coalesce(rules.tag(F.col("tags"), "name"), F.lit("")).alias("grp"), rules.way_class(F.col("tags")).alias("way_class")), "grp"),
     f"WITH {_WAYS}, k AS (SELECT way_id, coalesce({_T('name')},'') AS grp, {_CLASS} AS way_class FROM w), b AS (SELECT *, bool_or(way_class IN ('cycleway','lane')) OVER (PARTITION BY grp) AS better FROM k WHERE way_class IS NOT NULL) SELECT way_id, grp, way_class FROM b WHERE way_class<>'road' OR NOT better")

# --- places, routes, references --------------------------------------------------------------------------------
_PL = "p AS (SELECT DISTINCT ON (place_id) * FROM places)"
_RT = "r AS (SELECT DISTINCT ON (route_id) * FROM routes)"
_add("q_published_places", lambda s, d: located(places(s, d)).where("status is null or lower(trim(status)) = 'published'").select("place_id", "name", F.coalesce("category", F.lit("unknown")).alias("category"), "lat", "lng"),
     f"WITH {_PL} SELECT place_id, name, coalesce(category,'unknown') AS category, lat, lng FROM p WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AND (status IS NULL OR lower(trim(status))='published')")
_add("q_lookup", lambda s, d: R.lookup(table(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), table(s, d, "customer"), "c_custkey", "c_mktsegment", F.col("c_custkey"), "none"),
     "SELECT o_orderkey, o_custkey AS c_custkey, coalesce(c_mktsegment,'none') AS c_mktsegment FROM orders LEFT JOIN customer ON c_custkey=o_custkey")
_add("q_by_slug", lambda s, d: R.by_slug(table(s, d, "bikepaths").select("path_id", F.col("name").alias("pn")).where("path_id is not null").distinct(), "pn", routes(s, d).select("route_id", F.col("name").alias("rn")), "rn").select("path_id", "route_id", "slug"),
     f"""WITH {_RT}, a AS (SELECT DISTINCT path_id, regexp_replace(regexp_replace(strip_accents(lower(name)),'[^a-z0-9]+','-','g'),'^-|-$','','g') AS slug FROM bikepaths WHERE path_id IS NOT NULL), b AS (SELECT route_id, regexp_replace(regexp_replace(strip_accents(lower(name)),'[^a-z0-9]+','-','g'),'^-|-$','','g') AS slug FROM r)
SELECT path_id, route_id, slug FROM a JOIN b USING (slug) WHERE slug<>''""")
_add("q_fuzzy_name", lambda s, d: R.fuzzy_names(table(s, d, "bikepaths").where("path_id is not null and name is not null").select("path_id", F.col("name").alias("pn")).distinct(), "pn", routes(s, d).where("name is not null").select("route_id", F.col("name").alias("rn")), "rn").select("path_id", "route_id"),
     f"""WITH {_RT}, a AS (SELECT DISTINCT path_id, {_SP.format('strip_accents(lower(name))')} AS x FROM bikepaths WHERE path_id IS NOT NULL AND name IS NOT NULL), b AS (SELECT route_id, {_SP.format('strip_accents(lower(name))')} AS y FROM r WHERE name IS NOT NULL)
SELECT path_id, route_id FROM a JOIN b ON x=y OR (length(x)>=8 AND length(y)>=8 AND (contains(x,y) OR contains(y,x)) AND least(length(x),length(y))/greatest(length(x),length(y))>=0.5)""")


def _cascade(s, d):
    w = routes(s, d).select("route_id", F.explode("waypoints").alias("_w")).select("route_id", F.col("_w.ord").alias("ord"), F.coalesce(F.col("_w.place_id"), F.lit(-1)).alias("k"), F.col("_w.name").alias("wname"))
    p = places(s, d).where("name is not null").select(F.col("place_id").alias("k"), F.col("name").alias("pname"))
    b = table(s, d, "bikepaths").where("path_id is not null").select((F.col("path_id") - 500000000).alias("k"), F.col("name").alias("bname")).distinct()
    return R.cascade(w, "k", [("path", b, "bname"), ("place", p, "pname")]).select("route_id", "ord", "k", F.coalesce("source", F.when(F.col("wname").isNotNull(), "name")).alias("source"), F.coalesce("target", "wname").alias("target"))


_add("q_cascade", _cascade, f"""WITH {_RT}, {_PL}, w AS (SELECT route_id, x.ord AS ord, coalesce(x.place_id,-1) AS k, x.name AS wname FROM (SELECT route_id, unnest(waypoints) AS x FROM r)),
b AS (SELECT path_id-500000000 AS k, min(name) AS bname FROM bikepaths WHERE name IS NOT NULL GROUP BY 1) SELECT route_id, ord, w.k AS k, CASE WHEN bname IS NOT NULL THEN 'path' WHEN p.name IS NOT NULL THEN 'place' WHEN wname IS NOT NULL THEN 'name' END AS source, coalesce(bname, p.name, wname) AS target FROM w LEFT JOIN b ON b.k=w.k LEFT JOIN p ON p.place_id=w.k""")
_add("q_dangling", lambda s, d: R.dangling(routes(s, d).select("route_id", F.explode("waypoints").alias("_w")).select("route_id", F.col("_w.place_id").alias("place_id")), "place_id", places(s, d), "place_id").distinct(),
     f"WITH {_RT} SELECT DISTINCT route_id, x.place_id AS place_id FROM (SELECT route_id, unnest(waypoints) AS x FROM r) WHERE x.place_id IS NOT NULL AND x.place_id NOT IN (SELECT place_id FROM places WHERE place_id IS NOT NULL)")
_add("q_missing", lambda s, d: table(s, d, "bikepaths").where("path_id is not null").select("path_id", F.explode("osm_way_ids").alias("way_id")).distinct().join(_ways(s, d).select("way_id"), "way_id", "left_anti").select("path_id", "way_id"),
     "SELECT DISTINCT path_id, way_id FROM (SELECT path_id, unnest(osm_way_ids) AS way_id FROM bikepaths WHERE path_id IS NOT NULL) WHERE way_id IS NOT NULL AND way_id NOT IN (SELECT way_id FROM ways WHERE way_id IS NOT NULL)")
_add("q_tracked", lambda s, d: _ways(s, d).select("way_id").join(table(s, d, "bikepaths").select(F.explode("osm_way_ids").alias("way_id")), "way_id", "left_semi"),
     "SELECT DISTINCT way_id FROM ways WHERE way_id IN (SELECT unnest(osm_way_ids) FROM bikepaths)")
_add("q_registry_ids", lambda s, d: table(s, d, "bikepaths").where(~F.coalesce(F.col("highway").isin(*rules.REGISTRY_ROADS), F.lit(False))).select(F.explode("osm_way_ids").alias("way_id")).distinct(),
     "SELECT DISTINCT way_id FROM (SELECT unnest(osm_way_ids) AS way_id FROM bikepaths WHERE NOT coalesce(highway IN ('tertiary','secondary','primary','residential','unclassified'),false))")
_add("q_hierarchy", lambda s, d: R.hierarchy_edges(table(s, d, "bikepaths").where("path_id is not null"), "path_id", "osm_way_ids", table(s, d, "bikepaths").where("path_id is not null").select(F.col("path_id").alias("p"), F.explode("segments").alias("_s")).select("p", F.col("_s.osm_way").alias("c")), "c", "p"),
     "SELECT DISTINCT parent, child FROM (SELECT path_id AS parent, unnest(osm_way_ids) AS child FROM bikepaths WHERE path_id IS NOT NULL UNION ALL SELECT path_id, x.osm_way FROM (SELECT path_id, unnest(segments) AS x FROM bikepaths WHERE path_id IS NOT NULL)) WHERE child IS NOT NULL AND parent IS NOT NULL")
_add("q_suffix", lambda s, d: R.numbered_slugs(routes(s, d).where("name is not null").select("route_id", "name"), "name", F.col("route_id")).select("route_id", "slug"),
     f"WITH {_RT}, q AS (SELECT route_id, regexp_replace(regexp_replace(strip_accents(lower(name)),'[^a-z0-9]+','-','g'),'^-|-$','','g') AS g FROM r WHERE name IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY route_id) AS k FROM q) SELECT route_id, CASE WHEN k=1 THEN g ELSE g || '-' || k END AS slug FROM k")
_add("q_upsert", lambda s, d: R.upsert(table(s, d, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_acctbal"), table(s, d, "customer").where("c_mktsegment < 'F'").select("c_custkey", F.lit("new").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal")), "c_custkey", ["c_acctbal"]),
     "WITH o AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal>0), n AS (SELECT c_custkey, 'new' AS c_name, c_acctbal+1 AS c_acctbal FROM customer WHERE c_mktsegment<'F') SELECT coalesce(o.c_custkey,n.c_custkey) AS c_custkey, coalesce(o.c_name,n.c_name) AS c_name, coalesce(n.c_acctbal,o.c_acctbal) AS c_acctbal FROM o FULL JOIN n ON o.c_custkey=n.c_custkey")
_add("q_insert_missing", lambda s, d: R.insert_missing(places(s, d).where("status = 'published' and name is not null").select("name", "place_id").groupBy("name").agg(F.min("place_id").alias("place_id")), places(s, d).where("name is not null").select("name", "place_id"), "name", F.col("place_id")),
     f"WITH {_PL}, o AS (SELECT name, min(place_id) AS place_id FROM p WHERE status='published' AND name IS NOT NULL GROUP BY name), n AS (SELECT name, min(place_id) AS place_id FROM p WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM o) GROUP BY name) SELECT * FROM o UNION ALL SELECT * FROM n")
_add("q_tag_labels", lambda s, d: routes(s, d).select("route_id", F.explode(F.array_distinct("tags")).alias("tag")).where("tag is not null").join(F.broadcast(table(s, d, "ref_terms").where("field = 'tags'").select(F.col("term").alias("tag"), "label_fr")), "tag", "left").select("route_id", "tag", F.coalesce("label_fr", "tag").alias("label")),
     f"WITH {_RT} SELECT route_id, tag, coalesce(label_fr, tag) AS label FROM (SELECT DISTINCT route_id, unnest(tags) AS tag FROM r) LEFT JOIN (SELECT * FROM ref_terms WHERE field='tags') ON term=tag WHERE tag IS NOT NULL")
_add("q_overlap_tags", lambda s, d: routes(s, d).select("route_id", F.size(F.array_intersect("tags", F.array(F.lit("gravel"), F.lit("bike path"), F.lit("commute")))).alias("shared")).where("shared > 0"),
     f"WITH {_RT} SELECT route_id, len(list_intersect(list_distinct(tags), ['gravel','bike path','commute'])) AS shared FROM r WHERE len(list_intersect(list_distinct(tags), ['gravel','bike path','commute']))>0")
_add("q_union", lambda s, d: places(s, d).select(F.col("place_id").alias("id"), "name", F.lit("place").alias("src")).unionByName(table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), allowMissingColumns=True),
     f"WITH {_PL} SELECT place_id AS id, name, 'place' AS src FROM p UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
_add("q_city_summary", lambda s, d: _seg(s, d).agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("mean"), F.min("score").alias("low"), F.max("score").alias("high"), F.count_if(F.col("score") >= 3).alias("good"), F.count_if(F.col("score") < 1.5).alias("bad"), F.count_distinct("comuna").alias("comunas")),
     _SEG + " SELECT count(*) AS n, round(avg(score),4) AS mean, min(score) AS low, max(score) AS high, count(*) FILTER (score>=3) AS good, count(*) FILTER (score<1.5) AS bad, count(DISTINCT comuna) AS comunas FROM s WHERE NOT invalida")

# --- calendar --------------------------------------------------------------------------------------------------


def _series(s, d):
    o = table(s, d, "orders")
    day = F.to_date("o_orderdate")
    return o.select(F.col("o_orderkey").alias("series_id"), F.when(F.col("o_orderkey") % 2 == 0, "weekly").otherwise("biweekly").alias("recurrence"),
                    F.element_at(F.array(*map(F.lit, C.DAYS)), (F.col("o_orderkey") % 7 + 1).cast("int")).alias("recurrence_day"), day.alias("season_start"), F.date_add(day, 40).alias("season_end"),
                    F.array(F.date_add(day, 10), F.date_add(day, 14)).alias("skip_dates"), F.col("o_orderpriority").alias("location"))


_SER = """se AS (SELECT o_orderkey AS id, o_orderdate::DATE AS a, o_orderdate::DATE+40 AS z, CASE WHEN o_orderkey%2=0 THEN 7 ELSE 14 END AS gap, (o_orderkey%7)::INT AS wd, o_orderpriority AS location FROM orders),
f AS (SELECT *, (a + ((wd - (isodow(a)::INT-1) + 7)%7)::INT)::DATE AS first FROM se), oc AS (SELECT id AS series_id, a, location, unnest(list_transform(range(0, ((z-first)//gap)::BIGINT+1), lambda k: (first + (k*gap)::INT)::DATE)) AS date FROM f WHERE first<=z),
oo AS (SELECT * FROM oc WHERE date NOT IN (a+10, a+14))"""
_add("q_series", lambda s, d: C.recurrences(_series(s, d)), f"WITH {_SER} SELECT series_id, date FROM oo")


def _overridden(s, d):
    se = _series(s, d)
    dates = C.recurrences(se)
    ov = dates.where(F.pmod(F.col("series_id") + F.dayofyear("date"), F.lit(5)) == 0).select("series_id", "date", (F.dayofmonth("date") % 2 == 0).alias("cancelled"), F.lit("moved").alias("location"))
    return C.with_overrides(dates, ov, se, ["location"])


_add("q_series_override", _overridden, f"WITH {_SER} SELECT series_id, date, CASE WHEN (series_id+dayofyear(date))%5=0 THEN 'moved' ELSE location END AS location, (series_id+dayofyear(date))%5=0 AND day(date)%2=0 AS cancelled FROM oo")
_add("q_schedule", lambda s, d: C.scheduled(_series(s, d).select("series_id", F.array(F.struct(F.col("season_start").alias("date")), F.struct(F.col("season_end").alias("date"))).alias("schedule"))),
     "SELECT o_orderkey AS series_id, unnest([o_orderdate::DATE, o_orderdate::DATE+40]) AS date FROM orders")
_add("q_dupes", lambda s, d: C.merge_duplicates(table(s, d, "orders").select(F.concat(F.lit(" "), "o_orderpriority").alias("name"), F.col("o_orderstatus").alias("location"), F.col("o_orderkey").alias("slug"), F.to_date("o_orderdate").alias("d")), ["name", "location"], "slug", "d"),
     "SELECT o_orderpriority AS name, o_orderstatus AS location, arg_min(o_orderkey, (o_orderdate::DATE, o_orderkey)) AS slug, min(o_orderdate::DATE) AS first_date, max(o_orderdate::DATE) AS end_date, count(*) AS occurrences FROM orders GROUP BY 1,2")
_add("q_uid", lambda s, d: C.once_per_uid(table(s, d, "events").select("event_id", F.when(F.col("event_id") % 10 > 0, F.col("event_id") % 500).alias("uid")), "uid", "event_id"),
     "WITH e AS (SELECT event_id, CASE WHEN event_id%10>0 THEN event_id%500 END AS uid FROM events) SELECT max(event_id) AS event_id, uid FROM e WHERE uid IS NOT NULL GROUP BY uid UNION ALL SELECT event_id, uid FROM e WHERE uid IS NULL")
_add("q_results", lambda s, d: C.ranked_results(table(s, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 7 == 0, "DNS").otherwise(F.format_string("%02d:%02d", F.col("c_custkey") % 30, F.col("c_custkey") % 60)).alias("time"), F.lit(1200).alias("lim")), "c_nationkey", "time", "lim").select("c_custkey", "minutes", "in_time", "place"),
     "WITH r AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey%7=0 THEN NULL ELSE (c_custkey%30)*60+c_custkey%60 END::INT AS minutes FROM customer), q AS (SELECT *, coalesce(minutes<=1200,false) AS in_time FROM r) SELECT c_custkey, minutes, in_time, CASE WHEN in_time THEN rank() OVER (PARTITION BY c_nationkey, in_time ORDER BY minutes) END AS place FROM q")

# --- facts -----------------------------------------------------------------------------------------------------


def _tables(s, d):
    r = routes(s, d).select(F.col("route_id").alias("slug"), "name", "distance_km", "tags")
    wp = routes(s, d).select(F.col("route_id").alias("track"), F.explode("waypoints").alias("_w")).select("track", F.col("_w.lng").alias("lng"), F.col("_w.lat").alias("lat"))
    ev = table(s, d, "documents").where("collection = 'events'").select(F.col("created_at").alias("start_date"))
    return {"places": places(s, d), "routes": r, "tracks": wp, "events": ev, "organizers": routes(s, d).where("organizer is not null").select("organizer").distinct()}


def _fact(spec, today="2021-06-30"):
    return lambda s, d: facts.compile_query(spec, _tables(s, d), F.lit(today).cast("date"))


_WP = f"{_RT}, {_PL}, wp AS (SELECT route_id AS track, x.lng AS lng, x.lat AS lat FROM (SELECT route_id, unnest(waypoints) AS x FROM r) WHERE x.lat BETWEEN -90 AND 90 AND x.lng BETWEEN -180 AND 180)"
_HIT = _WP + """, hit AS (SELECT DISTINCT track, place_id FROM wp JOIN (SELECT place_id, lat AS b, lng AS a FROM p WHERE category='coffee house' AND lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180) ON abs(lat-b)<0.005
AND 2*6371000*asin(sqrt(least(1,pow(sin(radians(b-lat)/2),2)+cos(radians(lat))*cos(radians(b))*pow(sin(radians(a-lng)/2),2))))<=500)"""
_add("q_fact_count", _fact({"type": "places", "filter": {"category": "parkland"}, "count_as": "count"}), f"WITH {_PL} SELECT count(*) AS count FROM p WHERE category='parkland'")
_add("q_fact_longest", _fact({"type": "routes", "sort": "distance_km", "order": "desc", "pick": "first", "fields": ["name", "distance_km", "slug"]}), f"WITH {_RT} SELECT name, distance_km, route_id AS slug FROM r WHERE distance_km IS NOT NULL ORDER BY distance_km DESC, route_id, name LIMIT 1")
_add("q_fact_shortest", _fact({"type": "routes", "sort": "distance_km", "direction": "asc", "fields": ["name", "distance_km", "slug"]}), f"WITH {_RT} SELECT name, distance_km, route_id AS slug FROM r WHERE distance_km IS NOT NULL ORDER BY distance_km, route_id, name LIMIT 1")
_add("q_fact_organizers", _fact({"type": "organizers"}), f"WITH {_RT} SELECT count(DISTINCT organizer) AS count FROM r")
_add("q_fact_near", _fact({"type": "routes_near_places", "filter": {"category": "coffee house"}}), f"WITH {_HIT} SELECT count(DISTINCT track) AS count FROM hit")
_add("q_fact_density", _fact({"type": "route_place_density", "filter": {"category": "coffee house"}}), f"WITH {_HIT} SELECT track, count(*) AS count FROM hit GROUP BY track ORDER BY count DESC, track LIMIT 1")
_add("q_fact_year", _fact({"type": "events", "filter": {"year": "current"}}), "SELECT count(*) AS count FROM documents WHERE collection='events' AND year(created_at)=2021 HAVING count(*)>0")
_add("q_fact_total", _fact({"type": "aggregate"}), f"WITH {_RT} SELECT round(sum(distance_km),1) AS total_km FROM r")
_add("q_fact_text", lambda s, d: facts.fact({"template": "there are {count} parks?", "query": {"type": "places", "filter": {"category": "parkland"}}}, _tables(s, d)).unionAll(facts.fact({"text": "helmets on"}, _tables(s, d))),
     f"WITH {_PL} SELECT 'there are ' || count(*) || ' parks?' AS text FROM p WHERE category='parkland' UNION ALL SELECT 'helmets on'")
