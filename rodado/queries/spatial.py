"""Queries on distance joins, grids and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import graph as G
from ..operators import spatial as P
from ..operators import zones as Z
from ..session import stage, table
from ._sql import TRACKS, hav
from .views import event_tracks, located, places

QUERIES, SQL = {}, {}
_PL = "p AS (SELECT DISTINCT ON (place_id) place_id, name, category, lat, lng FROM places WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180)"
_AN = """u AS (SELECT path_id, unnest(anchors) AS a FROM bikepaths WHERE path_id IS NOT NULL), a AS (SELECT DISTINCT path_id, a[1] AS x, a[2] AS y FROM u WHERE len(a)=2 AND a[2] BETWEEN -90 AND 90 AND a[1] BETWEEN -180 AND 180)"""
_D = hav("lng", "lat", "x", "y")


def _add(name, make, sql=None):
    QUERIES[name] = make
    if sql:
        SQL[name] = sql


def _places(s, d):
    return located(places(s, d)).select("place_id", "name", "category", "lng", "lat")


def _anchors(s, d):
    b = table(s, d, "bikepaths").where("path_id is not null").select("path_id", F.explode("anchors").alias("_a")).where(F.size("_a") == 2)
    return b.select("path_id", F.col("_a")[0].alias("_x"), F.col("_a")[1].alias("_y")).where(geo.on_earth("_x", "_y")).distinct()


_add("q_pairs_radius", lambda s, d: P.pairs_within(_places(s, d), "place_id", 300.0).withColumn("metres", F.round("metres", 3)),
     f"WITH {_PL} SELECT p.place_id AS a, q.place_id AS b, round({hav('p.lng','p.lat','q.lng','q.lat')},3) AS metres FROM p JOIN p q ON p.place_id<q.place_id AND abs(p.lat-q.lat)<0.003 AND {hav('p.lng','p.lat','q.lng','q.lat')}<=300")
_add("q_semi_radius", lambda s, d: P.semi(_places(s, d), _anchors(s, d), 400.0, ["place_id"], ("_x", "_y")).select("place_id"),
     f"WITH {_PL}, {_AN} SELECT place_id FROM p WHERE EXISTS (SELECT 1 FROM a WHERE abs(lat-y)<0.004 AND {_D}<=400)")
_add("q_anti_radius", lambda s, d: P.anti(_places(s, d), _anchors(s, d), 400.0, ["place_id"], ("_x", "_y")).select("place_id"),
     f"WITH {_PL}, {_AN} SELECT place_id FROM p WHERE NOT EXISTS (SELECT 1 FROM a WHERE abs(lat-y)<0.004 AND {_D}<=400)")
_add("q_knn", lambda s, d: P.nearest(_places(s, d), _anchors(s, d), "place_id", "path_id", 1, 1000.0).select("place_id", "path_id", F.round("metres", 3).alias("metres")),
     f"WITH {_PL}, {_AN}, j AS (SELECT place_id, path_id, min({_D}) AS m FROM p CROSS JOIN a GROUP BY 1,2), k AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY m, path_id) AS n FROM j) SELECT place_id, path_id, round(m,3) AS metres FROM k WHERE n=1")
_add("q_best_in_radius", lambda s, d: P.best_within(_places(s, d), _anchors(s, d).withColumn("score", F.pmod(F.col("path_id") * 37, F.lit(11))), 1500.0, "place_id", "path_id", "score"),
     f"WITH {_PL}, {_AN}, j AS (SELECT place_id, path_id, (path_id*37)%11 AS score FROM p JOIN a ON abs(lat-y)<0.014 AND {_D}<=1500), k AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY score DESC, path_id) AS n FROM j) SELECT place_id, path_id, score FROM k WHERE n=1")
_add("q_topk_in_radius", lambda s, d: P.top_within(_places(s, d), _anchors(s, d), 2000.0, "place_id", "path_id", 3).select("place_id", "path_id", "place"),
     f"WITH {_PL}, {_AN}, j AS (SELECT place_id, path_id, min({_D}) AS m FROM p JOIN a ON abs(lat-y)<0.019 AND {_D}<=2000 GROUP BY 1,2), k AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY m, path_id) AS place FROM j) SELECT place_id, path_id, place FROM k WHERE place<=3")


def _samples(s, d):
    w = table(s, d, "ways").where("way_id is not null").dropDuplicates(["way_id"]).select("way_id", F.posexplode("geometry").alias("sample", "_p"))
    return w.select("way_id", "sample", F.col("_p.lon").alias("lng"), F.col("_p.lat").alias("lat")).where(geo.on_earth("lng", "lat"))


_SM = "w AS (SELECT DISTINCT ON (way_id) way_id, geometry FROM ways WHERE way_id IS NOT NULL), v AS (SELECT way_id, unnest(geometry) AS g, generate_subscripts(geometry,1) AS sample FROM w), sm AS (SELECT way_id, sample, g.lon AS lng, g.lat AS lat FROM v WHERE g.lat BETWEEN -90 AND 90 AND g.lon BETWEEN -180 AND 180)"
_add("q_first_match", lambda s, d: P.first_match(_samples(s, d), _anchors(s, d), 600.0, "way_id", "path_id"),
     f"WITH {_SM}, {_AN}, n AS (SELECT way_id, count(*) AS n FROM sm GROUP BY 1), h AS (SELECT way_id, path_id, count(DISTINCT sample) AS h FROM sm JOIN a ON abs(lat-y)<0.006 AND {_D}<=600 GROUP BY 1,2) SELECT way_id, min(path_id) AS path_id FROM h JOIN n USING (way_id) WHERE h>0.4*n GROUP BY 1")
_add("q_coverage", lambda s, d: P.coverage(_samples(s, d).select("way_id", F.col("sample").alias("ord"), "lng", "lat"), _places(s, d).select(F.col("lng").alias("_x"), F.col("lat").alias("_y")), "way_id"),
     f"WITH {_SM}, {_PL}, q AS (SELECT DISTINCT lng AS x, lat AS y FROM p), m AS (SELECT way_id, sample, min({_D}) AS d FROM sm JOIN q ON abs(lat-y)<0.0095 AND {_D}<=1000 GROUP BY 1,2), j AS (SELECT sm.way_id, d FROM sm LEFT JOIN m ON m.way_id=sm.way_id AND m.sample=sm.sample) SELECT way_id, count(*) AS points, "
     + ", ".join(f"floor(avg(CASE WHEN d<={m} THEN 1.0 ELSE 0.0 END)::DOUBLE*1e4+0.5)/1e4 AS within_{m}" for m in P.COVERAGE_M) + " FROM j GROUP BY 1")


def _lines(s, d):
    w = table(s, d, "ways").where("way_id is not null").dropDuplicates(["way_id"]).where(F.size("geometry") >= 2)
    a, b = geo.endpoints(F.col("geometry"))
    return w.select("way_id", a["lon"].alias("lng0"), a["lat"].alias("lat0"), b["lon"].alias("lng1"), b["lat"].alias("lat1"))


_LN = "l AS (SELECT DISTINCT ON (way_id) way_id, geometry[1].lon AS lng0, geometry[1].lat AS lat0, geometry[-1].lon AS lng1, geometry[-1].lat AS lat1 FROM ways WHERE way_id IS NOT NULL AND len(geometry)>=2)"
_GAP = "least(" + ",".join(hav(f"a.lng{i}", f"a.lat{i}", f"b.lng{j}", f"b.lat{j}") for i in (0, 1) for j in (0, 1)) + ")"
_LK = f"lk AS (SELECT a.way_id AS a, b.way_id AS b, {_GAP} AS gap_m FROM l a JOIN l b ON a.way_id<b.way_id AND abs(a.lat0-b.lat0)<0.02 AND {_GAP}<=200)"
_add("q_links", lambda s, d: P.line_links(_lines(s, d), "way_id", 200.0).withColumn("gap_m", F.round("gap_m", 3)), f"WITH {_LN}, {_LK} SELECT a, b, round(gap_m,3) AS gap_m FROM lk")
_add("q_components", lambda s, d: G.components(_lines(s, d), P.line_links(_lines(s, d), "way_id", 200.0), "way_id"),
     f"WITH RECURSIVE {_LN}, {_LK}, e AS (SELECT a AS u, b AS v FROM lk UNION ALL SELECT b, a FROM lk), r(u, c) AS (SELECT way_id, way_id FROM l UNION SELECT e.v, r.c FROM r JOIN e ON e.u=r.u WHERE r.c<e.v) SELECT u AS way_id, min(c) AS component FROM r GROUP BY u")
_add("q_corridor_rollup", lambda s, d: G.components(_lines(s, d), P.line_links(_lines(s, d), "way_id", 200.0), "way_id").groupBy("component").agg(F.count("*").alias("ways")),
     f"WITH RECURSIVE {_LN}, {_LK}, e AS (SELECT a AS u, b AS v FROM lk UNION ALL SELECT b, a FROM lk), r(u, c) AS (SELECT way_id, way_id FROM l UNION SELECT e.v, r.c FROM r JOIN e ON e.u=r.u WHERE r.c<e.v), m AS (SELECT u, min(c) AS component FROM r GROUP BY u) SELECT component, count(*) AS ways FROM m GROUP BY 1")
_CL = "c AS (SELECT floor(lng/0.005::DOUBLE)::BIGINT AS gx, floor(lat/0.005::DOUBLE)::BIGINT AS gy, count(*) AS n FROM p GROUP BY 1,2)"
_add("q_cell_density", lambda s, d: P.dense_cells(_places(s, d), 0.005, 2), f"WITH {_PL}, {_CL} SELECT gx, gy, n FROM c WHERE n>2")
_add("q_floodfill", lambda s, d: G.flood_fill(P.dense_cells(_places(s, d), 0.005, 0)).groupBy("component").agg(F.count("*").alias("cells"), F.min("gx").alias("gx0"), F.min("gy").alias("gy0")).drop("component"),
     f"WITH RECURSIVE {_PL}, {_CL}, i AS (SELECT gx, gy, (gx+2147483648)*4294967296::HUGEINT+gy+2147483648 AS id FROM c), e AS (SELECT x.id AS u, y.id AS v FROM i x JOIN i y ON abs(x.gx-y.gx)<=1 AND abs(x.gy-y.gy)<=1 AND x.id<>y.id), r(u, k) AS (SELECT id, id FROM i UNION SELECT e.v, r.k FROM r JOIN e ON e.u=r.u WHERE r.k<e.v), m AS (SELECT u, min(k) AS k FROM r GROUP BY u) SELECT count(*) AS cells, min(gx) AS gx0, min(gy) AS gy0 FROM m JOIN i ON i.id=m.u GROUP BY k")


def _links(s, d):
    return stage(P.line_links(_lines(s, d), "way_id", 200.0), "links")


def _edges(links):
    e = links.select("a", "b", (F.round("gap_m", 1) + 40).alias("cost"), "gap_m")
    return e.select("a", "b", "cost", F.col("gap_m").alias("length")).unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "cost", F.col("gap_m").alias("length")))


def _requests(e):
    return e.join(e.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").where("a <> c").select(F.col("a").alias("src"), F.col("c").alias("dst")).distinct()


def _shortest(s, d):
    """Cheapest paths between ways two links apart. Costs have no bound, as a way round may be cheaper than the two links."""
    e = _links(s, d)
    return G.paths(_requests(e), _edges(e)).select("src", "dst", F.round("cost", 1).alias("cost"))


_add("q_shortest", _shortest,
     f"""WITH RECURSIVE {_LN}, {_LK}, k AS (SELECT a, b, round(gap_m,1)+40 AS cost FROM lk), e AS (SELECT a, b, cost FROM k UNION ALL SELECT b, a, cost FROM k), q AS (SELECT DISTINCT x.a AS src, y.b AS dst FROM lk x JOIN lk y ON y.a=x.b WHERE x.a<>y.b),
r(src, n, cost) USING KEY (src, n) AS (SELECT DISTINCT src, src, 0.0::DOUBLE FROM q UNION SELECT r.src, e.b, min(r.cost+e.cost) FROM r JOIN e ON e.a=r.n LEFT JOIN recurring.r AS o ON o.src=r.src AND o.n=e.b WHERE r.cost+e.cost<coalesce(o.cost, 1e18) GROUP BY 1,2)
SELECT q.src, q.dst, round(r.cost,1) AS cost FROM q JOIN r ON r.src=q.src AND r.n=q.dst""")


def _zones(s, d):
    """(place_id, lng, lat): the centres of all lively zones, as q_zones finds them before its choice of the strongest."""
    z = Z.lively(_places(s, d).select(F.coalesce("category", F.lit("other")).alias("kind"), "lng", "lat"), 3)
    return stage(z.select(F.col("zone").alias("place_id"), F.col("clng").alias("lng"), F.col("clat").alias("lat")), "zones")


def _zone_edges(z):
    return stage(P.pairs_within(z, "place_id", 10_000.0).select("a", "b", F.col("metres").alias("length")), "pairs")


def _with_centres(df, z, keys):
    for k in keys:
        df = df.join(z.select(F.col("place_id").alias(k), F.col("lng").alias(f"_x{k}"), F.col("lat").alias(f"_y{k}")), k)
    return df


def _loops_of_three(s, d):
    z = _zones(s, d)
    t = _with_centres(G.triangles(_zone_edges(z), 5000.0, 35_000.0), z, "abc")
    return t.where(~G.collinear(*(F.col(f"_{v}{k}") for k in "abc" for v in "xy"))).select("a", "b", "c", F.round("total", 2).alias("total"))


def _loops_of_four(s, d):
    z = _zones(s, d)
    t = _with_centres(G.rectangles(_zone_edges(z), 10_000.0, 50_000.0), z, "abcd")
    return t.where(G.quadrants([F.col(f"_x{k}") for k in "abcd"], [F.col(f"_y{k}") for k in "abcd"]) >= 3).select("a", "b", "c", "d", F.round("total", 2).alias("total"))


#: Lively zones: cells of more than 3 places, flooded, with the mean of their places.
_ZN = f"""{_PL}, {_CL}, i AS (SELECT gx, gy, (gx*4294967296::HUGEINT+gy+2147483648)::BIGINT AS id FROM c WHERE n>3), e AS (SELECT x.id AS u, y.id AS v FROM i x JOIN i y ON abs(x.gx-y.gx)<=1 AND abs(x.gy-y.gy)<=1 AND x.id<>y.id),
r(u, k) AS (SELECT id, id FROM i UNION SELECT e.v, r.k FROM r JOIN e ON e.u=r.u WHERE r.k<e.v), m AS (SELECT u, min(k) AS k FROM r GROUP BY u), z AS (SELECT m.k AS id, avg(lng) AS x, avg(lat) AS y, count(*) AS n FROM p JOIN i ON floor(lng/0.005::DOUBLE)=i.gx AND floor(lat/0.005::DOUBLE)=i.gy JOIN m ON m.u=i.id GROUP BY 1)"""
_ZD = lambda a, b: hav(f"{a}.x", f"{a}.y", f"{b}.x", f"{b}.y")
_ZE = f"{_ZN}, ze AS (SELECT v.id AS a, w.id AS b, {_ZD('v', 'w')} AS length FROM z v JOIN z w ON v.id<w.id WHERE {_ZD('v', 'w')}<=10000)"
_add("q_zone_pairs", lambda s, d: _zone_edges(_zones(s, d)).withColumn("length", F.round("length", 3)), f"WITH RECURSIVE {_ZE} SELECT a, b, round(length,3) AS length FROM ze")
_add("q_triangles", _loops_of_three, f"""WITH RECURSIVE {_ZE} SELECT f.a AS a, f.b AS b, g.b AS c, round(f.length+g.length+h.length,2) AS total FROM ze f JOIN ze g ON g.a=f.b JOIN ze h ON h.a=f.a AND h.b=g.b JOIN z za ON za.id=f.a JOIN z zb ON zb.id=f.b JOIN z zc ON zc.id=g.b
WHERE f.length+g.length+h.length BETWEEN 5000 AND 35000 AND abs((zb.x-za.x)*(zc.y-za.y)-(zb.y-za.y)*(zc.x-za.x))>=0.001 AND greatest(f.length,g.length,h.length)>=1000""")
_QX = "(za.x+zb.x+zc.x+zd.x)/4"
_QY = "(za.y+zb.y+zc.y+zd.y)/4"
_add("q_rectangles", _loops_of_four, f"""WITH RECURSIVE {_ZE} SELECT f.a AS a, f.b AS b, g.b AS c, h.b AS d, round(f.length+g.length+h.length+l.length,2) AS total FROM ze f JOIN ze g ON g.a=f.b JOIN ze h ON h.a=g.b JOIN ze l ON l.a=f.a AND l.b=h.b JOIN z za ON za.id=f.a JOIN z zb ON zb.id=f.b JOIN z zc ON zc.id=g.b JOIN z zd ON zd.id=h.b
WHERE f.length+g.length+h.length+l.length BETWEEN 10000 AND 50000 AND len(list_distinct([{','.join(f"({k}.x>={_QX})::INT*2+({k}.y>={_QY})::INT" for k in ('za', 'zb', 'zc', 'zd'))}]))>=3""")
_add("q_footprints", lambda s, d: P.footprint_overlap(event_tracks(s, d).select("track", geo.cell("lng", 0.01).alias("gx"), geo.cell("lat", 0.01).alias("gy")), "track", 0.5).withColumn("share", F.round("share", 6)),
     f"WITH {TRACKS}, g AS (SELECT DISTINCT track, floor(lng/0.01::DOUBLE)::BIGINT AS gx, floor(lat/0.01::DOUBLE)::BIGINT AS gy FROM tr), n AS (SELECT track, count(*) AS n FROM g GROUP BY 1), k AS (SELECT x.track AS a, y.track AS b, count(*) AS k FROM g x JOIN g y ON x.gx=y.gx AND x.gy=y.gy AND x.track<y.track GROUP BY 1,2) SELECT a, b, round(k/least(na.n,nb.n),6) AS share FROM k JOIN n na ON na.track=a JOIN n nb ON nb.track=b WHERE k/least(na.n,nb.n)>0.5")
_add("q_pois_on_track", lambda s, d: T_pois(s, d), f"""WITH {TRACKS}, {_PL}, pp AS (SELECT place_id, name, -75.7+(place_id%400-200)/1e3 AS x, 45.4+(place_id*7%400-200)/1e3 AS y FROM p WHERE name IS NOT NULL),
sa AS (SELECT track, lng, lat FROM (SELECT *, row_number() OVER (PARTITION BY track ORDER BY ord)-1 AS i, count(*) OVER (PARTITION BY track) AS n FROM tr) WHERE i % greatest(n//200,1) = 0),
h AS (SELECT track, count(DISTINCT name) AS pois FROM sa JOIN pp ON abs(lat-y)<0.005 AND {_D}<500 GROUP BY 1) SELECT en.track, coalesce(pois,0) AS pois, CASE WHEN length_m>0 THEN floor(coalesce(pois,0)/(length_m/1000)*100+0.5)/10 ELSE 0 END AS per_10km FROM en LEFT JOIN h USING (track)""")


def T_pois(s, d):
    from ..plans.score_routes import pois_on_track

    p = _places(s, d).where("name is not null").select("name", (F.lit(-75.7) + (F.col("place_id") % 400 - 200) / 1e3).alias("_x"), (F.lit(45.4) + ((F.col("place_id") * 7) % 400 - 200) / 1e3).alias("_y"))
    return pois_on_track(event_tracks(s, d), p)
