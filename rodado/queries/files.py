"""Queries on formats and renderings, round trips included."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tracks as T
from ..sinks import files as K
from ..sources import files as S
from ..session import table
from ._sql import TRACKS, hav
from .views import event_tracks, routes, way_points

QUERIES, SQL = {}, {}


def gpx_round_trip(s, d):
    """Tracks written as GPX and read again."""
    g = K.gpx_text(event_tracks(s, d), "track")
    return S.gpx_points(g, "gpx", "track").select("track", "ord", F.round("lng", 5).alias("lng"), F.round("lat", 5).alias("lat"))


def dense_gpx(s, d):
    """Ways as GPX with long steps filled, one row a way: number of points and of segments."""
    p = T.densify(way_points(s, d))
    g = K.gpx_text(p, "track")
    return g.select("track", (F.size(F.split("gpx", "<trkpt")) - 1).alias("points"), (F.size(F.split("gpx", "<trkseg>")) - 1).alias("segments"))


def polyline_round_trip(s, d):
    p = event_tracks(s, d).groupBy("track").agg(F.sort_array(F.collect_list(F.struct("ord", "lng", "lat"))).alias("p"))
    kind = p.schema["track"].dataType.simpleString()

    def encode(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"track": pdf["track"], "poly": [S.encode_polyline([(x["lng"], x["lat"]) for x in v]) for v in pdf["p"]]})

    e = p.mapInPandas(encode, f"track {kind}, poly string")
    return S.polylines(e, "track", "poly").select("track", (F.col("ord") + 1).cast("long").alias("ord"), F.round("lng", 5).alias("lng"), F.round("lat", 5).alias("lat"))


def front_matter(s, d):
    """Front matter of the documents' texts: number of fields and length of the body."""
    docs = table(s, d, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("path"), "text")
    f = S.front_matter(docs)
    return f.where("fields is not null").select(F.col("path").cast("long").alias("doc_id"), F.size(F.json_object_keys("fields")).alias("fields"))


def route_pages(s, d):
    return K.route_page(routes(s, d)).select("route_id", F.length("page").alias("chars"), F.sha2("page", 256).alias("digest"))


def drawing(s, d):
    return K.draw(event_tracks(s, d))


def report(s, d):
    from .networks import cards

    return K.report_lines(cards(s, d))


def nested(s, d):
    """Routes written as nested JSON and read again."""
    r = routes(s, d).select("route_id", "name", "tags", "variants")
    back = K.nested(r).select(F.from_json("document", r.schema).alias("_r")).select("_r.*")
    return back.select("route_id", "name", F.array_join("tags", "|").alias("tags"), F.array_join(F.transform("variants", lambda v: v["name"]), "|").alias("variants"), F.try_element_at("variants", F.lit(1))["distance_km"].alias("first_km"))


_RT = "r AS (SELECT DISTINCT ON (route_id) * FROM routes)"
QUERIES = {
    "q_gpx_round_trip": gpx_round_trip, "q_dense_gpx": dense_gpx, "q_polyline_round_trip": polyline_round_trip, "q_front_matter": front_matter,
    "q_route_pages": route_pages, "q_drawing": drawing, "q_report": report, "q_nested_json": nested,
}
_WV = """w AS (SELECT DISTINCT ON (way_id) way_id, geometry FROM ways WHERE way_id IS NOT NULL), wu AS (SELECT way_id AS track, unnest(geometry) AS g, generate_subscripts(geometry,1) AS ord FROM w), wv AS (SELECT track, ord, g.lon AS lng, g.lat AS lat FROM wu WHERE g.lat BETWEEN -90 AND 90 AND g.lon BETWEEN -180 AND 180)"""
SQL = {
    "q_dense_gpx": f"WITH {_WV}, a AS (SELECT *, lead(lng) OVER w AS x, lead(lat) OVER w AS y FROM wv WINDOW w AS (PARTITION BY track ORDER BY ord)), b AS (SELECT track, {hav('lng', 'lat', 'x', 'y')} AS m FROM a) SELECT track, sum(CASE WHEN m>80 THEN ceil(m/50) ELSE 1 END)::INT AS points, 1 AS segments FROM b GROUP BY 1",
    "q_nested_json": f"WITH {_RT} SELECT route_id, name, array_to_string(list_filter(tags, lambda t: t IS NOT NULL),'|') AS tags, array_to_string(list_filter(list_transform(variants, lambda v: v.name), lambda n: n IS NOT NULL),'|') AS variants, variants[1].distance_km AS first_km FROM r",
    "q_gpx_round_trip": f"WITH {TRACKS} SELECT track, (ord-1)::INT AS ord, round(lng,5) AS lng, round(lat,5) AS lat FROM tr",
    "q_polyline_round_trip": f"WITH {TRACKS} SELECT track, ord, round(lng,5) AS lng, round(lat,5) AS lat FROM tr",
}
