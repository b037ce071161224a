"""Queries on points near points."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import nearby
from ..session import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return nearby.paths_near_places(table(spark, d, "places"), table(spark, d, "bikepaths"))


def regions(spark: SparkSession, d: str) -> DataFrame:
    """(path_id, ring): around the anchors of each path a star of 16 corners, from 150 m to 6 km wide by the path."""
    b = table(spark, d, "bikepaths").where("path_id is not null").dropDuplicates(["path_id"])
    a = F.try_element_at(F.filter("anchors", lambda a: (F.size(a) == 2) & geo.on_earth(F.try_element_at(a, F.lit(1)), F.try_element_at(a, F.lit(2)))), F.lit(1))
    b = b.select("path_id", a.alias("_a")).where("_a is not null").select("path_id", F.col("_a")[0].alias("x"), F.col("_a")[1].alias("y"))
    m = F.pow(F.lit(2.0), F.pmod(F.col("path_id"), F.lit(6))) * 0.0015
    turn = lambda k: k.cast("double") * (2 * math.pi / 16)
    out = lambda k: F.when(k % 2 == 0, m).otherwise(m * 0.6)
    ring = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.struct((F.col("x") + out(k) * F.cos(turn(k))).alias("lng"), (F.col("y") + out(k) * F.sin(turn(k))).alias("lat")))
    return b.where("abs(x) < 179 and abs(y) < 89").select("path_id", ring.alias("ring"))


def points_in_region(spark: SparkSession, d: str) -> DataFrame:
    """Each place with the regions that hold it."""
    p = table(spark, d, "places").where("place_id is not null").select("place_id", "lng", "lat").distinct()
    return nearby.regions_of_points(p, regions(spark, d), ["place_id"], "ring").select("place_id", "path_id").distinct()


QUERIES = {"p3_found": p3_found, "p3_regions": points_in_region}

_REGION = """WITH b AS (SELECT DISTINCT ON (path_id) path_id, list_filter(anchors, lambda a: len(a)=2 AND a[2] BETWEEN -90 AND 90 AND a[1] BETWEEN -180 AND 180)[1] AS a FROM bikepaths WHERE path_id IS NOT NULL),
c AS (SELECT path_id, a[1] AS x, a[2] AS y, pow(2.0::DOUBLE, ((path_id%6)+6)%6)*0.0015::DOUBLE AS m FROM b WHERE a IS NOT NULL AND abs(a[1])<179 AND abs(a[2])<89),
v AS (SELECT path_id, k, x+(CASE WHEN k%2=0 THEN m ELSE m*0.6::DOUBLE END)*cos(k::DOUBLE*(2*pi()/16)) AS u, y+(CASE WHEN k%2=0 THEN m ELSE m*0.6::DOUBLE END)*sin(k::DOUBLE*(2*pi()/16)) AS w FROM c, range(16) AS t(k)),
s AS (SELECT a.path_id, a.u AS x1, a.w AS y1, b.u AS x2, b.w AS y2 FROM v a JOIN v b ON a.path_id=b.path_id AND b.k=(a.k+1)%16),
p AS (SELECT DISTINCT place_id, lng, lat FROM places WHERE place_id IS NOT NULL AND lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180)
SELECT DISTINCT place_id, path_id FROM (SELECT place_id, path_id, lng, lat, count(*) AS n FROM p JOIN s ON (y1>lat)<>(y2>lat) AND lng<(x2-x1)*(lat-y1)/(y2-y1)+x1 GROUP BY ALL) WHERE n%2=1"""

SQL = {
    "p3_regions": _REGION,
    "p3_found": """
WITH p AS (SELECT DISTINCT place_id, lat, lng FROM places WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180),
u AS (SELECT path_id, unnest(anchors) AS a FROM bikepaths),
a AS (SELECT DISTINCT path_id, a[1] AS x, a[2] AS y FROM u WHERE len(a) = 2 AND a[2] BETWEEN -90 AND 90 AND a[1] BETWEEN -180 AND 180)
SELECT DISTINCT place_id, path_id FROM p JOIN a ON abs(lat - y) < 0.003
WHERE 2 * 6371000 * asin(sqrt(least(1, pow(sin(radians(y - lat) / 2), 2) + cos(radians(lat)) * cos(radians(y)) * pow(sin(radians(x - lng) / 2), 2)))) <= 250""",
}
