"""Zones that pull or repel routes, as sets of grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .graph import flood_fill
from .spatial import dense_cells, disc_cells, semi

#: Side of a zone's cell and of a dense cell in degrees, points a dense cell has at least one more than.
CELL, COARSE, DENSE = 0.001, 0.005, 15


def lively_cells(points: DataFrame, more_than: int = DENSE, res: float = 0.002) -> DataFrame:
    """(zone, gx, gy): the fine cells of ``res`` degrees that begin in the dense cells of each zone of :func:`lively`."""
    cells = flood_fill(dense_cells(points, COARSE, more_than)).withColumnRenamed("component", "zone")
    # a little inside, so that a border that both grids share falls on the right side
    fine = lambda c: F.sequence(geo.cell(F.col(c) * COARSE + res / 1e6, res), geo.cell((F.col(c) + 1) * COARSE - res / 1e6, res))
    return cells.select("zone", F.explode(fine("gx")).alias("gx"), "gy").select("zone", "gx", F.explode(fine("gy")).alias("gy")).distinct()


def lively(points: DataFrame, more_than: int = DENSE) -> DataFrame:
    """(zone, points, kind, cells, clng, clat, magnetism): neighbouring dense cells; kind is the most frequent one.

    points: (kind, lng, lat).
    """
    cells = flood_fill(dense_cells(points, COARSE, more_than)).withColumnRenamed("component", "zone")
    p = points.where(geo.on_earth("lng", "lat")).select("kind", "lng", "lat", geo.cell("lng", COARSE).alias("gx"), geo.cell("lat", COARSE).alias("gy")).join(cells, ["gx", "gy"])
    n = p.groupBy("zone", "kind").agg(F.count("*").alias("_n"))
    kind = n.groupBy("zone").agg(F.max(F.struct(F.col("_n"), F.col("kind").alias("_kind"))).alias("_k")).select("zone", F.col("_k._kind").alias("kind"))
    z = p.groupBy("zone").agg(F.count("*").alias("points"), F.count_distinct("gx", "gy").alias("cells"), F.avg("lng").alias("clng"), F.avg("lat").alias("clat"))
    return z.join(kind, "zone").withColumn("magnetism", 6 + F.least(F.col("points") / 30, F.lit(2.0)))


def buffered(points: DataFrame, key: str, radius_m: float) -> DataFrame:
    """Distinct (key, gx, gy): the cells within the radius of a line's or area's points (key, lng, lat)."""
    return disc_cells(points.where(geo.on_earth("lng", "lat")).select(key, "lng", "lat"), "lng", "lat", radius_m, CELL).select(key, "gx", "gy").distinct()


def waterside(points: DataFrame, key: str, radius_m: float = 150.0, magnetism: float = 9.0) -> DataFrame:
    """(key, cells, clng, clat, magnetism) of zones along waters or around parks."""
    b = buffered(points, key, radius_m)
    mid = lambda c: (F.avg(c) + 0.5) * CELL
    return b.groupBy(key).agg(F.count("*").alias("cells"), mid("gx").alias("clng"), mid("gy").alias("clat")).withColumn("magnetism", F.lit(magnetism))


#: Metres an area must extend to be a zone, and by which it pulls more; metres around areas without a ring.
AREA_M, WIDE_M, AROUND_M = 500.0, 1000.0, 300.0


def area_magnetism(extent_m: Column) -> Column:
    """9 over a kilometre, 8 over half of one, else 7, also for unknown extents."""
    return F.when(extent_m > WIDE_M, 9.0).when(extent_m > AREA_M, 8.0).otherwise(7.0)


def area_cells(areas: DataFrame, key: str, res: float = CELL) -> DataFrame:
    """Distinct (key, gx, gy) of areas (key, lng, lat, extent_m, ring array<struct<lng,lat>>): the cells whose middle lies in
    the ring, or around the point where there is no ring of three corners. Areas known to extend less are left out."""
    a = areas.where(F.coalesce(F.col("extent_m") >= AREA_M, F.lit(True)))
    ringed = F.coalesce(F.size("ring") >= 3, F.lit(False))
    side = lambda f, k: geo.cell(f(F.transform("ring", lambda v: v[k])), res)
    r = a.where(ringed).withColumn("gx", F.explode(F.sequence(side(F.array_min, "lng"), side(F.array_max, "lng"))))
    r = r.withColumn("gy", F.explode(F.sequence(side(F.array_min, "lat"), side(F.array_max, "lat"))))
    r = r.where(geo.in_ring((F.col("gx") + 0.5) * res, (F.col("gy") + 0.5) * res, F.col("ring"))).select(key, "gx", "gy")
    around = disc_cells(a.where(~ringed & geo.on_earth("lng", "lat")).select(key, "lng", "lat"), "lng", "lat", AROUND_M, res).select(key, "gx", "gy")
    return r.unionAll(around).distinct()


def areas(df: DataFrame, key: str) -> DataFrame:
    """(key, cells, clng, clat, magnetism) of the areas that have cells, as zones."""
    n = area_cells(df, key).groupBy(key).agg(F.count("*").alias("cells"))
    return df.join(n, key).select(key, "cells", F.col("lng").alias("clng"), F.col("lat").alias("clat"), area_magnetism(F.col("extent_m")).alias("magnetism"))


def repelling(points: DataFrame, radius_m: float = 200.0) -> DataFrame:
    """(zone, gx, gy): neighbouring cells near points of roads to keep away from."""
    one = points.select(F.lit(0).alias("_k"), "lng", "lat")
    return flood_fill(buffered(one, "_k", radius_m)).withColumnRenamed("component", "zone").select("zone", "gx", "gy")


def boosted(zones: DataFrame, key: str, helps: list[tuple[DataFrame, float, float]]) -> DataFrame:
    """Adds to magnetism for each (places (_x, _y), radius in metres, points) with a place near a zone's centre."""
    out = zones
    for places, radius, points in helps:
        z = zones.select(key, F.col("clng").alias("lng"), F.col("clat").alias("lat"))
        hit = semi(z, places, radius, [key], ("_x", "_y")).select(key).withColumn("_hit", F.lit(points))
        out = out.join(hit, key, "left").withColumn("magnetism", F.col("magnetism") + F.coalesce("_hit", F.lit(0.0))).drop("_hit")
    return out


def strongest(zones: DataFrame, key: str, n: int = 80) -> DataFrame:
    """The n strongest zones, then the larger ones: a top-k report."""
    return zones.orderBy(F.col("magnetism").desc(), F.col("cells").desc(), key).limit(n)


def zones_along(path_points: DataFrame, zone_cells: DataFrame, path: str, zone: str, ends: Column | None = None) -> DataFrame:
    """Distinct (path, zone) where a path's point (path, lng, lat) falls into a zone's cell (zone, gx, gy)."""
    p = path_points.select(path, geo.cell("lng", CELL).alias("gx"), geo.cell("lat", CELL).alias("gy"))
    # merged: Spark takes the cells for as small as the points they were made of, and would send them out whole
    out = p.join(zone_cells.select(zone, "gx", "gy").hint("merge"), ["gx", "gy"]).select(path, zone).distinct()
    return out if ends is None else out.where(~ends)
