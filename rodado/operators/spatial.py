"""Distance joins in the shapes that analyses need, on :mod:`nearby`'s range join.

Left rows are points (``point_key`` tells them apart, or they are distinct rows), right rows have other column names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..session import stage
from .nearby import within
from .skew import set_overlaps

#: Factor by which the radius of a nearest-neighbour search grows from ring to ring.
GROWTH = 8.0


def semi(points: DataFrame, targets: DataFrame, radius_m: float, key: list[str], target_xy) -> DataFrame:
    """Points with a target within the radius."""
    hit = within(points.select(*key, "lng", "lat"), targets.select(*target_xy).distinct(), radius_m, key, centre_xy=target_xy).select(*key).distinct()
    return points.join(hit, key, "left_semi")


def anti(points: DataFrame, targets: DataFrame, radius_m: float, key: list[str], target_xy) -> DataFrame:
    """Points without one; points without coordinates are among them."""
    hit = within(points.select(*key, "lng", "lat"), targets.select(*target_xy).distinct(), radius_m, key, centre_xy=target_xy).select(*key).distinct()
    return points.join(hit, key, "left_anti")


def pairs_within(points: DataFrame, key: str, radius_m: float) -> DataFrame:
    """(a, b, metres) with a < b of the points at most ``radius_m`` apart."""
    q = points.select(F.col(key).alias("b"), F.col("lng").alias("_x"), F.col("lat").alias("_y"))
    j = within(points.select(F.col(key).alias("a"), "lng", "lat"), q, radius_m, ["a"], centre_xy=("_x", "_y"), distance="metres")
    return j.where("a < b").select("a", "b", "metres")


def nearest(points: DataFrame, targets: DataFrame, key: str, target: str, k: int = 1, start_m: float = 250.0, most_m: float = 21_000_000.0, target_xy=("_x", "_y")) -> DataFrame:
    """(key, target, metres, place) of the k nearest targets of each point, ties by the smaller target.

    Rings: the radius starts at ``start_m`` and grows for the points that still lack k targets; found distances within
    the radius are final, so every ring is exact. Points that find fewer within ``most_m`` get those. What a ring found
    and left over is written to the shared folder, so that no ring repeats the ones before.
    """
    left, r, out = points.select(key, "lng", "lat").where(geo.on_earth("lng", "lat")).distinct(), start_m, None
    order = Window.partitionBy(key).orderBy("metres", target)
    while True:
        j = within(left, targets, r, [key], centre_xy=target_xy, distance="metres").groupBy(key, target).agg(F.min("metres").alias("metres"))
        j = j.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).withColumn("_n", F.count("*").over(Window.partitionBy(key)))
        last = r >= most_m
        found = stage((j if last else j.where(F.col("_n") >= k)).drop("_n"), "ring")
        out = found if out is None else out.unionAll(found)
        if last:
            return out
        left = stage(left.join(found.select(key).distinct(), key, "left_anti"), "ring")
        if left.isEmpty():
            return out
        r = min(r * GROWTH, most_m)


def nearest_one(points: DataFrame, targets: DataFrame, key: str, target: str, radii: tuple[float, ...], target_xy=("_x", "_y")) -> DataFrame:
    """(key, target, metres): the nearest target of each point within the last radius, ties by the smaller target.

    As :func:`nearest` for many targets to a point: what is found for a point is brought down to one row before it is shuffled,
    and the discs are those around the points that still lack a target.
    """
    c = F.col
    x, y = target_xy
    t = targets.select(target, c(x).alias("lng"), c(y).alias("lat"))
    left, out = points.select(key, "lng", "lat").where(geo.on_earth("lng", "lat")).distinct(), None
    for r in radii:
        j = within(t, left.select(key, c("lng").alias("_px"), c("lat").alias("_py")), r, [target], centre_xy=("_px", "_py"), distance="metres")
        j = j.groupBy(key).agg(F.min(F.struct("metres", c(target).alias("_t"))).alias("_b")).select(key, c("_b._t").alias(target), "_b.metres")
        found = stage(j, "ring")
        out = found if out is None else out.unionAll(found)
        left = left.join(found, key, "left_anti")
    return out


def nearest_far(points: DataFrame, targets: DataFrame, key: str, target: str, res: float = 0.1, target_xy=("_x", "_y")) -> DataFrame:
    """(key, target, metres): the nearest target of points that have none near, ties by the smaller target.

    Targets lie in cells of ``res`` degrees. A cell farther than another one's farthest target is left out, so that a point
    meets the targets of a few cells, not all.
    """
    c = F.col
    x, y = target_xy
    t = targets.where(geo.on_earth(x, y)).select(target, x, y, geo.cell(x, res).alias("gx"), geo.cell(y, res).alias("gy"))
    mid = lambda g: (c(g) + 0.5) * res
    cells = stage(t.groupBy("gx", "gy").agg(F.max(geo.haversine(mid("gx"), mid("gy"), c(x), c(y))).alias("_r")), "cells")
    p = points.select(key, "lng", "lat").where(geo.on_earth("lng", "lat")).distinct()
    away = geo.haversine("lng", "lat", mid("gx"), mid("gy"))
    most = p.crossJoin(cells).groupBy(key, "lng", "lat").agg(F.min(away + c("_r")).alias("_most"))
    # 10 m more than rounding can take off distances around the earth
    near = most.crossJoin(cells).where(away - c("_r") <= c("_most") + 10).select(key, "lng", "lat", "gx", "gy")
    j = near.join(t, ["gx", "gy"]).groupBy(key).agg(F.min(F.struct(geo.haversine("lng", "lat", x, y).alias("metres"), c(target).alias("_t"))).alias("_b"))
    return j.select(key, c("_b._t").alias(target), "_b.metres")


def best_within(points: DataFrame, targets: DataFrame, radius_m: float, key: str, target: str, score: str, target_xy=("_x", "_y")) -> DataFrame:
    """(key, target, score): the target of the highest score within the radius, ties to the smaller target."""
    j = within(points.select(key, "lng", "lat").distinct(), targets, radius_m, [key], centre_xy=target_xy)
    return j.groupBy(key).agg(F.max(F.struct(F.col(score), (-F.col(target)).alias("_t"))).alias("_b")).select(key, (-F.col("_b._t")).alias(target), F.col(f"_b.{score}").alias(score))


def top_within(points: DataFrame, targets: DataFrame, radius_m: float, key: str, target: str, k: int, target_xy=("_x", "_y")) -> DataFrame:
    """(key, target, metres, place): the k nearest targets within the radius; the nearest point counts of targets with several."""
    j = within(points.select(key, "lng", "lat").distinct(), targets, radius_m, [key], centre_xy=target_xy, distance="metres")
    j = j.groupBy(key, target).agg(F.min("metres").alias("metres"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("metres", target))
    return j.withColumn("place", place).where(F.col("place") <= k).select(key, target, "metres", "place")


def first_match(points: DataFrame, targets: DataFrame, radius_m: float, key: str, target: str, share: float = 0.4, target_xy=("_x", "_y")) -> DataFrame:
    """(key, target): sample points (key, sample, lng, lat) against targets with points (target, x, y): the smallest target
    that more than ``share`` of the key's samples lie near."""
    n = points.groupBy(key).agg(F.count("*").alias("_n"))
    hit = within(points.select(key, "sample", "lng", "lat"), targets, radius_m, [key, "sample"], centre_xy=target_xy)
    hit = hit.groupBy(key, target).agg(F.count_distinct("sample").alias("_hit")).join(n, key).where(F.col("_hit") > share * F.col("_n"))
    return hit.groupBy(key).agg(F.min(target).alias(target))


#: Metres within which the coverage of a reference line is told.
COVERAGE_M = (50, 100, 200, 500, 1000)


def coverage(reference: DataFrame, track: DataFrame, key: str, xy=("_x", "_y"), limits=COVERAGE_M) -> DataFrame:
    """(key, points, within_50, ...): share of a reference's points (key, ord, lng, lat) near any point of the track.

    The middle limit is asked for first, so that the widest radius is asked for the points alone that have nothing nearer.
    """
    t, p = track.select(*xy).distinct(), reference.select(key, "ord", "lng", "lat")
    near = lambda df, m: within(df, t, float(m), [key, "ord"], centre_xy=xy, distance="_d").groupBy(key, "ord").agg(F.min("_d").alias("_d"))
    close = stage(near(p, sorted(limits)[len(limits) // 2]), "near")
    far = near(p.join(close, [key, "ord"], "left_anti"), max(limits))
    j = p.select(key, "ord").join(close.unionAll(far), [key, "ord"], "left")
    return j.groupBy(key).agg(F.count("*").alias("points"), *(geo.half_up(F.avg(F.coalesce((F.col("_d") <= m).cast("int"), F.lit(0))), 4).alias(f"within_{m}") for m in limits))


def min_end_gap(a: str, b: str) -> Column:
    """Least of the four distances between the ends of two lines with columns {a}lng0, {a}lat0, {a}lng1, ... ."""
    return F.least(*(geo.haversine(f"{a}lng{i}", f"{a}lat{i}", f"{b}lng{j}", f"{b}lat{j}") for i in (0, 1) for j in (0, 1)))


def line_links(lines: DataFrame, key: str, gap_m: float) -> DataFrame:
    """(a, b, gap_m) with a < b of lines (key, lng0, lat0, lng1, lat1) whose nearest ends are at most ``gap_m`` apart."""
    tips = lines.select(F.col(key), F.explode(F.array(F.struct(F.col("lng0").alias("lng"), F.col("lat0").alias("lat")), F.struct(F.col("lng1").alias("lng"), F.col("lat1").alias("lat")))).alias("_p")).select(key, "_p.*").distinct()
    q = tips.select(F.col(key).alias("b"), F.col("lng").alias("_x"), F.col("lat").alias("_y"))
    j = within(tips.withColumnRenamed(key, "a"), q, gap_m, ["a", "lng", "lat"], centre_xy=("_x", "_y"), distance="_d").where("a < b")
    return j.groupBy("a", "b").agg(F.min("_d").alias("gap_m"))


def disc_cells(df: DataFrame, lng: str, lat: str, radius_m: float, res: float) -> DataFrame:
    """Adds gx, gy, a row for each grid cell of ``res`` degrees whose offset point lies within the radius of the point."""
    reach_y = F.lit(radius_m / geo.DEGREE_M)
    reach_x = reach_y / F.greatest(F.cos(F.radians(lat)), F.lit(0.01))
    ny, nx = F.ceil(reach_y / res).cast("int"), F.ceil(reach_x / res).cast("int")
    e = df.withColumn("_i", F.explode(F.sequence(-nx, nx))).withColumn("_j", F.explode(F.sequence(-ny, ny)))
    x, y = F.col(lng) + F.col("_i") * res, F.col(lat) + F.col("_j") * res
    near = geo.haversine(F.col(lng), F.col(lat), x, y) <= radius_m
    return e.where(near).select(*df.columns, geo.cell(x, res).alias("gx"), geo.cell(y, res).alias("gy"))


def dense_cells(points: DataFrame, res: float, more_than: int) -> DataFrame:
    """(gx, gy, n) of the cells with more than that many points."""
    g = points.where(geo.on_earth("lng", "lat")).select(geo.cell("lng", res).alias("gx"), geo.cell("lat", res).alias("gy"))
    return g.groupBy("gx", "gy").agg(F.count("*").alias("n")).where(F.col("n") > more_than)


def footprint_overlap(cells: DataFrame, key: str, more_than: float = 0.5) -> DataFrame:
    """(a, b, share) with a < b: cells two footprints (key, gx, gy) share, against the smaller; only above the limit."""
    c = cells.groupBy(key).agg(F.collect_set(F.struct("gx", "gy")).alias("_cells"))
    return set_overlaps(c, key, "_cells", more_than)


def _strided(points: DataFrame, samples: int = 500) -> DataFrame:
    from .tracks import every_nth

    return every_nth(points, samples)


def find_corridor(points: DataFrame, reference: DataFrame, near_m: float = 300.0, most: int = 25) -> DataFrame:
    """(track, near, total, pct): how many points of a reference line (ord, _x, _y) each track (track, ord, lng, lat) comes
    near, of how many; the ``most`` best, a top-k report. Long tracks are sampled at equal steps."""
    hit = within(_strided(points), reference.withColumnRenamed("ord", "_ref"), near_m, ["track", "ord"], centre_xy=("_x", "_y"))
    n = hit.groupBy("track").agg(F.count_distinct("_ref").alias("near")).join(reference.agg(F.count("*").alias("total")))
    return n.withColumn("pct", geo.half_up(F.col("near") / F.col("total") * 100).cast("long")).orderBy(F.col("near").desc(), "track").limit(most)


def tracks_near(points: DataFrame, lng: float, lat: float, radius_m: float = 500.0, most: int = 25) -> DataFrame:
    """(track, metres, points): the tracks that come within the radius of a place, the nearest first; a top-k report."""
    n = points.groupBy("track").agg(F.count("*").alias("points"))
    d = _strided(points).groupBy("track").agg(F.min(geo.haversine("lng", "lat", lng, lat)).alias("_d")).where(F.col("_d") <= radius_m)
    return d.join(n, "track").orderBy("_d", "track").limit(most).select("track", geo.half_up("_d").cast("long").alias("metres"), "points")
