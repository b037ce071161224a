"""Points near points or in regions, by ranges of a space-filling curve.

The earth is cut into 2^level by 2^level cells, numbered along a Z-order curve. A disc becomes a few ranges of cell
numbers, a point one number; points and ranges meet in a range join on the numbers, and the exact distance decides.
The level depends on the latitude alone, so both sides can tell it by themselves, also at the poles and across the
180th meridian.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import stage
from .skew import salted_join

#: Cells of one block in each direction are 2^BLOCK_BITS; a block is the equality key of the range join.
BLOCK_BITS = 2
MAX_LEVEL = 24


def _spread(x: Column) -> Column:
    """Puts a zero bit after each bit: the binary digits read in base four. The argument appears once, so plans stay small."""
    return F.conv(F.bin(x), 4, 10).cast("long")


def zcode(x: Column, y: Column) -> Column:
    """Z-order number of the cell (x, y); both below 2^31."""
    return _spread(x.cast("long")).bitwiseOR(F.shiftleft(_spread(y.cast("long")), 1))


def _half_width(lat: Column, radius_m: float) -> Column:
    """Half the width in degrees of longitude of the disc around a point of this latitude; 180 over a pole."""
    rho = radius_m / geo.EARTH_M
    over = F.abs(lat) + math.degrees(rho) >= 90.0
    ratio = F.least(F.lit(math.sin(min(rho, math.pi / 2))) / F.cos(F.radians(lat)), F.lit(1.0))
    return F.when(over, F.lit(180.0)).otherwise(F.degrees(F.asin(ratio)) + 1e-9)


def level(lat: Column, radius_m: float) -> Column:
    """Level at which a disc here is at most three cells wide; it never rises towards a pole."""
    return F.greatest(F.least(F.floor(F.log2(360.0 / _half_width(lat, radius_m))), F.lit(MAX_LEVEL)), F.lit(BLOCK_BITS)).cast("int")


def _cell_x(lng: Column, side: Column) -> Column:
    return F.floor((lng + 180.0) / 360.0 * side).cast("long")


def _cell_y(lat: Column, side: Column) -> Column:
    return F.greatest(F.least(F.floor((lat + 90.0) / 180.0 * side), side - 1), F.lit(0)).cast("long")


def point_codes(df: DataFrame, lng: str, lat: str, radius_m: float) -> DataFrame:
    """Adds (_level, _block, _code), one row for each level that a disc reaching this point can have: one, seldom two."""
    reach = math.degrees(radius_m / geo.EARTH_M) * (1 + 1e-9) + 1e-9
    away = F.abs(F.col(lat))
    lo = level(F.least(away + reach, F.lit(90.0)), radius_m)
    hi = level(F.greatest(away - reach, F.lit(0.0)), radius_m)
    side = F.pow(F.lit(2.0), F.col("_level"))
    code = zcode(F.pmod(_cell_x(F.col(lng), side), side.cast("long")), _cell_y(F.col(lat), side))
    return (
        df.withColumn("_level", F.explode(F.sequence(lo, hi)))
        .withColumn("_code", code)
        .withColumn("_block", F.shiftright("_code", 2 * BLOCK_BITS))
    )


def disc_ranges(df: DataFrame, lng: str, lat: str, radius_m: float) -> DataFrame:
    """Adds (_level, _block, _lo, _hi): the ranges of cell numbers that cover the disc, cut at the edges of blocks."""
    a, p = F.col(lng), F.col(lat)
    reach = math.degrees(radius_m / geo.EARTH_M) + 1e-9
    half = _half_width(p, radius_m)
    side = F.pow(F.lit(2.0), F.col("_level"))
    isize = side.cast("long")
    x0, x1 = _cell_x(a - half, side), _cell_x(a + half, side)
    xs = F.array_distinct(F.transform(F.sequence(x0, F.least(x1, x0 + isize - 1)), lambda x: F.pmod(x, isize)))
    ys = F.sequence(_cell_y(p - reach, side), _cell_y(p + reach, side))
    codes = F.array_sort(F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: zcode(x, y)))))
    # consecutive numbers of one block become one range
    shift = 2 * BLOCK_BITS
    empty = F.array().cast("array<struct<lo:bigint,hi:bigint>>")

    def step(acc: Column, c: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["lo"].alias("lo"), c.alias("hi"))))
        new = F.concat(acc, F.array(F.struct(c.alias("lo"), c.alias("hi"))))
        joins = (F.size(acc) > 0) & (last["hi"] + 1 == c) & (F.shiftright(last["hi"], shift) == F.shiftright(c, shift))
        return F.when(joins, grown).otherwise(new)

    return (
        df.withColumn("_level", level(p, radius_m))
        .withColumn("_codes", codes)
        .withColumn("_r", F.explode(F.aggregate("_codes", empty, step)))
        .select(*df.columns, "_level", F.shiftright(F.col("_r.lo"), shift).alias("_block"), F.col("_r.lo").alias("_lo"), F.col("_r.hi").alias("_hi"))
    )


def within(
    points: DataFrame, centres: DataFrame, radius_m: float, point_key: list[str], point_xy=("lng", "lat"), centre_xy=("lng", "lat"), distance: str | None = None, equal: tuple[str, ...] = ()
) -> DataFrame:
    """Every pair of a point and a centre at most ``radius_m`` apart (haversine), with all columns of both.

    The column names of the two sides must differ, but for those of ``equal``, which must be alike and come out once. Rows of either side whose coordinates are null, NaN or out of
    range match nothing; rows given twice come out twice. Blocks in which many points crowd are split by a hash of
    ``point_key``. ``distance`` names a result column for the metres.
    """
    px, py = point_xy
    cx, cy = centre_xy
    p = point_codes(points.where(geo.on_earth(px, py)), px, py, radius_m)
    c = disc_ranges(centres.where(geo.on_earth(cx, cy)), cx, cy, radius_m)
    d = geo.haversine(px, py, cx, cy)
    hit = F.col("_code").between(F.col("_lo"), F.col("_hi")) & (d <= radius_m)
    out = salted_join(p, c, ["_level", "_block", *equal], point_key, on=hit)
    if distance:
        out = out.withColumn(distance, d)
    return out.drop("_level", "_block", "_code", "_lo", "_hi")


#: Levels that the cells of a region are finer than its box at most: so it has a few hundred ranges at most, whatever its size.
FINER = 5


def _interleaved(x: int, y: int) -> int:
    return int(f"{x:b}", 4) | int(f"{y:b}", 4) << 1


def cover_ring(xs, ys, finer: int = FINER) -> list[tuple[int, int, int, bool]]:
    """(level, lo, hi, whole): ranges of cell numbers, cut at the edges of blocks, that cover a ring of corners (xs, ys).

    The first level is that at which the ring's box is at most a cell wide and high. A cell that a side of the ring runs
    through is split in four, ``finer`` times at most; others lie in the ring whole or don't belong to it.
    """
    import numpy as np

    x, y = (np.asarray(xs, dtype=float) + 180.0) / 360.0, (np.asarray(ys, dtype=float) + 90.0) / 180.0
    if len(x) < 3 or not (np.isfinite(x).all() and np.isfinite(y).all()):
        return []
    dx, dy = np.roll(x, -1) - x, np.roll(y, -1) - y
    wide = max(float(np.ptp(x)), float(np.ptp(y)), 2.0**-MAX_LEVEL)
    level = int(max(0, min(math.floor(math.log2(1 / wide)), MAX_LEVEL - finer)))

    def crossed(cx: float, cy: float, size: float, sides):
        """The sides that come into a cell, its border included, by clipping each against the four lines of the border."""
        lo, hi = np.zeros(len(sides)), np.ones(len(sides))
        for d, q0, q1 in ((dx[sides], cx - x[sides], cx + size - x[sides]), (dy[sides], cy - y[sides], cy + size - y[sides])):
            with np.errstate(divide="ignore", invalid="ignore"):
                t0, t1 = q0 / d, q1 / d
            flat = d == 0
            lo = np.where(flat, np.where((q0 <= 0) & (q1 >= 0), lo, 2.0), np.maximum(lo, np.minimum(t0, t1)))
            hi = np.where(flat, hi, np.minimum(hi, np.maximum(t0, t1)))
        return sides[lo <= hi]

    def holds(px: float, py: float) -> bool:
        up = (y > py) != (np.roll(y, -1) > py)
        with np.errstate(divide="ignore", invalid="ignore"):
            return bool((up & (px < dx / dy * (py - y) + x)).sum() % 2)

    cells: list[tuple[int, int, bool]] = []
    side = 1 << level
    at = lambda v: int(min(max(math.floor(v * side), 0), side - 1))
    open_ = [(level, i, j, np.arange(len(x))) for i in range(at(x.min()), at(x.max()) + 1) for j in range(at(y.min()), at(y.max()) + 1)]
    while open_:
        lv, i, j, sides = open_.pop()
        size = 0.5**lv
        near = crossed(i * size, j * size, size, sides)
        if not len(near):
            if holds((i + 0.5) * size, (j + 0.5) * size):
                cells.append((lv, _interleaved(i, j), True))
        elif lv == level + finer:
            cells.append((lv, _interleaved(i, j), False))
        else:
            open_ += [(lv + 1, 2 * i + k, 2 * j + m, near) for k in (0, 1) for m in (0, 1)]
    out: list[tuple[int, int, int, bool]] = []
    for lv, code, whole in sorted(cells, key=lambda c: (c[0], c[1])):
        if out and out[-1][0] == lv and out[-1][3] == whole and out[-1][2] + 1 == code and code >> 2 * BLOCK_BITS == out[-1][1] >> 2 * BLOCK_BITS:
            out[-1] = (lv, out[-1][1], code, whole)
        else:
            out.append((lv, code, code, whole))
    return out


def region_ranges(regions: DataFrame, ring: str) -> DataFrame:
    """Adds (_level, _block, _lo, _hi, _whole): the ranges of :func:`cover_ring` of each ring, a row for each."""
    import pandas as pd

    def covers(xs, ys):
        return pd.Series([[dict(zip(("level", "lo", "hi", "whole"), r)) for r in cover_ring(a, b)] for a, b in zip(xs, ys)])

    cover = F.pandas_udf(covers, "array<struct<level:int,lo:bigint,hi:bigint,whole:boolean>>", F.PandasUDFType.SCALAR)
    corner = lambda k: F.transform(ring, lambda v: v[k])
    g = regions.where(F.size(ring) >= 3).withColumn("_r", F.explode(cover(corner("lng"), corner("lat"))))
    return g.select(*regions.columns, F.col("_r.level").alias("_level"), F.shiftright("_r.lo", 2 * BLOCK_BITS).alias("_block"), F.col("_r.lo").alias("_lo"), F.col("_r.hi").alias("_hi"), F.col("_r.whole").alias("_whole"))


def regions_of_points(points: DataFrame, regions: DataFrame, point_key: list[str], ring: str, point_xy=("lng", "lat")) -> DataFrame:
    """Every pair of a point and a region whose ring (array<struct<lng,lat>>) holds it, by the even-odd rule.

    Regions are covered by cells of their own sizes (:func:`region_ranges`); a point asks at every level that a region
    has, which are few. Null, NaN or out-of-range points match nothing, nor do rings of fewer than three corners; corners
    must be on earth. Rings over the 180th meridian must be cut there first. Crowded blocks are split.
    """
    px, py = point_xy
    g = stage(region_ranges(regions, ring), "regions")
    levels = [r["_level"] for r in g.select("_level").distinct().collect()]  # at most one for each level there is
    p = points.where(geo.on_earth(px, py)).withColumn("_level", F.explode(F.lit(levels or [0]).cast("array<int>")))
    side = F.pow(F.lit(2.0), F.col("_level"))
    code = zcode(F.least(_cell_x(F.col(px), side), side.cast("long") - 1), _cell_y(F.col(py), side))
    p = p.withColumn("_code", code).withColumn("_block", F.shiftright("_code", 2 * BLOCK_BITS))
    hit = F.col("_code").between(F.col("_lo"), F.col("_hi")) & (F.col("_whole") | geo.in_ring(px, py, F.col(ring)))
    return salted_join(p, g, ["_level", "_block"], point_key, on=hit).drop("_level", "_block", "_code", "_lo", "_hi", "_whole")


def paths_near_places(places: DataFrame, bikepaths: DataFrame, radius_m: float = 250.0) -> DataFrame:
    """(place_id, path_id): each place with every path that has an anchor within the radius, once.

    Coordinates count as stored. A place or anchor off the earth or without a number doesn't count, nor an anchor
    that isn't exactly two numbers, nor rows without an id. Repeated deliveries and repeated anchors count once.
    """
    p = places.where(geo.on_earth("lng", "lat") & F.col("place_id").isNotNull()).select("place_id", "lng", "lat").distinct()
    a = (
        bikepaths.where(F.col("path_id").isNotNull())
        .select("path_id", F.explode(F.array_distinct("anchors")).alias("_a"))
        .where(F.size("_a") == 2)
        .select("path_id", F.try_element_at("_a", F.lit(1)).alias("_x"), F.try_element_at("_a", F.lit(2)).alias("_y"))
        .where(geo.on_earth("_x", "_y"))
        .distinct()
    )
    return within(p, a, radius_m, ["place_id"], centre_xy=("_x", "_y")).select("place_id", "path_id").distinct()
