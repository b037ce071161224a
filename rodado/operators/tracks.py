"""Measures of ordered tracks, by window functions.

A track table has (track, ord, lng, lat): one row a point, ``ord`` rising along the track and unique in it. Every
function here takes and returns DataFrames; all windows are by (track, ord), so a chain of them needs one exchange and
one sort. Tracks of one point have no steps; points without coordinates must be dropped before (:func:`clean`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.geo import half_up


def _by() -> WindowSpec:
    return Window.partitionBy("track")


def _order() -> WindowSpec:
    return _by().orderBy("ord")


def _so_far() -> WindowSpec:
    return _order().rowsBetween(Window.unboundedPreceding, Window.currentRow)


#: Metres of one degree in the plane that the projections use.
PLANE_M = 111_320.0


def clean(points: DataFrame) -> DataFrame:
    """Points on earth, of a track."""
    return points.where(F.col("track").isNotNull() & geo.on_earth("lng", "lat"))


def steps(points: DataFrame) -> DataFrame:
    """Adds plng, plat, step_m (null at a track's first point) and cum_m (metres from the start)."""
    p = points.withColumns({"plng": F.lag("lng").over(_order()), "plat": F.lag("lat").over(_order())})
    p = p.withColumn("step_m", geo.haversine("plng", "plat", "lng", "lat"))
    return p.withColumn("cum_m", F.coalesce(F.sum("step_m").over(_so_far()), F.lit(0.0)))


def ends(points: DataFrame) -> DataFrame:
    """One row a track: points, first and last coordinates, bounding box, centroid, length."""
    first = lambda c: F.min_by(c, "ord")
    last = lambda c: F.max_by(c, "ord")
    return steps(points).groupBy("track").agg(
        F.count("*").alias("points"), F.coalesce(F.sum("step_m"), F.lit(0.0)).alias("length_m"),
        first("lng").alias("lng0"), first("lat").alias("lat0"), last("lng").alias("lng1"), last("lat").alias("lat1"),
        F.min("lng").alias("min_lng"), F.max("lng").alias("max_lng"), F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
        F.avg("lng").alias("clng"), F.avg("lat").alias("clat"),
    )


def with_ends(points: DataFrame) -> DataFrame:
    """Adds n, lng0, lat0, lng1, lat1, crow_m to each point, by windows (no join)."""
    w = _order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p = points.withColumns({
        "n": F.count("*").over(_by()), "lng0": F.first("lng").over(w), "lat0": F.first("lat").over(w),
        "lng1": F.last("lng").over(w), "lat1": F.last("lat").over(w),
    })
    return p.withColumn("crow_m", geo.haversine("lng0", "lat0", "lng1", "lat1"))


def jumps(points: DataFrame) -> DataFrame:
    """Steps over 500, 1,000 and 2,000 m, and the longest in whole metres."""
    over = lambda m: F.count_if(F.col("step_m") > m)
    return steps(points).groupBy("track").agg(
        over(500).alias("over_500"), over(1000).alias("over_1k"), over(2000).alias("over_2k"),
        F.coalesce(half_up(F.max("step_m")), F.lit(0.0)).cast("long").alias("worst_m"),
    )


def density(points: DataFrame) -> DataFrame:
    """Points, kilometres and points per kilometre (0 for a track of no length)."""
    km = F.col("length_m") / 1000
    return ends(points).select(
        "track", "points", half_up(km, 1).alias("dist_km"),
        F.when(km > 0, half_up(F.col("points") / km)).otherwise(0.0).cast("long").alias("points_per_km"),
    )


def sharp_turns(points: DataFrame, skip_m: float = 30.0, least_m: float = 50.0, turn: float = 120.0) -> DataFrame:
    """Turns of more than ``turn`` degrees into steps over ``least_m``; steps under ``skip_m`` are passed over."""
    s = with_ends(steps(points)).where(F.col("step_m") >= skip_m)
    s = s.withColumn("_b", geo.bearing("plng", "plat", "lng", "lat"))
    s = s.withColumn("_t", geo.angle_between(F.lag("_b").over(_order()), F.col("_b")))
    return s.groupBy("track").agg(F.count_if((F.col("_t") > turn) & (F.col("step_m") > least_m)).alias("sharp_turns"))


def _projection() -> Column:
    ox, oy = F.col("lng1") - F.col("lng0"), F.col("lat1") - F.col("lat0")
    dx, dy = F.col("lng") - F.col("lng0"), F.col("lat") - F.col("lat0")
    size = F.sqrt(ox * ox + oy * oy)
    return F.when(ox * ox + oy * oy > 1e-12, (dx * ox + dy * oy) / size * PLANE_M)


def walkbacks_one_way(points: DataFrame, skip_m: float = 30.0, back_m: float = 200.0, loop_m: float = 2000.0) -> DataFrame:
    """Points that lie more than ``back_m`` behind the farthest point so far, along the line from start to end."""
    s = with_ends(steps(points)).where((F.col("step_m") >= skip_m) & (F.col("crow_m") >= loop_m))
    s = s.withColumn("_p", _projection())
    s = s.withColumn("_far", F.max("_p").over(_so_far()))
    return s.groupBy("track").agg(F.count_if(F.col("_far") - F.col("_p") > back_m).alias("walkbacks"))


def loop_angles(points: DataFrame) -> DataFrame:
    """Every k-th point (k = n / 100, at least 1) with its change of angle around the centroid, -180 to 180."""
    p = with_ends(points).withColumns({"_cx": F.avg("lng").over(_by()), "_cy": F.avg("lat").over(_by()), "_i": F.row_number().over(_order()) - 1})
    p = p.where(F.col("_i") % F.greatest(F.floor(F.col("n") / 100), F.lit(1)) == 0)
    p = p.withColumn("_a", F.degrees(F.atan2(F.col("lng") - F.col("_cx"), F.col("lat") - F.col("_cy"))))
    d = F.col("_a") - F.lag("_a").over(_order())
    return p.withColumn("delta", F.when(d > 180, d - 360).when(d < -180, d + 360).otherwise(d))


def walkbacks_loop(points: DataFrame, loop_m: float = 2000.0) -> DataFrame:
    """Changes of sense of more than 15 degrees on loops; changes of up to 5 degrees don't set the sense."""
    p = loop_angles(points).where(F.col("crow_m") < loop_m)
    p = p.withColumn("_dir", F.when(F.abs("delta") > 5, F.signum("delta")))
    before = F.last("_dir", ignorenulls=True).over(_order().rowsBetween(Window.unboundedPreceding, -1))
    p = p.withColumn("_before", before)
    return p.groupBy("track").agg(F.count_if((F.col("_dir") != F.col("_before")) & (F.abs("delta") > 15)).alias("walkbacks"))


def smoothness(points: DataFrame) -> DataFrame:
    """(track, smoothness 0..100, walkbacks, sharp_turns), by the tracks' kind; under three points: 100, 0, 0."""
    base = ends(points).select("track", "points")
    t, a, b = sharp_turns(points), walkbacks_one_way(points), walkbacks_loop(points).withColumnRenamed("walkbacks", "_loop")
    j = base.join(t, "track", "left").join(a, "track", "left").join(b, "track", "left")
    few = F.col("points") < 3
    turns = F.coalesce("sharp_turns", F.lit(0))
    score = F.greatest(100 - turns / F.greatest(F.col("points") - 1, F.lit(1)) * 2000, F.lit(0.0))
    return j.select(
        "track", F.when(few, 100).otherwise(half_up(score)).cast("long").alias("smoothness"),
        F.when(few, 0).otherwise(F.coalesce("walkbacks", "_loop", F.lit(0))).cast("long").alias("walkbacks"),
        F.when(few, 0).otherwise(turns).cast("long").alias("sharp_turns"),
    )


def interpolated(points: DataFrame) -> DataFrame:
    """Runs of evenly spaced collinear points: share of real distance in percent, runs, metres in them."""
    s = steps(points).withColumn("_b", geo.bearing("plng", "plat", "lng", "lat"))
    s = s.withColumns({"_pm": F.lag("step_m").over(_order()), "_pb": F.lag("_b").over(_order())})
    even = lambda c: (F.col(c) > 40) & (F.col(c) < 60)
    made = F.coalesce(even("step_m") & even("_pm") & (geo.angle_between("_pb", "_b") < 2), F.lit(False))
    s = s.withColumn("_made", made)
    s = s.withColumn("_starts", F.col("_made") & ~F.coalesce(F.lag("_made").over(_order()), F.lit(False)))
    total, inside = F.coalesce(F.sum("step_m"), F.lit(0.0)), F.coalesce(F.sum(F.when(F.col("_made"), F.col("step_m"))), F.lit(0.0))
    return s.groupBy("track").agg(
        F.when(total > 0, half_up((1 - inside / total) * 100)).otherwise(100.0).cast("long").alias("real_pct"),
        F.count_if("_starts").alias("runs"), half_up(inside).cast("long").alias("interpolated_m"),
    )


def rideability(points: DataFrame) -> DataFrame:
    """(track, rideability 0..100, wasted_m): how much of a track makes progress, around or from start to end."""
    s = with_ends(steps(points)).withColumn("_total", F.sum("step_m").over(_by()))
    s = s.withColumn("_loop", F.col("crow_m") < F.greatest(F.lit(2000.0), F.col("_total") * 0.15))
    one = s.where(~F.col("_loop")).withColumn("_p", F.coalesce(_projection(), F.lit(0.0)))
    one = one.withColumn("_back", F.col("_p") < F.lag("_p").over(_order()))
    one = one.groupBy("track").agg(
        F.first("n").alias("n"), F.first("_total").alias("total"), F.coalesce(F.sum(F.when(F.col("_back"), F.col("step_m"))), F.lit(0.0)).alias("wasted")
    )
    eff = F.greatest(1 - F.col("wasted") * 2 / F.col("total"), F.lit(0.0))
    one = one.select("track", "n", half_up(eff * 100).alias("_r"), half_up(F.col("wasted")).alias("_w"))
    loop = loop_angles(s.where("_loop").select("track", "ord", "lng", "lat", "_total"))
    # rows without a change are each track's first
    loop = loop.withColumn("_sense", F.when(F.sum(F.when(F.col("delta") > 0, 1).when(F.col("delta").isNotNull(), -1)).over(_by()) >= 0, 1.0).otherwise(-1.0))
    big = F.abs("delta") > 2
    fwd = F.coalesce(F.sum(F.when(big & (F.signum("delta") == F.col("_sense")), F.abs("delta"))), F.lit(0.0))
    back = F.coalesce(F.sum(F.when(big & (F.signum("delta") != F.col("_sense")), F.abs("delta"))), F.lit(0.0))
    loop = loop.groupBy("track").agg(F.first("n").alias("n"), F.first("_total").alias("total"), fwd.alias("fwd"), back.alias("back"))
    eff = F.when(F.col("fwd") + F.col("back") > 0, F.col("fwd") / (F.col("fwd") + F.col("back"))).otherwise(1.0)
    loop = loop.select("track", "n", half_up(eff * 100).alias("_r"), half_up(F.coalesce("total", F.lit(0.0)) * (1 - eff)).alias("_w"))
    few = F.col("n") < 3
    return one.unionByName(loop).select(
        "track", F.when(few, 100).otherwise(F.col("_r")).cast("long").alias("rideability"), F.when(few, 0).otherwise(F.col("_w")).cast("long").alias("wasted_m")
    )


#: Signs of the eight directions from north clockwise, and of a block that stands still.
ARROWS = ("↑N", "↗NE", "→E", "↘SE", "↓S", "↙SW", "←W", "↖NW")
STILL = "·"


def _arrow(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dy, dx = (by - ay) * PLANE_M, (bx - ax) * PLANE_M * F.cos(F.radians(ay))
    k = F.pmod(F.floor((F.degrees(F.atan2(dx, dy)) + 22.5) / 45.0).cast("int"), F.lit(8))
    return F.when(F.sqrt(dx * dx + dy * dy) < 50, STILL).otherwise(F.element_at(F.array(*map(F.lit, ARROWS)), k + 1))


def shape(points: DataFrame) -> DataFrame:
    """(track, shape): the main directions of 2 to 12 blocks of about a kilometre."""
    s = with_ends(steps(points)).where(F.col("n") >= 2)
    blocks = F.greatest(F.least(half_up(F.sum("step_m").over(_by()) / 1000), F.lit(12.0)), F.lit(2.0)).cast("int")
    s = s.withColumns({"_i": F.row_number().over(_order()) - 1, "_blocks": blocks})
    s = s.withColumn("_size", F.floor(F.col("n") / F.col("_blocks")).cast("int"))
    # a block's last point is the next block's first
    at = F.sequence(F.lit(0), F.col("_blocks") - 1)
    e = s.withColumn("_b", F.explode(F.filter(at, lambda b: (F.col("_i") == b * F.col("_size")) | (F.col("_i") == F.least((b + 1) * F.col("_size"), F.col("n") - 1)))))
    g = e.groupBy("track", "_b").agg(F.min_by("lng", "_i").alias("ax"), F.min_by("lat", "_i").alias("ay"), F.max_by("lng", "_i").alias("bx"), F.max_by("lat", "_i").alias("by"))
    g = g.withColumn("_s", _arrow(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")))
    return g.groupBy("track").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_b", "_s"))), lambda x: x["_s"]), " ").alias("shape"))


def measures(points: DataFrame) -> DataFrame:
    """One row a track with all of :func:`smoothness`, :func:`interpolated`, :func:`jumps`, :func:`density`,
    :func:`rideability` and :func:`shape`, and lng0, lat0, lng1, lat1, length_m, in one exchange, one sort, one group.

    Where those drop points before they look back, here the look back skips what they drop.
    """
    o, full = _order(), _order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = o.rowsBetween(Window.unboundedPreceding, -1)
    c = F.col
    last_known = lambda x: F.last(x, ignorenulls=True).over(before)
    s = points.select("track", "ord", "lng", "lat").withColumns({
        "plng": F.lag("lng").over(o), "plat": F.lag("lat").over(o), "n": F.count("*").over(full), "_i": F.row_number().over(o) - 1,
        "lng0": F.first("lng").over(full), "lat0": F.first("lat").over(full), "lng1": F.last("lng").over(full), "lat1": F.last("lat").over(full),
        "_cx": F.avg("lng").over(full), "_cy": F.avg("lat").over(full),
    })
    s = s.withColumns({
        "step_m": geo.haversine("plng", "plat", "lng", "lat"), "_b": geo.bearing("plng", "plat", "lng", "lat"), "_p": _projection(),
        "crow_m": geo.haversine("lng0", "lat0", "lng1", "lat1"),
        "_a": F.when(c("_i") % F.greatest(F.floor(c("n") / 100), F.lit(1)) == 0, F.degrees(F.atan2(c("lng") - c("_cx"), c("lat") - c("_cy")))),
    })
    long = c("step_m") >= 30
    s = s.withColumns({
        "_total": F.sum("step_m").over(full), "_pb30": last_known(F.when(long, c("_b"))), "_far": F.max(F.when(long, c("_p"))).over(_so_far()),
        "_pm": F.lag("step_m").over(o), "_pb": F.lag("_b").over(o), "_pp": F.lag(F.coalesce("_p", F.lit(0.0))).over(o),
        "_d": c("_a") - last_known(c("_a")),
    })
    even = lambda k: (c(k) > 40) & (c(k) < 60)
    s = s.withColumns({
        "_made": F.coalesce(even("step_m") & even("_pm") & (geo.angle_between("_pb", "_b") < 2), F.lit(False)),
        "delta": F.when(c("_d") > 180, c("_d") - 360).when(c("_d") < -180, c("_d") + 360).otherwise(c("_d")),
        "_blocks": F.greatest(F.least(half_up(F.coalesce("_total", F.lit(0.0)) / 1000), F.lit(12.0)), F.lit(2.0)).cast("int"),
    })
    s = s.withColumn("_dir", F.when(F.abs("delta") > 5, F.signum("delta"))).withColumn("_size", F.floor(c("n") / c("_blocks")).cast("int"))
    s = s.withColumns({"_was": last_known(c("_dir")), "_starts": c("_made") & ~F.coalesce(F.lag("_made").over(o), F.lit(False))})
    over = lambda m: F.count_if(c("step_m") > m)
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    swing = lambda sign: zero(F.sum(F.when((F.abs("delta") > 2) & (F.signum("delta") == sign), F.abs("delta"))))
    edge = ((c("_i") % c("_size") == 0) & (c("_i") <= c("_blocks") * c("_size"))) | (c("_i") == c("n") - 1)
    one = lambda k: F.first(k).alias(k)
    g = s.groupBy("track").agg(
        F.count("*").alias("points"), zero(F.sum("step_m")).alias("length_m"), *map(one, ("lng0", "lat0", "lng1", "lat1", "crow_m", "_blocks", "_size")),
        over(500).alias("over_500"), over(1000).alias("over_1k"), over(2000).alias("over_2k"), zero(half_up(F.max("step_m"))).cast("long").alias("worst_m"),
        F.count_if(long & (geo.angle_between("_pb30", "_b") > 120) & (c("step_m") > 50)).alias("_turns"),
        F.count_if(long & (c("_far") - c("_p") > 200)).alias("_one"), F.count_if((c("_dir") != c("_was")) & (F.abs("delta") > 15)).alias("_loop"),
        F.count_if("_starts").alias("runs"), zero(F.sum(F.when(c("_made"), c("step_m")))).alias("_inside"),
        zero(F.sum(F.when(zero(c("_p")) < c("_pp"), c("step_m")))).alias("_wasted"),
        F.coalesce(F.sum(F.when(c("delta") > 0, 1).when(c("delta").isNotNull(), -1)), F.lit(0)).alias("_sense"), swing(1).alias("_right"), swing(-1).alias("_left"),
        F.sort_array(F.collect_list(F.when((c("n") >= 2) & edge, F.struct("_i", "lng", "lat")))).alias("_edges"),
    )
    few, km = c("points") < 3, c("length_m") / 1000
    fwd, back = F.when(c("_sense") >= 0, c("_right")).otherwise(c("_left")), F.when(c("_sense") >= 0, c("_left")).otherwise(c("_right"))
    around = F.when(fwd + back > 0, fwd / (fwd + back)).otherwise(1.0)
    straight = F.greatest(1 - c("_wasted") * 2 / c("length_m"), F.lit(0.0))
    ring = c("crow_m") < F.greatest(F.lit(2000.0), c("length_m") * 0.15)
    whole = lambda x: half_up(x).cast("long")

    def arrow(b: Column) -> Column:
        p, q = c("_edges")[b], F.when((b + 1) * c("_size") <= c("points") - 1, c("_edges")[b + 1]).otherwise(F.element_at("_edges", -1))
        return _arrow(p["lng"], p["lat"], q["lng"], q["lat"])

    return g.select(
        "track", "points", "length_m", "lng0", "lat0", "lng1", "lat1", "over_500", "over_1k", "over_2k", "worst_m",
        F.when(few, 100).otherwise(half_up(F.greatest(100 - c("_turns") / F.greatest(c("points") - 1, F.lit(1)) * 2000, F.lit(0.0)))).cast("long").alias("smoothness"),
        F.when(few, 0).when(c("crow_m") < 2000, c("_loop")).otherwise(c("_one")).cast("long").alias("walkbacks"), F.when(few, 0).otherwise(c("_turns")).cast("long").alias("sharp_turns"),
        F.when(c("length_m") > 0, whole((1 - c("_inside") / c("length_m")) * 100)).otherwise(100).alias("real_pct"), "runs", whole(c("_inside")).alias("interpolated_m"),
        half_up(km, 1).alias("dist_km"), F.when(km > 0, whole(c("points") / km)).otherwise(0).alias("points_per_km"),
        F.when(few, 100).when(ring, whole(around * 100)).otherwise(whole(straight * 100)).alias("rideability"),
        F.when(few, 0).when(ring, whole(c("length_m") * (1 - around))).otherwise(whole(c("_wasted"))).alias("wasted_m"),
        F.when(c("points") >= 2, F.array_join(F.transform(F.sequence(F.lit(0), c("_blocks") - 1), arrow), " ")).alias("shape"),
    )


def every_nth(points: DataFrame, samples: int = 200) -> DataFrame:
    """The points of each track at equal steps of their number, ``samples`` or a few more of long tracks, all of short ones."""
    full = _order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p = points.withColumns({"_i": F.row_number().over(_order()) - 1, "_n": F.count("*").over(full)})
    return p.where(F.col("_i") % F.greatest(F.floor(F.col("_n") / samples), F.lit(1)) == 0).drop("_i", "_n")


def loop_closure(points: DataFrame, tags: DataFrame) -> DataFrame:
    """(track, closure_m, closed) of tracks tagged 'loop'; tags: (track, tags array<string>)."""
    e = ends(points).join(tags.where(F.array_contains("tags", "loop")).select("track"), "track", "left_semi")
    d = half_up(geo.haversine("lng0", "lat0", "lng1", "lat1"))
    return e.select("track", d.cast("long").alias("closure_m"), (d < 500).alias("closed"))


def resample(points: DataFrame, every_m: float) -> DataFrame:
    """(track, at_m, lng, lat): a point each ``every_m`` metres along the track, interpolated; the start included."""
    s = steps(points).where("step_m > 0")
    start = F.col("cum_m") - F.col("step_m")
    ks = F.sequence(F.ceil(start / every_m).cast("long"), F.floor(F.col("cum_m") / every_m).cast("long"))
    # a point that falls on a vertex belongs to the step that begins there
    ks = F.when(F.ceil(start / every_m) <= F.floor(F.col("cum_m") / every_m), F.filter(ks, lambda k: k * every_m < F.col("cum_m")))
    r = s.select("track", "plng", "plat", "lng", "lat", "step_m", start.alias("_start"), F.explode(ks).alias("_k"))
    t = (F.col("_k") * every_m - F.col("_start")) / F.col("step_m")
    return r.select(
        "track", (F.col("_k") * every_m).alias("at_m"), (F.col("plng") + (F.col("lng") - F.col("plng")) * t).alias("lng"),
        (F.col("plat") + (F.col("lat") - F.col("plat")) * t).alias("lat"),
    )


def point_at(points: DataFrame, wanted: DataFrame) -> DataFrame:
    """(track, at_m, lng, lat) at given distances (track, at_m); beyond the ends the ends."""
    s = steps(points).where("step_m > 0").select("track", "plng", "plat", "lng", "lat", "step_m", "cum_m")
    top = s.groupBy("track").agg(F.max("cum_m").alias("_all"))
    w = wanted.join(top, "track").withColumn("_at", F.greatest(F.least("at_m", "_all"), F.lit(0.0)))
    j = w.join(s, "track").where((F.col("_at") <= F.col("cum_m")) & ((F.col("_at") > F.col("cum_m") - F.col("step_m")) | ((F.col("_at") == 0) & (F.col("cum_m") == F.col("step_m")))))
    t = 1 - (F.col("cum_m") - F.col("_at")) / F.col("step_m")
    return j.select("track", "at_m", (F.col("plng") + (F.col("lng") - F.col("plng")) * t).alias("lng"), (F.col("plat") + (F.col("lat") - F.col("plat")) * t).alias("lat"))


def sample_every(points: DataFrame, every_m: float = 1000.0) -> DataFrame:
    """(track, ord): the first point, and the first vertex past each multiple, one multiple a vertex, and the last."""
    kind = points.schema["track"].dataType.simpleString()
    s = steps(points).select("track", "ord", "cum_m")

    def pick(pdf):
        pdf = pdf.sort_values("ord")
        keep, goal = [0], every_m
        cum = pdf["cum_m"].tolist()
        for i in range(1, len(cum)):
            if cum[i] >= goal:
                keep.append(i)
                goal += every_m
        if keep[-1] != len(cum) - 1:
            keep.append(len(cum) - 1)
        return pdf.iloc[keep][["track", "ord"]]

    return s.groupBy("track").applyInPandas(pick, f"track {kind}, ord bigint")


def retracing(points: DataFrame, radius_m: float = 200.0, apart_m: float = 500.0) -> DataFrame:
    """(track, retraced, retraced_m, length_m): the metres of the steps that end near an earlier point at least
    ``apart_m`` back on the track, as a share of all metres with two digits, and as whole metres.

    Tracks of fewer than five points never retrace. A grid cell as wide as the radius makes the join an equi-join.
    """
    res = radius_m / geo.DEGREE_M
    s = steps(points).withColumn("_n", F.count("*").over(_by())).where("_n >= 5")
    wide = F.ceil(1.0 / F.cos(F.radians(F.floor("lat") + F.when(F.col("lat") >= 0, 1).otherwise(0)))).cast("long")
    p = s.select("track", "ord", "lng", "lat", "cum_m", "step_m", geo.cell("lng", res).alias("_x"), geo.cell("lat", res).alias("_y"), wide.alias("_w"))
    q = p.select("track", F.col("ord").alias("ord2"), F.col("lng").alias("lng2"), F.col("lat").alias("lat2"), F.col("cum_m").alias("cum2"), "_x", "_y")
    p = p.withColumn("_x", F.explode(F.sequence(F.col("_x") - F.col("_w"), F.col("_x") + F.col("_w")))).withColumn("_y", F.explode(F.sequence(F.col("_y") - 1, F.col("_y") + 1)))
    j = p.join(q, ["track", "_x", "_y"]).where((F.col("cum_m") - F.col("cum2") >= apart_m) & (geo.haversine("lng", "lat", "lng2", "lat2") < radius_m))
    hits = j.select("track", "ord", "step_m").distinct().groupBy("track").agg(F.sum("step_m").alias("_hit"))
    n = steps(points).groupBy("track").agg(F.coalesce(F.sum("step_m"), F.lit(0.0)).alias("_all"))
    hit = F.coalesce("_hit", F.lit(0.0))
    return n.join(hits, "track", "left").select(
        "track", F.when(F.col("_all") > 0, half_up(hit / F.col("_all"), 2)).otherwise(0.0).alias("retraced"),
        half_up(hit).cast("long").alias("retraced_m"), half_up("_all").cast("long").alias("length_m"))


def islands(rows: DataFrame, by: str, order: str, key: str) -> DataFrame:
    """Adds island: consecutive rows of one key have one number, counted from 1 along the order."""
    w = Window.partitionBy(by).orderBy(order)
    change = (~F.col(key).eqNullSafe(F.lag(key).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    return rows.withColumn("_c", change).withColumn("island", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_c")


def breaks(points: DataFrame, gap_m: float) -> DataFrame:
    """Adds part: a new part begins after every step over ``gap_m``."""
    s = steps(points).withColumn("_c", F.coalesce(F.col("step_m") > gap_m, F.lit(False)).cast("int"))
    return s.withColumn("part", F.sum("_c").over(_so_far()) + 1).drop("_c")


def longest_run(rows: DataFrame, by: str, order: str, flag: Column) -> DataFrame:
    """(by, run): length of the longest run of rows with the flag."""
    r = islands(rows.withColumn("_f", F.coalesce(flag, F.lit(False))), by, order, "_f").where("_f")
    n = r.groupBy(by, "island").agg(F.count("*").alias("_n")).groupBy(by).agg(F.max("_n").alias("run"))
    return rows.select(by).distinct().join(n, by, "left").select(by, F.coalesce("run", F.lit(0)).alias("run"))


def reversals(lines: DataFrame, turn: float = 120.0) -> DataFrame:
    """(track, reversals, first): turns of more than ``turn`` degrees between consecutive lines (track, ord, lng0, lat0, lng1, lat1)."""
    b = geo.planar_bearing("lng0", "lat0", "lng1", "lat1")
    s = lines.withColumn("_b", b).withColumn("_t", geo.angle_between(F.lag("_b").over(_order()), F.col("_b")) > turn)
    return s.groupBy("track").agg(F.count_if("_t").alias("reversals"), F.min(F.when(F.col("_t"), F.col("ord"))).alias("first"))


def teleports(lines: DataFrame, gap_m: float = 3000.0) -> DataFrame:
    """Adds gap_m to the next line (least of the four pairs of ends) and teleports (gap over the limit)."""
    nxt = {k: F.lead(k).over(_order()) for k in ("lng0", "lat0", "lng1", "lat1")}
    d = [geo.haversine(f"lng{i}", f"lat{i}", nxt[f"lng{j}"], nxt[f"lat{j}"]) for i in (0, 1) for j in (0, 1)]
    return lines.withColumn("gap_m", F.least(*d)).withColumn("teleports", F.coalesce(F.col("gap_m") > gap_m, F.lit(False)))


def valid_trace(lines: DataFrame, every_m: float = 200.0, gap_m: float = 3000.0, limit: float = 0.10) -> DataFrame:
    """(track, valid, reason, worst_gap_m, retraced): no gap over ``gap_m`` between consecutive lines, and no more than
    ``limit`` of the way retraced, told at samples every ``every_m`` metres along the lines.

    lines: (track, ord, lng0, lat0, lng1, lat1). The reason of the first check that fails is a text with its figures.
    """
    t = teleports(lines, gap_m).groupBy("track").agg(F.count_if("teleports").alias("_t"), F.coalesce(F.max("gap_m"), F.lit(0.0)).alias("_gap"))
    ends_ = F.array(F.struct(F.lit(0).alias("k"), F.col("lng0").alias("lng"), F.col("lat0").alias("lat")), F.struct(F.lit(1).alias("k"), F.col("lng1").alias("lng"), F.col("lat1").alias("lat")))
    p = lines.select("track", (F.col("ord").cast("long") * 2).alias("_o"), F.explode(ends_).alias("_p")).select("track", (F.col("_o") + F.col("_p.k")).alias("ord"), "_p.lng", "_p.lat")
    s = resample(p, every_m)
    j = t.join(retracing(s.select("track", (F.col("at_m") / every_m).cast("long").alias("ord"), "lng", "lat")), "track", "left")
    again = F.coalesce("retraced", F.lit(0.0))
    km = lambda c: F.format_string("%.1f", half_up(F.col(c) / 1000, 1))
    whole = lambda c: half_up(c).cast("long").cast("string")
    jump = F.concat(F.lit("teleport: "), F.col("_t").cast("string"), F.lit(f" gap(s) > {gap_m:.0f}m (worst: "), whole(F.col("_gap")), F.lit("m)"))
    back = F.concat(F.lit("retracing: "), whole(again * 100), F.lit("% of route revisits same area ("), km("retraced_m"), F.lit("km of "), km("length_m"), F.lit("km)"))
    reason = F.when(F.col("_t") > 0, jump).when(again > limit, back)
    return j.select("track", reason.isNull().alias("valid"), reason.alias("reason"), F.col("_gap").alias("worst_gap_m"), F.when(F.col("_t") > 0, 0.0).otherwise(again).alias("retraced"))


def transition_penalty(rows: DataFrame, by: str, order: str, level: str) -> DataFrame:
    """(by, penalty): -1.5 for each drop of 3 levels or more, -0.5 for drops of 2, never below -3."""
    w = Window.partitionBy(by).orderBy(order)
    drop = F.lag(level).over(w) - F.col(level)
    p = F.when(drop >= 3, -1.5).when(drop >= 2, -0.5).otherwise(0.0)
    return rows.withColumn("_p", p).groupBy(by).agg(F.greatest(F.sum("_p"), F.lit(-3.0)).alias("penalty"))


def gap_penalty(distance: Column) -> Column:
    """Penalty of one gap in metres; sums of them are capped at 8 by the caller (:func:`gap_totals`)."""
    return F.when(distance < 200, distance / 2000).when(distance < 1000, 0.1 + (distance - 200) / 800).otherwise(1.1 + (distance - 1000) / 500)


def gap_totals(rows: DataFrame, by: str, gap: str, least_m: float = 10.0) -> DataFrame:
    """(by, gaps, gap_sum_m, gap_max_m, penalty) over gaps longer than ``least_m``."""
    g = F.when(F.col(gap) > least_m, F.col(gap))
    return rows.groupBy(by).agg(
        F.count(g).alias("gaps"), F.coalesce(F.sum(g), F.lit(0.0)).alias("gap_sum_m"), F.max(g).alias("gap_max_m"),
        F.least(F.coalesce(F.sum(gap_penalty(g)), F.lit(0.0)), F.lit(8.0)).alias("penalty"),
    )


def densify(points: DataFrame, longer_m: float = 80.0, every_m: float = 50.0) -> DataFrame:
    """(track, ord, sub, lng, lat): steps over ``longer_m`` get evenly spaced points about ``every_m`` apart; sub 0 is a vertex."""
    s = steps(points)
    nxt = {"nlng": F.lead("lng").over(_order()), "nlat": F.lead("lat").over(_order())}
    s = s.withColumns(nxt).withColumn("_d", geo.haversine("lng", "lat", "nlng", "nlat"))
    parts = F.when(F.col("_d") > longer_m, F.ceil(F.col("_d") / every_m)).otherwise(1).cast("int")
    e = s.withColumn("_parts", parts).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    t = F.col("sub") / F.col("_parts")
    at = lambda a, b: F.when(F.col("sub") == 0, F.col(a)).otherwise(F.col(a) + (F.col(b) - F.col(a)) * t)
    return e.select("track", "ord", "sub", at("lng", "nlng").alias("lng"), at("lat", "nlat").alias("lat"))


def fill_elevation(points: DataFrame) -> DataFrame:
    """Fills null ``ele`` by linear interpolation along cum_m between known points; beyond them the nearest known one."""
    s = steps(points)
    back = _order().rowsBetween(Window.unboundedPreceding, 0)
    fore = _order().rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col("ele").isNotNull(), F.struct("ele", "cum_m"))
    s = s.withColumns({"_a": F.last(known, ignorenulls=True).over(back), "_b": F.first(known, ignorenulls=True).over(fore)})
    t = (F.col("cum_m") - F.col("_a.cum_m")) / F.nullif(F.col("_b.cum_m") - F.col("_a.cum_m"), F.lit(0.0))
    mid = F.col("_a.ele") + (F.col("_b.ele") - F.col("_a.ele")) * t
    return s.withColumn("ele", F.coalesce("ele", mid, "_a.ele", "_b.ele")).drop("_a", "_b")
