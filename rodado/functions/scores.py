"""Weighted additive scores as single expressions. Fixed values throughout: weights, limits and caps are given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bands(x: Column, *steps: tuple[float, float], otherwise: float) -> Column:
    """The value of the first step whose limit x doesn't exceed."""
    out = F.lit(otherwise)
    for limit, value in reversed(steps):
        out = F.when(x <= limit, value).otherwise(out)
    return out


def interest(start: Column, end: Column, km: Column, infra_pct: Column, condition: Column, videos: Column, name_points: Column, park_share: Column, loop: Column, towns: Column, zone: Column, gap_max_m: Column) -> Column:
    """How interesting a route is: anchors, length, infrastructure, condition, videos, names, parks, loop, towns, zones, less penalties."""
    length = F.when(km.between(5, 30), 5).when(km.between(2, 40), 3).otherwise(0)
    penalty = F.when(infra_pct < 70, 5).when(infra_pct < 80, 2).otherwise(0) + F.when(gap_max_m > 1000, 3).when(gap_max_m > 500, 1).otherwise(0)
    return (
        (start + end) * 1.5 + length * 2 + F.least(infra_pct / 20, F.lit(5.0)) * 3 + condition + F.least(videos, F.lit(5)) + name_points * 1.5
        + F.least(park_share * 20, F.lit(6.0)) + F.when(loop, 5).otherwise(0) + F.when(towns >= 4, 6).when(towns >= 3, 3).otherwise(0) + zone * 2 - penalty
    )


def path_score(comfort: Column, length_m: Column, crow_m: Column, near_start_m: Column, near_end_m: Column, transitions: Column, covered: Column, amenities: Column) -> Column:
    """How well a path serves a way from start to end; comfort counts as far as the path lies on that way.

    comfort: length-weighted mean of 0..5. transitions: sum of penalties, at most 0. covered: share with any comfort.
    """
    ratio = length_m / F.nullif(crow_m, F.lit(0.0))
    direct = F.coalesce(F.when(ratio.between(0.5, 1.5), 5).when(ratio.between(0.3, 2), 3).when(ratio.between(0.2, 3), 1).otherwise(0), F.lit(0))
    approach = (near_start_m + near_end_m) / F.nullif(crow_m, F.lit(0.0))
    aligned = F.when(approach.isNull(), 0.0).otherwise(_bands(approach, (0.3, 10.0), (0.6, 8.0), (1.0, 6.0), (1.5, 4.0), (2.0, 2.0), otherwise=0.0))
    f = aligned / 10
    return comfort * 2 * f + direct + aligned + F.greatest(transitions, F.lit(-3.0)) * (1 - f) + F.least(covered * 2, F.lit(2.0)) * f + F.least(amenities, F.lit(3))


def zone_interest(magnetism: Column, kinds: Column) -> Column:
    """Of the magnetisms along a route (array, in order, unknown ones 0): the ends in full, those between by half, and 2 for
    each kind beyond the first, up to 6. One zone alone has neither ends nor variety."""
    n = F.size(magnetism)
    known = F.transform(magnetism, lambda v: F.coalesce(v.cast("double"), F.lit(0.0)))
    total = F.aggregate(known, F.lit(0.0), lambda s, v: s + v * 0.5) + (F.try_element_at(known, F.lit(1)) + F.try_element_at(known, F.lit(-1))) * 0.5
    return F.when(n > 1, total + F.least((F.size(F.array_distinct(kinds)) - 1) * 2, F.lit(6))).otherwise(0.0)


def edge_free_share(costs: Column) -> Column:
    """Share of the hops of a path (array of costs) that cost nothing; null for none."""
    return F.size(F.filter(costs, lambda c: c == 0)) / F.nullif(F.size(costs), F.lit(0))
